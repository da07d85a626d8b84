"""Quality rules with an isolation forest over rule statistics.

One pass over the texts makes a narrow table of rule statistics (words,
symbols, repeated lines and word windows, shapes of words). The forest is
grown on a bounded sample of documents that are labelled good: each tree
splits ``TREE_ROWS`` of them at random values of random statistics, drawn
over the box that all documents span, so that a statistic that never varies
among good documents still sets others apart. A document that few splits set
apart from them has a short mean path and is anomalous. The threshold on the path score is calibrated on the labelled
rows: of the thresholds that drop at most ``MOST_GOOD_DROPPED`` of the good
ones, that which drops most of the bad ones.

Defined results: a null, empty or wordless text has no words, all statistics
0, and fails the base rule; without good labels the forest is grown on all
rows; without bad labels nothing is dropped by the forest; null label ids are
ignored and repeated label rows count as they occur. Statistics cover whole
texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, unit_hash, written

#: bound of the sample that the forest is grown on
SAMPLE_ROWS = 20_000
TREES, TREE_ROWS = 120, 256
MOST_GOOD_DROPPED = 0.005
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SHAPES = ("symbol_share", "mean_word", "upper_share", "digit_share", "mark_share", "dup_line_share",
          "repeat_share", "distinct_share", "long_word_share", "words_per_line", "top_word_share")


def duplicates(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Marks of keys that occur earlier in the same text."""
    order = np.lexsort((np.arange(len(keys)), keys, text))
    k, t = keys[order], text[order]
    again = np.zeros(len(keys), bool)
    again[order[1:]] = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
    return again


def statistics(col: pa.Array) -> dict[str, np.ndarray]:
    """Rule statistics of each text of a string column."""
    data, off = W.texts(col)
    n = len(off) - 1
    ws = W.runs(W.NOT_SPACE[data], off)
    h, text = W.hashes(data, ws.starts, ws.ends), ws.text_of()
    count = np.diff(ws.bounds)

    def in_text(mark: np.ndarray) -> np.ndarray:
        return W.per_text(mark, off)

    def table(chars: bytes) -> np.ndarray:
        t = np.zeros(256, bool)
        t[list(chars)] = True
        return t

    first = (data & 0xC0) != 0x80
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(first, out=chars[1:])
    length = chars[ws.ends] - chars[ws.starts]
    # lines: the bytes between \n; only those with a word count
    line_start = np.zeros(len(data) + 1, bool)
    line_start[off] = True
    line_start[np.flatnonzero(data == 0x0A) + 1] = True
    starts = np.flatnonzero(line_start[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    ends = np.where(ends > starts, ends - (data[np.maximum(ends, 1) - 1] == 0x0A), ends) if len(starts) else ends
    has_word = np.zeros(len(starts), bool)
    if len(ws.starts):
        has_word[np.searchsorted(starts, ws.starts, "right") - 1] = True
    starts, ends = starts[has_word], ends[has_word]
    line_text = np.searchsorted(off, starts, "right") - 1
    dup_line = duplicates(W.hashes(data, starts, ends), line_text)
    n_lines = np.bincount(line_text, minlength=n)
    # 5-word windows that occur twice or more: all words in them
    win = W.windows(h, REPEAT_WINDOW)
    inside = text[:len(win)] == text[REPEAT_WINDOW - 1:] if len(win) else np.zeros(0, bool)
    spot = np.flatnonzero(inside)
    cover = np.zeros(len(h) + 1, np.int64)
    if len(spot):
        order = np.lexsort((win[spot], text[spot]))
        k, t = win[spot][order], text[spot][order]
        same = (k[1:] == k[:-1]) & (t[1:] == t[:-1])
        twice = spot[order[np.append(same, False) | np.insert(same, 0, False)]]
        np.add.at(cover, twice, 1)
        np.add.at(cover, twice + REPEAT_WINDOW, -1)
    repeated = np.cumsum(cover)[:-1] > 0
    order = np.lexsort((h, text))
    hs, ts = h[order], text[order]
    new = np.ones(len(hs), bool)
    new[1:] = (hs[1:] != hs[:-1]) | (ts[1:] != ts[:-1])
    distinct = np.bincount(ts[new], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(new), len(hs)))
    top = np.zeros(n, np.int64)
    np.maximum.at(top, ts[new], runs)

    c = {"n_words": count, "word_chars": W.per_text(length, ws.bounds), "n_symbols": in_text(table(SYMBOLS)[data]),
         "n_dup_lines": np.bincount(line_text, weights=dup_line, minlength=n).astype(np.int64),
         "n_repeat_words": W.per_text(repeated, ws.bounds)}
    words_, chars_ = np.maximum(count, 1), np.maximum(c["word_chars"], 1)
    upper = np.zeros(256, bool)
    upper[0x41:0x5B] = True
    digit = np.zeros(256, bool)
    digit[0x30:0x3A] = True
    shapes = {
        "symbol_share": c["n_symbols"] / chars_, "mean_word": c["word_chars"] / words_,
        "upper_share": in_text(upper[data]) / chars_, "digit_share": in_text(digit[data]) / chars_,
        "mark_share": in_text(table(b"!?:;=\"'()[]{}_/\\~^@")[data]) / chars_,
        "dup_line_share": c["n_dup_lines"] / np.maximum(n_lines, 1), "repeat_share": c["n_repeat_words"] / words_,
        "distinct_share": distinct / np.sqrt(words_), "long_word_share": W.per_text(length > 15, ws.bounds) / words_,
        "words_per_line": np.log1p(count / np.maximum(n_lines, 1)), "top_word_share": top / words_,
    }
    return c | {k: v.astype(np.float64) for k, v in shapes.items()}


def rule_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, shapes) of each document."""
    bound_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in W.pieces(whole, "_text"):
                s = statistics(W.column(batch, "_text"))
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(s[c]) for c in (*COUNTS, *SHAPES))],
                                                 ["_id", *COUNTS, *SHAPES])

    schema = ", ".join([f"_id {kind}", *(f"{c} bigint" for c in COUNTS), *(f"{c} double" for c in SHAPES)])
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)
            .withColumnRenamed("_id", id_col))


class Forest:
    """Trees as arrays: split statistic, split value, children, leaf paths."""

    def __init__(self, x: np.ndarray, box: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.rows = min(rows, len(x))
        self.depth = max(1, int(np.ceil(np.log2(max(self.rows, 2)))))
        size = 2 ** (self.depth + 1) - 1  # a heap: children of i are 2i+1 and 2i+2
        self.feature = np.full((trees, size), -1, np.int32)
        self.value = np.zeros((trees, size))
        self.path = np.zeros((trees, size))
        for t in range(trees):
            self._grow(t, 0, x[rng.choice(len(x), self.rows, replace=False)], 0, rng, box[0].copy(), box[1].copy())

    @staticmethod
    def expected(n: int) -> float:
        """Mean path in a random search tree of n rows."""
        return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n

    def _grow(self, t, node, x, depth, rng, lo, hi):
        wide = np.flatnonzero(hi > lo)
        if depth >= self.depth or len(x) == 0 or not len(wide):
            self.path[t, node] = depth + self.expected(len(x))
            return
        f = rng.choice(wide)
        v = rng.uniform(lo[f], hi[f])
        self.feature[t, node], self.value[t, node] = f, v
        left = x[:, f] <= v
        below, above = hi.copy(), lo.copy()
        below[f] = above[f] = v
        self._grow(t, 2 * node + 1, x[left], depth + 1, rng, lo, below)
        self._grow(t, 2 * node + 2, x[~left], depth + 1, rng, above, hi)

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** -(mean path / expected path): near 1 for anomalies."""
        total, row = np.zeros(len(x)), np.arange(len(x))
        for feature, value, path in zip(self.feature, self.value, self.path):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                go = 2 * node + 1 + (x[row, np.maximum(f, 0)] > value[node])
                node = np.where(f >= 0, go, node)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / max(self.expected(self.rows), 1.0))


def anomaly_scores(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality",
                   sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``stats`` with ``anomaly``, by a forest grown on documents labelled
    good."""
    lab = labels.select(F.col("doc_id").alias("_lid"), F.col(good).alias("_good")).where("_lid is not null")
    rows = stats.join(lab.where("_good = 1").select("_lid").distinct(), F.col(id_col) == F.col("_lid"), "left_semi")
    n = rows.count()
    if n < 2:
        rows, n = stats, stats.count()
    share = min(1.0, sample_rows / max(n, 1))
    x = np.array([tuple(r) for r in rows.where(unit_hash(id_col, 11) < share).select(*SHAPES).orderBy(*SHAPES).limit(2 * sample_rows).collect()])
    if len(x) == 0:
        return stats.withColumn("anomaly", F.lit(0.0))
    ends = stats.agg(*(F.percentile_approx(c, [0.001, 0.999], 1000).alias(c) for c in SHAPES)).first()
    box = np.array([ends[c] for c in SHAPES]).T
    forest = stats.sparkSession.sparkContext.broadcast(Forest(x, np.stack([np.minimum(box[0], x.min(axis=0)), np.maximum(box[1], x.max(axis=0))])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = np.stack([W.column(b, c).to_numpy(zero_copy_only=False) for c in SHAPES], axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(forest.value.score(v))], [*b.schema.names, "anomaly"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema.fields), "anomaly double"])
    return stats.mapInArrow(run, schema)


def base_failed():
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def threshold(scored: DataFrame, labels: DataFrame, id_col: str = "doc_id", good: str = "quality",
              most_good_dropped: float = MOST_GOOD_DROPPED) -> float:
    """The anomaly from which on documents that pass the base rule are dropped
    (1.0: none are)."""
    lab = labels.select(F.col("doc_id").alias("_lid"), F.col(good).cast("int").alias("_good")).where("_lid is not null and _good is not null")
    bins = (scored.where(~base_failed()).join(lab, F.col(id_col) == F.col("_lid"))
            .groupBy(F.floor(F.col("anomaly") * 1000).alias("bin"))
            .agg(F.sum("_good").alias("good"), F.sum(1 - F.col("_good")).alias("bad")).orderBy(F.desc("bin")).collect())
    all_good, good_out, bad_out, best = sum(b.good for b in bins), 0, 0, (0, 1.0)
    for b in bins:
        good_out, bad_out = good_out + b.good, bad_out + b.bad
        if good_out <= most_good_dropped * all_good and bad_out > best[0]:
            best = (bad_out, b.bin / 1000)
    return best[1]


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """(id, counts, shapes, anomaly, base_failed, kept) of each document."""
    stats = written(rule_statistics(docs, id_col, text_col), "rule-stats")
    scored = written(anomaly_scores(stats, labels, id_col, **options), "rule-scores")
    cut = threshold(scored, labels, id_col)
    return scored.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(cut)))
