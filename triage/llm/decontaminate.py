"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The text's symbols are its words. All windows of 13 consecutive words of the
benchmark items are the patterns (a shorter item is one pattern), grouped by
length. For a group of length m a search walks each text with a cursor on
the last word of the current m-word span:

* the *shift table* says, for the block of the last words under the cursor,
  how far the cursor may move without passing an occurrence (a block that no
  pattern has moves it by m - block + 1 words);
* at shift 0 the *suffix bucket* of that block names the patterns that end
  in it, a hash of their first block sorts out most, and
* the words are compared directly, first as hashes, then as bytes.

All texts of a batch are walked at once (one numpy lane for each piece of
``LANE`` words). Patterns are broadcast in blocks of about ``BLOCK_WORDS`` item
words; more blocks mean more passes over the documents, each merging its
occurrences into the row, without a shuffle. A long item is cut into pieces
that overlap by a window less one word, so that no item outgrows a block: the
pieces have the item's windows, each once.

Defined results: null and empty texts, or texts without a word, have no
words, no hits and are clean; null or wordless items match nothing; a null
item id is reported as the empty string; repeated items count once by id;
an empty benchmark leaves every document clean. Output columns replace input
columns of the same name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, written

WINDOW = 13
BLOCK = 3
LANE = 256
TABLE_BITS = 18
#: item words whose patterns are broadcast together (about 40 MB of tables)
BLOCK_WORDS = 200_000
PASSES_IN_A_JOB = 3
#: a block has room for this many of the largest pieces
PIECES_IN_A_BLOCK = 8
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OUT = ("decon_n_words", "decon_spans", "decon_items")


def block_hash(h: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that end at each index of ``last``."""
    out = h[last - (n - 1)].copy()
    for k in range(n - 2, -1, -1):
        out = out * W.U64(W.BASE) + h[last - k]
    return W.mix(out)


class PatternGroup:
    """Patterns of one length: shift table, suffix buckets, words."""

    def __init__(self, patterns: list[tuple[bytes, ...]], items: list[list[str]]):
        self.patterns, self.items = patterns, items
        self.length = m = len(patterns[0])
        self.block = b = min(BLOCK, m)
        flat = b"".join(w for p in patterns for w in p)
        sizes = np.array([len(w) for p in patterns for w in p])
        ends = np.cumsum(sizes)
        self.words = W.hashes(np.frombuffer(flat, np.uint8), ends - sizes, ends).reshape(-1, m)
        self.shift = np.full(1 << TABLE_BITS, m - b + 1, np.uint8)
        line, base = self.words.reshape(-1), np.arange(len(patterns)) * m
        for last in range(b - 1, m):
            at = block_hash(line, base + last, b) & W.U64((1 << TABLE_BITS) - 1)
            np.minimum.at(self.shift, at.astype(np.int64), m - 1 - last)
        suffix = block_hash(line, base + m - 1, b)
        self.order = np.argsort(suffix, kind="stable")
        self.suffix = suffix[self.order]
        self.prefix = block_hash(line, base + b - 1, b)

    def search(self, h: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of each place where all hashes agree."""
        m, b = self.length, self.block
        first, stop = bounds[:-1] + m - 1, bounds[1:]
        count = np.maximum(0, -(-(stop - first) // LANE))
        lane = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        cur = np.repeat(first, count) + lane * LANE
        end = np.minimum(cur + LANE, np.repeat(stop, count))
        at, pattern = [], []
        while len(cur):
            key = block_hash(h, cur, b)
            step = self.shift[(key & W.U64((1 << TABLE_BITS) - 1)).astype(np.int64)]
            zero = np.flatnonzero(step == 0)
            if len(zero):
                lo = np.searchsorted(self.suffix, key[zero], "left")
                n = np.searchsorted(self.suffix, key[zero], "right") - lo
                if n.any():
                    where = np.repeat(cur[zero], n) - (m - 1)
                    which = self.order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
                    same = block_hash(h, where + b - 1, b) == self.prefix[which]
                    where, which = where[same], which[same]
                    same = (h[where[:, None] + np.arange(m)] == self.words[which]).all(axis=1)
                    at.append(where[same])
                    pattern.append(which[same])
            cur = cur + np.maximum(step, 1)
            on = cur < end
            cur, end = cur[on], end[on]
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *at]), np.concatenate([none, *pattern])


def pattern_groups(items: list[tuple[str, str | None]], window: int) -> list[PatternGroup]:
    """The distinct windows of (id, text) items, by length."""
    found: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        data = W.LOWER[np.frombuffer((text or "").encode(), np.uint8)]
        spans = W.runs(W.LETTER_DIGIT[data], np.array([0, len(data)]))
        raw = data.tobytes()
        ws = [raw[s:e] for s, e in zip(spans.starts, spans.ends)]
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            found[tuple(ws[i:i + window])].add(item)
    by_length: dict[int, list[tuple[bytes, ...]]] = defaultdict(list)
    for p in sorted(found):
        by_length[len(p)].append(p)
    return [PatternGroup(ps, [sorted(found[p]) for p in ps]) for _, ps in sorted(by_length.items())]


def scan(batch: pa.RecordBatch, text_col: str, groups: list[PatternGroup]) -> tuple[np.ndarray, list, list]:
    """Words of each text, hit word ranges (merged) and items found."""
    raw, off = W.texts(W.column(batch, text_col))
    data = W.LOWER[raw]
    ws = W.runs(W.LETTER_DIGIT[data], off)
    h = W.hashes(data, ws.starts, ws.ends)
    body = data.tobytes()
    spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
    items: dict[int, set[str]] = defaultdict(set)
    for g in groups:
        at, which = g.search(h, ws.bounds)
        text = np.searchsorted(ws.bounds, at, "right") - 1
        for a, p, t in zip(at.tolist(), which.tolist(), text.tolist()):
            if all(body[s:e] == w for s, e, w in zip(ws.starts[a:a + g.length], ws.ends[a:a + g.length], g.patterns[p])):
                first = a - int(ws.bounds[t])
                spans[t].append((first, first + g.length))
                items[t].update(g.items[p])
    n = batch.num_rows
    return (np.diff(ws.bounds), [merge(spans[t]) if t in spans else [] for t in range(n)],
            [sorted(items[t]) if t in items else [] for t in range(n)])


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _as_arrow(batch, names, n_words, spans, items):
    cols = [*batch.columns[:len(names)], pa.array(n_words, pa.int64()),
            pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], SPANS),
            pa.array(items, pa.list_(pa.string()))]
    return pa.RecordBatch.from_arrays(cols, [*names, *OUT])


def item_pieces(items: DataFrame, window: int, most: int) -> DataFrame:
    """(i, t) of items, those of more than ``most`` characters cut into
    pieces of at most ``most`` words (no fewer than a window)."""
    most = max(most, window)
    lower = F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    ws = F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))
    step = most - window + 1
    starts = F.sequence(F.lit(0), F.greatest(F.size("_ws") - window, F.lit(0)), F.lit(step))
    pieces = F.transform(starts, lambda s: F.array_join(F.slice("_ws", s + 1, most), " "))
    is_long = F.length("t") > most
    short = items.where(~is_long)
    cut = items.where(is_long).select("i", ws.alias("_ws")).select("i", F.explode(pieces).alias("t"))
    return short.select("i", "t").unionByName(cut)


def find_passages(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``decon_n_words``, ``decon_spans`` (merged ranges of hit
    words, end exclusive) and ``decon_items`` (ids found, as strings)."""
    spark = docs.sparkSession
    bound_batches(spark)
    bench = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"),
                             F.col(item_text).alias("t")).where("t is not null")
    # copies of a row have one hash, and would meet in one block
    bench = written(item_pieces(bench, window, block_words // PIECES_IN_A_BLOCK).distinct(), "benchmark")
    total = bench.agg(F.sum(F.length("t") / 2 + 1)).first()[0] or 0  # no fewer than its words
    blocks = max(1, int(-(-total // block_words)))
    kept = [c for c in docs.columns if c not in OUT]
    out = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema.fields),
                        "decon_n_words bigint", "decon_spans array<struct<start:int,end:int>>",
                        "decon_items array<string>"])
    for b in range(blocks):
        part = bench.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b) if blocks > 1 else bench
        shared = spark.sparkContext.broadcast(pattern_groups([(r.i, r.t) for r in part.collect()], window))

        def search(batches: Iterator[pa.RecordBatch], shared=shared, again=b > 0) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in W.pieces(whole, text_col):
                    n_words, spans, items = scan(batch, text_col, shared.value)
                    if again:
                        for t, (old, ids) in enumerate(zip(W.column(batch, "decon_spans").to_pylist(),
                                                           W.column(batch, "decon_items").to_pylist())):
                            spans[t] = merge([*((x["start"], x["end"]) for x in old), *spans[t]])
                            items[t] = sorted({*ids, *items[t]})
                    yield _as_arrow(batch, kept, n_words, spans, items)

        out = out.mapInArrow(search, schema)
        if b % PASSES_IN_A_JOB == PASSES_IN_A_JOB - 1 and b + 1 < blocks:
            out = written(out, "decontaminate")
    return out


def n_hit():
    return F.aggregate("decon_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])


def contaminated():
    """The contract's rule: some word is hit, and a twentieth of the words
    or more."""
    return (n_hit() > 0) & (n_hit() * 20 >= F.col("decon_n_words"))
