"""Quality classifier: a factorisation machine.

Features of a text are its distinct hashed words (each 1/sqrt of their
number), its structure statistics (those of the quality rules, each in the
bin of a quantile grid learned from the sample) and metadata columns (the bin
of their logarithm). The score is

    sigmoid(w0 + sum w_i x_i + 1/2 sum_f ((sum v_if x_i)^2 - sum v_if^2 x_i^2))

so that all pairwise interactions cost time linear in the features.

The model is fitted on at most about ``SAMPLE_ROWS`` labelled rows outside
the held-out fold, in one task, by AdaGrad on the logistic loss; its size is
fixed by ``BUCKETS`` and ``FACTORS`` and it is broadcast. Scoring is one pass
without a shuffle.

Defined results: a null, empty or wordless text is scored by its statistics
(all 0); null metadata have a bin of their own; with no labelled rows, or of
one class only, every score is that class's share (1/2 without rows). Ids,
labels, language and source are never features.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, labelled_sample
from triage.llm.rule_forest import SHAPES, statistics

SAMPLE_ROWS = 8_000
BUCKETS, FACTORS, BINS = 1 << 16, 8, 12
EPOCHS, MINIBATCH, RATE, DECAY = 8, 128, 0.08, 2e-5
NAMES = (*SHAPES, "n_words", "n_lines_marked")


def raw_features(batch: pa.RecordBatch, metadata: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets and their text (distinct in it), and the table of
    statistics and metadata."""
    col = W.column(batch, "_text")
    s = statistics(col)
    raw, off = W.texts(col)
    data = W.LOWER[raw]
    ws = W.runs(W.NOT_SPACE[data], off)
    bucket = (W.hashes(data, ws.starts, ws.ends) % W.U64(BUCKETS)).astype(np.int64)
    key = np.unique(ws.text_of() * BUCKETS + bucket)
    dense = [s[c] for c in SHAPES] + [np.log1p(s["n_words"]), s["n_dup_lines"] > 0]
    for m in metadata:
        v = W.column(batch, m).to_numpy(zero_copy_only=False).astype(np.float64)
        dense.append(np.where(np.isnan(v), -1.0, np.log2(1 + np.maximum(v, 0))))
    return key % BUCKETS, key // BUCKETS, np.stack(dense, axis=1).astype(np.float64)


class Machine:
    """Weights, factors and the grid of the statistics' bins."""

    def __init__(self, grid: np.ndarray, seed: int = 3):
        self.grid = grid  # statistics x inner edges
        rng = np.random.default_rng(seed)
        n = BUCKETS + len(grid) * (grid.shape[1] + 1)
        self.bias, self.w = 0.0, np.zeros(n, np.float32)
        self.v = rng.normal(0, 0.02, (n, FACTORS)).astype(np.float32)

    def rows(self, bucket, text, dense):
        """All features of texts, by text: index, value and first of each."""
        n, k = dense.shape
        bins = np.stack([np.searchsorted(self.grid[j], dense[:, j], "right") for j in range(k)], axis=1)
        own = BUCKETS + np.arange(k) * (self.grid.shape[1] + 1) + bins
        count = np.bincount(text, minlength=n)
        first = np.arange(n) * k + np.cumsum(count) - count
        index, value = np.empty(len(bucket) + n * k, np.int64), np.ones(len(bucket) + n * k, np.float32)
        at = (first[:, None] + np.arange(k)).reshape(-1)
        index[at] = own.reshape(-1)
        rest = np.ones(len(index), bool)
        rest[at] = False
        index[rest] = bucket
        value[rest] = (1 / np.sqrt(np.maximum(count, 1)))[text]
        return index, value, first

    def margin(self, index, value, first):
        vx = self.v[index] * value[:, None]
        total = np.add.reduceat(vx, first)
        square = np.add.reduceat(np.einsum("ij,ij->i", vx, vx), first)
        linear = np.add.reduceat(self.w[index] * value, first)
        return self.bias + linear + 0.5 * (np.einsum("ij,ij->i", total, total) - square), vx, total

    def score(self, index, value, first):
        return 1 / (1 + np.exp(-np.clip(self.margin(index, value, first)[0], -30, 30)))

    def fit(self, bucket, text, dense, y, seed: int = 5) -> None:
        index, value, first = self.rows(bucket, text, dense)
        ends = np.append(first[1:], len(index))
        rng = np.random.default_rng(seed)
        gw, gv, gb = np.full(len(self.w), 1e-6, np.float32), np.full(self.v.shape, 1e-6, np.float32), 1e-6
        mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(mean / (1 - mean)))
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(y), MINIBATCH):
                part = order[i:i + MINIBATCH]
                n = ends[part] - first[part]
                at = np.repeat(first[part] - (np.cumsum(n) - n), n) + np.arange(n.sum())
                ix, x, f = index[at], value[at], np.cumsum(n) - n
                margin, vx, total = self.margin(ix, x, f)
                g = np.repeat((1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y[part]) / len(part), n).astype(np.float32)
                dw, dv = g * x, (g * x)[:, None] * (np.repeat(total, n, axis=0) - vx)
                seen, inverse = np.unique(ix, return_inverse=True)
                sw = np.bincount(inverse, dw).astype(np.float32) + DECAY * self.w[seen]
                sv = np.stack([np.bincount(inverse, dv[:, j]) for j in range(FACTORS)], axis=1).astype(np.float32) + DECAY * self.v[seen]
                gw[seen] += sw ** 2
                gv[seen] += sv ** 2
                self.w[seen] -= RATE * sw / np.sqrt(gw[seen])
                self.v[seen] -= RATE * 0.5 * sv / np.sqrt(gv[seen])
                d = float((g[f] if len(f) else g).sum())
                gb += d * d
                self.bias -= RATE * d / gb ** 0.5


def _prepared(docs: DataFrame, text_col: str, metadata: tuple[str, ...], *more) -> DataFrame:
    return docs.select(F.col(text_col).alias("_text"), *(F.col(m).cast("double").alias(f"_m{i}") for i, m in enumerate(metadata)), *more)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held_out: int = 0,
        text_col: str = "text", metadata: tuple[str, ...] = ("n_chars",), sample_rows: int = SAMPLE_ROWS) -> Machine | float:
    """The machine, or the share of positive rows if they can't train one."""
    bound_batches(docs.sparkSession)
    names = tuple(f"_m{i}" for i in range(len(metadata)))
    rows = _prepared(labelled_sample(docs, labels, label, folds, held_out, sample_rows), text_col, metadata, "_y")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "_text"):
                bucket, text, dense = raw_features(b, names)
                ends = np.searchsorted(text, np.arange(b.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [W.column(b, "_y"), pa.ListArray.from_arrays(pa.array(ends), pa.array(bucket.astype(np.int32))),
                     pa.array(dense.tolist(), pa.list_(pa.float64()))], ["y", "bucket", "dense"])

    sample = rows.mapInArrow(extract, "y int, bucket array<int>, dense array<double>")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        t = pa.Table.from_batches(list(batches))
        if t.num_rows:
            y = t["y"].to_numpy().astype(np.float64)
            out: Machine | float = float(y.mean())
            if 0 < out < 1:
                lists = t["bucket"].combine_chunks()
                bucket = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                text = np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy(zero_copy_only=False))
                dense = np.array(t["dense"].to_pylist())
                grid = np.quantile(dense, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
                model = Machine(grid)
                model.fit(bucket, text, dense, y)
                out = (model.grid, model.bias, model.w, model.v)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(out)], pa.binary())], ["model"])

    # the bounded sample, in an order of its own, goes to one task
    one = sample.repartition(1).sortWithinPartitions(F.xxhash64("bucket", "dense"), "y")
    got = one.mapInArrow(train, "model binary").collect()
    if not got:
        return 0.5
    import pickle

    out = pickle.loads(got[0].model)
    if isinstance(out, float):
        return out
    model = Machine(out[0])
    _, model.bias, model.w, model.v = out
    return model


def score(docs: DataFrame, model: Machine | float, text_col: str = "text",
          metadata: tuple[str, ...] = ("n_chars",), out_col: str = "fm_score") -> DataFrame:
    """``docs`` without its text, with the score."""
    bound_batches(docs.sparkSession)
    kept = [f for f in docs.schema.fields if f.name not in (text_col, out_col)]
    names = tuple(f"_m{i}" for i in range(len(metadata)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "_text"):
                m = shared.value
                out = np.full(b.num_rows, m) if isinstance(m, float) else m.score(*m.rows(*raw_features(b, names)))
                yield pa.RecordBatch.from_arrays([*(W.column(b, f.name) for f in kept), pa.array(out.astype(np.float64))],
                                                 [*(f.name for f in kept), out_col])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), f"`{out_col}` double"])
    return _prepared(docs, text_col, metadata, *(F.col(f"`{f.name}`") for f in kept)).mapInArrow(run, schema)
