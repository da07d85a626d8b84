"""Lexical retrieval packing: sequences of a fixed window, filled by a seed
document and its unused BM25 neighbours.

1. *Tokens.* Each text is encoded once (an end id after each) and written to
   the shared folder. Whole windows of long documents are sequences of their
   own; what a document has left, its *tail*, is shorter than a window.
2. *Statistics.* Document frequencies of the token ids and the mean length are
   counted over all documents; a table with a row for each id of the
   vocabulary is broadcast.
3. *Shards.* Tails are range-sorted by the two terms of the document that
   BM25 weighs most, then by a hash, so that lexically close documents lie
   together and a group of copies of any size is split between shards. A
   shard has ``SHARD_DOCS`` documents at most; a task streams its shards one by
   one.
4. *Packing.* A shard has an inverted index of the distinct terms of its whole
   documents (postings with BM25 weights; terms in half of all documents or
   more have the weight 0). A seed's terms are the query; the unused documents
   of the shard follow in order of their score until the window is full. The
   one that doesn't fit is cut, and its rest is the next seed; else the first
   unused document is. What is left of a shard (less than a window) goes on to
   the next one; the last rest of a task is cut into powers of two, which need
   no padding.

``pack`` returns the pieces: (id, start, length, doc_tokens, sequence_id,
offset, score, ids); ``score`` is the BM25 score against the seed (null for
the seed and in whole windows).

Defined results: null and empty texts are the end id alone; each row is packed
by itself, so repeated rows and ids (null ones too) are packed as often as
they occur; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.byte_bpe import encoder
from triage.llm.common import bound_batches, scratch_path

WINDOW, END_ID = 1024, 0
#: documents of a shard, and tokens of tails that a task gets on average
SHARD_DOCS, TASK_TOKENS = 512, 1 << 22
#: BM25's parameters
K1, B = 1.2, 0.75
#: bytes of text encoded together
PIECE_BYTES = 2 << 20
#: sequence ids: task << SEQ_BITS | number; whole windows have their own range
SEQ_BITS, WHOLE = 36, 1 << 62


class Postings:
    """An inverted index of a shard: BM25 weights by term."""

    def __init__(self, terms: list[np.ndarray], counts: list[np.ndarray], lengths: np.ndarray, idf: np.ndarray, mean: float):
        sizes = np.array([len(t) for t in terms], np.int64)
        doc = np.repeat(np.arange(len(terms)), sizes)
        flat = np.concatenate([*terms, np.zeros(0, np.int64)]).astype(np.int64)
        tf = np.concatenate([*counts, np.zeros(0, np.int64)]).astype(np.float64)
        weight = bm25(tf, idf[flat], np.repeat(lengths, sizes), mean)
        keep = weight > 0
        doc, flat, weight = doc[keep], flat[keep], weight[keep]
        self.n = len(terms)
        self.first = np.searchsorted(doc, np.arange(self.n + 1))
        self.of, order = np.unique(flat, return_inverse=True)
        self.query = order  # a document's terms by their place in ``of``
        by_term = np.argsort(order, kind="stable")
        self.start = np.searchsorted(order[by_term], np.arange(len(self.of) + 1))
        self.doc, self.weight = doc[by_term], weight[by_term]

    def keep(self, alive: np.ndarray) -> None:
        """Take the other documents out of the postings."""
        kept = alive[self.doc]
        self.start = np.concatenate([[0], np.cumsum(kept)])[self.start]
        self.doc, self.weight = self.doc[kept], self.weight[kept]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of all documents of the shard for the terms of one."""
        terms = self.query[self.first[seed]:self.first[seed + 1]]
        a, n = self.start[terms], self.start[terms + 1] - self.start[terms]
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def inverse_frequency(df: np.ndarray, docs: int) -> np.ndarray:
    return np.maximum(np.log((docs - df + 0.5) / (df + 0.5)), 0.0)


def bm25(tf: np.ndarray, idf: np.ndarray, length: np.ndarray, mean: float) -> np.ndarray:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def fill(index: Postings, left: np.ndarray, window: int) -> Iterator[list[tuple[int, int, float]]]:
    """Whole windows, as (document, tokens, score) in order, while the shard
    has enough tokens; ``left`` (tokens that each document has left) is worn
    down."""
    rest, at, seed, alive = int(left.sum()), 0, None, len(left)
    while rest >= window:
        if 4 * (now := int(np.count_nonzero(left))) < 3 * alive:
            index.keep(left > 0)
            alive = now
        if seed is None:
            while not left[at]:
                at += 1
            seed = at
        take = min(int(left[seed]), window)
        members, space, cut = [(seed, take, None)], window - take, None
        left[seed] -= take
        if left[seed]:
            cut = seed
        elif space:
            scores = np.where(left > 0, index.scores(seed), -1.0)
            for j in np.argsort(-scores, kind="stable").tolist():
                take = min(int(left[j]), space)
                members.append((j, take, float(scores[j])))
                left[j] -= take
                space -= take
                if not space:
                    cut = j if left[j] else None
                    break
        seed = cut
        rest -= window
        yield members


class Shard:
    """Tails of a shard, their packing, and the pieces made."""

    def __init__(self, window: int, first_id: int, idf: np.ndarray, mean: float):
        self.window, self.next_id, self.idf, self.mean = window, first_id, idf, mean
        self.rows: list[tuple] = []  # (id, doc_tokens, ids of the tail, taken, terms, counts)
        self.tokens = 0
        self.made: list[tuple] = []

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.tokens += len(row[2])

    def _emit(self, members, taken) -> None:
        offset = 0
        for j, n, score in members:
            doc, total, ids = self.rows[j][:3]
            a = int(taken[j])
            self.made.append((doc, total - len(ids) + a, n, total, self.next_id, offset, score, ids[a:a + n]))
            taken[j] += n
            offset += n
        self.next_id += 1

    def pack(self, last: bool) -> None:
        """Pack what is here; the rest stays for the next shard, unless this is the last."""
        if not self.rows:
            return
        taken = np.array([r[3] for r in self.rows], np.int64)
        left = np.array([len(r[2]) for r in self.rows], np.int64) - taken
        if left.sum() >= self.window:
            index = Postings([r[4] for r in self.rows], [r[5] for r in self.rows],
                             np.array([r[1] for r in self.rows], np.float64), self.idf, self.mean)
            for members in fill(index, left, self.window):
                self._emit(members, taken)
        over = int(left.sum())
        if last:
            while over:
                size, members = 1 << (over.bit_length() - 1), []
                over -= size
                for j in np.flatnonzero(left).tolist():
                    n = min(int(left[j]), size)
                    members.append((j, n, None))
                    left[j] -= n
                    size -= n
                    if not size:
                        break
                self._emit(members, taken)
        self.rows = [(*r[:3], int(t), *r[4:]) for r, t, n in zip(self.rows, taken, left) if n]
        self.tokens = int(left.sum())

    def batch(self, kind: pa.DataType) -> pa.RecordBatch:
        made, self.made = self.made, []
        ends = np.concatenate([[0], np.cumsum([len(m[7]) for m in made])]).astype(np.int32)
        ids = np.concatenate([*(m[7] for m in made), np.zeros(0, np.uint32)]).astype(np.int32)
        cols = [pa.array([m[k] for m in made], t) for k, t in enumerate([kind, *[pa.int64()] * 5, pa.float64()])]
        return pa.RecordBatch.from_arrays([*cols, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], PIECES)


PIECES = ["id", "start", "length", "doc_tokens", "sequence_id", "offset", "score", "ids"]


def piece_schema(kind: str) -> str:
    return f"id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, `offset` bigint, score double, ids array<int>"


def tokens(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int, window: int) -> DataFrame:
    """(row, id, n, first, whole, tail, bag) of each row, written to the
    shared folder: a number of the row, the sequence id of its first whole
    window, its ids (two or four bytes each) in whole windows and after them,
    and the distinct ids with their counts (the end id apart)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, row = encoder(tokenizer), TaskContext.get().partitionId() << SEQ_BITS
        next_id = WHOLE + row
        for whole in batches:
            for batch in W.pieces(whole, "_text", PIECE_BYTES):
                flat, n = e.encode(W.column(batch, "_text"))
                ids = np.insert(flat, np.cumsum(n), end_id).astype(width(e.size))
                n = n + 1
                off = np.concatenate([[0], np.cumsum(n)])
                firsts = next_id + np.cumsum(n // window) - n // window
                next_id += int((n // window).sum())
                of, term, count = distinct(ids, off)
                at = np.searchsorted(of, np.arange(len(n) + 1)).tolist()
                term, count = term.astype(ids.dtype), count.astype(np.uint32)
                cut = (off[1:] - n % window).tolist()
                spans = list(zip(off[:-1].tolist(), cut, off[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + np.arange(len(n))), batch.column(0), pa.array(n), pa.array(firsts),
                     pa.array([ids[a:c].tobytes() for a, c, _ in spans], pa.binary()), pa.array([ids[c:z].tobytes() for _, c, z in spans], pa.binary()),
                     pa.array([term[x:y].tobytes() + count[x:y].tobytes() for x, y in zip(at[:-1], at[1:])], pa.binary())],
                    ["row", "id", "n", "first", "whole", "tail", "bag"])
                row += len(n)

    return zstd(rows.mapInArrow(run, f"row bigint, id {kind}, n bigint, first bigint, whole binary, tail binary, bag binary"), "packing-tokens")


def zstd(df: DataFrame, name: str) -> DataFrame:
    """``written``, more compressed."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def width(size: int) -> type:
    return np.uint16 if size <= 1 << 16 else np.uint32


def values_of(batch: pa.RecordBatch, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """A binary column's values as one array, and where each row begins (in
    bytes)."""
    col = W.column(batch, name)
    if not len(col):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    size = np.dtype(dtype).itemsize
    flat = np.frombuffer(data, dtype, (off[-1] - off[0]) // size, off[0]) if data is not None else np.zeros(0, dtype)
    return flat, off - off[0]


def bags_of(batch: pa.RecordBatch, dtype) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the bags of a batch."""
    raw, off = values_of(batch, "bag", np.uint8)
    item = np.dtype(dtype).itemsize
    k = np.diff(off) // (item + 4)
    row = np.repeat(np.arange(len(k)), k)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)

    def at(start, size, kind):
        places = (np.repeat(start, k) + nth * size)[:, None] + np.arange(size)
        return raw[places].reshape(-1).view(kind)
    return row, at(off[:-1], item, dtype).astype(np.int64), at(off[:-1] + k * item, 4, np.uint32)


def distinct(flat: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, count) of the distinct ids of each row, without its end id."""
    n = len(off) - 1
    # row and id in one number, the smaller the faster sorted
    kind, bits = (np.uint32, 16) if flat.dtype == np.uint16 and n <= 1 << 16 else (np.uint64, 32)
    both = np.repeat(np.arange(n, dtype=kind) << kind(bits), np.diff(off)) | flat.astype(kind)
    inner = np.ones(len(flat), bool)
    inner[off[1:] - 1] = False
    both = np.sort(both[inner])
    first = np.flatnonzero(np.diff(both, prepend=~both[:1]))
    count = np.diff(np.append(first, len(both)))
    both = both[first]
    return (both >> kind(bits)).astype(np.int64), (both & kind((1 << bits) - 1)).astype(np.int64), count


def frequencies(made: DataFrame, size: int) -> np.ndarray:
    """In how many rows each token id occurs (the end id, last in a row, isn't
    counted there)."""
    dtype = width(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            if b.num_rows:
                df += np.bincount(bags_of(b, dtype)[1], minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    # a row for each id of the vocabulary at most
    for r in made.select("bag").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


def top_two(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The two terms of the most weight of each of ``n`` rows (ties: the
    smaller term; none: -1); ``row`` ascends, and ``term`` within a row."""
    out, weight = [], weight.copy()
    for _ in range(2):
        best = np.full(n, -1, np.int64)
        if len(row):
            starts = np.flatnonzero(np.diff(row, prepend=-1))
            most = np.repeat(np.maximum.reduceat(weight, starts), np.diff(np.append(starts, len(row))))
            at = np.flatnonzero((weight == most) & (weight >= 0))
            rows, first = np.unique(row[at], return_index=True)
            best[rows] = term[at[first]]
            weight[at[first]] = -1.0
        out.append(best)
    return out[0], out[1]


def keyed(made: DataFrame, shared, window: int, size: int) -> DataFrame:
    """(a, b, salt, id, n, tail, bag) of the rows with a tail, written: the
    two terms of the most weight, the tail's ids, and the terms and counts of
    the whole row if it is longer than the tail."""
    dtype = width(size)
    kind = made.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            n = W.column(b, "n").to_numpy()
            row, term, count = bags_of(b, dtype)
            x, y = top_two(row, term, bm25(count.astype(np.float64), idf[term], n[row].astype(np.float64), mean), len(n))
            # a short document's bag is found again from its tail
            bag = pc.if_else(pa.array(n > window), W.column(b, "bag"), pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int32()), pa.array(y, pa.int32()), *(W.column(b, c) for c in ("salt", "id", "n", "tail")), bag],
                                             ["a", "b", "salt", "id", "n", "tail", "bag"])

    rows = made.where(F.col("n") % window > 0).select("id", "n", "tail", "bag", F.xxhash64("row").alias("salt"))
    # written, as a range sort reads its input twice
    return zstd(rows.mapInArrow(run, f"a int, b int, salt bigint, id {kind}, n bigint, tail binary, bag binary"), "packing-tails")


def bag_of(ids: np.ndarray, bag: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Terms and counts of a row of ``keyed``."""
    if bag is None:
        return np.unique(ids[:-1], return_counts=True)
    n = len(bag) // (ids.itemsize + 4)
    return np.frombuffer(bag, ids.dtype, n), np.frombuffer(bag, np.uint8)[n * ids.itemsize:].view(np.uint32)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
         window: int = WINDOW, shard_docs: int = SHARD_DOCS, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """The pieces of all documents (see above)."""
    spark = docs.sparkSession
    bound_batches(spark)
    size = encoder(tokenizer).size
    made = tokens(docs, tokenizer, id_col, text_col, end_id, window)
    kind = made.schema["id"].dataType.simpleString()
    total = made.agg(F.count("*").alias("docs"), F.sum("n").alias("n"), F.sum(F.col("n") % window).alias("tails")).first()
    shared = spark.sparkContext.broadcast((inverse_frequency(frequencies(made, size), total.docs), (total.n or 1) / max(total.docs, 1)))
    dtype, names = width(size), PIECES

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, first = W.column(b, "n").to_numpy(), W.column(b, "first").to_numpy()
            k = n // window
            row = np.repeat(np.arange(len(n)), k)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
            ids = values_of(b, "whole", dtype)[0].astype(np.int32)
            ends = np.arange(len(row) + 1, dtype=np.int32) * window
            yield pa.RecordBatch.from_arrays(
                [W.column(b, "id").take(pa.array(row)), pa.array(nth * window), pa.array(np.full(len(row), window)), pa.array(n[row]),
                 pa.array(first[row] + nth), pa.array(np.zeros(len(row), np.int64)), pa.nulls(len(row), pa.float64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], names)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = shared.value
        shard, kind = Shard(window, TaskContext.get().partitionId() << SEQ_BITS, idf, mean), None
        for b in batches:
            kind = b.schema.field("id").type
            for doc, n, tail, bag in zip(*(W.column(b, c).to_pylist() for c in ("id", "n", "tail", "bag"))):
                ids = np.frombuffer(tail, dtype)
                shard.add((doc, n, ids, 0, *bag_of(ids, bag)))
                if len(shard.rows) >= shard_docs:
                    shard.pack(last=False)
                    yield shard.batch(kind)
        if kind is not None:
            shard.pack(last=True)
            yield shard.batch(kind)

    windows = made.where(F.col("n") >= window).select("id", "n", "first", "whole").mapInArrow(whole, piece_schema(kind))
    parts = max(1, -(-(total.tails or 0) // task_tokens))
    order = ["a", "b", "salt"]
    tails = (keyed(made, shared, window, size).repartitionByRange(parts, *order).sortWithinPartitions(*order)
             .mapInArrow(packed, piece_schema(kind)))
    return windows.unionByName(tails)
