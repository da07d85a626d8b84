"""Token ids as ORC: range-sorted stripes with row indexes and Bloom filters.

``write_tokens`` deals the documents out by ranges of their id, sorts each
part, encodes it with a public tokenizer and writes one ORC file for a part:
(doc_id, part_start, n_tokens, ids). ORC stores the ids by integer run-length
encoding in stripes with a row index (least and largest doc_id of each row
group) and a Bloom filter on doc_id, so that readers take stripes in parallel
and a lookup by id skips files, stripes and row groups by their metadata.
``part_start`` is the running number of ids in the part, made while the rows
stream by; ``read_tokens`` adds the totals of the parts before, a table with
one row for each part.

A text is encoded chunk by chunk between ASCII white space, which the
tokenizer drops and never joins across. The ids of a chunk are kept under its
64-bit hash, so that a frequent chunk is a lookup in a sorted array; of a new
one, each piece of the tokenizer's split goes to the library's BPE model. A
chunk beyond ASCII and Latin-1 letters goes to the library whole. Strings of
special tokens in a text are ordinary text.

Defined results: a null or empty text is only the end id; null ids come
first; repeated ids are ordered by their texts; an empty table gives an empty
file set that reads as no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches

END_ID = 1
STRIPE_BYTES = 16 << 20
#: distinct chunks and pieces whose ids a worker keeps, and the longest one kept
CACHE, PIECES, CACHE_CHARS = 1_500_000, 200_000, 60
#: bytes of text that are encoded together
PIECE_BYTES = 4 << 20
#: chunks of printable ASCII and Latin-1 letters: composed already, and lower-cased letter by letter
SIMPLE = re.compile(r"[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
#: the tokenizer's own split (fixed), for lower-case simple chunks
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z\xdf-\xf6\xf8-\xff0-9]+").findall

#: the file's rules (fixed values) for which texts may be cut at ASCII white space and pieces be split by ``PIECE``
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


class Known:
    """Ids by 64-bit chunk hash: sorted keys, and their ids' place in one
    array."""

    def __init__(self):
        none = np.zeros(0, np.int64)
        self.keys, self.at, self.n, self.ids = np.zeros(0, np.uint64), none, none, np.zeros(0, np.int32)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of ascending keys, and whether they are there."""
        i = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        return i, (self.keys[i] == keys if len(self.keys) else np.zeros(len(keys), bool))

    def add(self, keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        keys, at = np.concatenate([self.keys, keys]), np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
        order = np.argsort(keys, kind="stable")
        self.keys, self.at, self.n = keys[order], at[order], np.concatenate([self.n, n])[order]
        self.ids = np.concatenate([self.ids, ids])


def splits_at_space(made: dict) -> bool:
    """Whether a tokenizer file drops white space, never joins across it, and
    treats simple chunks as ``chunk`` does."""
    return (made.get("normalizer"), made.get("pre_tokenizer")) == (NORMALIZER, PRE_TOKENIZER)


class Encoder:
    """Ids of texts by a tokenizers file: chunk by chunk if the file's rules
    are those of ``splits_at_space``, else each text by the library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path) as f:
            self.chunked = splits_at_space(json.load(f))

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pieces: dict[str, list[int]] = {}
        self.old, self.new = Known(), Known()
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {c: level.pre_tokenize_str(chr(c))[0][0] for c in [*range(0x21, 0x7F), *range(0xDF, 0x100)]}

    def chunk(self, x: str) -> list[int]:
        if not SIMPLE(x):
            return self.tokenizer.encode(x, add_special_tokens=False).ids
        out: list[int] = []
        for p in PIECE(x.lower()):
            if (ids := self.pieces.get(p)) is None:
                ids = [t.id for t in self.tokenizer.model.tokenize(p.translate(self.byte_level))]
                if len(p) <= CACHE_CHARS:
                    self.pieces[p] = ids
            out += ids
        return out

    def encode(self, col: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, ``end_id`` after each, and their
        number for each text."""
        if not self.chunked:
            got = [e.ids for e in self.tokenizer.encode_batch_fast([t or "" for t in col.to_pylist()], add_special_tokens=False)]
            n = np.array([len(x) + 1 for x in got], np.int64)
            return np.fromiter(chain.from_iterable([*x, end_id] for x in got), np.int32, int(n.sum())), n
        data, off = W.texts(col)
        ws = W.runs(W.NOT_SPACE[data], off)
        keys, first, inverse = np.unique(W.hashes(data, ws.starts, ws.ends), return_index=True, return_inverse=True)
        at, n = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if len(self.pieces) > PIECES:
            self.pieces.clear()
        if len(self.new.keys) * 4 > len(self.old.keys) + 100_000:
            if len(self.old.keys) + len(self.new.keys) > CACHE:
                self.old = Known()
            self.old.add(self.new.keys, self.new.n, self.new.ids[np.repeat(self.new.at - (np.cumsum(self.new.n) - self.new.n), self.new.n) + np.arange(self.new.n.sum())])
            self.new = Known()
        base, there = [], np.zeros(len(keys), bool)
        for known in (self.old, self.new):
            i, found = known.find(keys)
            at[found], n[found] = known.at[i[found]] + sum(map(len, base)), known.n[i[found]]
            base.append(known.ids)
            there |= found
        todo = np.flatnonzero(~there)
        if len(todo):
            body = data.tobytes()
            spans = zip(ws.starts[first[todo]].tolist(), ws.ends[first[todo]].tolist())
            got = [self.chunk(body[s:e].decode()) for s, e in spans]
            n[todo] = [len(x) for x in got]
            ids = np.fromiter(chain.from_iterable(got), np.int32, int(n[todo].sum()))
            at[todo] = sum(map(len, base)) + np.cumsum(n[todo]) - n[todo]
            base.append(ids)
            keep = ws.ends[first[todo]] - ws.starts[first[todo]] <= CACHE_CHARS
            self.new.add(keys[todo[keep]], n[todo[keep]], ids[np.repeat(keep, n[todo])])
        word_n = n[inverse]
        total = int(word_n.sum())
        ids = np.concatenate(base)[np.repeat(at[inverse] - (np.cumsum(word_n) - word_n), word_n) + np.arange(total)]
        text_n = W.per_text(word_n, ws.bounds)
        out = np.full(total + len(text_n), end_id, np.int32)
        out[np.arange(total) + np.repeat(np.arange(len(text_n)), text_n)] = ids
        return out, text_n + 1


@lru_cache(maxsize=4)
def encoder_of(path: str) -> Encoder:
    """The worker process's encoder of a file: what it keeps serves all the
    process's tasks."""
    return Encoder(path)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, parts: int | None = None, stripe_bytes: int = STRIPE_BYTES) -> None:
    """Write the ids of ``docs`` to ORC files below ``path``. ``parts`` is the
    number of files (default: the shuffle partitions); ``tokenizer`` is a file
    that every executor can open."""
    spark = docs.sparkSession
    bound_batches(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    ranged = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, start = encoder_of(tokenizer), 0
        for whole in batches:
            for batch in W.pieces(whole, "_text", PIECE_BYTES):
                flat, n = encoder.encode(W.column(batch, "_text"), end_id)
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(start + ends - n), pa.array(n), lists],
                                                 ["doc_id", "part_start", "n_tokens", "ids"])
                start += int(n.sum())

    out = ranged.mapInArrow(run, f"doc_id {kind}, part_start bigint, n_tokens bigint, ids array<int>")
    (out.write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .option("orc.create.index", "true").option("orc.row.index.stride", "2000")
     .option("orc.stripe.size", str(stripe_bytes)).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) from the files below ``path``."""
    # files are named by their part number, in order of the id ranges (a part may be cut into several files)
    rows = spark.read.orc(path).withColumn("_part", F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("bigint"))
    parts = rows.groupBy("_part").agg(F.sum("n_tokens").alias("_n"))  # one row for each part
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(starts), "_part")
            .select("doc_id", (F.col("_before") + F.col("part_start")).alias("start"), "n_tokens", "ids"))


def with_crc32(tokens: DataFrame) -> DataFrame:
    """``ids_crc32`` in place of the ids: crc32 of the ids as little-endian
    unsigned 32-bit integers."""
    names = [c for c in tokens.columns if c != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = W.column(b, "ids")
            off = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            crc = [zlib.crc32(flat[s:e]) for s, e in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([*(W.column(b, c) for c in names), pa.array(crc, pa.int64())], [*names, "ids_crc32"])

    schema = ", ".join([*(f"`{c}` {tokens.schema[c].dataType.simpleString()}" for c in names), "ids_crc32 bigint"])
    return tokens.mapInArrow(run, schema)
