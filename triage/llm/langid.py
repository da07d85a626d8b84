"""Language ID by language-bitmask n-gram filters.

A *bit-sliced Bloom filter* holds, in each of its m slots, a word with one bit
for each language: an n-gram sets its languages' bits in k slots, and the
AND of the k slots returns, in one look, all languages that (may) contain it.
A text's n-grams are looked up at once; the popcount of a language's bit over
them is the number of n-grams it contains, corrected for false positives
(with p_l, the share of slots with bit l to the power k, the expected count is
c (1 - p_l) + n p_l). The language with the largest corrected count decides;
the score is its share of all corrected counts.

N-grams are of three and four characters of lower-cased text whose inner
characters are letters (other characters count as a word boundary). They are
learned from at most about ``SAMPLE_ROWS`` texts of each language: one belongs
to all languages where it is at least ``SHARE`` as frequent as where it is
most frequent, and occurs ``LEAST`` times. Counting, choosing and filling the
slots are Spark aggregates; the filter's size is m words, by the number of
n-grams up to ``MOST_SLOTS``, and it is broadcast.

Defined results: null texts and texts without a letter are ``und`` with score
0; a text none of whose n-grams is known is the most frequent language, with
score 0; ties go to the language that is first by code point; without
learned languages everything is ``und``. More than 64 languages use more
words for each slot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, fold, unit_hash, written

SAMPLE_ROWS = 1_500
SHARE, LEAST = 0.34, 3
HASHES, SLOTS_FOR_EACH, LEAST_SLOTS, MOST_SLOTS = 3, 8, 1 << 14, 1 << 22
SIZES = (3, 4)


def grams(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram hashes, their texts, and whether each text has a letter."""
    data, off = W.code_points(col)
    n = len(off) - 1
    alpha = W.letters()[data]
    unit = W.mix(np.where(alpha, data, 32).astype(np.uint64) * W.U64(W.BASE) + W.U64(7))
    text = np.repeat(np.arange(n), np.diff(off))
    hashes, of = [], []
    for size in SIZES:
        if len(data) < size:
            continue
        last = len(data) - size + 1
        inner = np.ones(last, bool)
        for k in range(1, size - 1):
            inner &= alpha[k:k + last]
        at = np.flatnonzero(inner)
        h = np.full(len(at), size, np.uint64)
        for k in range(size):
            h = h * W.U64(W.BASE) + unit[at + k]
        hashes.append(W.mix(h))
        of.append(text[at + 1])
    has = np.zeros(n, bool)
    has[text[alpha]] = True
    none = np.zeros(0, np.int64)
    return np.concatenate([none.view(np.uint64), *hashes]), np.concatenate([none, *of]), has


def slots(h: np.ndarray, m: int) -> list[np.ndarray]:
    return [(W.mix(h + W.U64(j * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) & W.U64(m - 1)).astype(np.int64) for j in range(HASHES)]


class Filters:
    """Slots x words of language bits."""

    def __init__(self, langs: list[str], priors: list[int], table: np.ndarray):
        self.langs, self.table = langs, table
        self.common = int(np.argmax(priors)) if langs else -1
        self.false = [float((table[:, i // 64] >> W.U64(i % 64) & W.U64(1)).mean()) ** HASHES for i in range(len(langs))]

    def decide(self, col: pa.Array) -> tuple[list[str], np.ndarray]:
        h, text, has = grams(col)
        n = len(col)
        total = np.bincount(text, minlength=n)
        at = slots(h, len(self.table))
        counts = np.zeros((n, max(len(self.langs), 1)))
        for word in range(self.table.shape[1]):
            mask = self.table[at[0], word] & self.table[at[1], word] & self.table[at[2], word]
            for i in range(64 * word, min(64 * word + 64, len(self.langs))):
                found = np.bincount(text[(mask >> W.U64(i % 64) & W.U64(1)).astype(bool)], minlength=n)
                p = min(self.false[i], 0.999)
                counts[:, i] = np.maximum(0, (found - total * p) / (1 - p))
        every, best = counts.sum(axis=1), counts.argmax(axis=1)
        if not self.langs:
            return ["und"] * n, np.zeros(n)
        best = np.where(every > 0, best, self.common)
        score = np.where(has & (every > 0), counts[np.arange(n), best] / np.maximum(every, 1e-12), 0.0)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, has)], np.clip(score, 0, 1)


def learn(docs: DataFrame, folds: int = 4, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Filters:
    """The filters, from texts outside the held-out fold."""
    spark = docs.sparkSession
    bound_batches(spark)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
            .where("_lang is not null and _text is not null").where(fold("_id", folds) != held_out))
    # one row for each language
    known = sorted(((r["_lang"], r["n"]) for r in rows.groupBy("_lang").agg(F.count("*").alias("n")).collect()), key=lambda x: x[0].encode())
    langs = [x for x, _ in known]
    if not langs:
        return Filters([], [], np.zeros((LEAST_SLOTS, 1), np.uint64))
    share = F.lit(0.0)
    for lang, n in known:
        share = F.when(F.col("_lang") == lang, min(1.0, sample_rows / n)).otherwise(share)
    index = F.array_position(F.array(*map(F.lit, langs)), F.col("_lang")).cast("int") - 1
    picked = rows.where(unit_hash("_id", 21) < share).select(index.alias("l"), "_text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "_text"):
                lang = W.column(b, "l").to_numpy(zero_copy_only=False)
                h, text, _ = grams(W.column(b, "_text"))
                for i in np.unique(lang):
                    g, n = np.unique(h[lang[text] == i], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), i, np.int32)), pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], ["l", "g", "n"])

    counts = written(picked.mapInArrow(count, "l int, g bigint, n bigint").groupBy("l", "g").agg(F.sum("n").alias("n")), "grams")
    total = counts.groupBy("l").agg(F.sum("n").alias("total"))
    rate = counts.join(F.broadcast(total), "l").withColumn("rate", F.col("n") / F.col("total"))  # a row for each language
    top = rate.groupBy("g").agg(F.max("rate").alias("top"))
    member = rate.join(top, "g").where((F.col("n") >= LEAST) & (F.col("rate") >= F.col("top") * SHARE))
    words = (len(langs) + 63) // 64
    bits = [F.bit_or(F.when(F.floor(F.col("l") / 64) == w, F.expr("shiftleft(1L, pmod(l, 64))"))
                     .otherwise(F.lit(0).cast("bigint"))).alias(f"b{w}") for w in range(words)]
    member = written(member.groupBy("g").agg(*bits), "gram-bits")
    m = LEAST_SLOTS
    while m < min(MOST_SLOTS, member.count() * SLOTS_FOR_EACH):
        m *= 2

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = W.column(b, "g").to_numpy(zero_copy_only=False).view(np.uint64)
            for s in slots(g, m):
                yield pa.RecordBatch.from_arrays([pa.array(s), *b.columns[1:]], ["slot", *b.schema.names[1:]])

    filled = (member.mapInArrow(place, "slot bigint, " + ", ".join(f"b{w} bigint" for w in range(words)))
              .groupBy("slot").agg(*(F.bit_or(f"b{w}").alias(f"b{w}") for w in range(words))).toArrow())  # m rows at most
    table = np.zeros((m, words), np.uint64)
    at = filled["slot"].to_numpy()
    for w in range(words):
        table[at, w] = filled[f"b{w}"].to_numpy().view(np.uint64)
    return Filters(langs, [n for _, n in known], table)


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of each document."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, "_text", 1 << 20):
                lang, score = shared.value.decide(W.column(b, "_text"))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["_id", "lang_pred", "score"])

    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .mapInArrow(run, f"_id {kind}, lang_pred string, score double").withColumnRenamed("_id", id_col))
