"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (md5 of the
id), gone through at most ``repeats`` times. An entry's *virtual finish time*
is the words of its queue up to and including it, divided by the queue's
target; serving entries in the order of finish times gives every source its
share at any moment. The order is cut where the words taken reach the total
budget; the entry at the cut is taken in part.

Plan: one pass over the texts writes a narrow table (id, source, size).
Running sums within a source are split by ranges of the shuffle key, so a
source with a third of all rows is summed by many tasks; the place of the
cut is found by refining a histogram of finish times, so no task sorts all
entries. ``mixed`` returns the documents in the mix's global order
(``repartitionByRange`` on finish time).

Targets: sources by code point, null last, weigh ``weights`` in turn and
share ``share`` of all words; a target stops at ``repeats`` times its
source's words and the excess goes to the others by weight (water filling).

Defined results: a null or empty text has size 0 and is not taken; a null
source is a source of its own; repeated rows are queued as often as they
occur; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from triage.llm.common import id_text, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
#: rows of one range of the shuffle key, and of the histogram bin at the cut
RANGE_ROWS = 2_048
CUT_ROWS = 4_096
BINS = 1_024
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, weight, target) of a table (source, size): one
    row for each source; the windows are over sources, not documents."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    t = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("_rank", F.row_number().over(by_name) - 1)
         .withColumn("weight", pick)
         .withColumn("_cap", F.col("source_size") * repeats))
    by_fill = Window.orderBy((F.col("_cap") / F.col("weight")).asc(), "_rank")
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * F.lit(float(share))
             - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    # in the order in which sources fill up, the first that needn't stop sets the level for it and all after it
    fits = F.col("_cap") >= F.col("_level") * F.col("weight")
    t = (t.withColumn("_level", level).withColumn("_place", F.row_number().over(by_fill))
         .withColumn("_final", F.min(F.when(fits, F.struct("_place", "_level"))).over(every)["_level"]))
    return t.select("source", "source_size", "weight", "_rank", F.least(
        F.col("_cap").cast("double"), F.coalesce(F.col("_final") * F.col("weight"), F.col("_cap").cast("double"))).alias("target"))


def range_starts(ranged: DataFrame, digits: int) -> DataFrame:
    """(source, range, _start): the words of a source before each range of
    its shuffle key, summed level by level of three digits, so that no window
    has more than 4,096 rows."""
    out, prev = None, 0
    for d in [*range(3, digits, 3), digits]:
        part = Window.partitionBy("source", F.substring("range", 1, prev) if prev else F.lit(0))
        before = part.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        level = (ranged.groupBy("source", F.substring("range", 1, d).alias("range")).agg(F.sum("size").alias("_n"))
                 .select("source", "range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")))
        if out is not None:
            up = out.select(F.col("source").alias("_s"), F.col("range").alias("_r"), F.col("_start").alias("_up"))
            level = (level.join(up, F.col("source").eqNullSafe(F.col("_s")) & (F.substring("range", 1, prev) == F.col("_r")))
                     .select("source", "range", (F.col("_start") + F.col("_up")).alias("_start")))
        out, prev = level, d
    return out


def schedule(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = REPEATS,
             seed: str = "mix", text_col: str = "text", id_col: str = "doc_id",
             source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, cum, key): ``cum`` are the
    words of the source's shuffled queue up to and with the document."""
    sized = written(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), id_text(id_col))).alias("key")), "mix-sizes")
    digits = max(1, math.ceil(math.log(max(sized.count() / RANGE_ROWS, 1), 16)))
    ranged = sized.withColumn("range", F.substring("key", 1, digits))
    starts = range_starts(ranged, digits)
    within = (Window.partitionBy("source", "range").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.withColumn("_cum", F.sum("size").over(within))
    targets = source_targets(sized, weights, share, repeats)
    a, s, t = local.alias("a"), starts.alias("s"), targets.alias("t")
    return (a.join(s, F.col("a.source").eqNullSafe(F.col("s.source")) & (F.col("a.range") == F.col("s.range")))
            .join(t, F.col("a.source").eqNullSafe(F.col("t.source")))
            .select("a.doc_id", "a.source", "a.size", "a.key", "t.source_size", "t.target", "t._rank",
                    (F.col("s._start") + F.col("a._cum")).alias("cum")))


def finish(turn: int):
    """Virtual finish time of a document's entry in the queue's turn-th
    round."""
    return F.when(F.col("target") > 0, (F.col("cum") + F.col("source_size") * turn) / F.col("target"))


def take(queue: DataFrame, share: float = SHARE, repeats: int = REPEATS) -> DataFrame:
    """``queue`` with ``taken``: the words that the mix takes of each row."""
    queue = written(queue, "mix-queue")
    # a row's turns are at least 1/repeats apart in finish time, so that it has one entry at most in a bin
    entries = queue.select("size", F.explode(F.array(*(finish(k) for k in range(repeats)))).alias("at")).where("at is not null")
    total = queue.agg(F.sum("size")).first()[0] or 0
    rest = math.floor(total * share)
    latest = entries.agg(F.max("at")).first()[0] or 1.0
    lo, hi, rows = 0.0, latest * (1 + 1e-9), None
    while rows is None or rows > CUT_ROWS:
        width = (hi - lo) / BINS
        if width < 1e-12:
            break
        bins = (entries.where((F.col("at") >= lo) & (F.col("at") < hi))
                .groupBy(F.least(F.floor((F.col("at") - lo) / width), F.lit(BINS - 1)).alias("bin"))
                .agg(F.sum("size").alias("n"), F.min("at").alias("least"), F.count("*").alias("rows"))
                .orderBy("bin").collect())  # at most BINS rows
        spot = None
        for i, b in enumerate(bins):
            if b.n > rest:
                spot = (b.least, bins[i + 1].least if i + 1 < len(bins) else hi, b.rows)
                break
            rest -= b.n
        if spot is None:  # everything below hi is taken
            lo, rest = hi, 0
            break
        if spot[1] - spot[0] >= hi - lo or spot[2] == rows:
            lo, hi, rows = *spot[:2], spot[2]
            break
        lo, hi, rows = spot
    full = [F.when(finish(k) < lo, F.col("size")).otherwise(0) for k in range(repeats)]
    whole = queue.withColumn("_full", sum(full[1:], full[0]))
    at_cut = F.coalesce(*(F.when((finish(k) >= lo) & (finish(k) < hi), finish(k)) for k in range(repeats)))
    whole = whole.withColumn("_cut", at_cut)
    order = Window.orderBy("_cut", "_rank", "key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.lit(rest) - F.coalesce(F.sum("size").over(order), F.lit(0))))
    cut = whole.where("_cut is not null").withColumn("taken", F.col("_full") + part)
    rest_of = whole.where("_cut is null").withColumn("taken", F.col("_full"))
    return rest_of.unionByName(cut).drop("_full", "_cut").withColumn("taken", F.col("taken").cast("bigint"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix in its global order, a document taken twice
    as two rows, with the columns of ``docs``. The document at the cut, of
    which only some words are needed, is kept whole. Expects unique ids (a
    repeated id is given its copies' total)."""
    share, repeats = options.get("share", SHARE), options.get("repeats", REPEATS)
    plan = take(schedule(docs, **options), share, repeats)
    id_col = options.get("id_col", "doc_id")
    turns = plan.groupBy(F.col("doc_id").alias("_mid")).agg(
        F.max(F.ceil(F.try_divide("taken", "size"))).cast("int").alias("_copies"), F.min(finish(0)).alias("_at"),
        F.max(F.try_divide("source_size", "target")).alias("_round"))
    both = docs.join(turns, F.col(id_col).eqNullSafe(F.col("_mid"))).where("_copies > 0")
    copies = both.withColumn("_turn", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
    at = F.col("_at") + F.col("_turn") * F.col("_round")
    return copies.withColumn("_at", at).repartitionByRange("_at", id_col).sortWithinPartitions("_at", id_col).select(*docs.columns)
