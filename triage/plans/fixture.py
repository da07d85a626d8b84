"""Shared inputs of the registered queries, all derived from the test tables.

The keyed-state queries need a table that already exists (the target) and a
new batch. Both come from the whole mailbox, split by UID range: the target
holds UIDs up to 60 % of the range, the batch UIDs above 40 %, so 20 % of the
range is in both (updates) and the rest is new (inserts). The bounds are two
scalar aggregates over ``events``; nothing is sampled or capped.

The delivery queries need a transport whose answers the oracle SQL can state;
``answer_by_uid`` is that input, not a part of the library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.operators import deliver as dlv
from triage.operators.silver import to_silver
from triage.schema import SILVER_COLUMNS
from triage.sources.mailbox import mailbox_view

# Fractions of the UID range, in thousandths: the target ends at 600, the
# batch starts at 400 (20 % overlap).
TARGET_END = 600
BATCH_START = 400

# What a message's key and order are made of, as the source has it.
PLACE = ["event_id", "ts"]


def uid_bounds(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    lo = ev.select((F.min("event_id") + 1).alias("lo")).scalar()
    hi = ev.select((F.max("event_id") + 1).alias("hi")).scalar()
    return lo, hi


def in_target(spark, sf_dir, end: int = TARGET_END) -> Column:
    """``uid <= lo + end/1000 * (hi - lo)`` in exact integer arithmetic."""
    lo, hi = uid_bounds(spark, sf_dir)
    return F.col("uid") * 1000 <= lo * (1000 - end) + hi * end


def in_batch(spark, sf_dir, start: int = BATCH_START) -> Column:
    """``uid > lo + start/1000 * (hi - lo)``."""
    lo, hi = uid_bounds(spark, sf_dir)
    return F.col("uid") * 1000 > lo * (1000 - start) + hi * start


def silver_rows(spark: SparkSession, sf_dir: str, keep=(), only=None) -> DataFrame:
    """Silver rows of the whole mailbox, with ``uid`` and ``mailbox`` kept, and
    the source's columns ``keep``; of the events that ``only`` names, if given."""
    return to_silver(mailbox_view(spark, sf_dir, keep, only), keep=("uid", "mailbox", *keep))


def target_rows(spark, sf_dir, end: int = TARGET_END, only=None) -> DataFrame:
    return silver_rows(spark, sf_dir, only=only).where(in_target(spark, sf_dir, end))


def batch_rows(spark, sf_dir, start: int = BATCH_START, only=None) -> DataFrame:
    return silver_rows(spark, sf_dir, only=only).where(in_batch(spark, sf_dir, start))


def tagged_rows(spark, sf_dir, end: int = TARGET_END, start: int = BATCH_START, keep=()) -> DataFrame:
    """Silver rows computed once, tagged ``_side`` 0 (target) and/or 1 (batch);
    a row in the overlap appears once per side."""
    s = silver_rows(spark, sf_dir, keep)
    sides = F.array(F.when(in_target(spark, sf_dir, end), F.lit(0)),
                    F.when(in_batch(spark, sf_dir, start), F.lit(1)))
    return (s.select(*SILVER_COLUMNS, *keep, F.explode(sides).alias("_side"))
            .where(F.col("_side").isNotNull()))


def answer_by_uid(message: dict, attempt: int) -> None:
    """The transport of the delivery queries: the alert's UID modulo 5 says
    how it goes (a UID that is no number counts as 0)."""
    text = str(message.get("email_uid") or "").strip()
    case = int(text) % 5 if text.isdecimal() else 0
    if case == 2:
        raise dlv.TransportAuthError
    if case == 4:
        raise dlv.RecipientRefusedError
    if case == 3 or case == 1 and attempt == 1:
        raise dlv.TransientError
