"""Bronze rows to silver rows (X20): one projection, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.functions import (
    classify_status, collapse_ws, head, parse_iso, parse_rfc2822, py_strip, sender_domain,
)
from triage.functions.subject import choose
from triage.schema import BRONZE_SCHEMA, check_columns, check_types


def _s(name: str):
    return F.coalesce(F.col(name), F.lit(""))


def key_present():
    """A row has a usable key when its stripped Message-ID is not empty."""
    return F.coalesce(py_strip(F.col("message_id")) != "", F.lit(False))


_EXPRS: dict = {}


def _silver_exprs():
    """The silver expressions, built once per JVM: they are unresolved
    expression trees over column names, and building them costs hundreds of
    driver-to-JVM calls."""
    from pyspark import SparkContext

    key = id(SparkContext._gateway)
    if key not in _EXPRS:
        from triage.functions.subject import candidate_columns, part_columns

        position, company = choose(_s("subject"), _s("sender"))
        staged = part_columns(F.col("subject"))
        candidates = candidate_columns(F.col("subject"), {name: F.col(name) for name in staged})
        _EXPRS[key] = (key_present(), staged, candidates, [
            py_strip(F.col("message_id")).alias("message_id"),
            _s("email_id").alias("email_uid"),
            _s("sender").alias("sender"),
            sender_domain(_s("sender")).alias("sender_domain"),
            company.alias("company_name"),
            position.alias("position"),
            _s("subject").alias("subject"),
            parse_rfc2822(F.col("date")).alias("date_received"),
            collapse_ws(F.lower(_s("body"))).alias("body_clean"),
            classify_status(F.col("subject"), F.col("body")).alias("status"),
            F.lit(False).alias("alerta_enviado"),
            parse_iso(F.col("scraped_at")).alias("scraped_at"),
        ])
    return _EXPRS[key]


def to_silver(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Silver columns in their fixed order, plus the ``keep`` columns.

    Rows without a Message-ID are dropped; the subject keeps its case; the
    status uses the raw body, ``body_clean`` the normalized one; the alert
    flag starts false.
    """
    check_columns(bronze, BRONZE_SCHEMA.fieldNames(), "silver")
    check_types(bronze, BRONZE_SCHEMA, "silver")
    present, parts, candidates, exprs = _silver_exprs()
    staged = bronze.where(present).withColumns(parts).withColumns(candidates)
    return staged.select(*exprs, *keep)


def quarantine_missing_id(bronze: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows dropped for a missing Message-ID, with the first 60 characters of
    the subject for the operator (F5, T3)."""
    return bronze.where(~key_present()).select(
        *keep, F.col("email_id"), head(F.col("subject"), 60).alias("subject_head"))
