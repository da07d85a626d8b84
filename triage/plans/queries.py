"""Registered queries: one per operator group of the inventory.

Every query takes ``(spark, sf_dir)``, reads the test tables (or data Spark
derives from them) in full and returns a lazy DataFrame whose column names
equal those of the matching oracle SQL.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.functions import (
    classify_status, clean, clean_lower, collapse_ws, company_from_domain, html_to_text,
    is_valid_email, normalize_text, parse_iso, parse_rfc2822, position_and_company,
    sender_domain, status_label,
)
from triage.operators import deliver as dlv
from triage.operators import merge as mg
from triage.operators import notify as nt
from triage.operators import search as sr
from triage.operators.silver import quarantine_missing_id, to_silver
from triage.plans import fixture as fx
from triage.schema import BRONZE_SCHEMA, OUTCOME_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA, UPSERT_COLUMNS
from triage.session import prepare
from triage.sources import handoff, mime
from triage.sources.mailbox import mailbox_view
from triage.sources.mime_columns import parse

ALERT_SENDER = "alerts@triage.example"
ALERT_RECIPIENT = "me@triage.example"
ALERT_LIMIT = 50


def _read(spark, sf_dir, name) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- sources and selection ---------------------------------------------------

def bronze_messages(spark, d):
    return mailbox_view(spark, d).select("mailbox", "uid", *BRONZE_SCHEMA.fieldNames())


def search_keywords(spark, d):
    return sr.search(mailbox_view(spark, d)).select("uid", "subject")


def keyword_hits(spark, d):
    return sr.keyword_hits(mailbox_view(spark, d))


def unseen_messages(spark, d):
    ingested = fx.target_rows(spark, d).select("message_id")
    return sr.unseen(mailbox_view(spark, d), ingested).select("uid", "message_id")


def uid_watermark(spark, d):
    marks = sr.watermarks(fx.target_rows(spark, d))
    return sr.above_watermark(mailbox_view(spark, d), marks).select("mailbox", "uid")


def uid_gaps(spark, d):
    """What a run would fetch by UID intervals: also below the highest UID."""
    read = sr.uid_intervals(fx.target_rows(spark, d))
    return sr.unfetched(mailbox_view(spark, d), read).select("mailbox", "uid", "message_id")


def numeric_uid(spark, d):
    mb = mailbox_view(spark, d).select("email_id", sr.numeric_uid(F.col("email_id")).alias("uid_num"))
    return mb.where(F.col("uid_num").isNotNull())


def uid_list_split(spark, d):
    """Search replies as a server gives them, one text of UIDs for each mailbox
    and range of 50, split into their numeric UIDs."""
    replies = (mailbox_view(spark, d).groupBy("mailbox", F.floor(F.col("uid") / 50).cast("bigint").alias("block"))
               .agg(F.concat_ws(" ", F.collect_list("email_id")).alias("uids")))
    return replies.select("mailbox", "block", F.explode(sr.parse_uid_list(F.col("uids"))).alias("uid_num"))


def drop_missing_id(spark, d):
    return quarantine_missing_id(mailbox_view(spark, d), keep=("uid",))


# -- column functions ----------------------------------------------------------

def normalize_text_q(spark, d):
    c = _read(spark, d, "conversations")
    return c.select("conv_id", "turn", normalize_text(F.col("text")).alias("text_norm"))


def body_collapse(spark, d):
    docs = _read(spark, d, "documents")
    return docs.select("doc_id", collapse_ws(F.col("text")).alias("text_collapsed"))


def clean_text(spark, d):
    c = _read(spark, d, "conversations")
    return c.select("conv_id", "turn", clean_lower(F.col("role")).alias("role_clean"),
                    clean(F.col("text")).alias("text_clean"))


def sender_domain_q(spark, d):
    return mailbox_view(spark, d).select("uid", sender_domain(F.col("sender")).alias("sender_domain"))


def company_from_domain_q(spark, d):
    return mailbox_view(spark, d).select(
        "uid", company_from_domain(sender_domain(F.col("sender"))).alias("company"))


def subject_parse(spark, d):
    pos, comp = position_and_company(F.col("subject"), F.col("sender"))
    return mailbox_view(spark, d).select("uid", pos.alias("position"), comp.alias("company_name"))


def parse_date(spark, d):
    return mailbox_view(spark, d).select("uid", parse_rfc2822(F.col("date")).alias("date_received"))


def parse_iso_q(spark, d):
    return mailbox_view(spark, d).select("uid", parse_iso(F.col("scraped_at")).alias("scraped_ts"))


def classify_status_q(spark, d):
    return mailbox_view(spark, d).select(
        "uid", classify_status(F.col("subject"), F.col("body")).alias("status"))


def silver_messages(spark, d):
    return to_silver(mailbox_view(spark, d))


def html_to_text_q(spark, d):
    return _read(spark, d, "pages").select("page_id", html_to_text(F.col("html")).alias("text"))


def valid_email(spark, d):
    addr = F.regexp_extract(F.col("sender"), r"<([^>]*)>", 1)
    return mailbox_view(spark, d).select("uid", addr.alias("address"),
                                         is_valid_email(addr).alias("is_valid"))


# -- keyed state ---------------------------------------------------------------

def existing_keys(spark, d):
    # only the target's keys matter: a key-only distinct, no row selection
    flagged = mg.existing_keys(fx.batch_rows(spark, d), fx.target_rows(spark, d))
    return flagged.select("uid", "message_id", "existed")


def upsert_counts(spark, d):
    return mg.counts_tagged(fx.tagged_rows(spark, d))


def merged_gold(spark, d, columns) -> DataFrame:
    return mg.merge_tagged(fx.tagged_rows(spark, d), columns=columns)


ALERT_COLUMNS = ["message_id", "email_uid", "company_name", "position", "status", "date_received", "alerta_enviado"]


def upsert_merge(spark, d):
    sides = {mg.TARGET: fx.target_rows, mg.BATCH: fx.batch_rows}
    return mg.merge_late(fx.tagged_rows(spark, d, keep=fx.PLACE), fx.PLACE,
                         lambda side, places: sides[side](spark, d, only=places))


def pending_alerts(spark, d):
    return nt.pending_alerts(merged_gold(spark, d, ALERT_COLUMNS), ALERT_LIMIT).drop("email_uid")


def mark_alerted(spark, d):
    # Read twice (pending rows, then the flag join): written once under the
    # shared checkpoint folder instead of merged twice.
    from triage.session import materialize

    gold = materialize(merged_gold(spark, d, ALERT_COLUMNS))
    ledger = dlv.deliver(nt.pending_alerts(gold, ALERT_LIMIT), transport=None)
    return nt.apply_alert_flag(gold, ledger).select("message_id", "status", "alerta_enviado")


# -- alert text ----------------------------------------------------------------

def status_label_q(spark, d):
    return fx.silver_rows(spark, d).select("uid", "status", status_label(F.col("status")).alias("label"))


def alert_payload_q(spark, d):
    from triage.functions import alert_payload

    g = merged_gold(spark, d, ALERT_COLUMNS)
    return g.select("message_id", alert_payload(F.col("company_name"), F.col("position"),
                                                F.col("status")).alias("payload"))


def alert_subject_q(spark, d):
    from triage.functions import alert_subject

    g = merged_gold(spark, d, ALERT_COLUMNS)
    return g.select("message_id", alert_subject(F.col("company_name"), F.col("status")).alias("alert_subject"))


def alert_message_q(spark, d):
    from triage.functions import alert_message

    pend = nt.pending_alerts(merged_gold(spark, d, ALERT_COLUMNS), ALERT_LIMIT)
    msgs = dlv.alert_frame(pend, ALERT_SENDER, None)
    m = alert_message(F.col("subject"), F.col("body"), F.col("from_addr"), F.col("to_addr"),
                      F.col("message_id")).alias("m")
    return msgs.select("message_id", m).select(
        "message_id", F.col("m.subject").alias("msg_subject"), F.col("m.from_addr").alias("msg_from"),
        F.col("m.to_addr").alias("msg_to"), F.col("m.source_id").alias("source_id"),
        F.col("m.body").alias("msg_body"))


def alert_json(spark, d):
    pend = nt.pending_alerts(merged_gold(spark, d, ALERT_COLUMNS), ALERT_LIMIT)
    lines = nt.fallback_lines(pend)
    return lines.select("message_id",
                        F.get_json_object("value", "$.message_id").alias("json_message_id"),
                        F.get_json_object("value", "$.payload").alias("json_payload"))


# -- delivery ------------------------------------------------------------------

RUNS = 3


def _ledger(spark, d) -> DataFrame:
    """The ledger after three runs of the retry queue, an hour apart, over the
    merged table's pending alerts, of the messages of the first run."""
    from triage.session import materialize, scratch_path
    from triage.sources.store import KeyedStore

    gold = merged_gold(spark, d, [*ALERT_COLUMNS, "scraped_at"])
    rows = gold.select(*(F.col(f.name) if f.name in gold.columns else F.lit(None).cast(f.dataType).alias(f.name)
                         for f in SILVER_SCHEMA.fields if f.name in UPSERT_COLUMNS))
    store = KeyedStore(spark, scratch_path(spark, "queue"), buckets=8)
    store.upsert(rows, stream="q", batch_id=0)
    for hour in range(RUNS):
        store.notify(fx.answer_by_uid, ALERT_LIMIT, sender=ALERT_SENDER, recipient=ALERT_RECIPIENT, queue=True,
                     now=F.lit(f"2026-01-01 {hour:02d}:00:00").cast("timestamp_ntz"))
    ledger = materialize(store.ledger(), "ledger")
    first = ledger.where(F.col("run") == ledger.select(F.min("run")).scalar()).select("message_id")
    return ledger.join(first, "message_id", "left_semi")


def delivery_outcomes(spark, d):
    return nt.last_outcomes(_ledger(spark, d)).select(*OUTCOME_SCHEMA.fieldNames())


def notify_counts(spark, d):
    return nt.notify_counts(nt.last_outcomes(_ledger(spark, d)))


def backoff_schedule(spark, d):
    return dlv.queue_schedule(_ledger(spark, d)).drop("delay_sec")


# -- whole run, hand-off, MIME -------------------------------------------------

def run_summary(spark, d):
    from triage.plans.pipeline import run_counts

    mb = mailbox_view(spark, d)
    # The merge keeps the last row per key of each side, so the raw target
    # rows stand for the existing table without a separate de-duplication.
    target = fx.target_rows(spark, d)
    return run_counts(mb, target, target.select(*SILVER_COLUMNS), limit=ALERT_LIMIT)


def store_upsert(spark, d):
    """The keyed store after two upserts (target rows, then batch rows)."""
    from triage.session import scratch_path
    from triage.sources.store import KeyedStore

    store = KeyedStore(spark, scratch_path(spark, "store"))
    store.upsert(fx.target_rows(spark, d).select(*SILVER_COLUMNS), stream="q", batch_id=0)
    store.upsert(fx.batch_rows(spark, d).select(*SILVER_COLUMNS), stream="q", batch_id=1)
    return store.gold()


def stream_gold(spark, d):
    """The keyed store after streaming the mailbox (two files, one per
    micro-batch) through search, silver and upsert."""
    from triage.session import scratch_path
    from triage.sources.mailbox import bronze
    from triage.sources.store import KeyedStore
    from triage.streaming.ingest import run_stream

    root = scratch_path(spark, "inbox")
    mb = mailbox_view(spark, d)
    lo_half = fx.in_target(spark, d, end=500)
    # a file is a micro-batch: in row groups of 16 MB, so that many tasks read a large one
    for part, half in enumerate((lo_half, ~lo_half)):
        bronze(mb.where(half)).write.option("parquet.block.size", 1 << 24).parquet(f"{root}/part={part}")
    store = KeyedStore(spark, scratch_path(spark, "stream-store"))
    run_stream(spark, f"{root}/*", store, checkpoint=f"{root}-ckpt", max_files_per_trigger=1)
    return store.gold()


def handoff_roundtrip(spark, d):
    return handoff.roundtrip(spark, to_silver(mailbox_view(spark, d)))


def parse_mime(spark, d):
    raw = mime.build_raw(mailbox_view(spark, d))
    return mime.good(parse(raw)).select("uid", "message_id", "sender", "subject", "date", "body")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_messages": bronze_messages,
    "search_keywords": search_keywords,
    "keyword_hits": keyword_hits,
    "unseen_messages": unseen_messages,
    "uid_watermark": uid_watermark,
    "uid_gaps": uid_gaps,
    "numeric_uid": numeric_uid,
    "uid_list_split": uid_list_split,
    "drop_missing_id": drop_missing_id,
    "normalize_text": normalize_text_q,
    "body_collapse": body_collapse,
    "clean_text": clean_text,
    "sender_domain": sender_domain_q,
    "company_from_domain": company_from_domain_q,
    "subject_parse": subject_parse,
    "parse_date": parse_date,
    "parse_iso": parse_iso_q,
    "classify_status": classify_status_q,
    "silver_messages": silver_messages,
    "html_to_text": html_to_text_q,
    "valid_email": valid_email,
    "existing_keys": existing_keys,
    "upsert_counts": upsert_counts,
    "upsert_merge": upsert_merge,
    "pending_alerts": pending_alerts,
    "mark_alerted": mark_alerted,
    "status_label": status_label_q,
    "alert_payload": alert_payload_q,
    "alert_subject": alert_subject_q,
    "alert_message": alert_message_q,
    "alert_json": alert_json,
    "delivery_outcomes": delivery_outcomes,
    "notify_counts": notify_counts,
    "backoff_schedule": backoff_schedule,
    "run_summary": run_summary,
    "handoff_roundtrip": handoff_roundtrip,
    "store_upsert": store_upsert,
    "stream_gold": stream_gold,
    "parse_mime": parse_mime,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status counts of the silver messages (the entry point's query)."""
    s = silver_messages(spark, sf_dir)
    return s.groupBy("status").agg(F.count(F.lit(1)).alias("n"))

