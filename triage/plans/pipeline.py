"""A whole run: select, silver, upsert, notify, and its counters (A3, A4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from triage.operators import deliver as dlv
from triage.operators import merge as mg
from triage.operators import notify as nt
from triage.operators import search as sr
from triage.operators.silver import key_present, to_silver
from triage.schema import SILVER_COLUMNS
from triage.session import scratch_path
from triage.sources.handoff import write_handoff

COUNTERS = ["bronze", "silver", "inserted", "updated", "notified", "failed", "fallback"]


def found_new(mailbox: DataFrame, ingested: DataFrame) -> DataFrame:
    """Messages a run finds: not seen, a subject keyword hit, a UID above the
    mailbox's mark (F1, F2, F3)."""
    return sr.above_watermark(sr.search(sr.not_seen(mailbox)), sr.watermarks(ingested))


def fetchable():
    """A numeric UID and a Message-ID."""
    return sr.numeric_uid(F.col("email_id")).isNotNull() & key_present()


def select_new(mailbox: DataFrame, ingested: DataFrame) -> DataFrame:
    """Messages a run fetches: those it finds that are ``fetchable``."""
    return found_new(mailbox, ingested).where(fetchable())


def observed(found: DataFrame, kept) -> tuple[DataFrame, Observation]:
    """``found`` with an observation of the rows found and dropped, counted by
    whatever action reads them (F5, A3, A4): no pass of its own."""
    watch = Observation()
    return found.observe(watch, F.count(F.lit(1)).alias("found"), F.count_if(~kept).alias("dropped")), watch


def _kv(df: DataFrame, names: list[str]) -> DataFrame:
    args = ", ".join(f"'{n}', CAST({n} AS BIGINT)" for n in names)
    return df.selectExpr(f"stack({len(names)}, {args}) AS (k, v)")


#: what counters, merge order and alerts read; bodies are not copied
RUN_COLUMNS = ["message_id", "email_uid", "scraped_at", "company_name", "position", "status", "date_received",
               "alerta_enviado"]


def run_counts(mailbox: DataFrame, ingested: DataFrame, gold: DataFrame, limit: int = 50,
               transport=None, handoff_root: str | None = None) -> DataFrame:
    """One row of run counters for one batch run. ``gold`` holds the existing
    rows (several rows of a key resolve to the last one, as in the merge).

    The selected messages go through silver once and are written, together
    with the current gold rows, as this run's hand-off (tagged by side); every
    counter and the merge then read the written files, so nothing upstream
    is computed twice and the lineage is cut. ``bronze`` counts the messages
    that the search found, observed by that write before those without a
    numeric UID or a Message-ID are dropped; ``silver`` counts what was
    written. The 1-row partial results are stacked into ``(k, v)`` rows and
    pivoted by one aggregation (no cross join).
    """
    spark = mailbox.sparkSession
    found, watch = observed(found_new(mailbox, ingested), fetchable())
    fetched = found.where(fetchable())
    tagged = mg.tag(gold, to_silver(fetched).select(*SILVER_COLUMNS)).select(*RUN_COLUMNS, "_side")
    root = handoff_root or scratch_path(spark, "run")
    path = write_handoff(tagged, root, 0)
    run = spark.read.parquet(path)

    batch_n = run.where(F.col("_side") == mg.BATCH).agg(F.count(F.lit(1)).alias("silver"))
    counts = mg.counts_tagged(run)
    merged = mg.merge_tagged(run, columns=RUN_COLUMNS)
    outcomes = dlv.deliver(nt.pending_alerts(merged, limit), transport=transport)
    parts = [
        _kv(batch_n.withColumn("bronze", F.lit(watch.get["found"]).cast("bigint")), ["bronze", "silver"]),
        _kv(counts, ["inserted", "updated"]),
        _kv(nt.notify_counts(outcomes), ["notified", "failed", "fallback"]),
    ]
    kv = reduce(DataFrame.unionByName, parts)
    return kv.agg(*[F.coalesce(F.max(F.when(F.col("k") == n, F.col("v"))), F.lit(0))
                    .cast("bigint").alias(n) for n in COUNTERS])


def run_batch(messages: DataFrame, store, transport=None, limit: int = 50,
              fallback_log: str | None = None, sender: str | None = None,
              recipient: str | None = None, run_id: str | None = None, queue: bool = False, metrics: dict | None = None) -> dict:
    """One whole run over parsed messages (``mailbox, uid`` + bronze columns,
    and if they come from ``mime.stamp`` their ``_error``): select the unseen
    that are in no interval of UIDs read before, silver, upsert, put aside what
    can't be used, record the UIDs, notify. Returns ``{bronze, dropped, gold:
    {inserted, updated}, notify: {...}}``: the messages fetched, how many of
    them could not be used (``store.quarantine()`` has those), and the counters
    of the stages; the first two are observed by the write of the hand-off.

    A message's UID is recorded only after it is in the store or in the
    quarantine, so that a run that fails before leaves it to the next one. A
    run that is repeated with its ``run_id`` replaces what it wrote."""
    import uuid

    stream, batch = ("batch", None) if run_id is None else (f"run-{run_id}", 0)
    run_id = run_id or uuid.uuid4().hex
    new = sr.unfetched(sr.not_seen(messages), store.ingested_uids())
    fetched, watch = observed(sr.usable(new), F.col("_reason").isNull())
    root = scratch_path(messages.sparkSession, "batch")
    path = write_handoff(fetched, root, 0)          # cut lineage: fetched once
    fetched = messages.sparkSession.read.schema(fetched.schema).parquet(path)
    found, dropped = watch.get["found"], watch.get["dropped"]
    if metrics is not None:
        metrics.update(watch.get)
    good = fetched.where(F.col("_reason").isNull())
    gold = store.upsert(to_silver(good), stream, batch) if found > dropped else {"inserted": 0, "updated": 0}
    if dropped:
        store.put_aside(sr.rejects(fetched), run_id)
    if found:
        store.record_uids(fetched, run_id)
    notify = store.notify(transport=transport, limit=limit, fallback_log=fallback_log,
                          sender=sender, recipient=recipient, run_id=run_id, queue=queue)
    return {"bronze": found - dropped, "gold": gold, "notify": notify}
