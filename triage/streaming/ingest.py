"""Incremental ingest with Structured Streaming.

New message files are read as a stream, parsed messages with the bronze schema
or raw mail (``raw=True``: each micro-batch is parsed first); every micro-batch
goes through selection and silver and is upserted into the keyed store as
batch ``epoch_id`` of this stream. Messages that can't be used go to the
store's quarantine under the same epoch. With ``availableNow`` the query
processes what is there and stops, which replaces an hourly scheduled run; a
second run on unchanged input processes nothing (the checkpoint remembers the
files). A replayed epoch overwrites its own log partition and
quarantine, so the store is
exactly-once even though the sink is not transactional.
"""

from __future__ import annotations

import datetime as dt
from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.operators import search as sr
from triage.operators.silver import to_silver
from triage.plans.pipeline import observed
from triage.schema import SEARCH_KEYWORDS
from triage.session import materialize
from triage.sources import mime
from triage.sources.mailbox import read_messages, read_raw
from triage.sources.mime_columns import parse
from triage.sources.store import KeyedStore


def micro_batch(store: KeyedStore, stream: str, keywords=SEARCH_KEYWORDS, counters=None, raw: bool = False):
    """The ``foreachBatch`` function: (parse,) keyword search, silver, upsert."""

    def run(df: DataFrame, epoch_id: int) -> None:
        if raw:
            now = dt.datetime.now(dt.timezone.utc).isoformat()
            # parsed once: the upsert and the quarantine read the copy
            df = mime.stamp(materialize(parse(df), "parsed"), now)
        # the upsert's write counts what can't be used; the batch is read again only if there is any
        fetched, watch = observed(sr.usable(df, keywords), F.col("_reason").isNull())
        counts = store.upsert(to_silver(fetched.where(F.col("_reason").isNull())), stream=stream,
                              batch_id=int(epoch_id))
        rejects = sr.rejects(fetched) if watch.get["dropped"] else sr.rejects(fetched).limit(0)
        store.put_aside(rejects, f"{stream}-{int(epoch_id)}")
        if counters is not None:
            counters.append((int(epoch_id), counts))

    return run


def run_stream(spark: SparkSession, source: str, store: KeyedStore, stream: str = "mail",
               checkpoint: Optional[str] = None, fmt: str = "parquet",
               keywords=SEARCH_KEYWORDS, max_files_per_trigger: Optional[int] = None, raw: bool = False) -> list:
    """Process all available input once; returns ``[(epoch, counts), ...]``."""
    counters: list = []
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    messages = (read_raw if raw else read_messages)(spark, source, fmt=fmt, stream=True, **options)
    checkpoint = checkpoint or f"{store.root}/checkpoints/{stream}"
    store.claim_stream(stream, checkpoint)
    q = (messages.writeStream
         .foreachBatch(micro_batch(store, stream, keywords, counters, raw))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return counters
