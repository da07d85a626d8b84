"""Streaming ingest equals batch; replays and re-runs add nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from triage.operators import search as sr
from triage.operators.silver import to_silver
from triage.sources.mailbox import bronze, mailbox_view
from triage.sources.store import KeyedStore
from triage.streaming.ingest import run_stream

SF = "/root/testdata/sf0.001"


def test_raw_mail_streams_into_the_store(spark, tmp_root):
    from tests.test_pipeline import MAILS, raw_frame

    src = f"{tmp_root}/mail"
    raw_frame(spark, MAILS).coalesce(1).write.parquet(f"{src}/a")
    raw_frame(spark, [(31, b"")]).coalesce(1).write.parquet(f"{src}/b")
    store = KeyedStore(spark, f"{tmp_root}/raw")
    got = run_stream(spark, f"{src}/*", store, stream="raw", raw=True, max_files_per_trigger=1)
    assert len(got) == 2 and sum(c["inserted"] for _, c in got) == 3
    assert {r["status"] for r in store.gold().collect()} == {"rejected", "advanced", "unknown"}
    assert [(r["uid"], r["reason"]) for r in store.quarantine().collect()] == [(31, "empty_payload")]
    assert run_stream(spark, f"{src}/*", store, stream="raw", raw=True) == []


def test_stream_equals_batch(spark, tmp_root):
    mb = mailbox_view(spark, SF)
    src = f"{tmp_root}/inbox"
    # two arrivals: lower and upper half of the UIDs, as separate files
    bronze(mb.where(F.col("uid") <= 500)).coalesce(1).write.parquet(f"{src}/part=0")
    bronze(mb.where(F.col("uid") > 500)).coalesce(1).write.parquet(f"{src}/part=1")

    streamed = KeyedStore(spark, f"{tmp_root}/s")
    ckpt = f"{tmp_root}/ckpt"
    run_stream(spark, f"{src}/*", streamed, checkpoint=ckpt, max_files_per_trigger=1)
    again = run_stream(spark, f"{src}/*", streamed, checkpoint=ckpt)
    assert again == []  # nothing new: no micro-batch

    batch = KeyedStore(spark, f"{tmp_root}/b")
    picked = sr.search(bronze(mb)).where(sr.numeric_uid(F.col("email_id")).isNotNull())
    batch.upsert(to_silver(picked))

    a = sorted(tuple(r) for r in streamed.gold().collect())
    b = sorted(tuple(r) for r in batch.gold().collect())
    assert len(a) > 0 and a == b


def test_a_micro_batch_without_rejects_is_read_once(spark, tmp_root, make_bronze, sample_records):
    from triage.streaming.ingest import micro_batch

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def counted(records):
        df = make_bronze(records)
        return df.mapInArrow(count, df.schema)

    store, counters = KeyedStore(spark, f"{tmp_root}/once"), []
    run = micro_batch(store, "mail", counters=counters)
    run(counted(sample_records[:2]), 0)
    assert seen.value == 2 and counters == [(0, {"inserted": 2, "updated": 0})]
    assert store.quarantine().count() == 0 and [k for k in store.log.table("quarantine").rows] == [("mail-0",)]
    blank = dict(sample_records[0], message_id=" ", email_id="77")
    run(counted([sample_records[1], blank]), 1)
    assert counters[1] == (1, {"inserted": 0, "updated": 1})
    assert [(r.email_id, r.reason, r.run_id) for r in store.quarantine().collect()] == [("77", "missing_message_id", "mail-1")]
    run(counted([sample_records[1]]), 1)  # a replay replaces what was put aside
    assert store.quarantine().count() == 0
