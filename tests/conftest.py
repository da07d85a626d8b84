"""Shared fixtures: one local Spark session, sample messages."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from triage.session import builder

    s = (builder("local[4]", shuffle_partitions=8)
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="triage-test-ckpt-"))
    yield s


@pytest.fixture
def tmp_root(tmp_path):
    return str(tmp_path)


def _mail(uid, key, who, subject, minute, body):
    """One bronze record, fetched half a minute after it was sent."""
    return dict(email_id=str(uid), message_id=key, sender=who, subject=subject, body=body,
                date=f"Mon, 2 Mar 2026 08:{minute:02d}:05 +0100", scraped_at=f"2026-03-02T07:{minute:02d}:35+00:00")


# a refusal, an invitation, and mail that is about neither
SAMPLE = [
    _mail(11, "<k1@norwind.example>", "Norwind People <jobs@norwind.example>",
          "Application for Harbour Analyst - Norwind", 15, "We regret that the post is filled."),
    _mail(12, "<k2@tidal.example>", "talent@tidal.example",
          "Lab position at Tidal", 20, "Welcome aboard the second round!"),
    _mail(13, "<k3@weekly.example>", "Weekly Digest <news@weekly.example>",
          "Seven maps of the coast", 25, "Maps, tides and a crossword."),
]


@pytest.fixture
def sample_records():
    return [dict(r) for r in SAMPLE]


def bronze_df(spark, records):
    from triage.schema import BRONZE_SCHEMA

    rows = [tuple(r.get(c) for c in BRONZE_SCHEMA.fieldNames()) for r in records]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


@pytest.fixture
def make_bronze(spark):
    return lambda records: bronze_df(spark, records)
