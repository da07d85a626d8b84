"""Benchmark of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line. Every timing forces the
whole result through a ``noop`` sink (no collect to the driver) and is the
median of ``$BENCH_RUNS`` runs after one warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from triage.operators import merge as mg  # noqa: E402
from triage.plans import fixture as fx  # noqa: E402
from triage.plans.queries import QUERIES  # noqa: E402
from triage.session import builder  # noqa: E402


def upsert_at(overlap_thousandths: int):
    """Merge with the given key overlap: target ends and batch starts
    ``overlap/2`` around the middle of the UID range."""
    half = overlap_thousandths // 2

    def q(spark, d):
        return mg.merge_tagged(fx.tagged_rows(spark, d, end=500 + half, start=500 - half))

    return q


HEADLINE = {
    "silver_messages": QUERIES["silver_messages"],
    "upsert_merge_1pct": upsert_at(10),
    "upsert_merge_50pct": upsert_at(500),
    "pending_alerts": QUERIES["pending_alerts"],
    "html_to_text": QUERIES["html_to_text"],
    "parse_mime": QUERIES["parse_mime"],
    "run_summary": QUERIES["run_summary"],
}


def timed(spark, fn, d, runs: int) -> float:
    def once():
        t = time.perf_counter()
        fn(spark, d).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    once()  # warm-up: JIT, Python workers, file listing
    return statistics.median(once() for _ in range(runs))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (builder(f"local[{cpus}]", shuffle_partitions=2 * cpus)
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    chosen = {k: v for k, v in HEADLINE.items() if not only or k in only}
    times = {name: round(timed(spark, fn, sf_dir, runs), 3) for name, fn in chosen.items()}

    ev = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    html_bytes = (spark.read.parquet(f"{sf_dir}/pages.parquet")
                  .agg(F.sum(F.octet_length("html"))).first()[0] or 0)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "throughput": {k: v for k, v in {
            "silver_messages_rows_per_s": round(ev / times["silver_messages"], 1) if "silver_messages" in times else None,
            "parse_mime_msgs_per_s": round(ev / times["parse_mime"], 1) if "parse_mime" in times else None,
            "html_to_text_MB_per_s": round(html_bytes / 1e6 / times["html_to_text"], 2) if "html_to_text" in times else None,
        }.items() if v is not None and not __import__("math").isnan(v)},
        "config": {"master": f"local[{cpus}]", "runs": runs, "spark": spark.version,
                   "shuffle_partitions": 2 * cpus,
                   "driver_memory": spark.conf.get("spark.driver.memory")},
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
