"""Print the condensed physical plan of registered queries (joins, exchanges,
aggregates, top-k, Python nodes, scans) after one run, for plan review.

Usage: python tests/plan_report.py [sf_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = re.compile(r"Join|Exchange|Aggregate|TakeOrdered|MapInPandas|ArrowEvalPython|"
                  r"BatchEvalPython|Generate|Window|Scan parquet|FileScan")
HEADLINE = ["silver_messages", "upsert_merge", "pending_alerts", "existing_keys",
            "uid_watermark", "html_to_text", "parse_mime"]


def main() -> None:
    from triage.plans.queries import QUERIES
    from triage.session import builder

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or HEADLINE
    spark = builder("local[8]").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        df = QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()  # final adaptive plan
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {name}")
        for line in plan.splitlines():
            if KEEP.search(line) and "Subquery" not in line:
                print("  " + line[:150])


if __name__ == "__main__":
    main()
