"""Every registered query equals its oracle SQL (DuckDB) on sf0.001."""

from __future__ import annotations

import pytest

from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_registry_complete():
    from __spark_entry__ import oracle_sql, queries
    from triage.plans.oracle import ORACLE_SQL
    from triage.plans.queries import QUERIES

    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(__import__("triage.plans.queries", fromlist=["QUERIES"]).QUERIES))
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF, [name], verbose=False)[name]
    assert res["ok"], res


def test_entry(spark):
    from __spark_entry__ import entry

    rows = {r["status"]: r["n"] for r in entry(spark).collect()}
    assert set(rows) <= {"rejected", "advanced", "unknown"} and sum(rows.values()) > 0


SPARK_TO_DUCK = {"StringType()": "VARCHAR", "LongType()": "BIGINT", "IntegerType()": "INTEGER",
                 "BooleanType()": "BOOLEAN", "DoubleType()": "DOUBLE",
                 "TimestampNTZType()": "TIMESTAMP"}


def test_column_types_match_oracle(spark):
    from tests.oracle_check import duck
    from triage.plans.oracle import ORACLE_SQL
    from triage.plans.queries import QUERIES

    con = duck(SF)
    bad = {}
    for name, fn in QUERIES.items():
        rel = con.sql(ORACLE_SQL[name])
        want = dict(zip(rel.columns, [str(t) for t in rel.types]))
        got = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in fn(spark, SF).schema}
        if got != want:
            bad[name] = (got, want)
    assert not bad, bad
