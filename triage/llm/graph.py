"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import removed, scratch_path, written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One round of star contraction over (a, b) with a > b: neighbours (the
    larger ones, or the smaller ones and the node itself) are tied to the
    least of the neighbourhood. The minimum is combined map-side; the join
    with it can split a hot node."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        tied = edges.join(least, "a")
        out = tied.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 100) -> DataFrame:
    """(node, component) of every node of an edge, the component being its
    least node. Alternates large and small stars until nothing changes; each
    round is written to the shared folder, and the one before it removed."""
    spark = edges.sparkSession
    now = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct())
    mark, before = None, None
    for _ in range(most_rounds):
        path = scratch_path(spark, "components")
        now = written(_stars(_stars(now, True), False), "components", path)
        if before:
            removed(spark, before)
        before = path
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (found.n, found.h) == mark:
            break
        mark = (found.n, found.h)
    else:
        raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
