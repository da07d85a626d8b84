"""Helpers shared by the operators: scratch tables, batch sizes, folds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch: a Python worker holds one batch at a time.
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts (never raises a lower
    setting)."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or int(now) > most or int(now) <= 0:
            spark.conf.set(key, str(most))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the
    context's checkpoint folder. Only a local session may fall back to a
    temporary folder of its own; elsewhere a missing setting is an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    made = tempfile.mkdtemp(prefix="llm-scratch-")
    spark.sparkContext.setCheckpointDir(made)
    return f"file://{made}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder (a new path, or ``path``) as Parquet
    and read again: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def id_text(col: str) -> Column:
    """A row's id as text; a null id counts as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fold(col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(id_text(col)) % folds


def unit_hash(col: str, seed: int) -> Column:
    """A deterministic number in [0, 1) from a column."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(col)), F.lit(1 << 40)) / float(1 << 40)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int,
                    held_out: int, max_rows: int, seed: int = 7) -> DataFrame:
    """Rows of ``docs`` with ``_y`` (the 0/1 label) outside the held-out fold,
    at most about ``max_rows`` of them (a hash of the id against the share
    that fits; about: the count of a random draw). An id that is labelled
    twice counts once, with its larger label; null ids and labels are left
    out."""
    lab = (labels.select(F.col("doc_id").alias("_lid"), F.col(label).cast("int").alias("_y"))
           .where("_lid is not null and _y is not null")
           .where(fold("_lid", folds) != held_out)
           .groupBy("_lid").agg(F.max("_y").alias("_y")))
    n = lab.count()
    share = min(1.0, max_rows / max(n, 1))
    if share < 1.0:
        lab = lab.where(unit_hash("_lid", seed) < share)
    return docs.join(lab, F.col("doc_id") == F.col("_lid")).drop("_lid")
