"""Session settings and the shared work folder.

The pipeline never picks a machine-local folder on a cluster: durable
intermediate data (hand-offs, state, ledgers) goes below the folder the
cluster names in ``spark.checkpoint.dir``. Only when that setting is absent
(unit tests, a laptop) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# HotSpot only interprets methods of more bytes of code than this
COMPILED_BYTES = 8000


def builder(master: str = "local[*]", shuffle_partitions: int = 8) -> SparkSession.Builder:
    """Builder with the settings the pipeline assumes (UTC, AQE, no UI)."""
    return (
        SparkSession.builder.master(master)
        .appName("triage")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.speculation", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings every query relies on.

    Timestamps are compared as UTC wall-clock values, so the session zone is
    always UTC. Stages whose generated method the JVM would never compile (the
    subject patterns behind the mailbox join are one) run operator by operator,
    whose projections are generated as small methods.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by driver and executors for durable intermediate data.

    Only a local session (tests, a laptop) may make one of its own; on a
    cluster a missing ``spark.checkpoint.dir`` is an error."""
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="triage-ckpt-"))
        path = sc.getCheckpointDir()
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for one job's output, removed
    when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(jpath)
    return path


def materialize(df, name: str = "table"):
    """``df`` written once below the shared folder as Parquet and read again
    (lineage cut, later reads prune columns)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
