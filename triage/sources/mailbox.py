"""Message sources (S1) and the mailbox derived from the test tables.

``read_messages`` reads parsed messages (bronze rows) from Parquet or JSON with
a fixed schema, batch or streaming. ``read_raw`` reads raw RFC 822 messages,
either a table with a ``raw`` binary column or one file per message.

``mailbox_view`` builds a mailbox from the driver tables, because the test
data holds no mail: one message per ``events`` row, its body taken from
``documents`` (every document is used, ``doc_id = event_id % count``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triage.schema import BRONZE_SCHEMA, RAW_SCHEMA
from triage.session import prepare

# Fixture values of the derived mailbox (see FIXTURES.md, section 3).
FIXTURE_DOMAINS = ["grab.com", "careers.stripe.co.uk", "credit-karma.com",
                   "rolls_royce.com", "3m.io"]
FIXTURE_SUBJECTS = [
    "Application for Backend Intern - Stripe",
    "Next steps: Data Intern at Grab",
    "Data Intern | Robinhood at Robinhood",
    "Your application to Grab: Software Engineer Intern",
    "Hello there",
    "Your position",
    "INTERNSHIP opportunity",
    "",
]
FIXTURE_BODY_PREFIX = {
    "error": "Unfortunately, we will not be moving forward. ",
    "purchase": "Congratulations! We are pleased to inform you. ",
    "signup": "You have been SELECTED. ",
    "click": "not selected. ",
}
FIXTURE_MAILBOXES = 4


def read_messages(spark: SparkSession, path: str, fmt: str = "parquet",
                  stream: bool = False, **options) -> DataFrame:
    """Parsed messages with ``BRONZE_SCHEMA`` (no schema inference)."""
    reader = (spark.readStream if stream else spark.read).options(**options)
    return reader.schema(BRONZE_SCHEMA).format(fmt).load(path)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet", stream: bool = False, **options) -> DataFrame:
    """Raw messages with ``RAW_SCHEMA``, as a batch or a stream of files.

    ``fmt="binaryFile"`` reads one message per file: the UID is the numeric
    file name (NULL otherwise), the mailbox the parent folder name.
    """
    reader = (spark.readStream if stream else spark.read).options(**options)
    if fmt != "binaryFile":
        return reader.schema(RAW_SCHEMA).format(fmt).load(path)
    files = reader.format("binaryFile").load(path)
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    folder = F.element_at(F.split(F.col("path"), "/"), -2)
    return files.select(
        folder.alias("mailbox"),
        F.regexp_extract(name, r"^(\d+)", 1).try_cast("bigint").alias("uid"),
        F.lit(False).alias("seen"),
        F.col("content").alias("raw"))


def mailbox_view(spark: SparkSession, sf_dir: str, keep=(), only: DataFrame | None = None) -> DataFrame:
    """Derived mailbox: ``mailbox, uid`` plus the bronze columns, and the
    columns ``keep`` of ``events`` as they are. With ``only`` (columns of
    ``events``) it has the messages of the events that agree with one of its
    rows: they are chosen before their bodies are looked up.

    * ``uid = event_id + 1`` (IMAP UIDs start at 1); ``mailbox`` from ``user_id``.
    * ``message_id`` is blank when ``event_id % 37 = 0`` (such broken messages
      also carry a non-numeric UID text), repeats the previous event's id when
      ``event_id % 10 = 9``, else ``<m{event_id}@mail.example>``.
    * sender domain by ``user_id % 5``, subject by ``event_id % 8``, body prefix
      by ``event_type``; ``date`` is RFC 2822 text of ``ts``; ``scraped_at`` ISO.
    """
    prepare(spark)
    ev_scan = spark.read.parquet(f"{sf_dir}/events.parquet")
    doc_scan = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n_docs = doc_scan.select(F.count(F.lit(1))).scalar()
    ev = ev_scan.select("event_id", "ts", "user_id", "event_type").withColumn(
        "doc_key", F.try_mod(F.col("event_id"), n_docs))
    if only is not None:
        ev = ev.join(only, [ev[c].eqNullSafe(only[c]) for c in only.columns], "left_semi")
    # both sides hold data that grows: a shuffle join, whose skewed partitions AQE splits
    docs = doc_scan.select("doc_id", "text").hint("shuffle_hash")
    j = ev.join(docs, ev["doc_key"] == docs["doc_id"], "inner")

    e = F.col("event_id")
    uid = e + 1
    mid = (F.when(e % 37 == 0, F.lit(""))
           .when(e % 10 == 9, F.concat(F.lit("<m"), (e - 1).cast("string"), F.lit("@mail.example>")))
           .otherwise(F.concat(F.lit("<m"), e.cast("string"), F.lit("@mail.example>"))))
    email_id = F.when(e % 37 == 0, F.concat(F.lit("u"), uid.cast("string"))).otherwise(uid.cast("string"))
    domains = F.array(*[F.lit(d) for d in FIXTURE_DOMAINS])
    subjects = F.array(*[F.lit(s) for s in FIXTURE_SUBJECTS])
    prefix = F.coalesce(
        F.try_element_at(F.create_map(*[x for k, v in FIXTURE_BODY_PREFIX.items()
                                        for x in (F.lit(k), F.lit(v))]), F.col("event_type")),
        F.lit(""))
    return j.select(
        F.concat(F.lit("box"), (F.col("user_id") % FIXTURE_MAILBOXES).cast("string")).alias("mailbox"),
        uid.alias("uid"),
        email_id.alias("email_id"),
        mid.alias("message_id"),
        F.concat(F.lit("Recruiting <no-reply@"),
                 F.element_at(domains, (F.col("user_id") % len(FIXTURE_DOMAINS) + 1).cast("int")),
                 F.lit(">")).alias("sender"),
        F.element_at(subjects, (e % len(FIXTURE_SUBJECTS) + 1).cast("int")).alias("subject"),
        F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")).alias("date"),
        F.concat(prefix, F.col("text")).alias("body"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("scraped_at"),
        *keep,
    )


def bronze(df: DataFrame) -> DataFrame:
    """The seven bronze columns of a mailbox frame."""
    return df.select(*BRONZE_SCHEMA.fieldNames())
