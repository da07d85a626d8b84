"""Schemas and fixed values of the message-triage pipeline.

Every layer uses one ``StructType`` per stage so that a contract check can
compare ``df.schema`` before any job runs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values of the original pipeline for the
# results to match; they are stated here plainly, in their natural order.
# ---------------------------------------------------------------------------

# Subject keywords of the mailbox search (case-insensitive substring match).
SEARCH_KEYWORDS = ["application", "internship", "intern", "position", "opportunity"]

# Classifier phrases, plain lower-case substrings of lower(subject + " " + body).
REJECTION_PHRASES = [
    "not moving forward",
    "not been shortlisted",
    "decided not to proceed",
    "unable to offer",
    "other candidates",
    "not selected",
    "not successful",
    "unfortunately",
    "regret",
]
ACCEPTANCE_PHRASES = [
    "pleased to inform",
    "happy to inform",
    "next steps",
    "welcome aboard",
    "interview invitation",
    "congratulations",
    "moving forward",
    "selected",
]

# Subject patterns in priority order: (pattern, position group, company group).
# Case-insensitive, Unicode classes, "." stops only at "\n".
SUBJECT_PATTERNS = [
    (r"application\s+(?:for|to)\s+(.+?)\s+(?:at|[-–])\s+(\S+)", 1, 2),
    (r"(.+?\b(?:intern|internship|position|role))\s+at\s+(\S+)", 1, 2),
    (r"(.+?)\s+[-–|]\s+(.+?)\s+at\s+(\S+)", 1, 3),
    (r"application\s+to\s+(\S+):\s*(.+)", 2, 1),
]

# Sender domain: first "@" followed by word characters, dots and dashes.
SENDER_DOMAIN_PATTERN = r"@([\w.\-]+)"

# Light address check used before delivery.
EMAIL_ADDRESS_PATTERN = r"^[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}$"

# Status -> human label; other statuses are title-cased.
STATUS_LABELS = {
    "rejected": "Rejected",
    "advanced": "Next step",
    "application_received": "Application Received",
    "offer": "Offer",
    "interview_invite": "Interview Invitation",
    "unknown": "Update",
}

# Statuses that produce an alert.
ALERT_STATUSES = ["rejected", "advanced"]

# Words of alerts for missing fields, and the subject-line separator.
UNKNOWN_FIELD = "Unknown"
UNKNOWN_EMPLOYER = "An employer"
SUBJECT_SEPARATOR = " — "

# RFC 822 / RFC 2822 zone names and their offsets in minutes (public RFC values).
ZONE_OFFSETS_MIN = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180,
    "EST": -300, "EDT": -240,
    "CST": -360, "CDT": -300,
    "MST": -420, "MDT": -360,
    "PST": -480, "PDT": -420,
}

# English month names accepted in dates: three-letter and full forms.
MONTHS_SHORT = ["jan", "feb", "mar", "apr", "may", "jun",
                "jul", "aug", "sep", "oct", "nov", "dec"]
MONTHS_LONG = ["january", "february", "march", "april", "may", "june",
               "july", "august", "september", "october", "november", "december"]

# Delivery defaults: at most 50 alerts per run, 3 attempts, 2 s backoff base.
DEFAULT_ALERT_LIMIT = 50
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_BACKOFF_BASE = 2.0

# Subject tag of outgoing alerts and the header carrying the source id.
DEFAULT_SUBJECT_TAG = "[Triage]"
SOURCE_ID_HEADER = "X-Triage-Message-ID"

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

# Parsed message, one row per fetched message (all strings, as fetched).
BRONZE_SCHEMA = T.StructType([
    T.StructField("email_id", T.StringType()),
    T.StructField("message_id", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("date", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("scraped_at", T.StringType()),
])

# Raw mailbox row: UID, mailbox name, seen flag and the RFC 822 bytes.
RAW_SCHEMA = T.StructType([
    T.StructField("mailbox", T.StringType()),
    T.StructField("uid", T.LongType()),
    T.StructField("seen", T.BooleanType()),
    T.StructField("raw", T.BinaryType()),
])

# Silver and gold rows (gold adds no column; the alert flag is derived).
SILVER_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType(), False),
    T.StructField("email_uid", T.StringType()),
    T.StructField("sender", T.StringType()),
    T.StructField("sender_domain", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("position", T.StringType()),
    T.StructField("subject", T.StringType()),
    T.StructField("date_received", T.TimestampNTZType()),
    T.StructField("body_clean", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("alerta_enviado", T.BooleanType()),
    T.StructField("scraped_at", T.TimestampNTZType()),
])
SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]

# Columns written by an upsert: every silver column but the alert flag.
UPSERT_COLUMNS = [c for c in SILVER_COLUMNS if c != "alerta_enviado"]

# Delivery outcome, one row per attempted alert.
OUTCOME_SCHEMA = T.StructType([
    T.StructField("message_id", T.StringType()),
    T.StructField("outcome", T.StringType()),   # sent | fallback | failed
    T.StructField("ok", T.BooleanType()),
    T.StructField("detail", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
])


class ContractError(ValueError):
    """A frame misses columns that a stage needs."""


def check_columns(df, required, stage: str) -> None:
    """Fail before any job runs when ``df`` lacks a required column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"{stage}: missing columns {missing}")


def check_types(df, schema: T.StructType, stage: str) -> None:
    """Fail before any job runs when a column of ``schema`` that ``df`` has is
    of another type (a column that is all NULL may be untyped)."""
    wrong = {f.name: df.schema[f.name].dataType.simpleString() for f in schema.fields
             if f.name in df.columns and df.schema[f.name].dataType not in (f.dataType, T.NullType())}
    if wrong:
        raise ContractError(f"{stage}: columns of another type {wrong}")
