"""Oracle SQL for every registered query, runnable by DuckDB on the test
tables (views ``events``, ``documents``, ``pages``, ``conversations`` ...).

The SQL restates each operator's semantics directly (RE2 regexes, CASE,
window functions), independently of the Spark code. Column names equal the
Spark queries'. Python white space is spelled out as a class because RE2's
``\\s`` is ASCII only.
"""

from __future__ import annotations

from triage.functions.html import ENTITY_VALUES, LEGACY_PATTERN, LEGACY_VALUES
from triage.schema import (
    ACCEPTANCE_PHRASES, DEFAULT_SUBJECT_TAG, EMAIL_ADDRESS_PATTERN, MONTHS_LONG, MONTHS_SHORT,
    REJECTION_PHRASES, SEARCH_KEYWORDS, SENDER_DOMAIN_PATTERN, STATUS_LABELS, SUBJECT_PATTERNS,
    ZONE_OFFSETS_MIN,
)
from triage.sources.mailbox import (
    FIXTURE_BODY_PREFIX, FIXTURE_DOMAINS, FIXTURE_MAILBOXES, FIXTURE_SUBJECTS,
)

PY_WS = (r"[\t\n\x0b\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
CASED = r"\p{Lu}\p{Ll}\p{Lt}"
ALERT_SENDER = "alerts@triage.example"
ALERT_RECIPIENT = "me@triage.example"
LIMIT = 50


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def lst(items) -> str:
    return "[" + ", ".join(q(i) for i in items) + "]"


# -- scalar expressions --------------------------------------------------------

def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{PY_WS}+|{PY_WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{PY_WS}+', ' ', 'g'), ' ')"


def normalize(x: str) -> str:
    return f"lower({collapse(x)})"


def sender_domain(x: str) -> str:
    return f"lower(regexp_extract(coalesce({x}, ''), {q(SENDER_DOMAIN_PATTERN)}, 1))"


def title(x: str) -> str:
    runs = f"regexp_extract_all({x}, '([{CASED}]+|[^{CASED}]+)', 1)"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def company(domain: str) -> str:
    return title(f"translate(split_part(coalesce({domain}, ''), '.', 1), '-_', '  ')")


def classify(subject: str, body: str) -> str:
    t = f"lower(coalesce({subject}, '') || ' ' || coalesce({body}, ''))"
    rej = " OR ".join(f"contains({t}, {q(p)})" for p in REJECTION_PHRASES)
    acc = " OR ".join(f"contains({t}, {q(p)})" for p in ACCEPTANCE_PHRASES)
    return f"CASE WHEN {rej} THEN 'rejected' WHEN {acc} THEN 'advanced' ELSE 'unknown' END"


WEEKDAY_RE = r"(?:[^\s,]*,\s*|(?:mon|tue|wed|thu|fri|sat|sun)\s+)?"
DASH_RE = r"(?i)^(\s*" + WEEKDAY_RE + r")([^\s-]+)-([^\s-]+)-([^\s-]+)(\s+\S+\s+\S+\s*)$"
DATE_RE = (
    r"(?i)^\s*" + WEEKDAY_RE +
    r"(?:(\d{1,2})\s+([a-z]+)|([a-z]+)\s+(\d{1,2}),?)\s+(\d{1,4}),?\s+"
    r"(\d{1,2})[:.](\d{1,2})(?:[:.](\d{1,2}))?"
    r"(?:\s*([+-]?\d{1,4}|[a-z]+))?\s*(?:\(.*\))?\s*$"
)


def parse_date(x: str) -> str:
    s = f"regexp_replace(coalesce({x}, ''), {q(DASH_RE)}, '\\1\\2 \\3 \\4\\5')"

    def g(i):
        return f"regexp_extract({s}, {q(DATE_RE)}, {i})"

    day = f"TRY_CAST(CASE WHEN {g(1)} <> '' THEN {g(1)} ELSE {g(4)} END AS INTEGER)"
    mon = f"lower(CASE WHEN {g(2)} <> '' THEN {g(2)} ELSE {g(3)} END)"
    pos = f"coalesce(list_position({lst(MONTHS_SHORT + MONTHS_LONG)}, {mon}), 0)"
    month = f"CASE WHEN {pos} > 0 THEN ({pos} - 1) % 12 + 1 END"
    yy = f"TRY_CAST({g(5)} AS INTEGER)"
    year = f"CASE WHEN {yy} < 100 THEN CASE WHEN {yy} > 68 THEN {yy} + 1900 ELSE {yy} + 2000 END ELSE {yy} END"
    sec = f"CASE WHEN {g(8)} = '' THEN 0 ELSE TRY_CAST({g(8)} AS INTEGER) END"
    z = f"upper({g(9)})"
    named = " ".join(f"WHEN {q(k)} THEN {v}" for k, v in ZONE_OFFSETS_MIN.items())
    num = f"TRY_CAST({z} AS INTEGER)"
    numeric = f"(CASE WHEN {num} < 0 THEN -1 ELSE 1 END) * ((abs({num}) // 100) * 60 + abs({num}) % 100)"
    offset = (f"coalesce(CASE {z} {named} END, "
              f"CASE WHEN regexp_matches({z}, '^[+-]?\\d+$') THEN {numeric} END, 0)")
    local = (f"try(make_timestamp({year}, {month}, {day}, TRY_CAST({g(6)} AS INTEGER), "
             f"TRY_CAST({g(7)} AS INTEGER), CASE WHEN {sec} < 60 THEN {sec} END))")
    return (f"CASE WHEN regexp_matches({s}, {q(DATE_RE)}) "
            f"THEN {local} - to_minutes(CAST({offset} AS BIGINT)) END")


def parse_iso(x: str) -> str:
    return f"timezone('UTC', TRY_CAST(nullif({x}, '') AS TIMESTAMPTZ))"


def subject_candidates(subject: str) -> list[tuple[str, str]]:
    out = []
    for pattern, pg, cg in SUBJECT_PATTERNS:
        p = q("(?i)" + pattern)
        out.append((strip(f"regexp_extract({subject}, {p}, {pg})"),
                    strip(f"regexp_extract({subject}, {p}, {cg})")))
    return out


def status_label(x: str, empty: str) -> str:
    known = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in STATUS_LABELS.items())
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN {q(empty)} "
            f"ELSE coalesce(CASE {x} {known} END, {title(x)}) END")


def or_default(x: str, d: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN {q(d)} ELSE {x} END"


def payload(company_c: str, position_c: str, status_c: str) -> str:
    return ("'Update on your internship application' || chr(10) || chr(10) || '  Company : ' || "
            f"{or_default(company_c, 'Unknown')} || chr(10) || '  Role    : ' || "
            f"{or_default(position_c, 'Unknown')} || chr(10) || '  Status  : ' || "
            f"{status_label(status_c, '')} || chr(10)")


def alert_subject(company_c: str, status_c: str) -> str:
    return (f"{q(DEFAULT_SUBJECT_TAG + ' ')} || {status_label(status_c, 'Update')} || ' — ' || "
            f"{or_default(company_c, 'An employer')}")


def html_text(x: str) -> tuple[str, str]:
    """``(stripped, text)``: the markup-free expression over ``x`` and the final
    expression over the column ``s3`` that holds it."""
    markup = ("(?is)" + "|".join(rf"<{el}\b.*?(?:</{el}\s*>|\z)" for el in ("script", "style", "template"))
              + r"|<!--.*?(?:-->|\z)|<[/!?a-zA-Z][^>]*>")
    s = f"regexp_replace({x}, {q(markup)}, ' ', 'g')"
    token = r"(&#[0-9]{1,7};|&#[xX][0-9a-fA-F]{1,6};|&[^\t\n\f <&#;]{1,32};?|[^&]+|&)"
    named = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in ENTITY_VALUES.items())
    legacy = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in LEGACY_VALUES.items())
    prefix = f"regexp_extract(t, {q(LEGACY_PATTERN)})"

    def cp(code):
        return (f"chr(CAST(CASE WHEN {code} = 0 OR ({code} >= 55296 AND {code} <= 57343) "
                f"OR {code} > 1114111 THEN 65533 ELSE {code} END AS INTEGER))")

    hexv = "TRY_CAST(('0x' || substr(t, 4, length(t) - 4)) AS BIGINT)"
    decv = "TRY_CAST(substr(t, 3, length(t) - 3) AS BIGINT)"
    one = (f"CASE WHEN t LIKE '&#x%' OR t LIKE '&#X%' THEN {cp(hexv)} "
           f"WHEN t LIKE '&#%' THEN {cp(decv)} "
           f"WHEN t LIKE '&%' THEN coalesce(CASE t {named} END, "
           f"CASE {prefix} {legacy} END || substr(t, length({prefix}) + 1), t) ELSE t END")
    decoded = (f"CASE WHEN instr(s3, '&') > 0 THEN array_to_string(list_transform("
               f"regexp_extract_all(s3, {q(token)}, 1), lambda t: {one}), '') ELSE s3 END")
    return s, collapse(decoded)


# -- shared CTEs ---------------------------------------------------------------

def _prefix_case() -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in FIXTURE_BODY_PREFIX.items())
    return f"CASE e.event_type {whens} ELSE '' END"


MAILBOX = f"""
mb AS (
  SELECT 'box' || CAST(e.user_id % {FIXTURE_MAILBOXES} AS VARCHAR) AS mailbox,
         e.event_id + 1 AS uid,
         CASE WHEN e.event_id % 37 = 0 THEN 'u' || CAST(e.event_id + 1 AS VARCHAR)
              ELSE CAST(e.event_id + 1 AS VARCHAR) END AS email_id,
         CASE WHEN e.event_id % 37 = 0 THEN ''
              WHEN e.event_id % 10 = 9 THEN '<m' || CAST(e.event_id - 1 AS VARCHAR) || '@mail.example>'
              ELSE '<m' || CAST(e.event_id AS VARCHAR) || '@mail.example>' END AS message_id,
         'Recruiting <no-reply@' || ({lst(FIXTURE_DOMAINS)})[e.user_id % {len(FIXTURE_DOMAINS)} + 1] || '>' AS sender,
         ({lst(FIXTURE_SUBJECTS)})[e.event_id % {len(FIXTURE_SUBJECTS)} + 1] AS subject,
         strftime(e.ts, '%a, %d %b %Y %H:%M:%S') || ' +0000' AS date,
         {_prefix_case()} || d.text AS body,
         strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS scraped_at
  FROM events e
  JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents)
)"""


def _silver_select(src: str, extra: str = "") -> str:
    cands = subject_candidates("coalesce(subject, '')")
    sp_cols = ", ".join(f"{p} AS _p{i}, {c} AS _c{i}" for i, (p, c) in enumerate(cands, 1))
    pos_case = " ".join(f"WHEN _p{i} <> '' AND _c{i} <> '' THEN _p{i}" for i in range(1, 5))
    comp_case = " ".join(f"WHEN _p{i} <> '' AND _c{i} <> '' THEN _c{i}" for i in range(1, 5))
    return f"""
  SELECT {strip('message_id')} AS message_id,
         coalesce(email_id, '') AS email_uid,
         coalesce(sender, '') AS sender,
         {sender_domain('sender')} AS sender_domain,
         CASE {comp_case} ELSE {company(sender_domain('sender'))} END AS company_name,
         CASE {pos_case} ELSE {strip("coalesce(subject, '')")} END AS position,
         coalesce(subject, '') AS subject,
         {parse_date('date')} AS date_received,
         {normalize('body')} AS body_clean,
         {classify('subject', 'body')} AS status,
         false AS alerta_enviado,
         {parse_iso('scraped_at')} AS scraped_at{extra}
  FROM (SELECT *, {sp_cols} FROM {src} WHERE coalesce({strip('message_id')} <> '', false))"""


SILVER = f"sv AS ({_silver_select('mb', ', uid, mailbox')})"

BOUNDS = "bounds AS (SELECT min(event_id) + 1 AS lo, max(event_id) + 1 AS hi FROM events)"

SILVER_COLS = ["message_id", "email_uid", "sender", "sender_domain", "company_name", "position",
               "subject", "date_received", "body_clean", "status", "alerta_enviado", "scraped_at"]
UPSERT_COLS = [c for c in SILVER_COLS if c != "alerta_enviado"]
_cols = ", ".join(SILVER_COLS)

DEDUP_ORDER = ("TRY_CAST(trim(email_uid) AS BIGINT) DESC NULLS LAST, scraped_at DESC NULLS LAST, "
               "email_uid DESC NULLS LAST")

def state(cols: list[str], source: str = "sv") -> str:
    """Target, batch, merged and pending rows of the given silver columns."""
    names = ", ".join(cols)
    return f"""
{BOUNDS},
trows AS (SELECT s.* FROM {source} s, bounds WHERE s.uid * 1000 <= bounds.lo * 400 + bounds.hi * 600),
brows AS (SELECT s.* FROM {source} s, bounds WHERE s.uid * 1000 > bounds.lo * 600 + bounds.hi * 400),
tg AS (SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY {DEDUP_ORDER}) AS _rn FROM trows) WHERE _rn = 1),
bd AS (SELECT {names} FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY {DEDUP_ORDER}) AS _rn FROM brows) WHERE _rn = 1),
merged AS (
  SELECT coalesce(b.message_id, t.message_id) AS message_id,
         {", ".join(f"CASE WHEN b.message_id IS NOT NULL THEN b.{c} ELSE t.{c} END AS {c}" for c in cols if c != "alerta_enviado" and c != "message_id")},
         coalesce(t.alerta_enviado, false) AS alerta_enviado
  FROM tg t FULL OUTER JOIN bd b ON t.message_id = b.message_id
),
pend AS (
  SELECT message_id, email_uid, company_name, position, status, date_received FROM merged
  WHERE coalesce(NOT alerta_enviado AND status IN ('rejected', 'advanced'), false)
  ORDER BY date_received DESC NULLS LAST, message_id ASC LIMIT {LIMIT}
)"""


STATE = state(SILVER_COLS)

LOW, HIGH = "(SELECT min(event_id) + 1 FROM events)", "(SELECT max(event_id) + 1 FROM events)"
IN_TARGET = f"uid * 1000 <= {LOW} * 400 + {HIGH} * 600"
IN_BATCH = f"uid * 1000 > {LOW} * 600 + {HIGH} * 400"

# what the keys need: no body, no silver row, one pass with windows in place of self-joins
KEYS = f"""
km AS MATERIALIZED (
  SELECT mailbox, uid, message_id, coalesce({strip("message_id")} <> '', false) AS keyed, {IN_TARGET} AS in_target, {IN_BATCH} AS in_batch
  FROM mb)"""

FLAG_COLS = ["message_id", "email_uid", "status", "date_received", "scraped_at"]
# the last row of each key, the batch's before the target's
FLAGS = f"""
ns AS MATERIALIZED (SELECT {', '.join(FLAG_COLS)}, {IN_TARGET} AS in_target, {IN_BATCH} AS in_batch FROM sv),
lk AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY in_batch DESC, {DEDUP_ORDER}) AS _rn FROM ns WHERE in_target OR in_batch)
  WHERE _rn = 1)"""

OUTCOMES = """
outc AS (
  SELECT message_id,
         CASE k WHEN 0 THEN 'sent' WHEN 1 THEN 'sent' ELSE 'failed' END AS outcome,
         k IN (0, 1) AS ok,
         CASE k WHEN 0 THEN 'sent' WHEN 1 THEN 'sent' WHEN 2 THEN 'auth: TransportAuthError'
                WHEN 3 THEN 'exhausted retries: TransientError'
                ELSE 'recipient_refused: RecipientRefusedError' END AS detail,
         CAST(CASE k WHEN 1 THEN 2 WHEN 3 THEN 3 ELSE 1 END AS INTEGER) AS attempts
  FROM (SELECT message_id, coalesce(TRY_CAST(trim(email_uid) AS BIGINT), 0) % 5 AS k FROM pend)
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


def _kw_flags(subject: str) -> list[str]:
    s = f"lower(coalesce({subject}, ''))"
    return [f"contains({s}, {q(k)})" for k in SEARCH_KEYWORDS]


def build() -> dict[str, str]:
    w_mb = _with(MAILBOX)
    w_sv = _with(MAILBOX, SILVER)
    w_state = _with(MAILBOX, SILVER, STATE)
    w_keys = _with(MAILBOX, KEYS)
    w_flags = _with(MAILBOX, SILVER, FLAGS)
    w_out = _with(MAILBOX, SILVER, STATE, OUTCOMES)
    kw_any = " OR ".join(_kw_flags("subject"))
    flags = _kw_flags("subject")
    first = "CASE " + " ".join(f"WHEN {f} THEN {i}" for i, f in enumerate(flags, 1)) + " END"
    kw_rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS keyword_pos, {q(k)} AS keyword, "
        f"CAST(count_if({flags[i-1]}) AS BIGINT) AS hits, "
        f"CAST(count_if(({first}) <= {i}) AS BIGINT) AS unique_new FROM mb"
        for i, k in enumerate(SEARCH_KEYWORDS, 1))
    addr = "regexp_extract(sender, '<([^>]*)>', 1)"
    return {
        "bronze_messages": w_mb + "SELECT mailbox, uid, email_id, message_id, sender, subject, date, body, scraped_at FROM mb",
        "search_keywords": w_mb + f"SELECT uid, subject FROM mb WHERE {kw_any}",
        "keyword_hits": w_mb + kw_rows,
        "unseen_messages": w_keys + (
            "SELECT uid, message_id FROM (SELECT *, bool_or(keyed AND in_target) OVER (PARTITION BY message_id) AS known FROM km) WHERE NOT (keyed AND known)"),
        "uid_watermark": w_keys + (
            "SELECT mailbox, uid FROM (SELECT *, max(uid) FILTER (WHERE keyed AND in_target) OVER (PARTITION BY mailbox) AS last_uid FROM km) "
            "WHERE uid > coalesce(last_uid, 0)"),
        "uid_gaps": w_keys + (
            "SELECT mailbox, uid, message_id FROM (SELECT *, bool_or(keyed AND in_target) OVER (PARTITION BY mailbox, uid) AS known FROM km) WHERE NOT known"),
        "numeric_uid": w_mb + "SELECT email_id, TRY_CAST(trim(email_id) AS BIGINT) AS uid_num FROM mb WHERE TRY_CAST(trim(email_id) AS BIGINT) IS NOT NULL",
        "uid_list_split": w_mb + (
            "SELECT mailbox, uid // 50 AS block, TRY_CAST(trim(email_id) AS BIGINT) AS uid_num FROM mb WHERE TRY_CAST(trim(email_id) AS BIGINT) IS NOT NULL"),
        "drop_missing_id": w_mb + f"SELECT uid, email_id, substr(coalesce(subject, ''), 1, 60) AS subject_head FROM mb WHERE NOT coalesce({strip('message_id')} <> '', false)",
        "normalize_text": f"SELECT conv_id, turn, {normalize('text')} AS text_norm FROM conversations",
        "body_collapse": f"SELECT doc_id, {collapse('text')} AS text_collapsed FROM documents",
        "clean_text": (f"SELECT conv_id, turn, nullif(lower({strip('role')}), '') AS role_clean, "
                       f"nullif({strip('text')}, '') AS text_clean FROM conversations"),
        "sender_domain": w_mb + f"SELECT uid, {sender_domain('sender')} AS sender_domain FROM mb",
        "company_from_domain": w_mb + f"SELECT uid, {company(sender_domain('sender'))} AS company FROM mb",
        "subject_parse": w_mb + _subject_parse_sql(),
        "parse_date": w_mb + f"SELECT uid, {parse_date('date')} AS date_received FROM mb",
        "parse_iso": w_mb + f"SELECT uid, {parse_iso('scraped_at')} AS scraped_ts FROM mb",
        "classify_status": w_mb + f"SELECT uid, {classify('subject', 'body')} AS status FROM mb",
        "silver_messages": w_sv + f"SELECT {_cols} FROM sv",
        "html_to_text": _html_sql(),
        "valid_email": w_mb + (f"SELECT uid, {addr} AS address, coalesce(regexp_matches({strip(addr)}, "
                               f"{q(EMAIL_ADDRESS_PATTERN)}), false) AS is_valid FROM mb"),
        "existing_keys": w_keys + (
            "SELECT uid, message_id, existed FROM (SELECT *, bool_or(in_target) OVER (PARTITION BY message_id) AS existed FROM km WHERE keyed) WHERE in_batch"),
        "upsert_counts": w_state + (
            "SELECT CAST(count_if(t.message_id IS NULL) AS BIGINT) AS inserted, "
            "CAST(count_if(t.message_id IS NOT NULL) AS BIGINT) AS updated "
            "FROM brows b LEFT JOIN tg t ON b.message_id = t.message_id"),
        "upsert_merge": w_state + f"SELECT {_cols} FROM merged",
        "pending_alerts": w_state + "SELECT message_id, company_name, position, status, date_received FROM pend",
        "mark_alerted": w_flags + (
            "SELECT message_id, status, status IN ('rejected', 'advanced') AND row_number() OVER (PARTITION BY status IN ('rejected', 'advanced') "
            f"ORDER BY date_received DESC NULLS LAST, message_id) <= {LIMIT} AS alerta_enviado FROM lk"),
        "status_label": w_sv + f"SELECT uid, status, {status_label('status', '')} AS label FROM sv",
        "alert_payload": w_state + f"SELECT message_id, {payload('company_name', 'position', 'status')} AS payload FROM merged",
        "alert_subject": w_state + f"SELECT message_id, {alert_subject('company_name', 'status')} AS alert_subject FROM merged",
        "alert_message": w_state + (
            f"SELECT message_id, {alert_subject('company_name', 'status')} AS msg_subject, "
            f"{q(ALERT_SENDER)} AS msg_from, {q(ALERT_SENDER)} AS msg_to, message_id AS source_id, "
            f"{payload('company_name', 'position', 'status')} AS msg_body FROM pend"),
        "alert_json": w_state + (
            f"SELECT message_id, message_id AS json_message_id, "
            f"{payload('company_name', 'position', 'status')} AS json_payload FROM pend"),
        "delivery_outcomes": w_out + "SELECT message_id, outcome, ok, detail, attempts FROM outc",
        "notify_counts": w_out + (
            "SELECT CAST(count_if(outcome = 'sent') AS BIGINT) AS notified, "
            "CAST(count_if(outcome = 'failed') AS BIGINT) AS failed, "
            "CAST(count_if(outcome = 'fallback') AS BIGINT) AS fallback FROM outc"),
        "backoff_schedule": w_out + (
            "SELECT message_id, CAST(a AS INTEGER) AS attempt, 2.0 * pow(2, a - 1) AS max_delay_sec "
            "FROM (SELECT message_id, unnest(range(1, attempts)) AS a FROM outc WHERE attempts > 1)"),
        "run_summary": _with(MAILBOX, SILVER, RUN) + RUN_SELECT,
        "handoff_roundtrip": w_sv + f"SELECT {_cols} FROM sv",
        "store_upsert": w_state + f"SELECT {_cols} FROM merged",
        "stream_gold": w_sv + (
            f"SELECT {_cols} FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY {DEDUP_ORDER}) AS _rn "
            f"FROM sv WHERE ({_kw_any_sql}) AND TRY_CAST(trim(email_uid) AS BIGINT) IS NOT NULL) WHERE _rn = 1"),
        "parse_mime": w_mb + (f"SELECT uid, message_id, sender, subject, date, {collapse('body')} AS body "
                              f"FROM mb WHERE trim(message_id) <> ''"),
    }


def _html_sql() -> str:
    stripped, text = html_text("html")
    return f"SELECT page_id, {text} AS text FROM (SELECT page_id, {stripped} AS s3 FROM pages)"


def _subject_parse_sql() -> str:
    cands = subject_candidates("coalesce(subject, '')")
    sp_cols = ", ".join(f"{p} AS _p{i}, {c} AS _c{i}" for i, (p, c) in enumerate(cands, 1))
    pos_case = " ".join(f"WHEN _p{i} <> '' AND _c{i} <> '' THEN _p{i}" for i in range(1, 5))
    comp_case = " ".join(f"WHEN _p{i} <> '' AND _c{i} <> '' THEN _c{i}" for i in range(1, 5))
    fallback_pos = strip("coalesce(subject, '')")
    return (f"SELECT uid, CASE {pos_case} ELSE {fallback_pos} END AS position, "
            f"CASE {comp_case} ELSE {company(sender_domain('sender'))} END AS company_name "
            f"FROM (SELECT *, {sp_cols} FROM mb)")


_kw_any_sql = " OR ".join(f"contains(lower(coalesce(subject, '')), {q(k)})" for k in SEARCH_KEYWORDS)

RUN = f"""
{BOUNDS},
trows AS (SELECT sv.* FROM sv, bounds WHERE sv.uid * 1000 <= bounds.lo * 400 + bounds.hi * 600),
tg AS (SELECT {_cols} FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY {DEDUP_ORDER}) AS _rn FROM trows) WHERE _rn = 1),
marks AS (SELECT mailbox, max(uid) AS last_uid FROM trows GROUP BY mailbox),
found AS (
  SELECT mb.* FROM mb LEFT JOIN marks m ON mb.mailbox = m.mailbox
  WHERE ({_kw_any_sql}) AND mb.uid > coalesce(m.last_uid, 0)
),
fetched AS (
  SELECT * FROM found WHERE TRY_CAST(trim(email_id) AS BIGINT) IS NOT NULL AND coalesce({strip('message_id')} <> '', false)
),
bs AS ({_silver_select('fetched')}),
bd AS (SELECT {_cols} FROM (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY {DEDUP_ORDER}) AS _rn FROM bs) WHERE _rn = 1),
merged AS (
  SELECT coalesce(b.message_id, t.message_id) AS message_id,
         CASE WHEN b.message_id IS NOT NULL THEN b.status ELSE t.status END AS status,
         CASE WHEN b.message_id IS NOT NULL THEN b.date_received ELSE t.date_received END AS date_received,
         coalesce(t.alerta_enviado, false) AS alerta_enviado
  FROM tg t FULL OUTER JOIN bd b ON t.message_id = b.message_id
),
pend AS (
  SELECT message_id FROM merged
  WHERE coalesce(NOT alerta_enviado AND status IN ('rejected', 'advanced'), false)
  ORDER BY date_received DESC NULLS LAST, message_id ASC LIMIT {LIMIT}
)"""

RUN_SELECT = """
SELECT CAST((SELECT count(*) FROM found) AS BIGINT) AS bronze,
       CAST((SELECT count(*) FROM bs) AS BIGINT) AS silver,
       CAST((SELECT count_if(t.message_id IS NULL) FROM bs b LEFT JOIN tg t ON b.message_id = t.message_id) AS BIGINT) AS inserted,
       CAST((SELECT count_if(t.message_id IS NOT NULL) FROM bs b LEFT JOIN tg t ON b.message_id = t.message_id) AS BIGINT) AS updated,
       CAST(0 AS BIGINT) AS notified, CAST(0 AS BIGINT) AS failed,
       CAST((SELECT count(*) FROM pend) AS BIGINT) AS fallback
"""

ORACLE_SQL = build()
