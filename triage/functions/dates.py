"""Message dates (X6) and ISO-8601 ingest times (X7) as built-in expressions.

RFC 2822 dates take two regex passes (the ``d-m-y`` form is rewritten with
spaces, then one regex splits the text into all its parts at once), then
``try_make_timestamp_ntz`` builds the wall-clock value and the zone offset is
subtracted, so the result is the UTC wall-clock time as TIMESTAMP_NTZ.
Accepted, as the mail-header reader of the original accepts:

* an optional weekday (a first token ending in ``,`` or a 3-letter day name),
* ``day month year`` or ``month day year``, month as 3-letter or full English name,
  parts separated by spaces; ``04-Jul-2026`` only as ``date time zone`` (exactly
  three tokens after the weekday, as the original reader requires),
* a 1- to 4-digit year; below 100, years above 68 are 19xx, else 20xx,
* ``H:M`` or ``H:M:S`` (``.`` also separates),
* a numeric zone ``+hhmm`` / ``-hhmm``, an RFC 822 zone name, or none,
* a trailing ``(comment)``.

An unknown zone name, a missing zone or ``-0000`` mean "local time", which we
read as UTC. Anything else gives NULL. Java's zone-name letter ``z`` is not
used: it applies daylight saving to ``EST``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triage.functions.text import _col
from triage.schema import MONTHS_LONG, MONTHS_SHORT, ZONE_OFFSETS_MIN

WEEKDAY = r"(?:[^\s,]*,\s*|(?:mon|tue|wed|thu|fri|sat|sun)\s+)?"
# "[weekday] d-m-y time zone" (exactly three tokens) is read as "d m y time zone"
DASH_FORM = r"(?i)^(\s*" + WEEKDAY + r")([^\s-]+)-([^\s-]+)-([^\s-]+)(\s+\S+\s+\S+\s*)$"
DATE_PATTERN = (
    r"(?i)^\s*" + WEEKDAY +
    r"(?:(\d{1,2})\s+([a-z]+)|([a-z]+)\s+(\d{1,2}),?)\s+(\d{1,4}),?\s+"
    r"(\d{1,2})[:.](\d{1,2})(?:[:.](\d{1,2}))?"
    r"(?:\s*([+-]?\d{1,4}|[a-z]+))?\s*(?:\(.*\))?\s*$"
)


SEP = "\u0001"


def _parts(s: Column) -> Column:
    """All nine groups in one regex pass: a match is rewritten to
    ``SEP g1 SEP g2 ... SEP g9`` and split; a non-match stays as it was."""
    repl = "".join(f"{SEP}${i}" for i in range(1, 10))
    return F.split(F.regexp_replace(s, DATE_PATTERN, repl), SEP)


def zone_offset_minutes(zone: Column) -> Column:
    """Offset east of UTC in minutes for a zone token; 0 for unknown/none."""
    z = F.upper(zone)
    named = F.create_map(*[x for k, v in ZONE_OFFSETS_MIN.items() for x in (F.lit(k), F.lit(v))])
    num = z.try_cast("int")
    sign = F.when(num < 0, F.lit(-1)).otherwise(F.lit(1))
    mag = F.abs(num)
    numeric = sign * (F.floor(mag / 100).cast("int") * 60 + mag % 100)
    return F.coalesce(F.try_element_at(named, z),
                      F.when(z.rlike(r"^[+-]?\d+$"), numeric),
                      F.lit(0))


def parse_rfc2822(c) -> Column:
    """RFC 2822 ``Date`` header to UTC TIMESTAMP_NTZ, NULL on failure."""
    p = _parts(F.regexp_replace(F.coalesce(_col(c), F.lit("")), DASH_FORM, "$1$2 $3 $4$5"))
    ok = (F.size(p) == 10) & (F.try_element_at(p, F.lit(1)) == "")

    def g(i: int) -> Column:
        return F.try_element_at(p, F.lit(i + 1))

    day = F.when(g(1) != "", g(1)).otherwise(g(4)).try_cast("int")
    mon_name = F.lower(F.when(g(2) != "", g(2)).otherwise(g(3)))
    pos = F.array_position(F.array(*[F.lit(m) for m in MONTHS_SHORT + MONTHS_LONG]), mon_name)
    month = F.when(pos > 0, ((pos - 1) % 12 + 1).cast("int"))
    yy = g(5).try_cast("int")
    year = (F.when(yy < 100, F.when(yy > 68, yy + 1900).otherwise(yy + 2000))
            .otherwise(yy))
    sec = F.when(g(8) == "", F.lit(0)).otherwise(g(8).try_cast("int"))
    local = F.try_make_timestamp_ntz(year, month, day, g(6).try_cast("int"), g(7).try_cast("int"),
                                     F.when(sec < 60, sec).cast("decimal(16,6)"))
    return F.when(ok, F.timestamp_add("MINUTE", -zone_offset_minutes(g(9)), local))


#: a whole date, with a time or not: Spark's cast alone would also take a bare year, or a
#: time of the current day
ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:[.][0-9]{1,6})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?$"
BASIC_ISO = r"^([0-9]{4})([0-9]{2})([0-9]{2})T([0-9]{2})([0-9]{2})([0-9]{2})"


def parse_iso(c) -> Column:
    """ISO-8601 text (``Z`` or an offset allowed) to UTC TIMESTAMP_NTZ, NULL on
    failure. Zone-less text is read as UTC (the session zone is UTC)."""
    s = _col(c)
    basic = F.regexp_replace(s, BASIC_ISO, r"$1-$2-$3T$4:$5:$6")
    return F.when(basic.rlike(ISO), basic.try_cast("timestamp").cast("timestamp_ntz"))
