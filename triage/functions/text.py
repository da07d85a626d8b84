"""Text column functions, all built-in expressions (no Python worker).

Whitespace follows Python's ``str.isspace``: Unicode white space plus the
four information separators U+001C..U+001F. Java regexes need ``(?U)`` for
Unicode classes, and Spark's ``trim`` strips only U+0020, so stripping uses a
regex unless the text was collapsed first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triage.schema import SENDER_DOMAIN_PATTERN

WS_CLASS = r"[\s\x1c-\x1f]"
_WS_RUN = r"(?U)" + WS_CLASS + "+"
_WS_EDGES = r"(?U)^" + WS_CLASS + "+|" + WS_CLASS + "+$"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing white space."""
    return F.regexp_replace(_col(c), _WS_EDGES, "")


def collapse_ws(c) -> Column:
    """Collapse white-space runs to one space and strip; case is kept.

    NULL gives ``''``.
    """
    return F.trim(F.regexp_replace(F.coalesce(_col(c), F.lit("")), _WS_RUN, " "))


def normalize_text(c) -> Column:
    """Collapse white space, strip, lower-case; NULL or empty gives ``''``."""
    return F.lower(collapse_ws(c))


def clean(c) -> Column:
    """Strip; empty becomes NULL."""
    return F.nullif(py_strip(c), F.lit(""))


def clean_lower(c) -> Column:
    """Strip and lower-case; empty becomes NULL."""
    return F.nullif(F.lower(py_strip(c)), F.lit(""))


def sender_domain(c) -> Column:
    """First ``@domain`` of a From header, lower-cased; ``''`` when absent."""
    return F.lower(F.regexp_extract(F.coalesce(_col(c), F.lit("")),
                                    "(?U)" + SENDER_DOMAIN_PATTERN, 1))


def title_case(c) -> Column:
    """Python ``str.title``: upper-case the first cased letter of every run of
    cased letters, lower-case the rest. ``initcap`` differs (``3m`` -> ``3M``,
    ``o'neil`` -> ``O'Neil`` here)."""
    runs = F.regexp_extract_all(_col(c), F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), 1)
    return F.array_join(
        F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)),
                                             F.lower(F.substring(x, 2, 1 << 30)))),
        "")


def company_from_domain(c) -> Column:
    """First domain label, ``-``/``_`` as spaces, title case.

    ``careers.stripe.com`` gives ``Careers``; empty gives ``''``.
    """
    root = F.split_part(F.coalesce(_col(c), F.lit("")), F.lit("."), F.lit(1))
    return title_case(F.translate(root, "-_", "  "))


def is_valid_email(c) -> Column:
    """Light address check; NULL and empty are false."""
    from triage.schema import EMAIL_ADDRESS_PATTERN

    return F.coalesce(py_strip(c).rlike(EMAIL_ADDRESS_PATTERN), F.lit(False))


def head(c, n: int = 60) -> Column:
    """First ``n`` characters, for log and quarantine output."""
    return F.substring(F.coalesce(_col(c), F.lit("")), 1, n)
