"""Position and company from a subject line.

The patterns are tried in priority order; the first one whose two groups are
non-empty after stripping wins. Without a match the stripped subject is the
position and the company comes from the sender domain.

Every pattern is evaluated at most once per row (``part_columns``, a projection
of its own), and only on a subject that holds the words it needs (``NEEDED``):
the patterns themselves backtrack over subjects that can't match. There is no
Python worker.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from triage.functions.text import _col, company_from_domain, py_strip, sender_domain
from triage.schema import SUBJECT_PATTERNS

# i: case-insensitive, U: Unicode classes and case folding, d: "." stops at \n only
FLAGS = "(?iUd)"


def java_pattern(pattern: str) -> str:
    r"""A pattern as Python reads it, for Java: Python's ``\s`` also covers
    U+001C..U+001F, Java's ``(?U)\s`` does not."""
    return pattern.replace(r"\s", r"[\s\x1c-\x1f]").replace(r"\S", r"[^\s\x1c-\x1f]")


SEP = "\u0001"


# what a subject must hold to match the pattern of the same place, found in one pass each
NEEDED = [
    [r"application\s+(?:for|to)\s"],
    [r"(?:intern|internship|position|role)\s+at\s+\S"],
    [r"\s[-–|]\s", r"\sat\s+\S"],
    [r"application\s+to\s+\S+:"],
]


def _wrapped(pattern: str) -> str:
    return FLAGS + "^(?s:.*?)(?:" + java_pattern(pattern) + ")(?s:.*)$"


def part_columns(subject) -> dict[str, Column]:
    """``_m1 .. _m4``: the subject rewritten by every pattern and split. A match
    is rewritten to ``SEP pos SEP company``; the lazy ``(?s:.*?)`` prefix finds
    the leftmost match, as a regex search does. No match leaves the subject as
    it was (no ``SEP``); NULL if the subject lacks what the pattern needs."""
    subj = F.coalesce(_col(subject), F.lit(""))
    out = {}
    for i, ((pattern, pos_group, comp_group), needed) in enumerate(zip(SUBJECT_PATTERNS, NEEDED, strict=True), start=1):
        may = reduce(lambda a, b: a & b, [subj.rlike(FLAGS + java_pattern(n)) for n in needed])
        out[f"_m{i}"] = F.when(may, F.split(F.regexp_replace(subj, _wrapped(pattern), f"{SEP}${pos_group}{SEP}${comp_group}"), SEP))
    return out


def candidate_columns(subject, parts: dict[str, Column] | None = None) -> dict[str, Column]:
    """``_p1, _c1 .. _p4, _c4``: stripped (position, company) groups of every
    pattern, from the columns of ``part_columns``."""
    subj = F.coalesce(_col(subject), F.lit(""))
    parts = parts or part_columns(subject)
    odd = F.contains(subj, F.lit(SEP))  # the separator itself occurs: one extraction for each group
    out = {}
    for i, (pattern, pos_group, comp_group) in enumerate(SUBJECT_PATTERNS, start=1):
        m = parts[f"_m{i}"]
        hit = (F.size(m) == 3) & (F.try_element_at(m, F.lit(1)) == "")
        for k, group, place in (("_p", pos_group, 2), ("_c", comp_group, 3)):
            out[f"{k}{i}"] = (F.when(odd, py_strip(F.regexp_extract(subj, _wrapped(pattern), group)))
                              .when(hit, py_strip(F.try_element_at(m, F.lit(place)))).otherwise(F.lit("")))
    return out


def choose(subject, sender, cands: dict[str, Column] | None = None) -> tuple[Column, Column]:
    """``(position, company_name)`` from the candidate columns (by default the
    columns ``_p1 .. _c4`` added by ``withColumns(candidate_columns(...))``)."""
    n = len(SUBJECT_PATTERNS)
    c = cands or {f"_{k}{i}": F.col(f"_{k}{i}") for i in range(1, n + 1) for k in "pc"}
    subj = F.coalesce(_col(subject), F.lit(""))
    pos_expr = comp_expr = None
    for i in range(1, n + 1):
        p, k = c[f"_p{i}"], c[f"_c{i}"]
        hit = (p != "") & (k != "")
        pos_expr = F.when(hit, p) if pos_expr is None else pos_expr.when(hit, p)
        comp_expr = F.when(hit, k) if comp_expr is None else comp_expr.when(hit, k)
    return (pos_expr.otherwise(py_strip(subj)),
            comp_expr.otherwise(company_from_domain(sender_domain(sender))))


def position_and_company(subject, sender) -> tuple[Column, Column]:
    """Return ``(position, company_name)`` columns in one expression."""
    return choose(subject, sender, candidate_columns(subject))
