"""Status classification.

Any rejection phrase in ``lower(subject + " " + body)`` gives ``rejected``, else
any acceptance phrase gives ``advanced``, else ``unknown``.
Plain substring tests on the raw body: a phrase may span the joining space, a
phrase broken by a newline does not match, ``regret`` matches ``regrettable``,
``not been selected`` is ``advanced``. Blank text can contain no phrase, so it
is ``unknown`` without a separate test.

A search for each phrase would read the text once a phrase. Instead every phrase
has a part (``PARTS``), and one pattern looks for the parts and tests the rest of
the phrase only around them. A text without a phrase is read once, another up to
its first phrase, and to its first rejection or to its end.

No copy of the text is lower-cased: the patterns take both cases of A to Z. Beyond
these only the Kelvin sign and the dotted capital I have a lower case with a letter
of A to Z in it, k and i with a dot above: no phrase has a k or ends in an i.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from triage.functions.text import _col
from triage.schema import ACCEPTANCE_PHRASES, REJECTION_PHRASES


# a part of each phrase that begins with one of few letters rare in texts: most characters are passed over by one look
PARTS = {
    "not moving forward": "ving forward", "moving forward": "ving forward",
    "not been shortlisted": "been shortlisted",
    "decided not to proceed": "ceed",
    "unable to offer": "ffer",
    "other candidates": "candidates",
    "not selected": "cted", "selected": "cted",
    "not successful": "ccessful",
    "unfortunately": "fortunately",
    "regret": "gret",
    "pleased to inform": "form",
    "happy to inform": "form",
    "next steps": "xt steps",
    "welcome aboard": "come aboard",
    "interview invitation": "view invitation",
    "congratulations": "gratulations",
}


def _parts_pattern(parts) -> str:
    """One of the parts, or its rest after another part's first letter. The rests are grouped by their
    first letters, and looked at where the next letters may be those of a part. No part's end begins
    another one, so a match hides none."""
    rests: dict[str, set] = {}
    for part in parts:
        rests.setdefault(part[1], set()).add(part[2:])
    first, *after = [f"[{''.join(sorted(set(letters)))}]" for letters in zip(*parts)]  # as far as the shortest part goes
    groups = "|".join(f"{c}(?:{'|'.join(sorted(ends))})" for c, ends in sorted(rests.items()))
    return f"{first}(?={''.join(after)})(?:{groups})"


PARTS_PATTERN = _parts_pattern(PARTS.values())


def phrases_pattern(phrases) -> str:
    """One of the phrases in any case: a part of one, with the rest of that phrase around it."""
    around = []
    for phrase in phrases:
        end = phrase.index(PARTS[phrase]) + len(PARTS[phrase])
        around.append(f"(?<={phrase[:end]}){phrase[end:]}")
    return f"(?i){_parts_pattern([PARTS[p] for p in phrases])}(?:{'|'.join(around)})"


def classify_text(text: Column) -> Column:
    """Status of a text column (subject and body), lower-cased or not."""
    return (F.when(text.rlike(phrases_pattern([*REJECTION_PHRASES, *ACCEPTANCE_PHRASES])),
                   F.when(text.rlike(phrases_pattern(REJECTION_PHRASES)), F.lit("rejected")).otherwise(F.lit("advanced")))
            .otherwise(F.lit("unknown")))


def _joined(subject, body) -> Column:
    return F.concat(F.coalesce(_col(subject), F.lit("")), F.lit(" "), F.coalesce(_col(body), F.lit("")))


def classification_text(subject, body) -> Column:
    return F.lower(_joined(subject, body))


def classify_status(subject, body) -> Column:
    return classify_text(_joined(subject, body))
