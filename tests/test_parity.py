"""Properties and constructed cases of the column functions: inputs are built
from parts whose results are known beforehand, with Unicode white space, case
and punctuation. Dates and HTML are held against the standard library's
parsers. One Spark job per batch of examples."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from triage import functions as X
from triage.schema import ACCEPTANCE_PHRASES, REJECTION_PHRASES

WS = [" ", "  ", "\t", "\n", "\r", "\u00a0", "\u2003", "\u3000", "\x1c", "\x0b", "\r\n", "\x85"]
FILLER = ["harbour", "Tide", "Ünïcödé", "ß", "3m", "o'neil", "crossword", "Lamp,", "x-ray", "(map)"]
SEEDS = [42, 7, 2026]


def spaced(rng, words):
    return "".join(w + rng.choice(WS) for w in words)


def filler(rng, low=0, high=8):
    return rng.choices(FILLER, k=rng.randint(low, high))


def evaluate(spark, rows, schema, *cols):
    """Results in the order of the rows."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


@pytest.mark.parametrize("seed", SEEDS)
def test_normalized_text(spark, seed):
    rng = random.Random(seed)
    texts = [rng.choice(["", rng.choice(WS)]) + spaced(rng, filler(rng)) for _ in range(1000)]
    for text, (got,) in zip(texts, evaluate(spark, [(t,) for t in texts], "t string", X.normalize_text(F.col("t")))):
        assert got.split(" ") == text.lower().split() or (got == "" and not text.split()), ascii(text)


@pytest.mark.parametrize("seed", SEEDS)
def test_planted_phrases_decide_the_status(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for _ in range(600):
        plant = rng.choice([[], ["rejected"], ["advanced"], ["rejected", "advanced"]])
        phrases = [rng.choice(REJECTION_PHRASES if p == "rejected" else ACCEPTANCE_PHRASES) for p in plant]
        words = filler(rng) + [p.upper() if rng.random() < 0.3 else p for p in phrases]
        rng.shuffle(words)
        cut = rng.randint(0, len(words))
        rows.append((" ".join(words[:cut]), " ".join(words[cut:])))
        want.append((plant[0] if plant else "unknown",))  # a refusal outweighs an invitation
    assert evaluate(spark, rows, "s string, b string", X.classify_status(F.col("s"), F.col("b"))) == want


@pytest.mark.parametrize("seed", SEEDS)
def test_senders_built_from_a_domain(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for _ in range(500):
        name = [rng.choice(["nor", "TIDAL", "vega", "Öre", "kite"]) for _ in range(rng.randint(1, 3))]
        sep = rng.choice("-_")
        domain = sep.join(name) + rng.choice([".example", ".co.example", ""])
        shape = rng.choice(["{}", "A B <{}>", "\"x\" <{}> (note)", "{} second@other.example"])
        rows.append((shape.format(f"who.{rng.randint(0, 9)}@{domain}"),))
        want.append((domain.lower(), " ".join(n.capitalize() for n in name)))
    rows += [("no address",), ("",), (None,)]
    want += [("", "")] * 3
    domain = X.sender_domain(F.col("f"))
    assert evaluate(spark, rows, "f string", domain, X.company_from_domain(domain)) == want


@pytest.mark.parametrize("seed", SEEDS)
def test_subjects_built_from_position_and_company(spark, seed):
    rng = random.Random(seed)
    rows, want = [], []
    for _ in range(800):
        job = " ".join(rng.choices(["Harbour", "Analyst", "Tide", "Öl", "3D", "Map"], k=rng.randint(1, 4)))
        firm = rng.choice(["Norwind", "tidal.example", "Öre&Co", "K9"])
        gap = lambda: rng.choice([" ", "  ", "\t", "\u00a0", "\u3000"])
        dash = rng.choice("-–")
        shape = rng.randint(0, 4)
        if shape == 0:
            link = rng.choice(["at", dash])
            subject, result = f"Application{gap()}for{gap()}{job}{gap()}{link}{gap()}{firm} soon", (job, firm)
        elif shape == 1:
            kind = rng.choice(["intern", "Internship", "POSITION", "role"])
            subject, result = f"{job} {kind}{gap()}at{gap()}{firm}", (f"{job} {kind}", firm)
        elif shape == 2:
            subject, result = f"{job}{gap()}{rng.choice('-–|')}{gap()}the team{gap()}at{gap()}{firm}", (job, firm)
        elif shape == 3:
            subject, result = f"Your application to {firm}:{gap()}{job}", (job, firm)
        else:
            subject, result = f" {job} ", (job, "Vega")
        rows.append((subject, "jobs@vega.example"))
        want.append(result)
    cols = X.position_and_company(F.col("s"), F.col("f"))
    assert evaluate(spark, rows, "s string, f string", *cols) == want


def gen_dates(rng: random.Random, n: int) -> list[str]:
    import datetime as dt

    zones = ["+0000", "-0500", "+0530", "EST", "EDT", "PST", "GMT", "UT", "Z", "", "-0000", "XYZ",
             "cdt", "+0100 (CET)"]
    out = []
    for _ in range(n):
        t = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=rng.randint(0, 4_000_000_000))
        day = t.strftime("%a, ") if rng.random() < 0.6 else ""
        mon = t.strftime("%b") if rng.random() < 0.8 else t.strftime("%B")
        year = t.strftime("%Y") if rng.random() < 0.8 else t.strftime("%y")
        clock = t.strftime("%H:%M:%S") if rng.random() < 0.8 else t.strftime("%H:%M")
        sep = " " if rng.random() < 0.9 else "-"
        s = f"{day}{t.day}{sep}{mon}{sep}{year} {clock} {rng.choice(zones)}".strip()
        if rng.random() < 0.05:
            s = "garbage " + s
        out.append(s)
    return out


def py_date(s):
    import datetime as dt
    from email.utils import parsedate_to_datetime

    try:
        d = parsedate_to_datetime(s)
    except (TypeError, ValueError, IndexError):
        return None
    if d.tzinfo is not None:
        d = d.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return d


@pytest.mark.parametrize("seed", [1, 2])
def test_random_date_parity(spark, seed):
    rng = random.Random(seed)
    dates = gen_dates(rng, 1000)
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    rows = df.select("d", X.parse_rfc2822(F.col("d")).alias("t")).collect()
    bad = [(r["d"], py_date(r["d"]), r["t"]) for r in rows if py_date(r["d"]) != r["t"]]
    for b in bad[:5]:
        print("MISMATCH", b)
    assert not bad, len(bad)


def py_html_text(markup: str) -> str:
    """Text nodes of an HTML document, stripped, joined by one space; script,
    style, template and comments excluded (an HTML parser's get_text reading)."""
    from html.parser import HTMLParser

    class Text(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.parts, self.skip = [], 0

        def handle_starttag(self, tag, attrs):
            self.skip += tag in ("script", "style", "template")

        def handle_endtag(self, tag):
            if tag in ("script", "style", "template") and self.skip:
                self.skip -= 1

        def handle_data(self, data):
            if not self.skip and data.strip():
                self.parts.append(data.strip())

    p = Text()
    p.feed(markup)
    p.close()
    return re.sub(r"\s+", " ", " ".join(p.parts)).strip()


def test_pages_match_an_html_parser(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pages.select("html", X.html_to_text(F.col("html")).alias("t")).collect()
    bad = [r["html"][:80] for r in rows if py_html_text(r["html"]) != r["t"]]
    assert not bad, (len(bad), bad[:2])
