"""Column functions on worked examples and edge cases."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from triage import functions as X


def one(spark, expr, *values, schema="a string, b string"):
    cols = [c.split()[0] for c in schema.split(",")]
    row = tuple(values) + (None,) * (len(cols) - len(values))
    df = spark.createDataFrame([row], schema)
    return df.select(expr(*[F.col(c) for c in cols[:max(1, len(values))]]).alias("r")).first()["r"]


def col1(spark, fn, value):
    df = spark.createDataFrame([(value,)], "a string")
    return df.select(fn(F.col("a")).alias("r")).first()["r"]


class TestClassify:
    @pytest.mark.parametrize("subject,body,expected", [
        ("Your file", "The board decided not to proceed.", "rejected"),
        ("Round two", "Welcome aboard, and bring a map.", "advanced"),
        ("Tide tables", "High water at nine.", "unknown"),
        ("Selected?", "Other candidates were closer.", "rejected"),
        ("RESULT", "NOT SUCCESSFUL", "rejected"),
        ("", "", "unknown"),
        (None, None, "unknown"),
        ("", "we have not been selected", "advanced"),
        ("Moving", "forward today", "advanced"),          # phrase across the seam: "moving forward"
        ("Not moving", "forward today", "rejected"),      # "not moving forward" across the seam
        ("x", "not moving\nforward", "unknown"),          # broken by a newline: no match
        ("x", "a regrettable delay", "rejected"),
    ])
    def test_status(self, spark, subject, body, expected):
        df = spark.createDataFrame([(subject, body)], "s string, b string")
        assert df.select(X.classify_status(F.col("s"), F.col("b"))).first()[0] == expected


class TestNormalize:
    @pytest.mark.parametrize("value,expected", [
        ("TIDE", "tide"), ("w \t\t x\r\ny", "w x y"), ("\tup ", "up"), ("", ""), (None, ""),
        ("a  b c", "a b c"), ("x\x1cy", "x y"), ("a\rb", "a b"),
    ])
    def test_normalize(self, spark, value, expected):
        assert col1(spark, X.normalize_text, value) == expected

    def test_collapse_keeps_case(self, spark):
        assert col1(spark, X.collapse_ws, "  A \n B ") == "A B"

    def test_clean(self, spark):
        assert col1(spark, X.clean, "  x ") == "x"
        assert col1(spark, X.clean, "   ") is None
        assert col1(spark, X.clean_lower, " Desk@ORE.example\t") == "desk@ore.example"
        assert col1(spark, X.clean_lower, None) is None


class TestSenderDomain:
    @pytest.mark.parametrize("value,expected", [
        ("jobs@norwind.example", "norwind.example"), ("Tidal <t@mail.tidal.example>", "mail.tidal.example"),
        ("", ""), ("no at sign", ""), ("Z <A@Vega.EXAMPLE> b@second.example", "vega.example"),
    ])
    def test_domain(self, spark, value, expected):
        assert col1(spark, X.sender_domain, value) == expected


class TestCompany:
    @pytest.mark.parametrize("value,expected", [
        ("tidal.example", "Tidal"), ("nor-wind.example", "Nor Wind"), ("deep_sea-lab.example", "Deep Sea Lab"),
        ("vega.co.example", "Vega"), ("", ""), ("mail.tidal.example", "Mail"),
        ("3m.io", "3M"), ("o'neil.com", "O'Neil"),
    ])
    def test_company(self, spark, value, expected):
        assert col1(spark, X.company_from_domain, value) == expected


class TestSubject:
    @pytest.mark.parametrize("subject,sender,pos,comp", [
        ("Application to Harbour Desk at Norwind", "j@norwind.example", "Harbour Desk", "Norwind"),
        ("Re: application for Tide Clerk - Tidal, part 2", "t@tidal.example", "Tide Clerk", "Tidal,"),
        ("Chart internship at Vega", "v@vega.example", "Chart internship", "Vega"),
        ("Maps | Coast Team at Öre", "o@ore.example", "Maps", "Öre"),
        ("Your application to Kite: Sail Maker", "k@kite.example", "Sail Maker", "Kite"),
        ("Seven maps of the coast", "n@weekly.example", "Seven maps of the coast", "Weekly"),
        ("News: Deck role at Vega", "v@vega.example", "News: Deck role", "Vega"),
        ("Deck role at Deep Sea", "d@ds.example", "Deck role", "Deep"),
        ("", "x@kite.example", "", "Kite"),
        (" \t ", "x@kite.example", "", "Kite"),
        ("APPLICATION FOR QA ROLE – ACME", "x@a.io", "QA ROLE", "ACME"),
    ])
    def test_subject(self, spark, subject, sender, pos, comp):
        df = spark.createDataFrame([(subject, sender)], "s string, f string")
        p, c = X.position_and_company(F.col("s"), F.col("f"))
        row = df.select(p.alias("p"), c.alias("c")).first()
        assert (row["p"], row["c"]) == (pos, comp)


class TestDates:
    @pytest.mark.parametrize("value,expected", [
        ("Tue, 14 Jul 2026 09:42:11 +0000", dt.datetime(2026, 7, 14, 9, 42, 11)),
        ("", None), ("not a date", None), (None, None),
        ("14 Jul 2026 09:42:11 -0500", dt.datetime(2026, 7, 14, 14, 42, 11)),
        ("Tue, 14 Jul 2026 09:42:11 EST", dt.datetime(2026, 7, 14, 14, 42, 11)),
        ("Tue, 14 Jul 2026 09:42:11 PDT", dt.datetime(2026, 7, 14, 16, 42, 11)),
        ("Tue, 14 Jul 2026 09:42 GMT", dt.datetime(2026, 7, 14, 9, 42, 0)),
        ("Tue, 14 Jul 26 09:42:11 +0000", dt.datetime(2026, 7, 14, 9, 42, 11)),
        ("Tue, 14 Jul 99 09:42:11 +0000", dt.datetime(1999, 7, 14, 9, 42, 11)),
        ("Tue, 14 Jul 2026 09:42:11 +0000 (UTC)", dt.datetime(2026, 7, 14, 9, 42, 11)),
        ("04-Jul-2026 09:42:11 +0000", dt.datetime(2026, 7, 4, 9, 42, 11)),
        ("Tue, 14 July 2026 09:42:11 +0530", dt.datetime(2026, 7, 14, 4, 12, 11)),
        ("Tue, Jul 14 2026 09:42:11 +0000", dt.datetime(2026, 7, 14, 9, 42, 11)),
        ("Tue, 14 Jul 2026 09:42:11 XYZ", dt.datetime(2026, 7, 14, 9, 42, 11)),
        ("Tue, 31 Feb 2026 09:42:11 +0000", None),
        ("Tue, 14 Jul 2026 25:42:11 +0000", None),
    ])
    def test_rfc2822(self, spark, value, expected):
        assert col1(spark, X.parse_rfc2822, value) == expected

    @pytest.mark.parametrize("value,expected", [
        ("2026-07-14T09:42:30+00:00", dt.datetime(2026, 7, 14, 9, 42, 30)),
        ("2026-07-14T09:42:30Z", dt.datetime(2026, 7, 14, 9, 42, 30)),
        ("2026-07-14T11:42:30+02:00", dt.datetime(2026, 7, 14, 9, 42, 30)),
        ("2026-07-14T09:42:30.123456+00:00", dt.datetime(2026, 7, 14, 9, 42, 30, 123456)),
        ("", None), ("garbage", None),
    ])
    def test_iso(self, spark, value, expected):
        assert col1(spark, X.parse_iso, value) == expected


class TestHtml:
    @pytest.mark.parametrize("value,expected", [
        ("<p>Hello <b>World</b></p>", "Hello World"),
        ('<script>var t="</p>";</script><p>a</p>', "a"),
        ("<style>p{}</style>x<!-- hidden --> y", "x y"),
        ("<p>Tom &amp; Jerry &quot;q&quot; &copy; &middot;</p>", "Tom & Jerry \"q\" © ·"),
        ("a &#233; &#xE9; &unknownref; &amp;lt;", "a é é &unknownref; &lt;"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<template><p>no</p></template><p>yes</p>", "yes"),
        ("<html><head><title>T</title></head><body>B</body></html>", "T B"),
        ("a&nbsp;&nbsp;b", "a b"),
        ("x<!-- <script> -->y<script>z</script>w", "x y w"),
        ("<STYLE>p{}</STYLE>up<p>per", "up per"),
    ])
    def test_html(self, spark, value, expected):
        assert col1(spark, X.html_to_text, value) == expected


class TestEmailCheck:
    @pytest.mark.parametrize("addr", ["desk@ore.example", "a.b+c%d@deep.sea.example", "k-9@x1.ab"])
    def test_valid(self, spark, addr):
        assert col1(spark, X.is_valid_email, addr) is True

    @pytest.mark.parametrize("addr", ["", None, "desk", "@ore.example", "ore.example", "two words@ore.example",
                                      "desk@ore", "desk@ore.e"])
    def test_invalid(self, spark, addr):
        assert col1(spark, X.is_valid_email, addr) is False


class TestLabels:
    @pytest.mark.parametrize("status,label", [
        ("rejected", "Rejected"), ("advanced", "Next step"), ("offer", "Offer"),
        ("mystery", "Mystery"), ("", ""), (None, ""), ("interview_invite", "Interview Invitation"),
    ])
    def test_label(self, spark, status, label):
        assert col1(spark, X.status_label, status) == label

    def test_payload(self, spark):
        df = spark.createDataFrame([("Kite", "Sail Maker", "rejected"), ("", None, "")],
                                   "c string, p string, s string")
        rows = df.select(X.alert_payload(F.col("c"), F.col("p"), F.col("s")).alias("x")).collect()
        assert rows[0]["x"] == ("Update on your internship application\n\n  Company : Kite\n"
                                "  Role    : Sail Maker\n  Status  : Rejected\n")
        assert "Company : Unknown" in rows[1]["x"] and rows[1]["x"].endswith("Status  : \n")

    def test_subject_line(self, spark):
        df = spark.createDataFrame([("Kite", "rejected"), ("", "")], "c string, s string")
        rows = df.select(X.alert_subject(F.col("c"), F.col("s")).alias("x")).collect()
        assert rows[0]["x"] == "[Triage] Rejected — Kite"
        assert rows[1]["x"] == "[Triage] Update — An employer"


def test_iso_needs_a_whole_date(spark):
    from triage.functions.dates import parse_iso

    rows = ["10:30:00", "T10:00", "2026", "2026-7-4", "20260714T094230", "2026-07-14", "2026-07-14T09:42:30Z", "2026-07-14 09:42:30+02:00", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string").orderBy("i").select(parse_iso(F.col("s"))).collect()]
    assert [None if x is None else x.isoformat() for x in got] == [
        None, None, None, None, "2026-07-14T09:42:30", "2026-07-14T00:00:00", "2026-07-14T09:42:30", "2026-07-14T07:42:30", None, None]


def test_html_references_and_quoted_attributes(spark):
    from triage.functions.html import html_to_text

    rows = ["&frac12;&eacute;", "a&#150;b", "&#00000065;", '<a title="x>y">t</a>', "<p title=it's>u</p>", "&#x00041;&#65 z", "&nosuch; & &#; &#x110000;", "&#99999999999999999999;"]
    want = ["½é", "a–b", "A", "t", "u", "AA z", "&nosuch; & &#; \ufffd", "\ufffd"]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, s string").orderBy("i").select(html_to_text(F.col("s"))).collect()]
    assert got == want


def test_subject_may_hold_the_separator(spark):
    from triage.functions.subject import position_and_company

    row = spark.createDataFrame([("Deck \u0001Intern at Kite", "x@y.com"), ("Deck Intern at Kite", "x@y.com")], "s string, f string")
    got = row.select(*position_and_company(F.col("s"), F.col("f"))).collect()
    assert got[0][1] == got[1][1]


def test_named_references_without_semicolon(spark):
    """Every old name, alone and with letters, digits or a stop behind it, as the standard library reads it."""
    import html

    from triage.functions.html import LEGACY_VALUES, decode_references

    texts = [name + tail for name in LEGACY_VALUES for tail in ("", "right", "7", " x", ";", ".", "=a", "&lt")]
    texts += ["&copyright", "&notit; &notin; &notin", "&ampamp;", "&foo", "&foo;", "&", "&&amp", "a&b=c&reg=1", "&(x", "&am", "&sup2x&sup", "&CounterClockwiseContourIntegral;", "&" + "x" * 40]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(decode_references(F.col("t"))).collect()]
    assert got == [html.unescape(t) for t in texts]


def test_a_text_is_classified_by_one_pass_over_parts_of_phrases(spark):
    from functools import reduce

    from triage.functions.classify import PARTS, PARTS_PATTERN, classify_text
    from triage.schema import ACCEPTANCE_PHRASES, REJECTION_PHRASES

    phrases = [*REJECTION_PHRASES, *ACCEPTANCE_PHRASES]
    assert set(PARTS) == set(phrases) and all(part in phrase for phrase, part in PARTS.items())
    ends = {part[i:] for part in PARTS.values() for i in range(1, len(part))}
    assert not any(part.startswith(end) for part in PARTS.values() for end in ends)  # no match hides another
    cut = [p[1:] for p in phrases] + [p[:-1] for p in phrases] + [*PARTS.values(), "", " ", "\u00e9x", "pted", "cret", "\ud83d\ude00"]
    texts = [None] + [a + mid + b for a in phrases + cut for b in phrases + cut for mid in ("", " ", a[:1])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")

    def plain(ps):
        return reduce(lambda a, b: a | b, [F.col("t").contains(p) for p in ps])

    want = F.when(plain(REJECTION_PHRASES), "rejected").when(plain(ACCEPTANCE_PHRASES), "advanced").otherwise("unknown")
    assert df.where(classify_text(F.col("t")) != want).isEmpty()
    held = df.select("t", F.regexp_extract_all("t", F.lit(PARTS_PATTERN), F.lit(0)).alias("h")).collect()
    assert all((part in r["t"]) <= (part in r["h"]) for r in held if r["t"] for part in PARTS.values())


def test_a_text_is_classified_in_any_case_without_a_lower_cased_copy(spark):
    import random
    from functools import reduce

    from triage.functions.classify import classify_status, classify_text
    from triage.schema import ACCEPTANCE_PHRASES, REJECTION_PHRASES

    phrases = [*REJECTION_PHRASES, *ACCEPTANCE_PHRASES]
    assert not any("k" in p or p.endswith("i") for p in phrases)  # their other capitals are not looked for
    rng = random.Random(7)
    odd = ["\u212a", "\u0130", "\u0131", "\u017f", "\u03a3", "\u00c9", "\ufb01", "\U0001f600", "\n", " ", "of", "Vice", "grC", ""]
    texts = []
    for p in phrases:
        for _ in range(60):
            mixed = "".join(rng.choice([c.lower(), c.upper()]) for c in p)
            at = rng.randrange(len(p))
            put = rng.choice([mixed, mixed, mixed[:at] + rng.choice(odd) + mixed[at + rng.randint(0, 1):], mixed.replace("i", "\u0130").replace("s", "\u017f")])
            texts.append(rng.choice(odd) + rng.choice([mixed[at:], put]) + rng.choice(odd) + put + rng.choice(odd) + rng.choice(phrases)[1:].upper())
    df = spark.createDataFrame([(t,) for t in [None, "", *texts]], "t string")

    def plain(ps):
        return reduce(lambda a, b: a | b, [F.lower("t").contains(p) for p in ps])

    want = F.when(plain(REJECTION_PHRASES), "rejected").when(plain(ACCEPTANCE_PHRASES), "advanced").otherwise("unknown")
    assert df.where(classify_text(F.col("t")) != want).collect() == []
    assert df.select(want.alias("w")).distinct().count() == 3
    split = df.select(classify_status(F.lit("S"), F.col("t")).alias("s"), classify_text(F.concat(F.lit("S "), F.coalesce("t", F.lit("")))).alias("w"))
    assert split.where("s <> w").isEmpty()
    assert "lower(" not in df.select(classify_status(F.lit("S"), F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_two_capitals_beyond_ascii_have_ascii_letters_in_their_lower_case(spark):
    """What the classifier's patterns rely on: the Kelvin sign and the dotted capital I, no others."""
    points = spark.range(128, 0x110000).where("id < 55296 OR id > 57343")
    utf32 = F.unhex(F.lpad(F.hex("id"), 8, "0"))
    df = points.select(F.decode(utf32, "UTF-32").alias("c"))
    assert sorted(r[0] for r in df.where(F.lower("c").rlike("[a-z]")).collect()) == ["\u0130", "\u212a"]
