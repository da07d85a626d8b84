"""Personal data by weak-supervision aggregation, in DataFrame functions.

*Base spans* (email, ip, card, phone) are regular-expression matches that
pass their check; they are always reported. *Candidates* are other spans that
may be personal data: numbers of a card's length that fail the check digit,
phone numbers without ``+``, IPv6 addresses, and emails with the ``@`` or the
dots spelled out. Labelers vote on candidates and base spans alike, for (1),
against (-1) or not at all (0): the strict pattern, the check (digit sum,
ranges, lengths), a gazetteer (top-level domains, issuer and country
prefixes, reserved networks), words before the span that speak for or against
it, and what it touches. Expectation-maximisation over the votes estimates
each labeler's reliability for each kind, without labels, and with them the
probability of every vote pattern. A failed check is decisive: such a span (a
number of a card's length with a wrong check digit, say) is a known negative
for the estimation and is never added. Those probabilities train the final span
classifier (naive Bayes over hashed context words, span shape and length),
and candidates that it accepts with ``ACCEPT`` are added to the base spans,
leftmost first, where they overlap none.

All row work is built-in expressions on arrays within the row: no Python, no
shuffle of texts. Only the counts of vote patterns (at most kinds x 3^labelers
rows) and of hashed features (kinds x ``BUCKETS``) are aggregated; EM runs over
the former on the driver, and the model returns as literals.

The patterns are written so that they are tried once for each run of
characters and never recurse: possessive, and anchored behind the run before.
They match what the plain forms match (see the tests).

Defined results: a null or empty text has no spans; offsets are code points,
the end exclusive; without candidates, or when a kind has none of either
class, only base spans are reported; repeated rows are counted as they occur.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import written

KINDS = ("email", "ip", "card", "phone")
BUCKETS = 512
ACCEPT = 0.9
ROUNDS = 40
#: the place of the check among the votes
CHECK = 1
#: weight of EM's prior, as a share of a kind's spans
PRIOR = 0.02

# fixed values: the base patterns
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# candidates that the base patterns don't take
EMAIL_SPELLED = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++\x20?+[\[({]\x20?+(?:at|AT)\x20?+[\])}]\x20?+[A-Za-z0-9-]++"
                 r"(?:(?:\.|\x20?+[\[({]\x20?+(?:dot|DOT)\x20?+[\])}]\x20?+)[A-Za-z0-9-]++)++")
IP_V6 = r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}+:){7}+[0-9A-Fa-f]{1,4}+(?![0-9A-Fa-f:])"
PHONE_LOCAL = r"(?<![0-9+().-])(?<![0-9)]\x20)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# fixed values: gazetteers and context words
TOP_DOMAINS = (r"(?i)[.)\]}]\x20?(?:com|org|net|edu|gov|int|mil|info|biz|name|pro|io|ai|app|dev|me|tv|cc|eu|de|fr|es|uk|us|it|nl|ch|at|be|lu|ie|pt|dk|se"
               r"|no|fi|is|pl|cz|sk|hu|ro|bg|gr|hr|si|ee|lv|lt|ua|ru|tr|il|ae|sa|in|pk|cn|jp|kr|tw|hk|sg|my|th|id|ph|vn|au|nz|ca|mx|br|ar|cl|co|pe|za|ng|ke|eg|ma)$")
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|65|30|36|38)"
COUNTRY = r"^\+?\x20?(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
RESERVED = r"^(?:0|127|255|22[4-9]|23[0-9])\."
FOR = {
    "email": r"(?i)(?:mail|contact|write|kontakt|correo|courriel|adresse?)\W*\s*\W*$",
    "ip": r"(?i)(?:ip|host|server|address|adresse|login from|client)\W*$",
    "card": r"(?i)(?:card|visa|mastercard|credit|karte|carte|tarjeta|payment|pay(?:ed|ing)?(?:\sby)?)\W*(?:no|number|nr)?\W*$",
    "phone": r"(?i)(?:phone|tel|telefon|téléphone|teléfono|call|mobile|mobil|fax|whatsapp)\W*(?:no|number|nr)?\W*(?:me)?\W*(?:at|on)?\W*$",
}
AGAINST = r"(?i)(?:version|v|license|isbn|order|invoice|page|id|token|sha|hash|price|section|chapter|serial|key|licen[cs]e)\W*(?:no|number|nr)?\W*$"
CONTEXT = 40


def luhn(digits: Column) -> Column:
    def add(total, i):
        x = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(x * 2 > 9, x * 2 - 9).otherwise(x * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(x)

    steps = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits)))
    return F.coalesce(F.aggregate(steps, F.lit(0), add) % 10 == 0, F.lit(False))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def check(kind: str, value: Column) -> Column:
    """The base check of a match."""
    n = F.length(digits(value))
    return {"email": F.lit(True), "ip": value.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
            "card": n.between(12, 19) & luhn(digits(value)), "phone": n.between(9, 15)}[kind]


def found(text: Column, pattern: str, guard: Column) -> Column:
    """Matches of a pattern, leftmost first: array of (start, end, value) in
    code points. The texts between matches give the offsets."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    none = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,value:string>>")

    def step(acc, m):
        start = acc["at"] + m["gap"]
        end = start + F.length(m["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), end.alias("end"), m["value"].alias("value")))).alias("out"))

    pairs = F.zip_with(values, gaps, lambda v, g: F.struct(F.length(g).alias("gap"), v.alias("value")))
    pairs = F.filter(pairs, lambda m: m["value"].isNotNull())
    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.when(guard & (F.regexp_instr(text, F.lit(pattern)) > 0), walked).otherwise(none)


def votes(kind: str, value: Column, before: Column, after: Column, strict: bool) -> Column:
    """The labelers' votes on a span."""
    ok = check(kind, value) if kind != "ip" or strict else F.lit(True)
    gazetteer = {
        "email": F.when(value.rlike(TOP_DOMAINS), 1).otherwise(-1),
        "ip": F.when(value.rlike(RESERVED), -1).otherwise(0),
        "card": F.when(digits(value).rlike(ISSUERS), 1).otherwise(-1),
        "phone": F.when(value.rlike(COUNTRY), 1).otherwise(0),
    }[kind]
    touches = before.rlike(r"[\p{L}0-9_=/\"']$") | after.rlike(r"^[\p{L}0-9_\"'=/]")
    return F.array(F.lit(1 if strict else 0), F.when(ok, 1).otherwise(-1), gazetteer,
                   F.when(before.rlike(FOR[kind]), 1).otherwise(0), F.when(before.rlike(AGAINST), -1).otherwise(0),
                   F.when(touches, -1).otherwise(1))


def features(kind: str, value: Column, before: Column, after: Column) -> Column:
    """Hashed features of a span and its context."""
    shape = F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), "[A-Za-z]+", "a")
    word = lambda c, p: F.lower(F.regexp_extract(c, p, 1))
    parts = [("s", F.substring(shape, 1, 24)), ("n", F.least(F.length(value), F.lit(40)).cast("string")),
             ("b", word(before, r"([\p{L}]+)[^\p{L}]*$")), ("a", word(after, r"^[^\p{L}]*([\p{L}]+)")),
             ("t", F.substring(before, -1, 1)), ("u", F.substring(after, 1, 1))]
    return F.array(*(F.pmod(F.xxhash64(F.lit(f"{kind}:{k}"), v), F.lit(BUCKETS)).cast("int") for k, v in parts))


def spotted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans): base spans and candidates with votes and features."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    anything = F.lit(True)
    sources = [(0, EMAIL, True, F.contains(text, F.lit("@"))),
               (0, EMAIL_SPELLED, False, text.rlike(r"[\[({]\x20?(?:at|AT)\x20?[\])}]")),
               (1, IP, True, anything), (1, IP_V6, False, F.contains(text, F.lit(":"))),
               (2, CARD, True, anything), (3, PHONE, True, F.contains(text, F.lit("+"))), (3, PHONE_LOCAL, False, anything)]

    def described(k: int, pattern: str, strict: bool, guard: Column) -> Column:
        kind = KINDS[k]

        def one(m):
            before = F.substring(text, F.greatest(m["start"] - CONTEXT, F.lit(0)) + 1, F.least(m["start"], F.lit(CONTEXT)))
            after = F.substring(text, m["end"] + 1, F.lit(CONTEXT))
            base = check(kind, m["value"]) if strict else F.lit(False)
            return F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["end"].alias("end"), base.alias("base"),
                            votes(kind, m["value"], before, after, strict).alias("votes"),
                            features(kind, m["value"], before, after).alias("features"))

        return F.transform(found(text, pattern, guard), one)

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return (rows.select("_id", F.concat(*(described(*s) for s in sources)).alias("spans"))
            .withColumnRenamed("_id", id_col))


def reliabilities(patterns: list[tuple[int, tuple[int, ...], int]], decisive: int | None = None) -> dict[tuple[int, tuple[int, ...]], float]:
    """EM over (kind, votes, count): two classes, each labeler with its own
    chance of each vote in each class. Starts from the majority of votes;
    returns each pattern's probability. A vote against by the labeler
    ``decisive`` settles the class."""
    out: dict[tuple[int, tuple[int, ...]], float] = {}
    by_kind: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for kind, v, n in patterns:
        by_kind[kind].append((v, n))
    for kind, rows in by_kind.items():
        known = {v for v, _ in rows if decisive is not None and v[decisive] < 0}
        p = {v: 0.0 if v in known else 1 / (1 + math.exp(-sum(v))) for v, _ in rows}
        for _ in range(ROUNDS):
            total = sum(n for _, n in rows)
            prior = (sum(n * p[v] for v, n in rows) + 1) / (total + 2)
            chance = {}
            for j in range(len(rows[0][0])):
                for c in (0, 1):
                    # prior counts (a share of the spans) keep a labeler better than chance, and the
                    # classes from parting spans that all labelers but one agree on
                    seen = {x: (0.5 + 2.0 * (x == (1 if c else -1))) * max(1.0, PRIOR * total) for x in (-1, 0, 1)}
                    for v, n in rows:
                        seen[v[j]] += n * (p[v] if c else 1 - p[v])
                    for x in seen:
                        chance[j, c, x] = seen[x] / sum(seen.values())
            p = {v: 0.0 if v in known else 1 / (1 + math.exp(-max(-30.0, min(30.0, math.log(prior / (1 - prior)) + sum(
                math.log(chance[j, 1, x] / chance[j, 0, x]) for j, x in enumerate(v)))))) for v, _ in rows}
        out |= {(kind, v): q for v, q in p.items()}
    return out


def span_classifier(spans: DataFrame) -> tuple[list[float], list[float]]:
    """Naive Bayes trained on the vote patterns' probabilities: a prior for
    each kind and a weight for each kind and feature bucket."""
    spark = spans.sparkSession
    each = spans.select(F.explode("spans").alias("s")).select("s.kind", "s.votes", "s.features", "s.base")
    counts = each.groupBy("kind", "votes").agg(F.count("*").alias("n")).collect()  # at most kinds x 3^labelers rows
    chance = reliabilities(sorted((r.kind, tuple(r.votes), r.n) for r in counts), CHECK)
    if not chance:
        return [0.0] * len(KINDS), [0.0] * (len(KINDS) * BUCKETS)
    table = spark.createDataFrame([(k, list(v), p) for (k, v), p in chance.items()], "kind int, votes array<int>, p double")
    sums = (each.join(F.broadcast(table), ["kind", "votes"])  # bounded as the counts are
            .select("kind", "p", F.explode(F.concat("features", F.array(F.lit(BUCKETS)))).alias("f"))
            .groupBy("kind", "f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect())  # kinds x buckets
    prior, weight = [0.0] * len(KINDS), [0.0] * (len(KINDS) * BUCKETS)
    total = {r.kind: (r.yes, r.no) for r in sums if r.f == BUCKETS}
    for k, (yes, no) in total.items():
        prior[k] = math.log((yes + 1) / (no + 1))
    for r in sums:
        if r.f < BUCKETS:
            yes, no = total[r.kind]
            usual = (r.yes + r.no) / (yes + no)  # unseen features of a class are as frequent as in all
            weight[r.kind * BUCKETS + r.f] = math.log((r.yes + 2 * usual) / (yes + 2) / ((r.no + 2 * usual) / (no + 2)))
    return prior, weight


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(id, base, spans): arrays of (start, kind, end), by start, then
    kind."""
    spans = written(spotted(docs, id_col, text_col), "pii-spans")
    prior, weight = span_classifier(spans)
    priors, weights = F.lit(prior), F.lit(weight)  # of fixed size
    edge = math.log(accept / (1 - accept))

    def margin(s):
        return F.aggregate(s["features"], F.get(priors, s["kind"]), lambda t, f: t + F.get(weights, s["kind"] * BUCKETS + f))

    plain = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    base = F.array_sort(F.transform(F.filter("spans", lambda s: s["base"]), plain))
    extra = F.array_sort(F.transform(F.filter("spans", lambda s: ~s["base"] & (F.get(s["votes"], F.lit(CHECK)) > 0) & (margin(s) >= edge)), plain))
    rows = spans.select(id_col, base.alias("base"), extra.alias("_extra"))
    clear = F.filter("_extra", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    rows = rows.withColumn("_extra", clear)
    first = F.aggregate("_extra", F.slice(F.col("base"), 1, 0), lambda out, s: F.when(
        F.exists(out, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])), out).otherwise(F.concat(out, F.array(s))))
    return rows.select(id_col, "base", F.array_sort(F.concat("base", first)).alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.col(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def n_of(kind: str, spans: str = "base") -> Column:
    return F.size(F.filter(F.col(spans), lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
