"""The ten operators against plain Python, on a table of hard cases: nulls in
any column, empty and long texts, ties and repeated rows, no rows, and extra
columns with clashing names."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from triage.llm import (decontaminate, jaccard_join, langid, mixing, pii, quality_fm, rule_forest, token_orc, toxicity,
                        warc_zstd, words)
from triage.llm.common import scratch_path
from triage.llm.graph import components
from triage.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long, region string, score double, id string"


def prose(rng, n, stem="abcdefgh"):
    return " ".join("".join(rng.choice(stem) for _ in range(rng.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    base = [prose(rng, rng.choice([3, 9, 14, 40, 120])) for _ in range(30)]
    texts = [None, "", "  \n\t ", "a", "a b", "é ö 漢字", "x" * 50_000, prose(rng, 6_000), "#$% | <b>\n#$% | <b>\n\n",
             "\x1c\x1d a\x85b <|endoftext|>", "one two three four five " * 30, *base]
    for t in base[:12]:  # near copies
        ws = t.split()
        ws[rng.randrange(len(ws))] = "changed"
        texts.append(" ".join(ws))
    texts += base[:5]  # exact copies
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "é", None]), rng.choice([None, 5, 900]), "r", 0.5, "i")
           for i, t in enumerate(texts)]
    return [*out, out[20], out[20]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(r[0], int(r[0] % 3 > 0), int(r[0] % 4 == 0)) for r in rows] + [(None, 1, 1), (3, None, None)],
                                 "doc_id long, quality int, toxic int")


def test_words_and_hashes():
    import pyarrow as pa

    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \té漢\n") for _ in range(rng.randint(0, 30))) for _ in range(200)] + [None, "", "word " * 3000]
    data, off = words.texts(pa.array(texts))
    ws = words.runs(words.NOT_SPACE[data], off)
    old, words.SEGMENT = words.SEGMENT, 64
    try:
        h = words.hashes(data, ws.starts, ws.ends)
    finally:
        words.SEGMENT = old
    assert (h == words.hashes(data, ws.starts, ws.ends)).all()
    seen = {}
    for i, t in enumerate(texts):
        mine = [data[s:e].tobytes().decode() for s, e in zip(ws.starts[ws.bounds[i]:ws.bounds[i + 1]], ws.ends[ws.bounds[i]:ws.bounds[i + 1]])]
        assert mine == brute.WORD.findall(t or "")
        for w, x in zip(mine, h[ws.bounds[i]:ws.bounds[i + 1]]):
            assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


def test_token_orc_round_trip(spark, docs, rows, none):
    path = scratch_path(spark, "t")
    token_orc.write_tokens(docs, path, tokenizer_path(), parts=5)
    got = token_orc.with_crc32(token_orc.read_tokens(spark, path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.tokens([r[:2] for r in rows], tokenizer_path()))
    path = scratch_path(spark, "t")
    token_orc.write_tokens(none, path, tokenizer_path())
    assert token_orc.with_crc32(token_orc.read_tokens(spark, path)).count() == 0


def test_jaccard_components(spark, docs, rows, none):
    want = brute.jaccard_components([r[:2] for r in rows])
    for most in (jaccard_join.REGION_SHINGLES, 60):  # 60: almost all regions go through distributed waves
        got = jaccard_join.join_components(docs, region_shingles=most).collect()
        assert len(got) == len(rows)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert jaccard_join.join_components(none).count() == 0


def test_jaccard_region_with_hard_boundaries():
    """Chains of links, and balls that are linked only at their edges."""
    rng = random.Random(9)
    for seed in range(6):
        start = rng.sample(range(10_000), 60)
        sets = []
        for _ in range(4):
            now = list(start)
            for _ in range(25):
                now[rng.randrange(len(now))] = rng.randrange(10_000, 99_999)
                if rng.random() < 0.7:
                    sets.append(np.unique(np.array(now, np.uint64)))
        root = list(range(len(sets)))
        for i, x in enumerate(sets):
            for j in range(i):
                n = len(np.intersect1d(x, sets[j]))
                if 100 * n >= 90 * (len(x) + len(sets[j]) - n):
                    a, b = root[i], root[j]
                    root = [min(a, b) if r in (a, b) else r for r in root]
        assert jaccard_join.join_region(sets) == root


def test_projections_share_a_region_when_linked():
    rng = np.random.default_rng(2)
    least = jaccard_join.shells(5_000)
    for _ in range(300):
        n = int(rng.integers(9, 700))
        x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        drop, add = int(rng.integers(0, len(x) // 9 + 1)), int(rng.integers(0, len(x) // 9 + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
        inter = len(x) - drop
        if len(x) != len(y) + 10**9 and jaccard_join.linked(np.array(inter), len(x), len(y)) and not np.array_equal(x, y):
            assert set(jaccard_join.projections(x, least)) & set(jaccard_join.projections(y, least))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(50)}}


def test_rule_statistics(spark, docs, rows, labels, none):
    got = rule_forest.judge(docs, labels).collect()
    want = sorted((r[0], *brute.rules(r[1])) for r in rows)
    assert sorted((r.doc_id, *(r[c] for c in rule_forest.COUNTS), r.base_failed) for r in got) == want
    assert all(not r.kept for r in got if r.base_failed)
    assert rule_forest.judge(none, labels).count() == 0


def test_forest_sets_outliers_apart():
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (2_000, 3)) * [1, 1, 0]
    f = rule_forest.Forest(x, np.array([[-4, -4, 0], [4, 4, 1]]))
    assert f.score(np.array([[0, 0, 1.0], [3.9, -3.9, 0]])).min() > np.quantile(f.score(x), 0.99)


def test_decontaminate(spark, docs, rows, none):
    texts = [r[1] for r in rows if r[1]]
    items = [(i, " ".join(t.split()[2:22]).upper()) for i, t in enumerate(texts[12:30])] + [
        (90, None), (91, ""), (None, "a b"), (92, "é ö"), (93, texts[12]), (93, texts[12])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute.contamination([r[:2] for r in rows], items)
    for most in (decontaminate.BLOCK_WORDS, 90):  # 90: many passes
        got = decontaminate.find_passages(docs, bench, block_words=most).select(
            "*", decontaminate.n_hit().alias("h"), F.sha2(F.array_join("decon_items", ","), 256).alias("sha"),
            decontaminate.contaminated().alias("bad")).collect()
        assert {r.doc_id: (r.decon_n_words, r.h, len(r.decon_items), r.sha, r.bad) for r in got} == want
        assert len(got) == len(rows)
    pieces = decontaminate.item_pieces(spark.createDataFrame([("x", "A-b " * 20), ("y", "c" * 99), ("z", "--- " * 9)], "i string, t string"), 13, 15)
    got = sorted((r.i, len(r.t.split())) for r in pieces.collect())
    assert got == [("x", n) for n in sorted([15] * 9 + [13])] + [("y", 1), ("z", 0)]  # 28 windows: three a piece, one in the last
    assert decontaminate.find_passages(none, bench).count() == 0
    clean = decontaminate.find_passages(docs, bench.where("false")).agg(F.max(F.size("decon_items"))).first()[0]
    assert clean == 0


def test_warc_round_trip(spark, none):
    rng = random.Random(3)
    long = [prose(rng, 200) for _ in range(5)]
    pages = [(i, rng.choice(["http://a/é b%20\r\nX: y", None, ""]), rng.choice([*long, None, "", "short", "short é"])) for i in range(60)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    path = scratch_path(spark, "w")
    warc_zstd.write_archives(frame, path, archive_bytes=2_000)
    got = warc_zstd.read_archives(spark, path).collect()
    want = brute.pages(pages)
    ids = lambda x: None if x is None else int(x)
    assert sorted((ids(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, ids(r.refers_to)) for r in got) == want
    assert {int(r.page_id): r.url for r in got} == {p[0]: p[1] for p in pages}
    assert {int(r.page_id): bytes(r.payload).decode() for r in got if r.payload is not None}.items() <= {p[0]: p[2] or "" for p in pages}.items()
    path = scratch_path(spark, "w")
    warc_zstd.write_archives(frame.where("false"), path)
    assert warc_zstd.read_archives(spark, path).count() == 0


def test_warc_reader_rejects_damage(spark, tmp_path):
    path = scratch_path(spark, "w")
    rows = [(i, "u", f"page {i} " * 40) for i in range(8)]
    warc_zstd.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    data = bytearray(bytes(spark.read.format("binaryFile").load(path).first().content))
    assert len(list(warc_zstd.records(bytes(data)))) == 8
    for broken in (data[:-20], data[20:], data[:-8] + b"junk", b""):
        with pytest.raises(warc_zstd.ArchiveError):
            list(warc_zstd.records(bytes(broken)))
    record = warc_zstd.render("1", "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, False, "d")
    warc_zstd.parse(record)
    for broken in (record.replace(b"payload\r", b"paylood\r"), record.replace(b"WARC/1.1", b"WARC/0.9"), record[:-1]):
        with pytest.raises(warc_zstd.ArchiveError):
            warc_zstd.parse(broken)


def test_mixing(spark, docs, rows, none):
    got = mixing.take(mixing.schedule(docs)).collect()
    assert len(got) == len(rows)
    size, taken, largest, target = {}, {}, {}, {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        largest[r.source] = max(largest.get(r.source, 0), r["size"])
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
    want = brute.targets(size)
    for s, t in want.items():
        assert target[s] == pytest.approx(t)
        assert abs(taken[s] - t) <= max(largest.values())
    assert sum(taken.values()) == int(1.5 * sum(size.values()))
    assert sorted(map(str, got)) == sorted(map(str, mixing.take(mixing.schedule(docs)).collect()))
    assert mixing.take(mixing.schedule(none)).count() == 0 and mixing.mixed(none).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 100}, {None: 10, "a": 10, "b": 10}, {"a": 5}, {"a": 0, "b": 7}])
def test_targets(spark, sizes):
    t = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(t).collect()}
    assert got == pytest.approx(brute.targets(sizes))


def test_pii_base_spans(spark, docs, rows, none):
    rng = random.Random(8)
    hard = ["1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.4", "a@b.c.d@e.f a@b.c_x@y.z @a.b x@y a..b@c-.d", "4111 1111 1111 1111 4111-1111--11111111",
            "+1 (017) 555-7713+49 30 1234567 +1", "0" * 15_000, "a" * 15_000 + "@b.cc", "1 " * 12_000, "5 - 4111111111111111,é漢@a.b"]
    hard += ["".join(rng.choice("0123456789. -+()@ab%_é") for _ in range(rng.randint(5, 120))) for _ in range(400)]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(hard)], "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find_pii(frame).select("doc_id", pii.joined("base").alias("b"), pii.joined("spans").alias("s")).collect()}
    for i, t in enumerate(hard):
        assert got[i].b == brute.base_spans(t), t[:100]
        assert set(got[i].b.split(",")) <= set(got[i].s.split(",")) or not got[i].b
    assert pii.find_pii(docs).count() == len(rows) and pii.find_pii(none).count() == 0


def test_pii_adds_spans_that_labelers_agree_on(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        kind = i % 4
        text = (prose(rng, 8) + [f" phone: {rng.randint(200, 999)}-555-{rng.randint(1000, 9999)} call",
                                 f" mail: bob{i} (at) site{i} (dot) com soon",
                                 f" mail: bob{i}@site{i}.com soon",
                                 f" id={rng.randint(10**15, 10**16 - 1)}x "][kind] + prose(rng, 5))
        rows.append((i, text))
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r.s for r in found.select("doc_id", pii.joined("spans").alias("s")).collect()}
    share = lambda k, name: np.mean([name in got[i] for i in range(k, 400, 4)])
    assert share(0, "phone") > 0.9 and share(1, "email") > 0.9 and share(2, "email") == 1


def test_pii_leaves_decoy_numbers_alone(spark):
    """Numbers of a card's length with a wrong check digit are never added, whatever stands around them."""
    rng = random.Random(6)

    def number(ok):
        while True:
            n = [rng.choice([4, 5]), *(rng.randrange(10) for _ in range(15))]
            total = sum(d if i % 2 else (2 * d - 9 if 2 * d > 9 else 2 * d) for i, d in enumerate(n))
            if (total % 10 == 0) == ok:
                return "".join(map(str, n))

    rows = [(i, f"{prose(rng, 6)} {rng.choice(['', 'card: ', 'visa ', 'ref '])}{number(i % 3 == 0)} {prose(rng, 6)}") for i in range(300)]
    rows += [(300 + i, f"{prose(rng, 6)} mail: bob{i} (at) site{i} (dot) com soon {i}.2.3.{400 + i} end") for i in range(60)]
    found = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: (r.b, r.s) for r in found.select("doc_id", pii.joined("base").alias("b"), pii.joined("spans").alias("s")).collect()}
    assert all(got[i][0] == got[i][1] and ("card" in got[i][1]) == (i % 3 == 0) for i in range(300))
    assert all("email" in got[i][1] and "ip" not in got[i][1] for i in range(300, 360))


def test_em_learns_reliability():
    rng = random.Random(0)
    votes = {}
    for _ in range(4_000):
        y = rng.random() < 0.3
        v = tuple((1 if y else -1) * (1 if rng.random() < q else -1) for q in (0.95, 0.9, 0.85, 0.5))
        votes[v] = votes.get(v, 0) + 1
    p = pii.reliabilities([(0, v, n) for v, n in votes.items()])
    assert p[0, (1, 1, 1, -1)] > 0.95 and p[0, (-1, -1, -1, 1)] < 0.05
    assert abs(p[0, (1, 1, -1, 1)] - p[0, (1, 1, -1, -1)]) < 0.1  # the last labeler knows nothing


def test_learned_scores_on_hard_cases(spark, docs, rows, labels, none):
    for fitted in (labels, labels.where("false"), labels.where("quality = 1 and toxic = 0")):
        fm = quality_fm.score(docs, quality_fm.fit(docs, fitted)).collect()
        tox = toxicity.score(docs, toxicity.fit(docs, fitted)).collect()
        assert len(fm) == len(tox) == len(rows)
        assert all(0 <= r.fm_score <= 1 for r in fm) and all(0 <= r.toxic_score <= 1 for r in tox)
    assert quality_fm.score(none, quality_fm.fit(docs, labels)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0
    for learned in (docs, none):
        got = langid.identify(docs, langid.learn(learned)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
        assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
    assert langid.identify(none, langid.learn(docs)).count() == 0


def test_factorisation_identity():
    rng = np.random.default_rng(0)
    m = quality_fm.Machine(np.zeros((2, 3)))
    m.v = rng.normal(0, 1, m.v.shape)
    m.w = rng.normal(0, 1, m.w.shape)
    index, value, first = np.array([3, 70, 5, 9, 11]), rng.normal(0, 1, 5), np.array([0, 3])
    want = []
    for part in (slice(0, 3), slice(3, 5)):
        i, x = index[part], value[part]
        pairs = sum(m.v[i[a]] @ m.v[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a))
        want.append(m.bias + m.w[i] @ x + pairs)
    assert m.margin(index, value, first)[0] == pytest.approx(want)


def test_language_filter_has_no_false_negatives():
    import pyarrow as pa

    h, _, _ = langid.grams(pa.array(["the quick brown fox"]))
    table = np.zeros((1 << 14, 2), np.uint64)
    for s in langid.slots(h, 1 << 14):
        table[s, 1] |= words.U64(1 << 5)  # language 69
    f = langid.Filters([f"l{i:02}" for i in range(70)], [1] * 70, table)
    lang, score = f.decide(pa.array(["the quick fox", "12 34", None]))
    assert lang == ["l69", "und", "und"] and score[0] == pytest.approx(1) and score[1] == 0


def test_grammar_scores_clauses():
    import pyarrow as pa

    s = toxicity.Scorer(np.zeros(0, np.uint64), np.zeros(0), toxicity.grammar())
    keys = toxicity.span_hash(["dolt"])
    s.keys, s.weights = keys, np.array([2.0])
    texts = ["you are a dolt.", "a dolt.", "you are not a dolt.", "he said you are a dolt.", "I will kill you.", "they kill time.", "fine day."]
    _, found = s.matches(pa.array(texts))
    score = {t: x for t, _, _, x in found}
    assert score[0] > score[1] > score[2] and score[0] > score[3] and score[4] > 2 * score[5] and 6 not in score


@pytest.mark.parametrize("query, label, least", [("op1_quality_fm", "quality", 0.97), ("op6_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, query, label, least):
    from triage.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    got = QUERIES[query](spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("predicted") == F.col(label)).cast("double"))).first()[0] >= least - 0.06


def test_held_out_language(spark):
    from triage.llm.queries import QUERIES

    d = "/root/testdata/sf0.01"
    got = QUERIES["op2_langid"](spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] >= 0.98
