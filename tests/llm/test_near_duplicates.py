"""The pipeline's near-duplicate stage against a brute force of its rule."""

from __future__ import annotations

import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import brute
from triage.llm import jaccard_join

SHINGLE, LINK = 5, 80
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text, n=SHINGLE):
    ws = brute.WORD.findall((text or "").translate(brute.UPPER))
    return frozenset(tuple(ws[i:i + n]) for i in range(len(ws) - n + 1)) if len(ws) >= n else frozenset({tuple(ws)} - {()})


def groups(sets):
    """The least index of each set's component, by all pairs."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            n = len(x & sets[j])
            if n and 100 * n >= LINK * (len(x) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


@pytest.fixture(scope="module")
def rows():
    """Texts of several sizes, each followed by copies with more and more words changed."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    texts = [None, "", "a b c", "a b c", "A b c d"]
    for n in [5, 8, 9, 12, 20, 40, 100, 100, 250, 600] * 2:
        ws = [word() for _ in range(n)]
        texts.append(" ".join(ws))
        for _ in range(5):
            at = rng.randrange(len(ws))
            ws[at:at + 1] = rng.choice([[word()], [word(), word()], []])
            texts.append(" ".join(ws))
    return [(i, t, "en", "s", 1) for i, t in enumerate(texts)]


def test_two_edits_in_a_hundred_words(spark):
    ws = [f"w{i}" for i in range(100)]
    near = [*ws[:30], "changed", *ws[31:60], "too", *ws[61:]]  # 86 of 106 shingles: 0.811; of 3 words 0.885
    docs = spark.createDataFrame([(1, " ".join(ws), "en", "s", 1), (2, " ".join(near), "en", "s", 1)], DOCS)
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()] == [1]


def test_stage_against_brute_force(spark, rows):
    want = groups([shingles(r[1]) for r in rows])
    assert set(want) != {c for _, c in brute.jaccard_components([r[:2] for r in rows]).values()}  # op5's rule
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want))
    for most in (jaccard_join.REGION_SHINGLES, 60):  # 60: almost all regions go through distributed waves
        got = jaccard_join.join_components(docs, region_shingles=most, rule=corpus_pipeline.NEAR).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {
            r[0]: (len(shingles(r[1])), g) for r, g in zip(rows, want)}


@pytest.mark.parametrize("link", [80, 85, 67, 95])
def test_projections_share_a_region_when_linked(link):
    rule, rng = jaccard_join.Rule(5, link), np.random.default_rng(3)
    least = jaccard_join.shells(5_000, rule)
    found = 0
    for _ in range(600):
        x = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 700))).astype(np.uint64))
        most = len(x) * (100 - link) // link + 1
        drop, add = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
        inter = len(x) - drop
        if inter > 0 and jaccard_join.linked(np.array(inter), len(x), len(y), rule) and not np.array_equal(x, y):
            found += 1
            assert set(jaccard_join.projections(x, least, rule)) & set(jaccard_join.projections(y, least, rule))
    assert found > 50


def test_an_id_with_different_texts_loses_none(spark):
    a, b, c, d = (" ".join(f"{s}{i}" for i in range(50)) for s in "abcd")
    rows = [(1, a), (2, a + " end"), (2, b), (3, c), (3, d), (3, d), (3, d + " "), (None, c), (None, c), (4, None), (5, ""), (6, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, (r.text or "").strip()) for r in got.collect()) == sorted(
        [(1, a), (2, b), (3, c), (3, d), (0, c), (0, c), (4, ""), (5, "")])


@pytest.mark.parametrize("link", [80, 67, 88])
def test_rare_keys_meet_when_linked(spark, link):
    """Whatever the counts of the shingles are, linked sets keep one in common."""
    rule, rng = jaccard_join.Rule(5, link), np.random.default_rng(4)
    sets, pairs = [], []
    for _ in range(400):
        x = np.unique(rng.integers(0, 1 << 63, int(rng.integers(2, 400))).astype(np.uint64))
        most = len(x) * (100 - link) // link + 1
        drop, add = int(rng.integers(0, most + 1)), int(rng.integers(0, most + 1))
        y = np.unique(np.concatenate([x[drop:], rng.integers(0, 1 << 63, add).astype(np.uint64)]))
        if drop < len(x) and jaccard_join.linked(np.array(len(x) - drop), len(x), len(y), rule) and not np.array_equal(x, y):
            pairs.append((len(sets), len(sets) + 1))
            sets += [x, y]
    assert len(pairs) > 50
    rows = [(i, int(k)) for i, x in enumerate(sets) for k in jaccard_join.single_shingles(x, rule)]
    others = [(len(sets) + int(j), k) for _, k in rows[::3] for j in rng.integers(0, 50, rng.integers(0, 9))]
    point = [(i, i, len(x)) for i, x in enumerate(sets)] + [(len(sets) + j, len(sets) + j, 100) for j in range(50)]
    got = jaccard_join.rare_keys(spark.createDataFrame(rows + others, "uid long, key long"),
                                 spark.createDataFrame(point, "uid long, point long, n long"), rule).collect()
    kept = {}
    for r in got:
        kept.setdefault(r.point, set()).add(r.key)
    assert all(kept[a] & kept[b] for a, b in pairs)
    assert len(got) < len(rows + others)


def passages(seed, docs):
    """Texts of 120 words of their own and a passage of 30 that others have: a
    fifth of the shingles, where two fifths (less what a draw by hash strays)
    may be."""
    rng = random.Random(seed)
    shared = [[f"s{seed}x{i}y{j}" for j in range(30)] for i in range(max(docs // 40, 1))]
    return [" ".join([f"w{seed}x{i}y{j}" for j in range(120)] + rng.choice(shared)) for i in range(docs)]


@pytest.mark.parametrize("docs", [100, 800])
def test_shared_passages_tie_no_texts(spark, docs):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(passages(docs, docs))]
    rows.append((docs, rows[0][1].replace("y7 ", "new ", 1), "en", "s", 1))
    table = spark.createDataFrame(rows, DOCS)
    rule = corpus_pipeline.NEAR
    point = (jaccard_join.points(table, "doc_id", "text", rule).withColumnRenamed("id", "uid")
             .withColumn("point", jaccard_join.F.col("uid")).cache())
    keys = point.select("uid", jaccard_join.F.explode("regions").alias("key"))
    got = jaccard_join.rare_keys(keys, point.select("uid", "point", "n"), rule)
    assert {r.point for r in got.groupBy("key").agg(jaccard_join.F.collect_set("point").alias("p")).where("size(p) > 1")
            .select(jaccard_join.F.explode("p").alias("point")).collect()} == {0, docs}
    kept = corpus_pipeline.drop_near_duplicates(spark, table, "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(docs))
