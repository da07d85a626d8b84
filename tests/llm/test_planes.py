"""Centroid clustering by bit planes against plain integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from triage.llm import planes

SCHEMA = "vec_id long, embedding array<double>, id string, cluster string, planes string"


def plain(rows, k=8, rounds=10):
    vecs = [(i, [math.floor(1024 * x) if abs(x) < 2 ** 53 else 1024 * int(x) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    bits = planes.bits_of(min((min(v) for _, v in vecs), default=0), max((max(v) for _, v in vecs), default=0))
    by_hash = sorted(vecs, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                                          planes.packed(r[1], bits).tobytes()))
    cents = [v for _, v in by_hash[:k]]

    def assign():
        out = []
        for _, v in vecs:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        got = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (x, _) in zip(vecs, got) if x == c]
            if mine:
                cents[c] = [sum(col) // len(mine) for col in zip(*mine)]
    got = assign()
    top = (1 << 63) - 1
    inertia = {c: sum(d for x, d in got if x == c) for c, _ in got}
    return sorted(((i, c, min(d, top), min(inertia[c], top), min(sum(inertia.values()), top),
                    hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(vecs, got)), key=repr)


def mine(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "i", "c", "p") for i, v in rows], SCHEMA).repartition(3)
    out = planes.cluster(df, **options)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def vectors(rng, n, scale=1.0):
    mids = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(5)]
    return [(i, [rng.gauss(m, scale / 3) for m in rng.choice(mids)]) for i in range(n)]


@pytest.mark.parametrize("scale", [0.3, 1e-4, 200.0])
def test_equals_plain_integers(spark, scale):
    rows = vectors(random.Random(2), 60, scale)
    assert mine(spark, rows) == plain(rows)


def test_hard_rows(spark):
    rng = random.Random(5)
    rows = vectors(rng, 20)
    v = rows[0][1]
    rows += [(None, v), (None, [-x for x in v]), (100, None), (101, []), (102, v[:63]), (103, [*v, 0.0]), (104, [None, *v[1:]]),
             (105, [math.nan, *v[1:]]), (106, [math.inf, *v[1:]]), (107, [0.0] * 64), (108, [-0.0] * 64), rows[3], rows[3], (3, v)]
    assert mine(spark, rows) == plain(rows)


def test_components_beyond_int64_are_exact(spark):
    rows = vectors(random.Random(7), 12)
    rows += [(50, [1e30] * 64), (51, [-3.4e38] + [0.5] * 63), (52, [2.0 ** 52 + 0.5] * 64)]
    assert mine(spark, rows, rounds=3) == plain(rows, rounds=3)


def test_few_and_no_vectors(spark):
    rows = vectors(random.Random(8), 3)
    assert mine(spark, rows) == plain(rows)
    same = [(i, rows[0][1]) for i in range(30)]  # all centroids equal: the smallest number takes all
    assert mine(spark, same) == plain(same)
    assert mine(spark, []) == []


def test_dot_products_and_norms():
    rng = np.random.default_rng(1)
    for bits in (2, 12, planes.FAST_BITS, planes.FAST_BITS + 9):
        v = rng.integers(-(1 << bits - 1), 1 << bits - 1, (20, 64))
        p = planes.to_planes(v, bits)
        o = v.astype(object)
        assert (planes.norms(p) == (o * o).sum(axis=1)).all()
        assert (planes.dots(p, p[3]) == (o * o[3]).sum(axis=1)).all()
        assert planes.components(p[4], bits) == v[4].tolist()
