"""The conversation trie against a plain trie, list ranking against a plain
walk, and the sorted scan against plain groups."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from triage.llm import conversation_trie as T
from triage.llm.ordered import along

SCHEMA = "conv_id long, turn long, role string, text string, c long, d string, pos string, n double"


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text))


def order(rows):
    """Turns of each conversation, as documented."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest(), (r, t)))
    return {c: [x[3] for x in sorted(ts, key=lambda x: x[:3])] for c, ts in own.items()}


def anew(own):
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - int(c - 20 * int(c / 20)), [])[:h] + ts[h:]
    return out


def plain(convs):
    members, ends = defaultdict(set), defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].add(c)
        ends[tuple(ts)].append(c)
    children = defaultdict(int)
    for key in members:
        if key:
            children[key[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for key in members:
        for d in range(len(key) + 1):
            leaves[key[:d]] += not children[key]
            saved[key[:d]] += (len(members[key]) - 1) * words(key[-1][1]) if key else 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(ends[k]))).encode()).hexdigest()) for k, m in members.items())


COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def mine(spark, rows, block=T.BLOCK, again=True):
    df = spark.createDataFrame([(*r, 1, "d", "p", 0.5) for r in rows], SCHEMA).repartition(5)
    found = T.trie(T.rebuilt(df) if again else T.numbered(df), block).collect()
    spots = sorted(x for r in found for x in (r.enter_at, r.exit_at))
    assert spots == list(range(len(spots)))  # each arc has a position of its own
    return sorted((tuple(r[c] for c in COLS) for r in found))


def some(seed, n=120, longest=9):
    rng = random.Random(seed)
    out = []
    for c in range(n):
        for t in range(rng.randint(1, longest)):
            out.append((c, t, rng.choice(["user", "assistant"]) if t else "system", rng.choice(["", "a b", "hello  there\tyou", "x"]) if t else f"s{rng.randrange(2)}"))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed, block", [(1, T.BLOCK), (2, 4), (3, 40)])
def test_equals_a_plain_trie(spark, seed, block):
    rows = some(seed)
    assert mine(spark, rows, block) == plain(anew(order(rows)))


def test_without_rebuilding(spark):
    rows = some(4, 40)
    assert mine(spark, rows, 16, again=False) == plain(order(rows))


def test_hard_rows(spark):
    rows = [(None, 0, "user", "lost"), (20, None, None, None), (20, 1, "user", "a"), (20, 1, "user", "a"), (20, 1, "user", "b"), (21, 5, None, "  "),
            (-3, 1, "user", "é 漢字  x"), (-20, 1, "user", "first"), (47, 2, "u", "no first conversation"), (47, 1, "u", ""), (10 ** 12, 0, "user", "w " * 50_000),
            *((60, t, "user", f"t{t}") for t in range(300)), *((61, t, "user", f"t{t}") for t in range(299)), *((c, 0, "same", "turn") for c in range(100, 180))]
    assert mine(spark, rows, 64) == plain(anew(order(rows)))


def test_a_conversation_with_a_third_of_all_turns_and_a_hot_prefix(spark):
    rows = [(5, t, "user", f"{t}") for t in range(2000)] + [(c, t, "user", f"{t}") for c in range(1000, 1400) for t in range(c % 7 + 1)]
    assert mine(spark, rows, 512, again=False) == plain(order(rows))


def test_no_rows(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(None, 1, "a", "b")]) == []


@pytest.mark.parametrize("block", [1, 7, 10_000])
def test_ranks_of_a_shuffled_list(spark, block):
    rng = random.Random(block)
    ids = [(rng.randrange(50), d, rng.randrange(2)) for d in range(300)]
    rng.shuffle(ids)
    w = [(1, rng.randrange(3), rng.randrange(100)) for _ in ids]
    rows = [(*a, *(b or (None, None, None)), *x) for a, b, x in zip(ids, [*ids[1:], None], w)]
    kinds = ", ".join(f"{c} bigint" for c in [*T.ARC, *T.NEXT, *T.TOTAL])
    got = {tuple(r[:3]): tuple(r[3:]) for r in T.ranked(spark.createDataFrame(rows, kinds).repartition(3), block).collect()}
    total = (0, 0, 0)
    for a, x in zip(ids, w):
        assert got[a] == total
        total = tuple(p + q for p, q in zip(total, x))


def test_sorted_scan(spark):
    rng = random.Random(6)
    rows = [(rng.choice([1, 1, 1, 2, 9]), i, rng.randrange(-2 ** 63, 2 ** 63)) for i in range(3000)] + [(k, 0, 5) for k in range(50, 90)]
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(4)
    got = along(df, ["g"], [F.col("o")], sums=("v",), ahead="o").collect()
    groups = defaultdict(list)
    for g, o, v in sorted(rows):
        groups[g].append((o, v))
    wrap = lambda x: (x + 2 ** 63) % 2 ** 64 - 2 ** 63
    want = []
    for g, items in groups.items():
        total = 0
        for i, (o, v) in enumerate(items):
            total += v
            want.append((g, o, v, wrap(total), wrap(total - v), i == len(items) - 1, items[i + 1][0] if i + 1 < len(items) else None))
    assert sorted(((r.g, r.o, r.v, r.up_v, r.before_v, r.last, r.next) for r in got), key=repr) == sorted(want, key=repr)
