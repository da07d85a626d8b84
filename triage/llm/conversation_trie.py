"""Prefix trie of conversations, with subtree sums by the Euler-tour technique.

1. *Turns.* A turn is reduced to 128 bits of its role and text and the words
   of its text; texts are never shuffled. Conversations are numbered and
   prefix-hashed along a range-sorted table (``ordered.along``), so that one
   conversation may have any share of all turns.
2. *Nodes.* A prefix is identified by its depth and two 64-bit sums of
   (position, turn) hashes; an aggregate, combined map-side, gives each node
   its members. A node is named (conv_id, depth) by its smallest member.
3. *Tour.* Each node has an enter and an exit arc. Children follow each other
   by conv_id: enter leads to the first child's enter (a leaf's to its exit),
   exit to the next sibling's enter, the last one's to the parent's exit.
4. *List ranking.* The tour is contracted in rounds. A round deals the live
   arcs by ranges of (conv_id, depth) in blocks of bounded size; each block
   replaces the chains within it by their heads, which carry the chain's sums
   and its next arc. As siblings are in order of conv_id, neighbours in the
   tour lie mostly in one block. A round that leaves more than half is
   followed by one that splices out arcs with a coin of 1 after one with a
   coin of 0, so that a quarter goes whatever the order. Up to ``BLOCK`` arcs
   are finished by one task. Then the rounds are unrolled: an arc's position
   is its head's and its place in the chain. The chains carry the sums of
   leaves and savings besides, so each arc has its position and the prefix
   sums there.
5. A subtree's sums are those at the exit arc less those at the enter arc.

The ids of the conversations that end at a node are hashed in ascending order
from texts of up to ``CHUNK`` ids, so the task that hashes a node's ids, by
nature one after the other, reads a small stream.

Defined results: rows without a conv_id are left out; turns are ordered by
turn (null first), equal ones by the MD5 of role and text; rows that repeat
are turns each; null roles and texts are empty; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triage.llm.common import bound_batches, written
from triage.llm.ordered import along

#: conversations that share a first one, and the modulus of the turns taken from it
GROUP, HEADS = 20, 4
#: arcs that one task contracts at a time; ids in a text that is hashed
BLOCK, CHUNK = 1 << 16, 4096
ARC, NEXT, HEAD, TOTAL, OFFSET = ["c", "d", "k"], ["nc", "nd", "nk"], ["hc", "hd", "hk"], ["t0", "t1", "t2"], ["o0", "o1", "o2"]


@dataclass
class Turns:
    """``rows`` (conv, pos, digest, words): turns at positions 1, 2, ...;
    ``empty`` (conv): conversations without turns."""

    rows: DataFrame
    empty: DataFrame


def numbered(conversations: DataFrame) -> Turns:
    """The turns of a (conv_id, turn, role, text) table."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), "turn",
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).cast("bigint").alias("words"),
        F.lit(1).cast("bigint").alias("one"), F.monotonically_increasing_id().alias("salt"))
    out = along(rows, ["conv"], [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("salt")], sums=("one",))
    out = out.select("conv", F.col("up_one").alias("pos"), "digest", "words")
    return Turns(written(out, "turns"), out.select("conv").limit(0))


def heads_of(conv: Column) -> Column:
    """How many turns of its group's first conversation a conversation begins with."""
    return (F.crc32(conv.cast("string")) % HEADS).cast("bigint")


def rebuilt(conversations: DataFrame) -> Turns:
    """Each conversation c anew: the first h turns of conversation c - c % 20
    (h = crc32(c) % 4), then its own turns after its first h."""
    bound_batches(conversations.sparkSession)
    own = numbered(conversations).rows
    first = [F.max(F.when(F.col("pos") == i, F.struct("digest", "words"))).alias(f"x{i}") for i in range(1, HEADS)]
    base = own.where((F.col("conv") % GROUP == 0) & (F.col("pos") < HEADS)).groupBy(F.col("conv").alias("base")).agg(*first)
    size = own.groupBy("conv").agg(F.count("*").alias("n"))
    size = size.withColumn("h", heads_of(F.col("conv"))).withColumn("base", F.col("conv") - F.col("conv") % GROUP)
    taken = F.array_compact(F.slice(F.array(*(F.col(f"x{i}") for i in range(1, HEADS))), 1, F.col("h").cast("int")))
    about = written(size.join(base, "base", "left").select("conv", "n", "h", F.when(F.col("h") > 0, taken).alias("x"))
                    .withColumn("m", F.when(F.col("h") > 0, F.size("x")).otherwise(0).cast("bigint")), "rebuilt-heads")
    head = about.select("conv", F.posexplode("x").alias("i", "t")).select(
        "conv", (F.col("i") + 1).cast("bigint").alias("pos"), "t.digest", "t.words")
    # positions move only where the first conversation has fewer turns
    short = about.where("m < h").select("conv", (F.col("m") - F.col("h")).alias("move"))
    rest = own.where(F.col("pos") > heads_of(F.col("conv"))).join(short, "conv", "left").select(
        "conv", (F.col("pos") + F.coalesce("move", F.lit(0))).alias("pos"), "digest", "words")
    return Turns(head.unionByName(rest), about.where("m = 0 and n <= h").select("conv"))


def contract(rows: pa.Table) -> pa.RecordBatch:
    """Chains of the live arcs at hand: every arc with its chain's head and
    the sums before it in the chain; heads have the chain's next arc and
    sums."""
    cols = {c: rows.column(c).to_numpy(zero_copy_only=False) for c in [*ARC, *TOTAL]}
    has_next = ~rows.column("nk").combine_chunks().is_null().to_numpy(zero_copy_only=False)
    nxt = {c: rows.column(c).fill_null(0).to_numpy(zero_copy_only=False) for c in NEXT}
    n = rows.num_rows
    names = np.empty(n, [(c, np.int64) for c in ARC])
    aims = np.empty(n, names.dtype)
    for a, b in zip(ARC, NEXT):
        names[a], aims[a] = cols[a], nxt[b]
    both, place = np.unique(np.concatenate([names, aims]), return_inverse=True)
    at = np.full(len(both), -1, np.int64)
    at[place[:n]] = np.arange(n)
    follows = np.where(has_next, at[place[n:]], -1)
    led = np.zeros(n, bool)
    led[follows[follows >= 0]] = True
    head = np.zeros(n, np.int64)
    offset = np.zeros((n, len(TOTAL)), np.int64)
    weight = np.stack([cols[t] for t in TOTAL], axis=1)
    step, own = follows.tolist(), weight.tolist()
    end = head.tolist()
    total = weight.copy()
    for i in np.flatnonzero(~led).tolist():
        x, y, z = 0, 0, 0
        j = i
        while True:
            head[j] = i
            offset[j] = (x, y, z)
            w = own[j]
            x, y, z = x + w[0], y + w[1], z + w[2]
            if step[j] < 0:
                break
            j = step[j]
        total[i] = (x, y, z)
        end[i] = j
    end = np.array(end)
    leads = pa.array(~led)
    out = [*(pa.array(cols[c]) for c in ARC), *(pa.array(cols[c][head]) for c in ARC), *(pa.array(offset[:, i]) for i in range(3)), leads]
    lost = led | ~has_next[end]
    out += [pa.array(nxt[c][end], mask=lost) for c in NEXT] + [pa.array(total[:, i], mask=led) for i in range(3)]
    return pa.RecordBatch.from_arrays(out, [*ARC, *HEAD, *OFFSET, "leads", *NEXT, *TOTAL])


ROUND = ", ".join([*(f"{c} bigint" for c in [*ARC, *HEAD, *OFFSET]), "leads boolean", *(f"{c} bigint" for c in [*NEXT, *TOTAL])])


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= most:
            yield contract(pa.Table.from_batches(held))
            held, n = [], 0
    if held:
        yield contract(pa.Table.from_batches(held))


def spliced(live: DataFrame, turn: int) -> DataFrame:
    """A round that takes arcs with a coin of 1 out behind those with a coin
    of 0, in the form of ``contract``."""
    coin = F.pmod(F.xxhash64(F.lit(turn), *ARC), F.lit(2))
    zero, one = live.where(coin == 0), live.where(coin == 1)
    behind = one.select(*(F.col(c).alias(f"x{c}") for c in [*ARC, *NEXT, *TOTAL]))
    pair = written(zero.join(behind, [F.col(n) == F.col(f"x{a}") for n, a in zip(NEXT, ARC)], "left"), "spliced")
    joined = F.col("xk").isNotNull()
    same = [F.col(c).alias(h) for c, h in zip(ARC, HEAD)]
    none = [F.lit(0).cast("bigint").alias(o) for o in OFFSET]
    stay = pair.select(*ARC, *same, *none, F.lit(True).alias("leads"), *(F.when(joined, F.col(f"x{c}")).otherwise(F.col(c)).alias(c) for c in NEXT),
                       *(F.col(c) + F.coalesce(f"x{c}", F.lit(0)) for c in TOTAL)).toDF(*[*ARC, *HEAD, *OFFSET, "leads", *NEXT, *TOTAL])
    gone = pair.where(joined).select(*(F.col(f"x{c}").alias(c) for c in ARC), *same, *(F.col(t).alias(o) for t, o in zip(TOTAL, OFFSET)),
                                     F.lit(False).alias("leads"), *(F.lit(None).cast("bigint").alias(c) for c in [*NEXT, *TOTAL]))
    alone = one.join(gone.select(*ARC), ARC, "left_anti").select(*ARC, *same, *none, F.lit(True).alias("leads"), *NEXT, *TOTAL)
    return stay.union(gone).union(alone)


def ranked(arcs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(c, d, k, p0, p1, p2): the sums of ``t0, t1, t2`` over all arcs before
    an arc in the list; ``arcs`` is (c, d, k, nc, nd, nk, t0, t1, t2), one
    list."""
    live, rounds = written(arcs, "arcs"), []
    n = live.count()
    while n > 1:
        if n <= block:
            dealt = live.coalesce(1)  # a bounded number of arcs
        else:
            dealt = live.repartitionByRange(-(-n // block), *ARC)
        rounds.append(written(dealt.mapInArrow(lambda b, most=block: blocks(b, 2 * most), ROUND), "tour-round"))
        live = rounds[-1].where("leads").select(*ARC, *NEXT, *TOTAL)
        before, n = n, live.count()
        if n > 1 and 2 * n > before:
            rounds.append(written(spliced(live, len(rounds)), "tour-round"))
            live = rounds[-1].where("leads").select(*ARC, *NEXT, *TOTAL)
            n = live.count()
    found = live.select(*ARC, *(F.lit(0).cast("bigint").alias(f"p{i}") for i in range(3)))
    for i, r in enumerate(reversed(rounds)):
        base = found.select(*(F.col(c).alias(h) for c, h in zip(ARC, HEAD)), *(F.col(f"p{i}").alias(f"b{i}") for i in range(3)))
        found = r.select(*ARC, *HEAD, *OFFSET).join(base, HEAD).select(*ARC, *((F.col(f"b{i}") + F.col(f"o{i}")).alias(f"p{i}") for i in range(3)))
        if i % 8 == 7:
            found = written(found, "tour-places")
    return found


def ends_hash(ends: DataFrame) -> DataFrame:
    """(c, d, sha) of ``ends`` (c, d, conv): SHA-256 of a node's conv ids in
    ascending order, comma-joined."""
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids = None, []

        def flush():
            return pa.RecordBatch.from_pydict({"c": [now[0]], "d": [now[1]], "first": [ids[0]], "text": [",".join(map(str, ids))]})

        for b in batches:
            for c, d, conv in zip(*(b.column(i).to_pylist() for i in range(3))):
                if ids and (now != (c, d) or len(ids) == CHUNK):
                    yield flush()
                    ids = []
                now = (c, d)
                ids.append(conv)
        if ids:
            yield flush()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, h = None, None
        for b in batches:
            out = []
            for c, d, text in zip(*(b.column(b.schema.get_field_index(x)).to_pylist() for x in ("c", "d", "text"))):
                if now == (c, d):
                    h.update(b",")
                else:
                    if now is not None:
                        out.append((*now, h.hexdigest()))
                    now, h = (c, d), hashlib.sha256()
                h.update(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["c", "d", "sha"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*now, h.hexdigest())], ["c", "d", "sha"])

    order = ["c", "d", "conv"]
    parts = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(texts, "c bigint, d bigint, first bigint, text string")
    return parts.repartition("c", "d").sortWithinPartitions("c", "d", "first").mapInArrow(hashed, "c bigint, d bigint, sha string")


def nodes_of(turns: Turns) -> tuple[DataFrame, DataFrame]:
    """(c, d, pc, n, w) of each node: smallest member, depth, the parent's
    smallest member (null: the root), members, words of the last turn; and (c,
    d, conv) of each conversation and the node where it ends."""
    x, y = (F.xxhash64(F.lit(seed), "pos", "digest").alias(name) for seed, name in ((11, "x"), (13, "y")))
    rows = along(turns.rows.select("conv", "pos", "words", x, y), ["conv"], [F.col("pos")], sums=("x", "y"))
    rows = written(rows.select("conv", "pos", "words", "last", "up_x", "up_y", "before_x", "before_y"), "prefixes")
    key = ["pos", "up_x", "up_y"]
    found = written(rows.groupBy(*key).agg(F.min("conv").alias("c"), F.count("*").alias("n"), F.max("words").alias("w"),
                                           F.max("before_x").alias("px"), F.max("before_y").alias("py")), "nodes")
    every = rows.where("pos = 1").select("conv").union(turns.empty).agg(F.min("conv").alias("c"), F.count("*").alias("n"))
    root = every.where("c is not null").select("c", F.lit(0).cast("bigint").alias("d"), F.lit(None).cast("bigint").alias("pc"), "n",
                                               F.lit(0).cast("bigint").alias("w"))
    first = root.first()  # one row
    top = F.lit(first.c if first else None).cast("bigint")
    up = found.select((F.col("pos") + 1).alias("pos"), F.col("up_x").alias("px"), F.col("up_y").alias("py"), F.col("c").alias("pc"))
    deep = found.where("pos > 1").join(up, ["pos", "px", "py"]).select("c", F.col("pos").alias("d"), "pc", "n", "w")
    nodes = deep.union(found.where("pos = 1").select("c", F.col("pos").alias("d"), top.alias("pc"), "n", "w")).union(root)
    at = rows.where("last").select(*key, "conv").join(found.select(*key, "c"), key).select("c", F.col("pos").alias("d"), "conv")
    return written(nodes, "trie-nodes"), at.union(turns.empty.select(top.alias("c"), F.lit(0).cast("bigint").alias("d"), "conv"))


def tour(nodes: DataFrame) -> DataFrame:
    """The arcs of ``nodes`` for ``ranked``: each counts 1, and enter arcs 1
    for a leaf and the savings of the node."""
    below = nodes.where("pc is not null").select("c", "d", "pc", (F.col("d") - 1).alias("pd"))
    row = written(along(below, ["pc", "pd"], [F.col("c")], ahead="c").select("c", "d", "next"), "siblings")
    child = below.groupBy("pc", "pd").agg(F.min("c").alias("child")).select(F.col("pc").alias("c"), F.col("pd").alias("d"), "child")
    full = nodes.join(row, ["c", "d"], "left").join(child, ["c", "d"], "left")
    one, zero, null = (F.lit(v).cast("bigint") for v in (1, 0, None))
    leaf, sibling, top = F.col("child").isNull(), F.col("next").isNotNull(), F.col("pc").isNull()
    enter = F.struct(zero.alias("k"), F.coalesce("child", "c").alias("nc"), F.when(leaf, F.col("d")).otherwise(F.col("d") + 1).alias("nd"),
                     F.when(leaf, one).otherwise(zero).alias("nk"), one.alias("t0"), F.when(leaf, one).otherwise(zero).alias("t1"),
                     ((F.col("n") - 1) * F.col("w")).alias("t2"))
    leave = F.struct(one.alias("k"), F.coalesce("next", "pc").alias("nc"),
                     F.when(sibling, F.col("d")).when(~top, F.col("d") - 1).alias("nd"),
                     F.when(sibling, zero).when(~top, one).otherwise(null).alias("nk"), one.alias("t0"), zero.alias("t1"), zero.alias("t2"))
    return full.select("c", "d", F.explode(F.array(enter, leave)).alias("a")).select("c", "d", "a.*")


def trie(turns: Turns, block: int = BLOCK) -> DataFrame:
    """One row for each node: conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, and the positions of its
    arcs in the tour (enter_at, exit_at)."""
    bound_batches(turns.rows.sparkSession)
    nodes, ends = nodes_of(turns)
    at = ranked(tour(nodes), block)
    null = F.lit(None).cast("bigint")
    # one aggregate by node over what is known of it: itself, its children, its two arcs, its ends
    cols = ["pc", "n", "children", "e0", "e1", "e2", "x0", "x1", "x2"]
    enter, leave = F.col("k") == 0, F.col("k") == 1
    parts = [nodes.select("c", "d", "pc", "n", *[null] * 7, F.lit(None).cast("string")),
             nodes.where("pc is not null").groupBy("pc", "d").agg(F.count("*").alias("children")).select(
                 "pc", F.col("d") - 1, null, null, "children", *[null] * 6, F.lit(None).cast("string")),
             at.select("c", "d", null, null, null, *(F.when(enter, F.col(f"p{i}")) for i in range(3)),
                       *(F.when(leave, F.col(f"p{i}")) for i in range(3)), F.lit(None).cast("string")),
             ends_hash(ends).select("c", "d", *[null] * 9, "sha")]
    whole = parts[0].toDF("c", "d", *cols, "sha")
    for p in parts[1:]:
        whole = whole.union(p)
    whole = whole.groupBy("c", "d").agg(*(F.max(x).alias(x) for x in [*cols, "sha"]))
    return whole.select(
        F.col("c").alias("conv_id"), F.col("d").alias("depth"), F.col("pc").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.coalesce("children", F.lit(0)).cast("bigint").alias("n_children"), (F.col("x1") - F.col("e1")).alias("n_leaves"),
        (F.col("x2") - F.col("e2")).alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        F.col("e0").alias("enter_at"), F.col("x0").alias("exit_at"))
