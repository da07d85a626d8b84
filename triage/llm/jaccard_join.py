"""Exact Jaccard similarity join of shingle sets in metric space.

The Jaccard distance d = 1 - |x & y| / |x | y| is a metric, and a link is
d <= r. A ``Rule`` has the words of a shingle and r: ``RULE`` (3 words, r = 0.1)
is op5's, others are given by the caller. The join narrows regions of the space, level by level:

1. *Copies.* Documents with equal sets are one point (an aggregate by set
   hash, combined map-side). All further work is on points.
2. *Size shells.* Sizes have the distance 1 - min/max, which is never above
   d. Pivot sizes, a factor 1.5 apart, own the shells; a point within r of
   the shell below is replicated into it, so linked points share a shell.
3. *Sub-universes.* Unrelated texts are all at a distance near 1 of each
   other and of any pivot, so windows around pivots alone would replicate
   every point to every region. A shell therefore splits the universe of
   shingles into m parts. Linked points of the shell differ in at most
   D = floor(largest size * r / (1 - r)) shingles (a ninth of it at r = 0.1, a
   quarter at r = 0.2) and m > D, so in some part the
   distance of their projections is 0: a region for each (shell, part,
   projection) holds every link, with windows of width 0. (If a point has D
   non-empty projections or fewer, its empty ones count as well; m leaves
   room for that to be rare.) At a link below ``PARTS_LINK`` the parts would
   have two or three shingles, and a passage that many documents share would
   tie them all. The regions are those of single shingles there. Of sets x, y
   that are linked, a prefix of |x| - ceil(t |x|) + l shingles and one of
   |y| - ceil(t |y|) + l in any fixed order have l in common (t = 1 - r). So
   of each set ``KEY_SHARE`` hundredths are taken in the order of their hash,
   and each is counted over all points; then each set leaves out the
   l - 1 most frequent of its own (l: the least for any set of a size that it
   may be linked with), and the least frequent common one still is in both.
   A text is thus tied to no other by passages of up to two fifths of its
   taken shingles (t = 0.8), however many texts share them. Points
   that share a region are tied to its least point; the connected
   components of these ties are the *regions* of the next level. No link
   crosses a region.
4. *Pivots.* A region is joined exactly by pivots. Each pivot owns the ball
   of points within r: they are linked to it. Pivots are drawn from points
   that no ball has, until all are owned. By the triangle inequality a link
   between balls of p and q joins points within 2r of both p and q; only
   where p and q are still unconnected, these boundary points become pivots
   themselves, recursively. A region of up to ``REGION_SHINGLES`` is joined
   in one task (numpy); a larger one, however large, by distributed waves:
   up to ``WAVE_PIVOTS`` pivots of bounded total size are broadcast, every
   point of the region is held against them where it lies, and the waves go
   on until each point is owned and each boundary settled.

The result is the components of the link graph, without listing the pairs of
a group: a link inside a ball needs no pair, one between balls is found by
step 4.

Words are runs of non-space characters after A-Z are lower-cased; a set is the
distinct shingles of the rule's length (64-bit hashes), of fewer words the whole
sequence.

Defined results: null, empty and wordless texts have an empty set (size 0) and
are linked with nothing; a document without links is its own component;
repeated rows and equal texts are linked; of rows that share an id the id
stands for all of them; a null id is linked like others, and is never the
least id of a group with ids; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triage.llm import words as W
from triage.llm.common import bound_batches, unit_hash, written
from triage.llm.graph import components

#: a link: SCALE * intersection >= Rule.link * union
SCALE = 100


@dataclass(frozen=True)
class Rule:
    """Which documents are linked: those whose sets of ``shingle``-word
    shingles have a Jaccard similarity of ``link`` hundredths or more."""

    shingle: int
    link: int

    def __post_init__(self):
        if self.shingle < 1 or not SCALE < 2 * self.link < 2 * SCALE:
            raise ValueError(f"no rule of the join: {self}")

    @property
    def smallest(self) -> int:
        """Sets below this size are linked with equal ones only."""
        return self.link // (SCALE - self.link)


RULE = Rule(shingle=3, link=90)
#: shingles of a region that one task joins
REGION_SHINGLES = 1_000_000
#: so many keys of more than one point are broadcast; more are joined by a shuffle
BROADCAST_KEYS = 1 << 19
#: links below have regions by single shingles; of so many hundredths of a set
PARTS_LINK, KEY_SHARE = 90, 40
#: regions and pivots of a wave, and the cells of its tables (shingles times pivots, a byte each)
WAVE_REGIONS, WAVE_PIVOTS, WAVE_CELLS = 16, 256, 64_000_000


def shells(largest: int, rule: Rule = RULE) -> np.ndarray:
    """Least sizes of the shells up to a size."""
    out = [rule.smallest]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out)


@lru_cache(maxsize=None)
def parts_of(least: int, most: int) -> int:
    """The parts of a shell whose sets have ``least`` shingles or more and whose
    linked points differ in ``most``: so many that also the least sets have
    more non-empty projections than that, by two standard deviations."""
    m = most + 2 + most // 16
    while m < 4 * (most + 2):
        empty = np.exp(-least / m)
        if m * (1 - empty) >= most + 1 + 2 * np.sqrt(m * empty * (1 - empty * (1 + least / m))):
            break
        m += 1
    return m


def shingle_sets(col: pa.Array, n: int = RULE.shingle) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, off = W.texts(col)
    data = W.LOWER[raw]
    ws = W.runs(W.NOT_SPACE[data], off)
    h = W.hashes(data, ws.starts, ws.ends)
    long = W.windows(h, n)
    out = []
    for a, b in zip(ws.bounds[:-1].tolist(), ws.bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(long[a:b - n + 1]))
        else:
            out.append(W.windows(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
    return out


def set_hash(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    with np.errstate(over="ignore"):
        return tuple(int(np.sum(W.mix(x ^ W.U64(s)), dtype=np.uint64).view(np.int64)) for s in (0x1234567, 0xABCDEF987))


def projections(x: np.ndarray, least: np.ndarray, rule: Rule = RULE) -> np.ndarray:
    """Hashes of a point's regions: its projections in its own shell and,
    within r of it, the shell below."""
    n = len(x)
    if n < rule.smallest:
        return np.zeros(0, np.int64)
    own = int(np.searchsorted(least, n, "right")) - 1
    low = int(np.searchsorted(least, -(-n * rule.link // SCALE), "right")) - 1
    out = []
    for shell in range(max(low, 0), own + 1):
        most = (int(least[shell + 1]) - 1) // rule.smallest  # D
        m = parts_of(int(least[shell]), most)
        tag = W.mix(np.array([shell + 1], np.uint64))[0]
        spread = W.mix(x ^ tag)
        part = (spread % W.U64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        parts, first = np.unique(part[order], return_index=True)
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(W.mix(spread[order] + tag), first)
            keys = W.mix(sums + W.mix(parts.astype(np.uint64) + tag * W.U64(3)))
            out.append(keys)
            if len(parts) <= most:
                empty = np.setdiff1d(np.arange(m), parts).astype(np.uint64)
                out.append(W.mix(W.mix(empty + tag * W.U64(5))))
    return np.concatenate(out).view(np.int64)


def single_shingles(x: np.ndarray, rule: Rule) -> np.ndarray:
    """The shingles of a set that may be its regions: ``KEY_SHARE`` hundredths
    of it, the first by hash."""
    n = len(x)
    if n < rule.smallest:
        return np.zeros(0, np.int64)
    most = max(n + (-n * rule.link // SCALE) + 1, -(-n * KEY_SHARE // SCALE))
    return x[np.argpartition(W.mix(x), most - 1)[:most]].view(np.int64)


def spare(rule: Rule) -> Column:
    """How many of the shingles of ``single_shingles`` a set of ``n`` leaves
    out: one less than it has in common with any set linked to it. (A linked
    set has t n shingles or more, and one of k shingles has k (KEY_SHARE + t - 1)
    more in its prefix than it may lack of the other.)"""
    more = max(KEY_SHARE + rule.link - SCALE, 0)
    return F.expr(f"greatest(1, ({more} * (({rule.link} * n + {SCALE - 1}) div {SCALE}) + {SCALE - 1}) div {SCALE}) - 1")


def rare_keys(keys: DataFrame, point: DataFrame, rule: Rule) -> DataFrame:
    """(point, key) of the keys (uid, key) that are a set's regions: those of
    several sets but for its ``spare`` most frequent ones. The rows of a key
    are counted by a window, which spills; each set has many keys, so that
    even one in all sets has a small part of the rows."""
    several = keys.withColumn("k", F.count("*").over(Window.partitionBy("key"))).where("k > 1")
    rank = F.row_number().over(Window.partitionBy("uid").orderBy(F.desc("k"), F.desc("key")))
    return several.withColumn("rank", rank).join(point, "uid").where(F.col("rank") > spare(rule)).select("point", "key")


def linked(inter: np.ndarray, a, b, rule: Rule = RULE) -> np.ndarray:
    return SCALE * inter >= rule.link * (a + b - inter)


def near(inter: np.ndarray, a, b, rule: Rule = RULE) -> np.ndarray:
    """Within 2r."""
    return SCALE * inter >= (2 * rule.link - SCALE) * (a + b - inter)


class Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def join_region(sets: list[np.ndarray], rule: Rule = RULE) -> list[int]:
    """Step 4 in one task: the component (least index) of each set."""
    n = len(sets)
    sizes = np.array([len(x) for x in sets], np.int64)
    first = np.cumsum(sizes) - sizes
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    groups, here = Union(n), np.zeros(ids.max() + 1, np.int64)
    owned, pivot = np.zeros(n, bool), np.zeros(n, bool)
    bounds: list[tuple[int, np.ndarray]] = []  # pivot, the points within 2r of it

    def own(p: int) -> None:
        pivot[p] = True
        mine = ids[first[p]:first[p] + sizes[p]]
        here[mine] = 1
        inter = np.add.reduceat(here[ids], first)
        here[mine] = 0
        ball = linked(inter, sizes[p], sizes, rule)
        owned[ball] = True
        for x in np.flatnonzero(ball).tolist():
            groups.join(p, x)
        bounds.append((p, np.flatnonzero(near(inter, sizes[p], sizes, rule) & ~ball)))

    for p in range(n):
        if not owned[p]:
            own(p)
    done = 0
    while done < len(bounds):  # grows while boundary points become pivots
        p, edge = bounds[done]
        done += 1
        for x in edge.tolist():
            if not pivot[x] and groups.find(x) != groups.find(p):
                own(x)
    return [groups.find(x) for x in range(n)]


def points(docs: DataFrame, id_col: str, text_col: str, rule: Rule = RULE) -> DataFrame:
    """(id, n, h1, h2, regions) of each document."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = shells(1 << 10, rule)
        for whole in batches:
            for b in W.pieces(whole, "_text"):
                sets = shingle_sets(W.column(b, "_text"), rule.shingle)
                if (most := max(map(len, sets), default=0)) >= least[-1]:
                    least = shells(2 * most, rule)
                hashes = [set_hash(x) for x in sets]
                keys = [projections(x, least, rule) if rule.link >= PARTS_LINK else single_shingles(x, rule) for x in sets]
                ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([h[0] for h in hashes], pa.int64()),
                     pa.array([h[1] for h in hashes], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*keys, np.zeros(0, np.int64)]), pa.int64()))],
                    ["id", "n", "h1", "h2", "regions"])

    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"))
            .mapInArrow(run, f"id {kind}, n bigint, h1 bigint, h2 bigint, regions array<bigint>"))


def with_set(docs: DataFrame, text_col: str, name: str, rule: Rule = RULE) -> DataFrame:
    """``docs`` with the column ``name``: the size and hash of the shingle set."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in W.pieces(whole, text_col):
                sets = shingle_sets(W.column(b, text_col), rule.shingle)
                keys = [f"{len(x)}:{'%016x%016x' % tuple(h % (1 << 64) for h in set_hash(x))}" for x in sets]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.string())], [*b.schema.names, name])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields), f"`{name}` string"])
    return docs.mapInArrow(run, schema)


def join_small(rows: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(point, component) of regions that fit a task; ``rows`` is (region,
    point, text)."""
    kind = rows.schema["point"].dataType.simpleString()
    dealt = rows.repartition("region").sortWithinPartitions("region", "point")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets = None, [], []

        def flush():
            group = join_region(sets, rule)
            return pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("point").type),
                                               pa.array([ids[g] for g in group], batch.schema.field("point").type)], ["point", "component"])

        for whole in batches:
            for batch in W.pieces(whole, "text"):
                new = shingle_sets(W.column(batch, "text"), rule.shingle)
                for region, point, x in zip(W.column(batch, "region").to_pylist(), W.column(batch, "point").to_pylist(), new):
                    if ids and region != now:
                        yield flush()
                        ids, sets = [], []
                    now = region
                    ids.append(point)
                    sets.append(x)
        if ids:
            yield flush()

    return dealt.mapInArrow(run, f"point {kind}, component {kind}")


class Wave:
    """The pivots of a wave, by region: their shingles, and which have each."""

    def __init__(self, pivots: list[tuple[object, object, str]], rule: Rule = RULE):
        self.by_region: dict[object, tuple] = {}
        self.rule = rule
        sets = shingle_sets(pa.array([t for _, _, t in pivots], pa.string()), rule.shingle)
        for region in {r for r, _, _ in pivots}:
            mine = [(p, s) for (r, p, _), s in zip(pivots, sets) if r == region]
            values, inverse = np.unique(np.concatenate([s for _, s in mine]), return_inverse=True)
            has = np.zeros((len(values), len(mine)), np.uint8)
            has[inverse, np.repeat(np.arange(len(mine)), [len(s) for _, s in mine])] = 1
            self.by_region[region] = ([p for p, _ in mine], np.array([len(s) for _, s in mine]), values, has)

    def against(self, region, x: np.ndarray) -> tuple[list, list]:
        """Pivots linked to a set, and those within 2r of it besides."""
        pivots, sizes, values, has = self.by_region[region]
        i = np.minimum(np.searchsorted(values, x), len(values) - 1)
        inter = has[i[values[i] == x]].sum(axis=0, dtype=np.int64)
        link = linked(inter, len(x), sizes, self.rule)
        edge = near(inter, len(x), sizes, self.rule) & ~link
        return [pivots[k] for k in np.flatnonzero(link)], [pivots[k] for k in np.flatnonzero(edge)]


def join_large(rows: DataFrame, rule: Rule = RULE) -> DataFrame:
    """Ties (a, b) that connect the components of regions beyond one task's
    size; ``rows`` is (region, point, n, text)."""
    spark = rows.sparkSession
    kind, region_kind = (rows.schema[c].dataType.simpleString() for c in ("point", "region"))
    rows = written(rows, "large-regions")
    state = written(rows.select("region", "point", "n", F.lit(True).alias("wanted")), "wave-state")
    ties, edges, wave = None, None, 0
    while True:
        left = (state.where("wanted").groupBy("region").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.min("point").alias("one"))
                .orderBy(F.desc("k"), "region").limit(WAVE_REGIONS).collect())  # a bounded number of regions at a time
        if left:
            wave += 1
            share = F.lit(None).cast("double")
            for r in left:
                most = min(WAVE_PIVOTS, max(1, int((WAVE_CELLS / len(left) / max(r.n / r.k, 1)) ** 0.5)))
                share = F.when(F.col("region") == r.region, most / r.k).otherwise(share)
            drawn = state.where("wanted").where(share.isNotNull()).where(
                (unit_hash("point", 100 + wave) < share) | F.col("point").isin([r.one for r in left]))
            drawn = drawn.join(rows.select("point", "text"), "point").select("region", "point", "text", "n")
            pivots, cells = [], 0
            for r in drawn.orderBy(F.xxhash64(F.lit(wave), "point")).limit(WAVE_PIVOTS * WAVE_REGIONS).toLocalIterator():
                if pivots and (cells + r.n) * (len(pivots) + 1) > 4 * WAVE_CELLS:
                    break  # the rest wait for the next wave
                pivots.append((r.region, r.point, r.text))
                cells += r.n
            shared = spark.sparkContext.broadcast(Wave(pivots, rule))
            regions = sorted({r for r, _, _ in pivots})

            def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                for whole in batches:
                    for b in W.pieces(whole, "text"):
                        sets = shingle_sets(W.column(b, "text"), rule.shingle)
                        got = [shared.value.against(r, x) for r, x in zip(W.column(b, "region").to_pylist(), sets)]
                        t = b.schema.field("point").type
                        yield pa.RecordBatch.from_arrays(
                            [W.column(b, "region"), W.column(b, "point"), pa.array([g[0] for g in got], pa.list_(t)),
                             pa.array([g[1] for g in got], pa.list_(t))], ["region", "point", "link", "edge"])

            held = written(rows.where(F.col("region").isin(regions)).select("region", "point", "text")
                           .mapInArrow(run, f"region {region_kind}, point {kind}, link array<{kind}>, edge array<{kind}>"), "wave")
            # pivots that share a point are one group: the point is tied to the first, the others to that
            new = held.select(F.col("point").alias("a"), F.explode("link").alias("b")).where("a != b")
            ties = new if ties is None else ties.union(new)
            far = held.where(F.size("edge") > 0).select("region", "point", "edge")
            edges = far if edges is None else edges.union(far)
            owned = held.where(F.size("link") > 0).select("region", "point", F.lit(True).alias("owned"))
            state = written(state.join(owned, ["region", "point"], "left")
                            .select("region", "point", "n", (F.col("wanted") & F.col("owned").isNull()).alias("wanted")), "wave-state")
            continue
        # all points are owned: boundary points of unconnected balls become pivots
        ties, edges = written(ties, "wave-ties"), written(edges, "wave-edges")
        part = components(ties)
        pair = edges.select("region", "point", F.explode("edge").alias("pivot"))
        a, b = part.select(F.col("node").alias("point"), F.col("component").alias("_a")), part.select(F.col("node").alias("pivot"), F.col("component").alias("_b"))
        pair = (pair.join(a, "point", "left").join(b, "pivot", "left")
                .where(F.coalesce("_a", "point") != F.coalesce("_b", "pivot")).select("region", "point").distinct())
        pivots_so_far = ties.select(F.col("b").alias("point")).union(
            edges.select(F.explode("edge").alias("point"))).distinct()
        todo = written(pair.join(pivots_so_far, "point", "left_anti").select("region", "point", F.lit(True).alias("again")), "wave-todo")
        if todo.isEmpty():
            return ties
        state = written(state.join(todo, ["region", "point"], "left")
                        .select("region", "point", "n", F.coalesce("again", F.lit(False)).alias("wanted")), "wave-state")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    region_shingles: int = REGION_SHINGLES, rule: Rule = RULE) -> DataFrame:
    """(id, n_shingles, component_id) of each document, linked by ``rule``."""
    bound_batches(docs.sparkSession)
    table = written(points(docs, id_col, text_col, rule).withColumn("uid", F.monotonically_increasing_id()), "points")
    same = ["h1", "h2", "n"]
    # a set's point is its least id; one of its rows, named by uid, gives its regions
    one = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "uid")))
    point = (table.where("n > 0").groupBy(*same).agg(one.alias("one")).where("one is not null")
             .select(F.col("one.id").alias("point"), F.col("one.uid").alias("uid"), *same))
    point = written(point, "copies")
    # regions of level 3, each tied to its least point
    keys = table.where("size(regions) > 0").join(point.select("uid", "point"), "uid")
    if rule.link >= PARTS_LINK:
        keys = keys.select("point", F.explode("regions").alias("key"))
    else:
        keys = rare_keys(keys.select("uid", F.explode("regions").alias("key")), point.select("uid", "point", "n"), rule)
    keys = written(keys, "keys")
    shared = keys.groupBy("key").agg(F.min("point").alias("least"), F.max("point").alias("most")).where("least != most").select("key", "least")
    shared = written(shared, "shared-keys")
    if shared.count() <= BROADCAST_KEYS:
        shared = F.broadcast(shared)
    ties = keys.join(shared, "key").where("point != least").select(F.col("point").alias("a"), F.col("least").alias("b")).distinct()
    region = written(components(ties).select(F.col("node").alias("point"), F.col("component").alias("region")), "regions")
    size = region.join(point.groupBy("point").agg(F.sum("n").alias("n")), "point").select("region", "point", "n")
    total = size.groupBy("region").agg(F.sum("n").alias("total"))
    size = written(size.join(total, "region"), "region-sizes")
    text = docs.select(F.col(id_col).alias("point"), F.col(text_col).alias("text")).where("point is not null")
    # an id that repeats with different texts: each text is a point only as its set's least id
    rows = size.join(text, "point")
    small = join_small(rows.where(F.col("total") <= region_shingles).select("region", "point", "text"), rule)
    found = written(small, "small-regions")
    big = size.where(F.col("total") > region_shingles)
    if not big.isEmpty():
        ties = join_large(rows.where(F.col("total") > region_shingles).select("region", "point", "n", "text"), rule)
        found = found.union(components(ties).select(F.col("node").alias("point"), "component"))
    found = found.groupBy("point").agg(F.min("component").alias("component")).where("point != component")
    owner = point.drop("uid").join(found, "point", "left").select(
        *(F.col(c).alias(f"_{c}") for c in same), F.coalesce("component", "point").alias("_component"))
    joined = table.join(owner, [F.col(c) == F.col(f"_{c}") for c in same], "left")
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.coalesce("_component", "id").alias("component_id"))
