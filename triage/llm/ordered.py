"""Sums and neighbours along a sorted table whose groups may be of any size.

A window function needs a whole group in one task. Here the rows are
range-sorted by group and order, so that a group of any size lies across
several partitions. Each task passes over its part once (running sums that
begin anew with each group; the next row of a group); a second pass corrects
what crosses the parts' edges, known from the first and last row of each part
(two rows for each partition reach the driver).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triage.llm.common import written


def _column(batch, name: str) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    return col.to_numpy(zero_copy_only=False)


def along(rows: DataFrame, group: list[str], order: list, sums: tuple[str, ...] = (), ahead: str | None = None) -> DataFrame:
    """``rows`` with ``up_<s>`` and ``before_<s>`` for each of ``sums`` (the
    running sum of the group in 64 bits that wrap around, with this row and
    without it), ``last`` (whether
    the row is the last of its group) and, for ``ahead``, ``next`` (that
    column of the group's next row, null at the last). ``group``, ``sums`` and
    ``ahead`` are bigint columns without nulls; ``order`` are columns or
    expressions that order the rows of a group."""
    keys = [*(F.col(g) for g in group), *order]
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    made = [*(f"up_{s}" for s in sums), "last", *(["next"] if ahead else [])]
    kinds = [*(f"`up_{s}` bigint" for s in sums), "`last` boolean", *(["`next` bigint"] if ahead else [])]
    without = [f"before_{s}" for s in sums]

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, state, begun = TaskContext.get().partitionId(), None, dict.fromkeys(sums, 0), False
        previous = None  # the group that ``state`` is of

        def done(t: pa.Table, n: int) -> pa.RecordBatch:
            """The first ``n`` rows of ``t``; a further one is looked at only."""
            nonlocal state, previous, begun
            g = np.stack([_column(t, c) for c in group], axis=1)
            new = np.ones(t.num_rows, bool)
            new[1:] = (g[1:] != g[:-1]).any(axis=1)
            if previous is not None:
                new[0] = tuple(g[0].tolist()) != previous
            at = np.arange(t.num_rows)
            start = np.maximum.accumulate(np.where(new, at, -1))  # -1: the group began in an earlier batch
            cols = [c.slice(0, n) for c in t.columns]
            for s in sums:
                total = np.cumsum(_column(t, s).view(np.uint64), dtype=np.uint64)
                before = np.concatenate([np.zeros(1, np.uint64), total])
                with np.errstate(over="ignore"):
                    up = total - np.where(start >= 0, before[start], np.uint64(-state[s] % (1 << 64)))
                cols.append(pa.array(up[:n].view(np.int64)))
                state[s] = int(up[n - 1])
            previous = tuple(g[n - 1].tolist())
            ends = np.ones(n, bool)
            ends[:t.num_rows - 1] = new[1:][:n]
            cols.append(pa.array(ends))
            if ahead:
                nxt = np.zeros(n, np.int64)
                nxt[:t.num_rows - 1] = _column(t, ahead)[1:][:n]
                cols.append(pa.array(nxt, mask=ends))
            head, tail = np.zeros(n, bool), np.zeros(n, bool)
            head[0], begun = not begun, True
            tail[-1] = t.num_rows == n
            cols += [pa.array(np.full(n, part)), pa.array(head), pa.array(tail)]
            return pa.Table.from_arrays(cols, [*t.column_names, *made, "_part", "_head", "_tail"]).combine_chunks().to_batches()[0]

        for b in batches:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            if t.num_rows > 1:
                yield done(t, t.num_rows - 1)
            held = t.slice(t.num_rows - 1)
        if held is not None:
            yield done(held, 1)

    local = written(sorted_rows.mapInArrow(first_pass, ", ".join([*fields, *kinds, "_part bigint", "_head boolean", "_tail boolean"])), "along")
    edges = local.where("_head or _tail").select("_part", "_head", "_tail", *group, *([ahead] if ahead else []), *(f"up_{s}" for s in sums)).collect()
    heads, tails = {r._part: r for r in edges if r._head}, {r._part: r for r in edges if r._tail}
    of = lambda r: tuple(r[c] for c in group)
    fixes: dict[int, tuple] = {}  # part: (the first group, what it has before this part, the last group's next row or None)
    parts, before = sorted(heads), None
    for i, p in enumerate(parts):
        g = of(heads[p])
        carry = before[1] if before and before[0] == g else dict.fromkeys(sums, 0)
        follows = heads[parts[i + 1]] if i + 1 < len(parts) and of(heads[parts[i + 1]]) == of(tails[p]) else None
        fixes[p] = (g, carry, None if follows is None else (follows[ahead] if ahead else 0))
        alone = of(tails[p]) == g
        before = (of(tails[p]), {s: tails[p][f"up_{s}"] + (carry[s] if alone else 0) for s in sums})
    shared = rows.sparkSession.sparkContext.broadcast(fixes)

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            part, tail = _column(b, "_part"), _column(b, "_tail")
            g = np.stack([_column(b, c) for c in group], axis=1)
            cols = {name: b.column(i) for i, name in enumerate(b.schema.names)}
            for p in np.unique(part).tolist():
                first, carry, nxt = shared.value[p]
                here = (part == p) & (g == np.array(first)).all(axis=1)
                for s in sums:
                    if carry[s]:
                        up = _column(pa.RecordBatch.from_arrays([cols[f"up_{s}"]], ["x"]), "x").view(np.uint64).copy()
                        with np.errstate(over="ignore"):
                            up[here] += np.uint64(carry[s] % (1 << 64))
                        cols[f"up_{s}"] = pa.array(up.view(np.int64))
                if nxt is not None:
                    edge = (part == p) & tail
                    cols["last"] = pa.array(_column(pa.RecordBatch.from_arrays([cols["last"]], ["x"]), "x").astype(bool) & ~edge)
                    if ahead:
                        cols["next"] = pc.if_else(pa.array(edge), pa.scalar(nxt, pa.int64()), cols["next"])
            for s in sums:
                up, own = (_column(pa.RecordBatch.from_arrays([cols[c]], ["x"]), "x").view(np.uint64) for c in (f"up_{s}", s))
                with np.errstate(over="ignore"):
                    cols[f"before_{s}"] = pa.array((up - own).view(np.int64))
            names = [c for c in (*b.schema.names, *without) if c not in ("_part", "_head", "_tail")]
            yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

    return local.mapInArrow(second_pass, ", ".join([*fields, *kinds, *(f"`{c}` bigint" for c in without)]))
