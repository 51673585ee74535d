"""Pairs within groups and connected components, without all pairs of a group in one task.

``units`` cuts each group of nodes that share a value into blocks of about ``block`` nodes and makes one unit of
work for each pair of blocks, so a task holds two blocks at most, however large a group is. ``by_unit`` hands the
rows of one unit after another to a function. ``components`` labels nodes with the smallest node they reach.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.llm.common import stored

UNIT = ["value", "bi", "bj"]


def units(postings: DataFrame, block: int) -> DataFrame:
    """(value, bi, bj, own, node) of (value, node) rows: the units that each node takes part in, ``own`` its block."""
    sizes = postings.groupBy("value").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = postings.join(sizes, "value").withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.select("value", "own", "node", other.alias("other"))
    return rows.select("value", F.least("own", "other").alias("bi"), F.greatest("own", "other").alias("bj"), "own", "node")


def by_unit(rows: DataFrame, f: Callable[[dict, list], Iterator[pa.RecordBatch] | list], schema: str) -> DataFrame:
    """Applies ``f(unit, columns)`` to the rows of each unit; columns hold the rest of each row as lists."""
    names = [c for c in rows.columns if c not in UNIT]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held = None, []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = list(zip(*(table.column(c).to_pylist() for c in UNIT), strict=True))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            own = table.select(names)
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if lo == hi:
                    continue
                if keys[lo] != unit:
                    if held:
                        yield from f(unit, pa.concat_tables(held))
                    unit, held = keys[lo], []
                held.append(own.slice(lo, hi - lo))
        if held:
            yield from f(unit, pa.concat_tables(held))

    return rows.select(*UNIT, *names).repartition(*UNIT).sortWithinPartitions(*UNIT, "node").mapInArrow(apply, schema)


def unit_starts(rows: pa.Table) -> np.ndarray:
    """Where each unit of sorted rows starts."""
    new = np.ones(rows.num_rows, bool)
    if rows.num_rows:
        new[1:] = np.logical_or.reduce([np.diff(rows.column(c).to_numpy()) != 0 for c in UNIT])
    return np.flatnonzero(new)


def whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole units from sorted rows: the last unit of a batch waits for the next."""
    held: list[pa.Table] = []
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if held and all(held[-1].column(c)[-1].as_py() == table.column(c)[-1].as_py() for c in UNIT):
            held.append(table)  # one unit goes on through the whole batch
            continue
        rows = pa.concat_tables([*held, table])
        last = int(unit_starts(rows)[-1])
        if last:
            yield rows.slice(0, last)
        held = [rows.slice(last)]
    if held:
        yield pa.concat_tables(held)


#: Values that are compared at once.
SLICE = 1_000_000


def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int = 2048) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with the sets ``right`` (row numbers of sorted sets).

    The range of values is cut into slices of about SLICE values; each adds the products of incidence matrices over
    the values that two sets or more hold, ``columns`` at a time, so memory grows with neither.
    """
    out = np.zeros((len(left), len(right)), np.float32)
    slices = -(-sum(map(len, sets)) // SLICE)
    if slices <= 1:
        _add_common(out, sets, left, right, columns)
    else:
        top = max(int(s[-1]) for s in sets if len(s)) + 1
        bounds = np.array([top * k // slices for k in range(slices + 1)], np.uint64)
        cuts = [np.searchsorted(s, bounds) for s in sets]
        for k in range(slices):
            _add_common(out, [s[c[k] : c[k + 1]] for s, c in zip(sets, cuts, strict=True)], left, right, columns)
    return out.astype(np.int64)


def _add_common(out: np.ndarray, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, columns: int) -> None:
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    if not len(flat):
        return
    owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    group = np.cumsum(np.concatenate([[True], flat[1:] != flat[:-1]])) - 1
    shared = np.bincount(group)[group] > 1
    owner, group = owner[shared], group[shared]
    if not len(owner):
        return
    group = np.cumsum(np.concatenate([[0], (np.diff(group) != 0).astype(np.int64)]))
    for lo in range(0, int(group[-1]) + 1, columns):
        a, b = np.searchsorted(group, [lo, lo + columns])
        m = np.zeros((len(sets), min(columns, int(group[-1]) + 1 - lo)), np.float32)
        m[owner[a:b], group[a:b] - lo] = 1
        out += m[left] @ m[right].T


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """(root, member) of the nodes 0..n-1 that the links a-b join, one row for each member that is no root."""
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            up[max(x, y)] = min(x, y)
    return [(root(x), x) for x in range(n) if root(x) != x]


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of (a, b) rows reaches, by alternating stars; nodes that are their own label are left out.

    Each round joins every node's neighbours to the smallest of them; a hub's rows are spread by the join, not
    gathered. Rounds go on until one changes nothing; their number grows with the logarithm of the nodes.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "links")
    sign = None
    while True:
        new = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(new) == sign:
            break
        sign = tuple(new)
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(
            least.where("a != m").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        now = stored(small, "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))
