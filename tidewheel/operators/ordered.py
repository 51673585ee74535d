"""Ordered operators: runs, as-of joins, moving filters, gaps. Every one takes its keys and an explicit order column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, keys: list[str], order: str, hit: Column) -> DataFrame:
    """(keys, first, last, n): maximal runs of consecutive rows where ``hit`` holds; ``last`` is inclusive."""
    w = Window.partitionBy(*keys).orderBy(order)
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False))).withColumn("_n", F.row_number().over(w))
    only = marked.where("_hit").withColumn("_isle", F.col("_n") - F.row_number().over(w))
    return only.groupBy(*keys, "_isle").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).drop("_isle")


def scan_edges(df: DataFrame, keys: list[str], order: str, hit: Column, lead_in: int = 1000, lead_out: int = 100, least: int = 100) -> DataFrame:
    """(keys, start, end): the last index of each block of hits to that of the next, trimmed at both sides; short scans go."""
    w = Window.partitionBy(*keys).orderBy(order)
    idx = df.where(F.coalesce(hit, F.lit(False))).withColumn("_next", F.lead(order).over(w)).withColumn("_prev", F.lag(order).over(w))
    edges = idx.where((F.col("_next") - F.col(order) > 1) | F.col("_next").isNull() | F.col("_prev").isNull()).select(*keys, F.col(order).alias("_at"))
    out = edges.withColumn("_to", F.lead("_at").over(Window.partitionBy(*keys).orderBy("_at"))).where("_to is not null")
    return out.select(*keys, (F.col("_at") + lead_in).alias("start"), (F.col("_to") - lead_out).alias("end")).where(F.col("end") - F.col("start") >= least)


def first_difference_groups(df: DataFrame, keys: list[str], order: str, gap: Column | float) -> DataFrame:
    """Adds ``grp``: a new one starts where the step from the row before exceeds ``gap``; counted from 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.col(order) - F.lag(order).over(w)
    return df.withColumn("_new", F.when(step > gap, 1).otherwise(0)).withColumn("grp", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def circular_groups(df: DataFrame, value: str, half: float, period: float = 24.0) -> DataFrame:
    """Groups on a circle: sorted, cut where the gap exceeds 2 * half, the last joined to the first across the wrap.

    Rows are first put in cells of ``half``, inside which no gap can be that wide; only the cells' ends are sorted in one task.
    """
    rows = df.withColumn("_cell", F.floor(F.col(value) / half) if half > 0 else F.col(value))
    ends = rows.groupBy("_cell").agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    w, every = Window.partitionBy(F.lit(0)).orderBy("_lo"), Window.partitionBy(F.lit(0))
    ends = ends.withColumn("_new", F.when(F.col("_lo") - F.lag("_hi").over(w) > 2 * half, 1).otherwise(0))
    ends = ends.withColumn("_grp", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    wrap = F.min("_lo").over(every) + period - F.max("_hi").over(every) <= 2 * half
    grp = F.when(wrap & (F.col("_grp") == F.max("_grp").over(every)), 0).otherwise(F.col("_grp")).cast("bigint")
    ends = ends.select(F.col("_cell").alias("_at"), grp.alias("grp"))
    return rows.join(F.broadcast(ends), F.col("_cell").eqNullSafe(F.col("_at"))).drop("_cell", "_at")


def neighbours(left: DataFrame, right: DataFrame, keys: list[str], lt: str, rt: str, value: str, before: bool = True, after: bool = True) -> DataFrame:
    """``left`` with the rows of ``right`` at or before ``lt`` (_t0, _v0) and at or after it (_t1, _v1), null where there are none.

    Both sides are unioned and dealt out by key once; no pair is formed. Each direction is one sort and a running
    last value: the later neighbours run through the rows backwards, as a frame that reaches to the end would be
    evaluated anew for every row.
    """
    cols = left.columns
    hit = F.struct(F.col(rt).alias("t"), F.col(value).alias("v"))
    kind = right.select(hit.alias("h")).schema["h"].dataType
    a = left.select(*cols, F.col(lt).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_hit"))
    b = right.select(*[F.col(c) if c in keys else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in cols], F.col(rt).alias("_at"), F.lit(0).alias("_side"), hit.alias("_hit"))
    rows = a.unionByName(b)
    for wanted, n, order in ((before, 0, F.asc("_at")), (after, 1, F.desc("_at"))):
        if wanted:
            w = Window.partitionBy(*keys).orderBy(order, "_side").rowsBetween(Window.unboundedPreceding, 0)
            rows = rows.withColumn(f"_h{n}", F.last("_hit", ignorenulls=True).over(w))
    found = [F.col(f"_h{n}.{c}").alias(f"_{c}{n}") for n, wanted in ((0, before), (1, after)) if wanted for c in "tv"]
    return rows.where("_side = 1").select(*cols, *found)


def asof(left: DataFrame, right: DataFrame, keys: list[str], lt: str, rt: str, value: str, forward: bool = False) -> DataFrame:
    """``left`` with the row of ``right`` at or before ``lt`` (or at or after it): columns ``_t`` and ``value``, null where there is none."""
    n = 1 if forward else 0
    rows = neighbours(left, right, keys, lt, rt, value, not forward, forward)
    return rows.withColumnsRenamed({f"_t{n}": "_t", f"_v{n}": value})


def nearest(left: DataFrame, right: DataFrame, keys: list[str], lt: str, rt: str, value: str) -> DataFrame:
    """The nearer of the rows before and after, the earlier one on a tie; null outside the range of ``right``."""
    both = neighbours(left, right, keys, lt, rt, value)
    inside = F.col("_t0").isNotNull() & F.col("_t1").isNotNull()
    pick = F.when(F.col(lt) - F.col("_t0") <= F.col("_t1") - F.col(lt), F.col("_v0")).otherwise(F.col("_v1"))
    return both.select(*left.columns, F.when(inside, pick).alias(value))


def interpolate(left: DataFrame, right: DataFrame, keys: list[str], lt: str, rt: str, value: str) -> DataFrame:
    """Linear in time between the rows before and after, clamped at the ends."""
    both = neighbours(left, right, keys, lt, rt, value)
    t0, v0, t1, v1 = (F.col(c) for c in ("_t0", "_v0", "_t1", "_v1"))
    line = F.when(t1 > t0, v0 + (v1 - v0) * (F.col(lt) - t0) / (t1 - t0)).otherwise(v0)
    return both.select(*left.columns, F.coalesce(line, v0, v1).alias(value))


def moving_mean(df: DataFrame, keys: list[str], order: str, value: str, window: int, out: str) -> DataFrame:
    """Centred mean over offsets -window/2 .. window/2 - 1, edge windows shortened."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(window // 2), window // 2 - 1)
    return df.withColumn(out, F.avg(value).over(w))


def moving_median(df: DataFrame, keys: list[str], order: str, value: str, size: int, out: str) -> DataFrame:
    """Exact median of ``size`` rows around each, edge windows shortened."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(size // 2), size // 2 + size % 2 - 1)
    return df.withColumn(out, F.percentile(value, F.lit(0.5)).over(w))


def dilate(df: DataFrame, keys: list[str], order: str, flag: str, reach: int, out: str) -> DataFrame:
    """True within ``reach`` rows of a true flag."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-reach, reach)
    return df.withColumn(out, F.max(F.col(flag).cast("int")).over(w) == 1)


def fill_gaps(df: DataFrame, keys: list[str], order: str, value: str, good: Column, out: str) -> DataFrame:
    """Values of rows that aren't good, linear in row number between the nearest good ones, clamped at the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    back = Window.partitionBy(*keys).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)  # later values, run through backwards
    rows = df.withColumn("_n", F.row_number().over(w)).withColumn("_ok", F.when(F.coalesce(good, F.lit(False)), F.struct("_n", F.col(value).alias("v"))))
    rows = rows.withColumn("_a", F.last("_ok", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_b", F.last("_ok", ignorenulls=True).over(back))
    line = F.when(F.col("_b._n") > F.col("_a._n"), F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * (F.col("_n") - F.col("_a._n")) / (F.col("_b._n") - F.col("_a._n"))).otherwise(F.col("_a.v"))
    return rows.withColumn(out, F.coalesce(line, F.col("_a.v"), F.col("_b.v"))).drop("_n", "_ok", "_a", "_b")


def pair_noise(df: DataFrame, keys: list[str], order: str, value: str, out: str = "auto_rms") -> DataFrame:
    """Standard deviation of the differences of disjoint neighbours over sqrt 2; an odd last row and pairs with a null go."""
    rows = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(order)) - 1)
    pairs = rows.groupBy(*keys, F.floor(F.col("_n") / 2).alias("_p")).agg((F.max(F.when(F.col("_n") % 2 == 1, F.col(value))) - F.max(F.when(F.col("_n") % 2 == 0, F.col(value)))).alias("_d"))
    return pairs.groupBy(*keys).agg((F.stddev_pop("_d") / F.sqrt(F.lit(2.0))).alias(out))


def offset_chunks(df: DataFrame, keys: list[str], order: str, length: int) -> DataFrame:
    """Adds ``chunk``: whole chunks of ``length`` rows; what is left over at the end goes."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("_n", F.row_number().over(w.orderBy(order)) - 1).withColumn("_all", F.count(F.lit(1)).over(w))
    return rows.where(F.col("_n") < F.floor(F.col("_all") / length) * length).withColumn("chunk", F.floor(F.col("_n") / length)).drop("_n", "_all")


def less_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Value less its group's median: an aggregate joined back, so that no group is gathered in a window."""
    mid = df.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("_mid"))
    return df.join(mid, keys).withColumn(out, F.col(value) - F.col("_mid")).drop("_mid")


def curvature(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Second difference; one-sided at the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    v = F.col(value)
    return df.withColumn(out, F.coalesce(F.lag(value).over(w), v) - 2 * v + F.coalesce(F.lead(value).over(w), v))


def gradient(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """Central difference, one-sided at the ends."""
    w = Window.partitionBy(*keys).orderBy(order)
    before, after, v = F.lag(value).over(w), F.lead(value).over(w), F.col(value)
    return df.withColumn(out, F.when(before.isNull(), after - v).when(after.isNull(), v - before).otherwise((after - before) / 2))


def fold(df: DataFrame, keys: list[str], order: str, value: str, period: int) -> DataFrame:
    """Mean and standard error at each phase over whole folds."""
    w = Window.partitionBy(*keys)
    rows = df.withColumn("_n", F.row_number().over(w.orderBy(order)) - 1).withColumn("_folds", F.floor(F.count(F.lit(1)).over(w) / period))
    rows = rows.where((F.col("_n") < F.col("_folds") * period) & (F.col("_folds") >= 2))
    return rows.groupBy(*keys, (F.col("_n") % period).cast("bigint").alias("phase")).agg(F.avg(value).alias("mean"), (F.stddev_pop(value) / F.sqrt(F.count(F.lit(1)))).alias("error"))


def best_fold(df: DataFrame, keys: list[str], order: str, value: str, first: int, last: int) -> DataFrame:
    """(keys, period, spread): the period from ``first`` to ``last`` rows whose mean profile over whole folds has the largest range; of equal ones the shortest.

    A group's rows are numbered once; the means by period and phase are partial sums where the rows lie.
    """
    w = Window.partitionBy(*keys)
    rows = df.select(*keys, order, value).withColumn("_n", F.row_number().over(w.orderBy(order)) - 1).withColumn("_all", F.count(F.lit(1)).over(w))
    rows = rows.withColumn("_p", F.explode(F.sequence(F.lit(first), F.lit(last)))).withColumn("_folds", F.floor(F.col("_all") / F.col("_p")))
    rows = rows.where((F.col("_n") < F.col("_folds") * F.col("_p")) & (F.col("_folds") >= 2))
    profile = rows.groupBy(*keys, "_p", (F.col("_n") % F.col("_p")).alias("_phase")).agg(F.avg(value).alias("_m"))
    spread = profile.groupBy(*keys, "_p").agg(F.round(F.max("_m") - F.min("_m"), 9).alias("_s"))
    best = spread.groupBy(*keys).agg(F.min(F.struct((-F.col("_s")).alias("s"), F.col("_p").alias("p"))).alias("_b"))
    return best.select(*keys, F.col("_b.p").cast("bigint").alias("period"), (-F.col("_b.s")).alias("spread"))


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, lo: str, hi: str, width: float, how: str = "inner") -> DataFrame:
    """Points joined with the intervals [lo, hi) of their key that hold them; ``how`` is inner, left, left_semi or left_anti.

    Intervals may have any length and overlap. Each is put into the cells of ``width`` that it touches, a point into
    its own, and the join is an equi-join on key and cell with the bounds checked after it; so choose a width near
    the usual length. Intervals with a null bound, or that end where they start or before, hold nothing.
    """
    cell = lambda c: F.floor(F.col(c) / width).cast("bigint")
    own = intervals.where(F.col(hi) > F.col(lo)).withColumn("_cell", F.explode(F.sequence(cell(lo), cell(hi))))
    own = own.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    left = points.withColumn("_at", cell(at))
    on = (F.col("_at") == F.col("_cell")) & (F.col(at) >= F.col(lo)) & (F.col(at) < F.col(hi))
    for s in same:
        on = on & s
    return left.join(own, on, how).drop("_at", "_cell", *(f"_key_{k}" for k in keys))


def reflected_median(df: DataFrame, keys: list[str], order: str, value: str, size: int, out: str) -> DataFrame:
    """Exact median of ``size`` (odd) rows around each; beyond a group's ends its rows are mirrored, the end row repeated.

    The mirrored rows are copies of a group's first and last size / 2 rows; a group shorter than that has windows cut.
    """
    w, half = Window.partitionBy(*keys), size // 2
    rows = df.withColumn("_n", F.row_number().over(w.orderBy(order))).withColumn("_all", F.count(F.lit(1)).over(w))
    places = F.array_compact(F.array(F.col("_n"), F.when(F.col("_n") <= half, 1 - F.col("_n")), F.when(F.col("_n") > F.col("_all") - half, 2 * F.col("_all") + 1 - F.col("_n"))))
    rows = rows.withColumn("_at", F.explode(places))
    rows = rows.withColumn(out, F.percentile(value, F.lit(0.5)).over(w.orderBy("_at").rangeBetween(-half, half)))
    return rows.where("_at = _n").drop("_n", "_all", "_at")
