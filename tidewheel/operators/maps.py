"""Map-making: weighted binning, masks, and the destriper's normal equations and solver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.values import map_mask
from tidewheel.sources.scratch import kept


def binned(df: DataFrame, keys: list[str], value: Column, weight: Column) -> DataFrame:
    """(keys, total, weight, hits): weighted sum, weight sum and count; rows with a null pixel go."""
    rows = df.where(F.col(keys[-1]).isNotNull())
    return rows.groupBy(*keys).agg(F.sum(value * weight).alias("total"), F.sum(weight).alias("weight"), F.count(F.lit(1)).alias("hits"))


def compressed(samples: DataFrame, offset: str, pix: str, value: Column, weight: Column) -> DataFrame:
    """(offset, pix, w, wd): all that the destriper needs of the samples; one pass and one partial aggregate over them."""
    rows = samples.where(F.col(pix).isNotNull())
    return rows.groupBy(F.col(offset).alias("offset"), F.col(pix).alias("pix")).agg(F.sum(weight).alias("w"), F.sum(weight * value).alias("wd"))


def sky(cells: DataFrame, amount: str) -> DataFrame:
    """(pix, sky): weighted mean of ``amount`` (already weighted) over the cells of each pixel."""
    return cells.groupBy("pix").agg(F.sum(amount).alias("_a"), F.sum("w").alias("_w")).where("_w > 0").select("pix", (F.col("_a") / F.col("_w")).alias("sky"))


def right_side(cells: DataFrame) -> DataFrame:
    """(offset, b): the offsets' sums of weight times (data less sky)."""
    m = sky(cells, "wd")
    return cells.join(m, "pix").groupBy("offset").agg(F.sum(F.col("wd") - F.col("w") * F.col("sky")).alias("b"))


def stencil(offsets: DataFrame, value: str, out: str) -> DataFrame:
    """(offset, out): the sum of the neighbours' differences from an offset's own value, one-sided at the ends. Values are sent to their neighbours; nothing is sorted."""
    rows = offsets.select("offset", F.col(value).alias("_own"), F.lit(None).cast("double").alias("_next"))
    for step in (-1, 1):
        rows = rows.unionByName(offsets.select((F.col("offset") + step).alias("offset"), F.lit(None).cast("double").alias("_own"), F.col(value).alias("_next")))
    sums = rows.groupBy("offset").agg(F.max("_own").alias("_own"), F.sum("_next").alias("_sum"), F.count("_next").alias("_n")).where("_own is not null")
    return sums.select("offset", (F.coalesce("_sum", F.lit(0.0)) - F.col("_n") * F.col("_own")).alias(out))


def applied(cells: DataFrame, offsets: DataFrame, ridge: float = 0.0, gradient: float = 0.0, curvature: float = 0.0) -> DataFrame:
    """(offset, a): the destriper's matrix times (offset, v), with the regularisers' terms: ridge v + gradient L v + curvature L L v, L the ``stencil``."""
    rows = cells.join(offsets, "offset").withColumn("_wv", F.col("w") * F.col("v"))
    m = sky(rows, "_wv")
    out = rows.join(m, "pix").groupBy("offset").agg((F.sum(F.col("_wv") - F.col("w") * F.col("sky")) + ridge * F.first("v")).alias("a"))
    if gradient or curvature:
        first = stencil(offsets, "v", "_g")
        out = out.join(first, "offset")
        if curvature:
            out = out.join(stencil(first, "_g", "_c"), "offset")
        out = out.select("offset", (F.col("a") + gradient * F.col("_g") + (curvature * F.col("_c") if curvature else 0.0)).alias("a"))
    return out


def preconditioner(cells: DataFrame, ridge: float = 0.0) -> DataFrame:
    """(offset, m): inverse weight sums."""
    return cells.groupBy("offset").agg((1.0 / F.greatest(F.sum("w") + ridge, F.lit(1e-12))).alias("m"))


def destriped(cells: DataFrame, ridge_share: float = 1e-2, tolerance: float = 1e-6, most_rounds: int = 1000, gradient_share: float = 0.0, curvature_share: float = 0.0) -> tuple[DataFrame, list[float]]:
    """(offset, v): conjugate gradients with a diagonal preconditioner on the compressed cells, and the residuals of its rounds.

    The regularisers' factors are shares of the offsets' median weight. Each round's state is checkpointed to the
    folder that the cluster shares, so the lineage stays short and a lost executor costs one round. Only three sums a
    round reach the driver. A solution that is not below ``tolerance`` after ``most_rounds`` is an error, not a result.
    """
    cells = kept(cells.repartition("offset"))
    weights = cells.groupBy("offset").agg(F.sum("w").alias("w"))
    (middle,) = quantiles(weights, "w", [0.5])
    ridge, steep, bent = (share * (middle or 0.0) for share in (ridge_share, gradient_share, curvature_share))
    m = preconditioner(cells, ridge)
    b = right_side(cells)
    state = kept(b.join(m, "offset").select("offset", F.lit(0.0).alias("v"), F.col("b").alias("r"), (F.col("b") * F.col("m")).alias("p"), "m"))
    rz, norm = state.agg(F.sum(F.col("r") * F.col("r") * F.col("m")), F.sqrt(F.sum(F.col("r") * F.col("r")))).first()
    first = max(1.0, norm or 0.0)
    residuals = [(norm or 0.0) / first]
    while residuals[-1] >= tolerance and rz:
        if len(residuals) > most_rounds:
            raise RuntimeError(f"the destriper's residual is {residuals[-1]:.3g} after {most_rounds} rounds, not below {tolerance:.3g}")
        ap = applied(cells, state.select("offset", F.col("p").alias("v")), ridge, steep, bent)
        rows = kept(state.join(ap, "offset"))
        pap = rows.agg(F.sum(F.col("p") * F.col("a"))).first()[0]
        if not pap or pap <= 0:
            raise RuntimeError("the destriper's matrix is not positive: a regulariser outweighs the data")
        step = rz / pap
        left = F.col("r") - step * F.col("a")
        new, norm = rows.agg(F.sum(left * left * F.col("m")), F.sqrt(F.sum(left * left))).first()
        state = kept(rows.select("offset", (F.col("v") + step * F.col("p")).alias("v"), left.alias("r"), (left * F.col("m") + (new / rz) * F.col("p")).alias("p"), "m"))
        rz = new
        residuals.append(norm / first)
    return state.select("offset", "v"), residuals


def offset_map(cells: DataFrame, offsets: DataFrame) -> DataFrame:
    """(pix, offset_map): what the offsets put into the map."""
    rows = cells.join(offsets, "offset").withColumn("_wv", F.col("w") * F.col("v"))
    return sky(rows, "_wv").withColumnRenamed("sky", "offset_map")


def quantiles(df: DataFrame, column: str, shares: list[float], few: int = 1_000_000, bins: int = 4096) -> list[float | None]:
    """Exact linear quantiles of a column's non-null values over all rows; nulls where it has none.

    Up to ``few`` values are handled by one aggregate. Beyond, each rank is narrowed by counts in ``bins`` equal
    cells, a scan a round, until at most ``few`` values are left in its cell; only counts and those bounds move.
    """
    v = F.col(column)
    rows = df.select(v.cast("double").alias(column)).where(v.isNotNull())
    n, least, most = rows.agg(F.count(F.lit(1)), F.min(column), F.max(column)).first()
    if not n:
        return [None] * len(shares)
    if n <= few:
        return list(rows.agg(F.percentile(column, F.array(*map(F.lit, shares)))).first()[0])

    def ranked(k: int) -> float:
        """The k-th smallest value, from 0."""
        lo, hi, left = least, most, n
        while lo < hi and left > few:
            cell = F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1))
            counts = rows.where(v.between(lo, hi)).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi"))
            for r in sorted(counts.collect()):
                if k < r["n"]:
                    lo, hi, left = r["lo"], r["hi"], r["n"]
                    break
                k -= r["n"]
        if lo == hi:
            return lo
        return rows.where(v.between(lo, hi)).agg(F.sort_array(F.collect_list(column))[k]).first()[0]

    out = []
    for share in shares:
        at = share * (n - 1)
        a = ranked(int(at))
        b = ranked(int(at) + 1) if at > int(at) else a
        out.append(a + (b - a) * (at - int(at)))
    return out


def masked(maps: DataFrame, nx: int, ny: int, border: int = 2, value: str = "naive") -> DataFrame:
    """Map, rms, hits and mask bits of (pix, total, weight, hits); what is masked is null.

    Bits: 1 never hit, 2 fewer hits than the 5th percentile of hit pixels (1 at least), 4 border pixels outside the
    interior's 0.5 and 99.5 percentiles of ``value`` (the naive map, or a column of ``maps`` such as a destriped one).
    """
    rows = maps.withColumn("naive", F.try_divide("total", "weight")).withColumn("rms", F.sqrt(F.try_divide(F.lit(1.0), F.col("weight"))))
    x, y = F.col("pix") % nx, F.floor(F.col("pix") / nx)
    hit = F.col("hits") > 0
    rows = rows.withColumn("_edge", (x < border) | (y < border) | (x >= nx - border) | (y >= ny - border))
    rows = rows.withColumn("_hits", F.when(hit, F.col("hits").cast("double"))).withColumn("_inner", F.when(~F.col("_edge") & hit, F.col(value)))
    rows = kept(rows)
    low, (lowest, highest) = quantiles(rows, "_hits", [0.05])[0], quantiles(rows, "_inner", [0.005, 0.995])
    inside = F.col(value).between(lowest, highest) if lowest is not None else F.lit(None).cast("boolean")
    out = F.coalesce(F.col("_edge") & hit & ~inside, F.lit(False))
    mask = map_mask(F.col("hits"), F.col("hits") < max(low or 1.0, 1.0), out).cast("bigint")
    own = dict.fromkeys(["naive", value, "rms", "hits"])
    rows = rows.withColumn("mask", mask)
    return rows.select("pix", *[F.when(F.col("mask") == 0, F.col(c)).alias(c) for c in own], "mask")
