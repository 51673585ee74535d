"""Nearest neighbours on the sky, by cells instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions.sky import separation

#: Degrees of the first search where there is no limit; each further one is three times as wide.
FIRST = 4.0


def _cells(lon: Column, band: Column, most: float) -> Column:
    """The number of cells of longitude in a band of latitude, each at least ``most`` degrees wide on the sky anywhere in the band."""
    edge = F.least(F.greatest(F.abs(band * most - 90.0), F.abs((band + 1) * most - 90.0)), F.lit(90.0))
    return F.greatest(F.lit(1), F.floor(360.0 * F.cos(F.radians(edge)) / most)).cast("int")


def _within(left: DataFrame, right: DataFrame, left_name: str, right_name: str, most: float) -> DataFrame:
    """(left_name, right_name, sep) of the nearest within ``most`` degrees.

    A right row is put into its own and the neighbouring bands of latitude, there into the cell of longitude that it
    falls into and the two beside it; the join is an equi-join on the cell.
    """
    band = F.floor((F.col("b") + 90.0) / most).cast("bigint")
    lon = F.pmod(F.col("l"), F.lit(360.0))
    cell = lambda n: F.least(F.floor(lon * n / 360.0), n - 1).cast("bigint")
    a = left.where("l is not null and b is not null").select(left_name, F.col("l").alias("_l"), F.col("b").alias("_b"), band.alias("_band"), cell(_cells(lon, band, most)).alias("_cell"))
    b = right.where("l is not null and b is not null").select(right_name, "l", "b", F.explode(F.array(band - 1, band, band + 1)).alias("_band"))
    n = _cells(lon, F.col("_band"), most)
    beside = F.array_distinct(F.array(*[F.pmod(cell(n) + k, n.cast("bigint")) for k in (-1, 0, 1)]))
    b = b.withColumn("_cell", F.explode(beside))
    near = a.join(b, ["_band", "_cell"]).withColumn("sep", separation(F.col("_l"), F.col("_b"), F.col("l"), F.col("b"))).where(F.col("sep") <= most)
    best = near.groupBy(left_name).agg(F.min(F.struct(F.round("sep", 9).alias("r"), F.col(right_name).alias("n"), F.col("sep").alias("s"))).alias("m"))
    return best.select(left_name, F.col("m.n").alias(right_name), F.round("m.s", 6).alias("sep"))


def nearest_on_sky(left: DataFrame, right: DataFrame, left_name: str, right_name: str, most: float = 0.0) -> DataFrame:
    """(left_name, right_name, sep): the nearest position within ``most`` degrees; of equal ones the first name.

    Both sides have columns l and b, names are distinct; rows without a position match nothing. With ``most`` of 0 or
    less there is no limit: the search widens threefold for those without a neighbour so far, up to half the sky.
    """
    if most > 0:
        return _within(left, right, left_name, right_name, most)
    found, rest, reach = None, left, FIRST
    while True:
        own = _within(rest, right, left_name, right_name, min(reach, 180.0))
        found = own if found is None else found.unionByName(own)
        if reach >= 180.0:
            return found
        rest, reach = rest.join(own.select(left_name), left_name, "left_anti"), reach * 3
