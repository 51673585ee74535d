"""Calibration models, pointing offsets and line selection as joins and column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.values import polynomial
from tidewheel.operators.ordered import neighbours


def gain_ratios(flux: DataFrame, chi2: float, low: float = 0.3, high: float = 3.0, least: int = 10) -> DataFrame:
    """Rows with a gain measured / expected within bounds, in groups of (feed, band, channel) that have at least ``least``."""
    rows = flux.withColumn("gain", F.try_divide("measured", "expected")).where((F.col("chi2") < chi2) & (F.col("expected") > 0) & F.col("gain").between(low, high))
    big = rows.groupBy("feed", "band", "channel").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least)
    return rows.join(big.drop("_n"), ["feed", "band", "channel"], "left_semi")


def mean_models(ratios: DataFrame) -> DataFrame:
    """(feed, band, channel, coeffs, rms, n): a constant model for each group."""
    return ratios.groupBy("feed", "band", "channel").agg(F.array(F.avg("gain")).alias("coeffs"), F.stddev_pop("gain").alias("rms"), F.count(F.lit(1)).alias("n"))


def nearest_in_time(left: DataFrame, right: DataFrame, keys: list[str], time: str, value: str) -> DataFrame:
    """``value`` of the row of ``right`` that is nearest in time, the earlier on a tie; beyond the ends the end's."""
    both = neighbours(left, right.select(*keys, F.col(time).alias("_rt"), value), keys, time, "_rt", value)
    first = F.col("_t1").isNull() | (F.col(time) - F.col("_t0") <= F.col("_t1") - F.col(time))
    return both.select(*left.columns, F.when(F.col("_t0").isNotNull() & first, F.col("_v0")).otherwise(F.col("_v1")).alias(value))


def calibrated(samples: DataFrame, models: DataFrame, keys: list[str], value: str, origin: float = 59000.0) -> DataFrame:
    """Samples divided by their model's gain at their time; a missing model counts as 1, a gain below 0.3 gives null."""
    rows = samples.join(F.broadcast(models.select(*keys, "coeffs")), keys, "left")  # models: at most 19 x 4 x 2 rows
    gain = polynomial(F.coalesce("coeffs", F.array(F.lit(1.0))), (F.col("mjd") - origin) / 365.25)
    return rows.withColumn("gain", F.when(gain >= 0.3, gain)).withColumn(value, F.col(value) / F.col("gain")).drop("coeffs")


def seasonal_factor(mjd: Column, amplitude: Column | float, phase: Column | float, period: Column | float, slope: Column | float, offset: Column | float, least: float = 0.3, origin: float = 59000.0) -> Column:
    """A sine in days since the origin, a slope a year and a constant; null below ``least``."""
    t = mjd - origin
    f = amplitude * F.sin(2 * F.pi() * (t - phase) / period) + slope * t / 365.25 + offset
    return F.when(f >= least, f)


def line_window(channels: DataFrame, line: float, width: int) -> DataFrame:
    """(band, low, high, nearest): the first band whose frequencies enclose the line, and a window of channels around the nearest."""
    bands = channels.groupBy("band").agg(F.min("freq").alias("f0"), F.max("freq").alias("f1"), F.min_by("channel", F.struct(F.abs(F.col("freq") - line), "channel")).alias("nearest"), F.max("channel").alias("_top"))
    best = bands.where((F.col("f0") < line) & (F.col("f1") > line)).orderBy("band").limit(1)
    return best.select("band", F.greatest(F.col("nearest") - width, F.lit(0)).alias("low"), F.least(F.col("nearest") + width, F.col("_top")).alias("high"), "nearest")


def bad_flags(red: float, rms: float, alpha: float = -1.5) -> Column:
    """A flag, or a statistic beyond its threshold; missing statistics don't count."""
    over = lambda c, t: F.coalesce(F.col(c) > t, F.lit(False))
    return ~F.col("is_good") | over("red_noise", red) | over("auto_rms", rms) | F.coalesce(F.col("noise_index") < alpha, F.lit(False))


def top_row(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each group."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def power_fit(table: DataFrame, x: str, y: str) -> DataFrame:
    """(slope, intercept) of log10 y against log10 x."""
    return table.agg(F.regr_slope(F.log10(y), F.log10(x)).alias("slope"), F.regr_intercept(F.log10(y), F.log10(x)).alias("intercept"))
