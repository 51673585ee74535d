"""The per-scan reduction in steps: normalise, take the atmosphere off, solve the gain, weigh, bin, and accumulate maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import maps as M
from tidewheel.operators import ordered as O
from tidewheel.operators import signal as S


def normalised(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Value over its group's median, less 1, less the mean of that; null where the median is zero."""
    mid = df.groupBy(*keys).agg(F.percentile(value, F.lit(0.5)).alias("_mid"), F.avg(value).alias("_mean"))
    rows = df.join(mid, keys)
    return rows.withColumn(out, F.try_divide(F.col(value) - F.col("_mean"), F.col("_mid"))).drop("_mid", "_mean")


def less_gain(df: DataFrame, keys: list[str], time: str, channel: str, value: str, templates: tuple[str, str], out: str) -> DataFrame:
    """Value less the gain that the channels share at each time."""
    g = S.gain(df, keys, time, channel, value, templates)
    return df.join(g, [*keys, time]).withColumn(out, F.col(value) - F.col("gain")).drop("gain")


def projected(df: DataFrame, keys: list[str], value: str, template: str, out: str) -> DataFrame:
    """Value less its least-squares part along a template without its mean."""
    sums = df.groupBy(*keys).agg(F.regr_slope(value, template).alias("_s"), F.avg(template).alias("_t"))
    return df.join(sums, keys).withColumn(out, F.col(value) - F.coalesce("_s", F.lit(0.0)) * (F.col(template) - F.col("_t"))).drop("_s", "_t")


def nonnegative(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """(keys, a, b): y = a x + b by least squares with a >= 0; where the free slope is negative, a = 0 and b is the mean."""
    fit = df.groupBy(*keys).agg(F.regr_slope(y, x).alias("_a"), F.regr_intercept(y, x).alias("_b"), F.avg(y).alias("_m"))
    free = F.col("_a") >= 0
    return fit.select(*keys, F.when(free, F.col("_a")).otherwise(0.0).alias("a"), F.when(free, F.col("_b")).otherwise(F.col("_m")).alias("b"))


def weighed(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """Adds ``weight``: one over the squared pair noise of the scan."""
    return df.join(S.noise_weights(df, keys, order, value).withColumnRenamed("w", "weight"), keys)


def gated(samples: DataFrame, keys: list[str], noise: DataFrame, limit: float) -> DataFrame:
    """Only samples of files whose first feed is quieter than ``limit``; a file without that statistic goes."""
    good = noise.where((F.col("feed") == 1) & (F.col("red") <= limit)).select(*keys).distinct()
    return samples.join(good, keys, "left_semi")


def process(samples: DataFrame, keys: list[str], order: str, value: str, length: int, spike: float, least_good: float) -> DataFrame:
    """A scan's samples, ready for the map: whole chunks, median off, spikes off, bad scans off, weights on."""
    rows = O.offset_chunks(samples, keys, order, length)
    rows = O.less_median(rows, keys, value, "_v")
    noise = O.pair_noise(rows, keys, order, "_v")
    rows = rows.join(noise, keys).where("auto_rms > 0").withColumn("_ok", F.abs("_v") <= spike * F.col("auto_rms"))
    good = rows.groupBy(*keys).agg(F.avg(F.col("_ok").cast("double")).alias("_f")).where(F.col("_f") >= least_good)
    rows = rows.join(good, keys, "left_semi").where("_ok")
    return rows.withColumn("clean", F.col("_v")).withColumn("weight", 1.0 / (F.col("auto_rms") * F.col("auto_rms"))).drop("_v", "_ok", "auto_rms")


def smoothed(maps: DataFrame, value: str, nx: int, reach: int, sigma: float, out: str) -> DataFrame:
    """(pix, out): a Gaussian mean over pixels within ``reach``: each pixel is sent to its (2 reach + 1)^2 neighbours and summed there."""
    steps = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    rows = maps.where(F.col(value).isNotNull()).select("pix", value, steps.alias("dx")).select("pix", value, "dx", steps.alias("dy"))
    x = F.col("pix") % nx + F.col("dx")
    k = F.exp(-(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) / (2.0 * sigma * sigma))
    rows = rows.where((x >= 0) & (x < nx)).select((F.col("pix") + F.col("dx") + F.col("dy") * nx).alias("pix"), (k * F.col(value)).alias("_v"), k.alias("_k"))
    sums = rows.groupBy("pix").agg((F.sum("_v") / F.sum("_k")).alias(out))
    return sums.join(maps.select("pix"), "pix", "left_semi")


def with_prior(maps: DataFrame, prior: DataFrame, share: float) -> DataFrame:
    """(pix, sky): the map with ``share`` of the smooth prior in place of its own smooth part."""
    both = maps.join(prior, "pix")
    return both.select("pix", (F.col("naive") - F.col("smooth") + share * F.col("prior") + (1 - share) * F.col("smooth")).alias("sky"))


def accumulated(samples: DataFrame, offset: str, value: Column, weight: Column) -> tuple[DataFrame, DataFrame]:
    """The naive map and the right-hand side of the same samples, from one compression."""
    cells = M.compressed(samples, offset, "pix", value, weight)
    return M.sky(cells, "wd"), M.right_side(cells)


def gain_filter_and_bin(tod: DataFrame, vane: DataFrame, atmosphere: DataFrame, time: str, size: int, skip_feeds: tuple[int, ...] = (20,)) -> DataFrame:
    """(feed, band, time, bin, value, filtered, freq, width): a file's spectra, calibrated, gain-filtered and binned in frequency.

    ``tod`` has (feed, band, channel, time, value, freq, el), ``vane`` (feed, band, channel, tsys, gain, rms), and
    ``atmosphere`` (feed, band, offset, tau). Values and rms are divided by the gain; offset and tau / sin(el) come
    off; the part that all channels of a feed share at one time, fitted beside 1 / tsys and its slope in frequency, is
    the gain's drift and comes off the filtered values. Weights are one over the squared rms. Channels without vane
    measurements, with a gain or rms of zero, and skipped feeds (the ground's) have no rows.
    """
    good = vane.where((F.col("gain") != 0) & (F.col("rms") > 0) & (F.col("tsys") > 0))
    rows = tod.where(~F.col("feed").isin(*skip_feeds)).join(good, ["feed", "band", "channel"])
    rows = rows.join(atmosphere, ["feed", "band"]).withColumn("value", F.col("value") / F.col("gain") - F.col("offset") - F.col("tau") / F.sin(F.radians("el")))
    rows = rows.withColumns({"_w": F.pow(F.col("gain") / F.col("rms"), 2), "_a": 1.0 / F.col("tsys"), "_rel": F.col("value") / F.col("tsys")})
    middle = rows.select("feed", "band", "channel", "freq").distinct().groupBy("feed").agg(F.avg("freq").alias("_f0"))
    rows = rows.join(middle, "feed").withColumns({"_b": (F.col("freq") - F.col("_f0")) * F.col("_a"), "_cell": F.col("band") * 1_000_000 + F.col("channel")})
    drift = S.gain(rows, ["feed"], time, "_cell", "_rel", ("_a", "_b"))
    rows = rows.drop("gain").join(drift, ["feed", time]).withColumn("_f", F.col("value") - F.col("gain") * F.col("tsys"))
    keys = ["feed", "band", time]
    plain = S.frequency_bins(rows, keys, "channel", size, "value", "_w", "freq").select(*keys, "bin", "value", "freq", "width")
    filtered = S.frequency_bins(rows, keys, "channel", size, "_f", "_w", "freq").select(*keys, "bin", F.col("value").alias("filtered"))
    return plain.join(filtered, [*keys, "bin"])


def continuum(df: DataFrame, keys: list[str], time: str, channel: str, value: str, templates: tuple[str, str], out: str) -> DataFrame:
    """The fitted continuum at each time, the first template's coefficient, on every channel's row instead of its residual."""
    t1, t2 = (F.col(t) for t in templates)
    sums = df.groupBy(*keys, time).agg(F.sum(t1 * t1).alias("_a"), F.sum(t1 * t2).alias("_b"), F.sum(t2 * t2).alias("_d"), F.sum(t1 * F.col(value)).alias("_x"), F.sum(t2 * F.col(value)).alias("_y"))
    fit = F.try_divide(F.col("_x") * F.col("_d") - F.col("_y") * F.col("_b"), F.col("_a") * F.col("_d") - F.col("_b") * F.col("_b"))
    return df.join(sums.select(*keys, time, fit.alias(out)), [*keys, time])


def line_samples(level1: DataFrame, level2: DataFrame, keys: list[str], line: float, width: float, rest: float) -> DataFrame:
    """Spectra of one file around a line, calibrated by the same file's products: (..., velocity, value, weight).

    ``level1`` has the keys, channel, freq and value; ``level2`` the keys, channel, gain and rms. Channels within
    ``width`` of ``line`` are read; velocities are c (rest - freq) / rest in km/s.
    """
    near = level1.where(F.abs(F.col("freq") - line) <= width)
    rows = near.join(level2.where("gain <> 0 and rms > 0"), [*keys, "channel"])
    return rows.withColumns({"velocity": 299792.458 * (rest - F.col("freq")) / rest, "value": F.col("value") / F.col("gain"), "weight": F.pow(F.col("gain") / F.col("rms"), 2)}).drop("gain", "rms")
