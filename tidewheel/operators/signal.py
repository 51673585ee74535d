"""Atmosphere, receiver, gain and noise operators over long tables; linear fits are closed forms over sums."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.operators.ordered import pair_noise


def atmosphere(df: DataFrame, keys: list[str], value: str, el: str = "el", flat: float = 0.2) -> DataFrame:
    """(keys, offset, tau): value = offset + tau / sin(el) by least squares; a scan flatter than ``flat`` degrees gets its median and no tau."""
    x = 1.0 / F.sin(F.radians(el))
    sums = df.where((F.col(el) > 0) & F.col(value).isNotNull()).groupBy(*keys).agg(
        F.regr_slope(value, x).alias("_s"), F.regr_intercept(value, x).alias("_i"), F.percentile(value, F.lit(0.5)).alias("_m"), (F.max(el) - F.min(el)).alias("_r"))
    level = F.col("_r") < flat
    return sums.select(*keys, F.when(level, F.col("_m")).otherwise(F.col("_i")).alias("offset"), F.when(~level, F.col("_s")).alias("tau"))


def less_atmosphere(df: DataFrame, fit: DataFrame, keys: list[str], value: str, out: str, el: str = "el") -> DataFrame:
    """Value less offset + tau / sin(el); rows of scans without a fit keep a null."""
    rows = df.join(fit.select(*keys, "offset", "tau"), keys, "left")
    return rows.withColumn(out, F.col(value) - F.col("offset") - F.coalesce(F.col("tau"), F.lit(0.0)) / F.sin(F.radians(el))).drop("offset", "tau")


def airmass_templates(df: DataFrame, keys: list[str], el: str = "el", az: str = "az") -> DataFrame:
    """Adds ``air``, the airmass less its mean over the keys, and ``dev``, the azimuth less its circular mean, in degrees."""
    x, a = 1 / F.sin(F.radians(el)), F.radians(az)
    mean = df.groupBy(*keys).agg(F.avg(x).alias("_m"), F.degrees(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a)))).alias("_a"))
    return df.join(mean, keys).withColumn("air", x - F.col("_m")).withColumn("dev", F.col(az) - F.col("_a")).drop("_m", "_a")


def frequency_bins(df: DataFrame, keys: list[str], channel: str, size: int, value: str, weight: str, freq: str) -> DataFrame:
    """(keys, bin, value, freq, width, masked): weighted mean of blocks of ``size`` channels, null without weight, weighted centre and rms width; masked without weight or where more than half the channels weigh nothing."""
    w, v, f = F.col(weight), F.col(value), F.col(freq)
    sums = df.groupBy(*keys, F.floor(F.col(channel) / size).alias("bin")).agg(
        F.sum(w).alias("_w"), F.sum(w * v).alias("_wv"), F.sum(w * f).alias("_wf"), F.sum(w * f * f).alias("_wff"), F.count_if(w == 0).alias("_none"), F.count(F.lit(1)).alias("_n"))
    centre = F.try_divide(F.col("_wf"), F.col("_w"))
    spread = F.sqrt(F.greatest(F.lit(0.0), F.try_divide(F.col("_wff"), F.col("_w")) - centre * centre))
    return sums.select(*keys, "bin", F.try_divide("_wv", "_w").alias("value"), centre.alias("freq"), spread.alias("width"), ((F.col("_w") == 0) | (2 * F.col("_none") > F.col("_n"))).alias("masked"))


def gain(df: DataFrame, keys: list[str], time: str, channel: str, value: str, templates: tuple[str, str]) -> DataFrame:
    """(keys, time, gain): at each time, value = a t1 + b t2 + gain over the channels; the third coefficient.

    The normal matrix doesn't depend on time: its sums are taken over one row for each channel, and each time adds
    only its three right-hand sums. Cramer's rule solves the 3 x 3 system.
    """
    t1, t2, v = F.col(templates[0]), F.col(templates[1]), F.col(value)
    m = df.select(*keys, channel, *templates).dropDuplicates([*keys, channel]).groupBy(*keys).agg(
        F.sum(t1 * t1).alias("a"), F.sum(t1 * t2).alias("b"), F.sum(t1).alias("c"), F.sum(t2 * t2).alias("d"), F.sum(t2).alias("e"), F.count(F.lit(1)).cast("double").alias("f"))
    r = df.groupBy(*keys, time).agg(F.sum(t1 * v).alias("x"), F.sum(t2 * v).alias("y"), F.sum(v).alias("z"))
    a, b, c, d, e, f, x, y, z = (F.col(k) for k in "abcdefxyz")
    det = a * (d * f - e * e) - b * (b * f - e * c) + c * (b * e - d * c)
    third = a * (d * z - e * y) - b * (b * z - c * y) + x * (b * e - d * c)
    return r.join(m, keys).select(*keys, time, F.try_divide(third, det).alias("gain"))


def noise_weights(df: DataFrame, keys: list[str], order: str, value: str) -> DataFrame:
    """(keys, w): one over the square of the pair noise; null where it is zero."""
    return pair_noise(df, keys, order, value).select(*keys, F.try_divide(F.lit(1.0), F.col("auto_rms") * F.col("auto_rms")).alias("w"))


def vane(df: DataFrame, keys: list[str], angle: str, value: str, load: str) -> DataFrame:
    """(keys, hot, cold, tsys, gain): means where the vane is within 4 degrees of its least angle and beyond 180 degrees."""
    from tidewheel.functions.sky import receiver

    least = df.groupBy(*keys).agg(F.min(angle).alias("_least"), F.avg(load).alias("_load"))
    means = df.join(least, keys).groupBy(*keys).agg(
        F.avg(F.when(F.col(angle) < F.col("_least") + 4, F.col(value))).alias("hot"), F.avg(F.when(F.col(angle) > 180, F.col(value))).alias("cold"), F.first("_load").alias("_load"))
    tsys, g = receiver(F.col("hot"), F.col("cold"), F.col("_load") * 0.01 + 273.15)
    return means.select(*keys, "hot", "cold", tsys.alias("tsys"), g.alias("gain"))


def polynomial_fit(df: DataFrame, keys: list[str], x: str, y: str, origin: float = 59000.0, unit: float = 365.25) -> DataFrame:
    """(keys, c0, c1, c2, n): a least-squares parabola in (x - origin) / unit, from power sums about the group's centre.

    The centre and the spread come first, so the sums stay well conditioned, and the parabola is then expanded.
    """
    t = (F.col(x) - origin) / unit
    mid = df.groupBy(*keys).agg(F.avg(t).alias("_m"))
    u = t - F.col("_m")
    s = df.join(mid, keys).groupBy(*keys).agg(F.first("_m").alias("m"), F.count(F.lit(1)).alias("n"), *[F.sum(F.pow(u, p)).alias(f"s{p}") for p in range(1, 5)], *[F.sum(F.pow(u, p) * F.col(y)).alias(f"y{p}") for p in range(3)])
    n, s1, s2, s3, s4, y0, y1, y2 = (F.col(k) for k in ("n", "s1", "s2", "s3", "s4", "y0", "y1", "y2"))

    def det(p: list[Column]) -> Column:
        a, b, c, d, e, f, g, h, i = p
        return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)

    whole = det([n, s1, s2, s1, s2, s3, s2, s3, s4])
    a = F.try_divide(det([y0, s1, s2, y1, s2, s3, y2, s3, s4]), whole)
    b = F.try_divide(det([n, y0, s2, s1, y1, s3, s2, y2, s4]), whole)
    c = F.try_divide(det([n, s1, y0, s1, s2, y1, s2, s3, y2]), whole)
    m = F.col("m")
    return s.select(*keys, (a - b * m + c * m * m).alias("c0"), (b - 2 * c * m).alias("c1"), c.alias("c2"), "n")


def _spectrum(x: np.ndarray, rate: float, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres of log-spaced bins, mean power and counts of a series; bins without a frequency are left out."""
    n = len(x)
    power = np.abs(np.fft.rfft(x - x.mean())[1 : n // 2]) ** 2 / n
    freq = np.fft.rfftfreq(n, 1 / rate)[1 : n // 2]
    edges = np.logspace(np.log10(freq[0]), np.log10(freq[-1]), bins + 1)
    at = np.clip(np.searchsorted(edges, freq, side="right") - 1, 0, bins - 1)
    count = np.bincount(at, minlength=bins)
    some = count > 0
    return (edges[1:] + edges[:-1])[some] / 2, np.bincount(at, power, bins)[some] / count[some], count[some]


def fit_noise(x: np.ndarray, rate: float = 50.0, bins: int = 100, k_ref: float = 0.1) -> tuple[float, float, float] | None:
    """White level, red level at ``k_ref`` and slope of a series' spectrum: log residuals weighted by the square root of the counts, by damped Gauss-Newton steps kept within the bounds.

    The median is taken off and samples that aren't finite count as zero, so that later ones keep their times. None
    where fewer than 16 samples are finite or all are equal.
    """
    good = np.isfinite(x)
    if good.sum() < 16 or not np.ptp(x[good]):
        return None
    even = len(x) // 2 * 2
    steps = x[1:even:2] - x[:even:2]
    x = np.where(good, x - np.median(x[good]), 0.0)
    k, p, n = _spectrum(x, rate, bins)
    p = np.maximum(p, 1e-300)
    white = max(np.nanstd(np.where(np.isfinite(steps), steps, np.nan)) / np.sqrt(2) if np.isfinite(steps).any() else 0.0, 1e-12)
    theta = np.array([np.log(white), np.log(max(np.sqrt(p[np.argmin(np.abs(k - 0.1))]), 1e-12)), -1.5])
    weight, damp = n**0.25, 1e-2

    def model(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, r = np.exp(2 * t[0]), np.exp(2 * t[1]) * (k / k_ref) ** t[2]
        total = w + r
        return np.log(total), np.stack([2 * w / total, 2 * r / total, r * np.log(k / k_ref) / total], 1)

    value, slope = model(theta)
    cost = (((np.log(p) - value) * weight) ** 2).sum()
    for _ in range(100):
        j, r = slope * weight[:, None], (np.log(p) - value) * weight
        step = np.linalg.solve(j.T @ j + damp * np.eye(3), j.T @ r)
        new = theta + np.clip(step, -2, 2)
        new[2] = np.clip(new[2], -4, 4)
        new[:2] = np.clip(new[:2], -30, 30)
        v2, s2 = model(new)
        c2 = (((np.log(p) - v2) * weight) ** 2).sum()
        if c2 < cost:
            done = cost - c2 < 1e-10 * cost
            theta, value, slope, cost, damp = new, v2, s2, c2, damp / 3
            if done:
                break
        else:
            damp *= 4
            if damp > 1e8:
                break
    return float(np.exp(theta[0])), float(np.exp(theta[1])), float(theta[2])


def noise_spectra(df: DataFrame, keys: list[str], order: str, value: str, rate: float = 50.0) -> DataFrame:
    """(keys, sigma_white, sigma_red, alpha) of each group's series; a group is one scan of one channel, some thousands of samples."""
    schema = ", ".join([*(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys), "sigma_white double, sigma_red double, alpha double"])

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        got = fit_noise(rows.sort_values(order)[value].to_numpy(float), rate) or (None, None, None)
        return pd.DataFrame([[*key, *got]], columns=[*keys, "sigma_white", "sigma_red", "alpha"])

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(one, schema)


def robust_trend(y: np.ndarray, x: np.ndarray, rounds: int = 5, weight: np.ndarray | None = None, usable: np.ndarray | None = None) -> np.ndarray:
    """The trend of ``y`` along the columns of ``x``, by repeated weighted least squares.

    A round's residuals give a scale: 1.4826 times their median deviation, or where that is zero their weighted rms.
    Weights are then multiplied by 1.345 scales over the residual, where that is below 1, and the next round's samples
    are all usable ones within 4 scales, whether the last round had them or not. Zeros where fewer than 32 samples, or
    two more than the columns, are usable; rounds end when as few are left or the scale is zero.
    """
    least = max(x.shape[1] + 2, 32)
    w = np.ones(len(y)) if weight is None else weight.astype(float)
    may = np.isfinite(y) & np.isfinite(x).all(1) & (w > 0)
    may = may if usable is None else may & usable
    if may.sum() < least:
        return np.zeros(len(y))
    x0, y0, own = np.where(np.isfinite(x), x, 0.0), np.where(may, y, 0.0), may
    for _ in range(rounds):
        root = np.sqrt(w[own])
        coef = np.linalg.lstsq(x0[own] * root[:, None], y0[own] * root, rcond=None)[0]
        rest = y0 - x0 @ coef
        near = rest[own]
        scale = 1.4826 * np.median(np.abs(near - np.median(near)))
        scale = scale if scale > 0 else np.sqrt(np.average(near * near, weights=w[own]))
        if not scale > 0:
            break
        far = np.abs(rest) / scale
        own = may & (far < 4)
        w = w * np.minimum(1.0, 1.345 / np.maximum(far, 1e-300))
        if own.sum() < least:
            break
    return x0 @ coef


def legendre(x: np.ndarray, degree: int) -> np.ndarray:
    """Legendre polynomials 1..degree of x scaled to [-1, 1]; a constant x gives zeros."""
    span = np.ptp(x)
    u = 2 * (x - x.min()) / span - 1 if span else np.zeros_like(x)
    cols = [np.ones_like(u), u]
    for n in range(1, degree):
        cols.append(((2 * n + 1) * u * cols[n] - n * cols[n - 1]) / (n + 1))
    return np.stack(cols[1 : degree + 1], 1)


def detrended(df: DataFrame, keys: list[str], order: str, value: str, along: list[str], degree: int = 3) -> DataFrame:
    """(keys, order, value): less a robust fit of a constant and Legendre polynomials in each of ``along``, for each scan."""
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, order]) + f", {value} double"

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        x = np.column_stack([np.ones(len(rows)), *(legendre(rows[c].to_numpy(float), degree) for c in along)])
        y = rows[value].to_numpy(float)
        return rows[[*keys, order]].assign(**{value: y - robust_trend(y, x)})

    return df.select(*dict.fromkeys([*keys, order, value, *along])).groupBy(*keys).applyInPandas(one, schema)


def prior_gain(df: DataFrame, keys: list[str], order: str, value: str, white: float, red: float, alpha: float, rate: float = 50.0) -> DataFrame:
    """(keys, order, gain): each series' part that a power-law prior explains, a Wiener filter in Fourier space."""
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, order]) + ", gain double"

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        y = np.nan_to_num(rows[value].to_numpy(float))
        f = np.abs(np.fft.rfftfreq(len(y), 1 / rate))
        with np.errstate(divide="ignore"):
            prior = red**2 * np.where(f > 0, f, np.inf) ** alpha
        share = np.where(f > 0, prior / (prior + white**2), 1.0)
        return rows[[*keys, order]].assign(gain=np.fft.irfft(np.fft.rfft(y) * share, len(y)))

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(one, schema)


def gaussian_fit(x: np.ndarray, y: np.ndarray, v: np.ndarray, width: float, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Amplitude, centre, two widths and a constant of a 2-D Gaussian by Levenberg-Marquardt steps; their errors for data of unit noise, and the mean square residual."""
    good = np.isfinite(x) & np.isfinite(y) & np.isfinite(v)
    x, y, v = x[good], y[good], v[good]
    if len(v) < 10:
        return None
    base, top = np.median(v), v.argmax()
    p, damp = np.array([v[top] - base, x[top], y[top], width, width, base]), 1e-3

    def parts(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, x0, y0, s1, s2, _ = q
        g = np.exp(-0.5 * (((x - x0) / s1) ** 2 + ((y - y0) / s2) ** 2))
        return a * g + q[5], np.stack([g, a * g * (x - x0) / s1**2, a * g * (y - y0) / s2**2, a * g * (x - x0) ** 2 / s1**3, a * g * (y - y0) ** 2 / s2**3, np.ones_like(g)], 1)

    f, j = parts(p)
    cost = ((v - f) ** 2).sum()
    for _ in range(rounds):
        h = j.T @ j
        try:
            step = np.linalg.solve(h + damp * np.diag(np.diag(h) + 1e-12), j.T @ (v - f))
        except np.linalg.LinAlgError:
            return None
        q = p + step
        q[3:5] = np.abs(q[3:5]) + 1e-9
        f2, j2 = parts(q)
        c2 = ((v - f2) ** 2).sum()
        if c2 <= cost:
            done = cost - c2 <= 1e-14 * max(cost, 1e-300)
            p, f, j, cost, damp = q, f2, j2, c2, damp / 5
            if done:
                break
        else:
            damp *= 5
            if damp > 1e12:
                break
    return p, np.sqrt(np.abs(np.diag(np.linalg.pinv(j.T @ j)))), float(cost / max(1, len(v) - 6))


def background_noise(x: np.ndarray, y: np.ndarray, v: np.ndarray, sigma: float) -> float:
    """Standard deviation in the ring between 1.5 and 3 beam sigmas where it has more than 20 samples, else of disjoint neighbours."""
    r2 = x * x + y * y
    ring = (r2 > (1.5 * sigma) ** 2) & (r2 < (3.0 * sigma) ** 2)
    if np.count_nonzero(ring) > 20:
        return float(np.nanstd(v[ring]))
    even = len(v) // 2 * 2
    return float(np.nanstd(v[1:even:2] - v[:even:2]) / np.sqrt(2)) if even else 0.0


def source_fits(df: DataFrame, keys: list[str], order: str, x: str, y: str, value: str, sigma: float, radius: float) -> DataFrame:
    """A Gaussian fit of each group's samples within ``radius`` of the source, in offsets from it.

    (keys, amplitude, x0, y0, s1, s2, base, their errors, noise, chi2): chi2 is reduced, over samples within one beam
    sigma, against the background's noise. Null where the noise is zero or unknown, where fewer than 10 samples are
    near, and where the fit has a negative amplitude, a width above 3 beam sigmas or a centre outside the radius.
    """
    names = ["amplitude", "x0", "y0", "s1", "s2", "base"]
    columns = [*names, *(f"{n}_error" for n in names), "noise", "chi2"]
    schema = ", ".join([*(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys), *(f"{n} double" for n in columns)])

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        px, py, v = (rows[c].to_numpy(float) for c in (x, y, value))
        noise, out = background_noise(px, py, v, sigma), [None] * len(columns)
        near = (px * px + py * py < radius * radius) & np.isfinite(v)
        if noise and np.isfinite(noise) and near.sum() >= 10:
            px, py, v = px[near], py[near], v[near]
            v = v - np.median(v)
            got = gaussian_fit(px, py, v, sigma)
            if got and got[0][0] >= 0 and max(got[0][3], got[0][4]) <= 3 * sigma and np.hypot(got[0][1], got[0][2]) <= radius:
                p, unit, _ = got
                model = p[0] * np.exp(-0.5 * (((px - p[1]) / p[3]) ** 2 + ((py - p[2]) / p[4]) ** 2)) + p[5]
                close = px * px + py * py < sigma * sigma
                free = close.sum() - len(names)
                chi2 = float((((v - model)[close] / noise) ** 2).sum() / free) if free > 0 else None
                out = [*p, *(unit * noise), noise, chi2]
        return pd.DataFrame([[*key, *out]], columns=[*keys, *columns])

    return df.select(*dict.fromkeys([*keys, order, x, y, value])).groupBy(*keys).applyInPandas(one, schema)


def long_median(df: DataFrame, keys: list[str], order: str, value: str, size: int, out: str) -> DataFrame:
    """Running median over long windows (thousands of rows), for each group: a skip list, logarithmic in the window.

    Edge windows are shortened. Values that aren't finite are left out; a window without any has a null.
    """
    schema = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in [*keys, order, value]) + f", {out} double"

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order)
        v = rows[value].astype(float).replace([np.inf, -np.inf], np.nan)
        after = size // 2 + size % 2 - 1
        padded = pd.concat([v, pd.Series(np.full(after, np.nan))], ignore_index=True)
        mid = padded.rolling(size, min_periods=1).median().to_numpy()[after:]
        return rows[[*keys, order, value]].assign(**{out: pd.Series(mid, index=rows.index).astype(object).where(~np.isnan(mid), None)})

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(one, schema)
