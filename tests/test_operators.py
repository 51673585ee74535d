import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.functions import values as V
from tidewheel.operators import catalogue as C
from tidewheel.operators import maps as M
from tidewheel.operators import ordered as O
from tidewheel.operators import signal as S


@pytest.mark.parametrize(("raw", "comment", "name", "group"), [("TauA,", "test comment", "TauA", "Calibrator"), ("GField10,CasA", "test comment", "GField10", "Galactic"), ("GField10, ", "Sky Nod", "GField10", "SkyDip"), ("fg10, ,", "test comment", "fg10", "Foreground"), ("", "x", "", None)])
def test_source_names_and_groups(spark, raw, comment, name, group):
    row = spark.createDataFrame([(raw, comment)], "s string, c string").select(V.source_name(F.col("s")), V.source_group(F.col("s"), F.col("c"))).first()
    assert tuple(row) == (name, group)


def test_sexagesimal_keeps_the_sign_of_zero(spark):
    rows = spark.createDataFrame([("-0:30:00",), ("12:00:36",), ("-10:15:00",)], "t string").select(K.sexagesimal(F.col("t")).alias("d"))
    assert [r["d"] for r in rows.collect()] == pytest.approx([-0.5, 12.01, -10.25])
    back = rows.select(K.to_sexagesimal(F.col("d"))).collect()
    assert [r[0] for r in back] == ["-00:30:00.00", "12:00:36.00", "-10:15:00.00"]


def test_galactic_centre(spark):
    lon, lat = K.to_galactic(F.lit(266.40499), F.lit(-28.93617))
    row = spark.range(1).select(lon, lat).first()
    assert min(row[0], 360 - row[0]) < 1e-3 and abs(row[1]) < 1e-3


def test_horizon_round_trip(spark):
    df = spark.createDataFrame([(float(a), float(e)) for a in (10, 100, 200, 300) for e in (20, 50, 80)], "az double, el double")
    ra, dec = K.from_horizon(F.col("az"), F.col("el"), F.lit(5.0), 37.0)
    az, el = K.horizon(F.col("ra"), F.col("dec"), F.lit(5.0), 37.0)
    for r in df.withColumns({"ra": ra, "dec": dec}).select("az", "el", az.alias("a"), el.alias("e")).collect():
        assert (r["a"], r["e"]) == pytest.approx((r["az"], r["el"]), abs=1e-6)


def test_healpix_covers_each_pixel(spark):
    """Points of a fine grid fall into every pixel, and pixels of a ring share their height."""
    n = 4
    df = spark.range(0, 360 * 180).select(((F.col("id") % 360) + 0.5).alias("l"), F.degrees(F.asin((F.floor(F.col("id") / 360) + 0.5) / 90 - 1)).alias("b"))
    rows = df.select(K.healpix_ring(F.col("l"), F.col("b"), n).alias("p"), "b").groupBy("p").agg(F.count(F.lit(1)).alias("c"), F.avg("b").alias("b")).collect()
    assert {r["p"] for r in rows} == set(range(12 * n * n))
    mean = 360 * 180 / (12 * n * n)
    assert all(0.85 * mean < r["c"] < 1.15 * mean for r in rows)
    by = {r["p"]: r["b"] for r in rows}
    assert by[0] > by[40] > by[191]


def _shuffled(spark, rows, schema):
    return spark.createDataFrame(rows[::2][::-1] + rows[1::2], schema).repartition(3)


def test_runs_are_maximal(spark):
    codes = [0, 1, 1, 0, 1, 0, 0, 1, 1, 1]
    df = _shuffled(spark, [(0, i, c) for i, c in enumerate(codes)], "k int, i int, c int")
    got = O.runs(df, ["k"], "i", F.col("c") == 1).orderBy("first").collect()
    assert [(r["first"], r["last"], r["n"]) for r in got] == [(1, 2, 2), (4, 4, 1), (7, 9, 3)]
    assert O.runs(df, ["k"], "i", F.col("c") == 5).count() == 0


def test_asof_family(spark):
    left = _shuffled(spark, [("a", t) for t in (0, 5, 10, 14, 30)], "k string, t int")
    right = _shuffled(spark, [("a", 5, 1.0), ("a", 15, 3.0), ("a", 25, 7.0)], "k string, u int, v double")
    get = lambda f: {r["t"]: r["v"] for r in f(left, right, ["k"], "t", "u", "v").collect()}
    assert get(O.asof) == {0: None, 5: 1.0, 10: 1.0, 14: 1.0, 30: 7.0}
    assert get(O.nearest) == {0: None, 5: 1.0, 10: 1.0, 14: 3.0, 30: None}
    assert get(O.interpolate) == pytest.approx({0: 1.0, 5: 1.0, 10: 2.0, 14: 2.8, 30: 7.0})


@pytest.mark.parametrize("size", [3, 4, 5])
def test_running_median(spark, size):
    v = [5, 3, 9, 1, 7, 7, 2, 8, 6, 4, 10, 0, 3, 3, 5, 12, 11, 2, 6, 1]
    df = _shuffled(spark, [(0, i, float(x)) for i, x in enumerate(v)], "k int, i int, v double")
    want = [float(np.median(v[max(0, i - size // 2) : i + size // 2 + size % 2])) for i in range(len(v))]
    for f in (O.moving_median, S.long_median):
        got = [r["m"] for r in f(df, ["k"], "i", "v", size, "m").orderBy("i").collect()]
        assert got == want


def test_gap_fill(spark):
    df = _shuffled(spark, [(0, i, float(v)) for i, v in enumerate([9, 2, 0, 0, 8, 9])], "k int, i int, v double")
    got = [r["f"] for r in O.fill_gaps(df, ["k"], "i", "v", F.col("i").isin(1, 4), "f").orderBy("i").collect()]
    assert got == pytest.approx([2, 2, 4, 6, 8, 8])


def test_lst_groups_wrap(spark):
    df = spark.createDataFrame([(1, 23.9), (2, 0.1), (3, 5.0), (4, 5.2), (5, 12.0)], "o int, lst double")
    got = {r["o"]: r["grp"] for r in O.circular_groups(df, "lst", 0.25).collect()}
    assert got[1] == got[2] and got[3] == got[4] and len(set(got.values())) == 3


def test_lst_groups_of_many_rows(spark):
    rng = np.random.default_rng(0)
    at = [float(v) for c in (0.05, 3.1, 9.4, 9.95, 17.2, 23.8) for v in (c + rng.normal(0, 0.06, 50)) % 24.0]
    df = spark.createDataFrame(list(enumerate(at)), "o int, lst double").repartition(4)
    order, want, g = sorted(range(len(at)), key=lambda i: at[i]), {}, 0
    for k, i in enumerate(order):
        g += k > 0 and at[i] - at[order[k - 1]] > 0.5
        want[i] = g
    if at[order[0]] + 24 - at[order[-1]] <= 0.5:
        want = {i: 0 if x == g else x for i, x in want.items()}
    got = O.circular_groups(df, "lst", 0.25).withColumn("p", F.spark_partition_id()).collect()
    assert {r["o"]: r["grp"] for r in got} == want and len(set(want.values())) > 2
    assert len({r["p"] for r in got}) == 4  # rows stay where they are: no task holds them all


def test_upsert_keeps_what_is_not_given(spark):
    old = spark.createDataFrame([(1, 45.2, "pending", None), (2, 1.0, "failed", 3)], "obsid int, tsys double, status string, n int")
    new = spark.createDataFrame([(1, "complete", 8, 0), (3, None, 2, 0)], "obsid int, status string, n int, other int")
    got = {r["obsid"]: tuple(r) for r in C.upsert(old, new, ["obsid"], {"status": F.lit("pending")}).collect()}
    assert got == {1: (1, 45.2, "complete", 8), 2: (2, 1.0, "failed", 3), 3: (3, None, "pending", 2)}


def test_merge_prefers(spark):
    a = spark.createDataFrame([(1, "x", None), (2, None, 5)], "k int, s string, n int")
    b = spark.createDataFrame([(1, "y", 4), (3, "z", None)], "k int, s string, n int")
    assert {tuple(r) for r in C.merge(a, b, ["k"]).collect()} == {(1, "x", 4), (2, None, 5), (3, "z", None)}
    assert {tuple(r) for r in C.merge(a, b, ["k"], "secondary").collect()} == {(1, "y", 4), (2, None, 5), (3, "z", None)}


def test_flag_ranges(spark):
    rows = [("5", None, "1, 3", "BandA"), ("7", "ongoing", "All", "BandB"), ("9", "10", "none", "BandX")]
    got = C.flag_ranges(spark.createDataFrame(rows, "obsid_start string, obsid_end string, pixels string, sidebands string")).orderBy("first").collect()
    assert (got[0]["first"], got[0]["last"], got[0]["pixels"], got[0]["bands"]) == (5, 5, [1, 3], [0, 1])
    assert got[1]["last"] > 10**9 and got[1]["pixels"] == list(range(1, 20)) and got[2]["bands"] == []


def test_atmosphere(spark):
    rows = [(0, 40 + i / 10, 3 + 8 / math.sin(math.radians(40 + i / 10))) for i in range(200)] + [(1, 50 + i / 1000, float(i)) for i in range(101)]
    got = {r["s"]: r for r in S.atmosphere(spark.createDataFrame(rows, "s int, el double, v double"), ["s"], "v").collect()}
    assert (got[0]["offset"], got[0]["tau"]) == pytest.approx((3, 8), abs=1e-6)
    assert got[1]["offset"] == 50 and got[1]["tau"] is None


def test_noise_fit_recovers_levels():
    rng = np.random.default_rng(42)
    n = 8192
    k = np.fft.rfftfreq(n, 1 / 50)
    shape = np.sqrt(1 + 0.5**2 * np.where(k > 0, k, k[1]) ** -2.0)
    x = np.fft.irfft(np.fft.rfft(rng.normal(size=n)) * shape, n)
    white, red, alpha = S.fit_noise(x, k_ref=1.0)
    assert abs(white - 1) < 0.1 and abs(red - 0.5) < 0.15 and abs(alpha + 2) < 0.4
    assert S.fit_noise(np.full(100, np.nan)) is None and S.fit_noise(np.ones(2)) is None


def test_gaussian_fit_recovers_a_source(spark):
    g = np.linspace(-0.2, 0.2, 41)
    x, y = (v.ravel() for v in np.meshgrid(g, g))
    rng = np.random.default_rng(2)
    clean = 2.5 * np.exp(-0.5 * (((x - 0.0167) / 0.032) ** 2 + ((y + 0.01) / 0.03) ** 2))
    rows = [(k, i, float(a), float(b), float(c)) for k, v in ((1, clean), (3, clean + rng.normal(0, 0.01, len(x))), (4, -clean)) for i, (a, b, c) in enumerate(zip(x, y, v, strict=True))]
    df = spark.createDataFrame([*rows, (2, 0, 0.0, 0.0, 1.0)], "k int, i int, x double, y double, v double").repartition(4)
    got = {r["k"]: r for r in S.source_fits(df, ["k"], "i", "x", "y", "v", 0.032, 0.15).collect()}
    assert [got[1][c] for c in ("amplitude", "x0", "y0", "s1", "s2")] == pytest.approx([2.5, 0.0167, -0.01, 0.032, 0.03], abs=1e-6)
    assert got[3]["x0"] == pytest.approx(0.0167, abs=5 * got[3]["x0_error"]) and got[3]["chi2"] is not None
    assert got[2]["amplitude"] is None and got[4]["amplitude"] is None
    assert S.background_noise(np.zeros(4), np.zeros(4), np.array([1.0, 2.0, 1.0, 4.0]), 1.0) == pytest.approx(1 / math.sqrt(2))


def test_robust_trend_ignores_spikes():
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(500), S.legendre(np.arange(500.0), 3)])
    y = x @ [1.0, 2.0, -0.5, 0.25] + rng.normal(0, 0.01, 500)
    y[::50] += 100
    assert np.abs(S.robust_trend(y, x) - x @ [1.0, 2.0, -0.5, 0.25]).max() < 0.02


def test_gain_matches_least_squares(spark):
    rng = np.random.default_rng(3)
    a, b = 1 / rng.uniform(30, 60, 16), np.linspace(-1, 1, 16) / 45
    data = rng.normal(size=(6, 16))
    rows = [(0, t, c, float(a[c]), float(b[c]), float(data[t, c])) for t in range(6) for c in range(16)]
    df = spark.createDataFrame(rows, "k int, t int, c int, a double, b double, v double")
    want = np.linalg.lstsq(np.column_stack([a, b, np.ones(16)]), data.T, rcond=None)[0][2]
    got = [r["gain"] for r in S.gain(df, ["k"], "t", "c", "v", ("a", "b")).orderBy("t").collect()]
    assert got == pytest.approx(list(want), abs=1e-6)


def test_parabola(spark):
    rows = [(0, 59000 + 365.25 * t, 1.5 - 0.2 * t + 0.05 * t * t) for t in np.linspace(0, 2, 12)]
    got = S.polynomial_fit(spark.createDataFrame([(k, float(a), float(b)) for k, a, b in rows], "k int, x double, y double"), ["k"], "x", "y").first()
    assert [got["c0"], got["c1"], got["c2"]] == pytest.approx([1.5, -0.2, 0.05], abs=1e-8)


def test_destriper_matches_a_dense_solve(spark):
    rng = np.random.default_rng(5)
    n, offsets, pixels, length = 240, 12, 9, 20
    pix, w, y = rng.integers(0, pixels, n), rng.integers(1, 3, n).astype(float), rng.normal(size=n) + np.repeat(rng.normal(size=offsets), length)
    df = spark.createDataFrame([(int(i // length), int(pix[i]), float(w[i]), float(y[i])) for i in range(n)], "o int, p int, w double, y double")
    cells = M.compressed(df, "o", "p", F.col("y"), F.col("w"))
    got, residuals = M.destriped(cells, ridge_share=1e-2, tolerance=1e-10)
    f, p, wm = np.eye(offsets)[np.arange(n) // length], np.eye(pixels)[pix], np.diag(w)
    z = np.eye(n) - p @ np.linalg.inv(p.T @ wm @ p) @ p.T @ wm
    ridge = 1e-2 * np.median((f.T @ wm @ f).diagonal())
    want = np.linalg.solve(f.T @ wm @ z @ f + ridge * np.eye(offsets), f.T @ wm @ z @ y)
    assert [r["v"] for r in got.orderBy("offset").collect()] == pytest.approx(list(want), abs=1e-6)
    assert residuals[-1] < 1e-8


def test_mask_bits(spark):
    rows = [(p, float(100 if p == 0 else p % 5), 1.0, 20 - p % 20) for p in range(49)]
    got = {r["pix"]: r["mask"] for r in M.masked(spark.createDataFrame(rows, "pix int, total double, weight double, hits int"), 7, 7, 2).collect()}
    assert got[0] & 4 and not got[24] & 4 and {p for p, m in got.items() if m & 2} <= {p for p in range(49) if 20 - p % 20 < 3}
    rows = [(0, 4.0, 2.0, 3), (1, 0.0, 0.0, 0), (2, 5.0, 1.0, 9)]
    got = {r["pix"]: (r["naive"], r["hits"], r["mask"]) for r in M.masked(spark.createDataFrame(rows, "pix int, total double, weight double, hits int"), 3, 1, 0).collect()}
    assert got == {0: (None, None, 2), 1: (None, None, 3), 2: (5.0, 9, 0)}


def test_nearest_on_sky_matches_all_pairs(spark):
    from tidewheel.operators.nearby import nearest_on_sky

    rng = np.random.default_rng(8)
    a = [(f"a{i}", float(rng.uniform(0, 360)), float(rng.uniform(-89, 89))) for i in range(60)]
    b = [(f"b{i}", float(rng.uniform(0, 360)), float(rng.uniform(-89, 89))) for i in range(40)]

    def sep(p, q):
        x = math.sin(math.radians(p[2])) * math.sin(math.radians(q[2])) + math.cos(math.radians(p[2])) * math.cos(math.radians(q[2])) * math.cos(math.radians(p[1] - q[1]))
        return math.degrees(math.acos(max(-1, min(1, x))))

    want = {p[0]: min((sep(p, q), q[0]) for q in b) for p in a}
    want = {k: n for k, (s, n) in want.items() if s <= 12}
    got = nearest_on_sky(spark.createDataFrame(a, "x string, l double, b double"), spark.createDataFrame(b, "y string, l double, b double"), "x", "y", 12.0).collect()
    assert {r["x"]: r["y"] for r in got} == want



def test_direction_of_the_galactic_pole(spark):
    """A step towards the pole raises the latitude and keeps the longitude."""
    row = spark.range(1).select(K.galactic_position_angle(F.lit(40.0), F.lit(10.0)).alias("pa"), *(c.alias(n) for c, n in zip(K.to_equatorial(F.lit(40.0), F.lit(10.0)), ("ra", "dec"), strict=True))).first()
    a, step = math.radians(row["pa"]), 0.01
    near = K.to_galactic(F.lit(row["ra"] + step * math.sin(a) / math.cos(math.radians(row["dec"]))), F.lit(row["dec"] + step * math.cos(a)))
    lon, lat = spark.range(1).select(*near).first()
    assert lon == pytest.approx(40.0, abs=1e-4) and lat == pytest.approx(10.01, abs=1e-4)


def test_flux_models(spark):
    row = spark.range(1).select(K.model_flux(F.lit("TauA"), F.lit(40.0), F.lit(53371.0)), K.model_flux(F.lit("CasA"), F.lit(33.0), F.lit(51544.0), "hafez", "hafez"), K.model_flux(F.lit("other"), F.lit(40.0), F.lit(0.0))).first()
    assert row[0] == pytest.approx(10**2.506) and row[1] == pytest.approx(182.0) and row[2] is None


@pytest.mark.parametrize("size", [4, 5, 201])
def test_long_median_skips_nulls(spark, size):
    rng = np.random.default_rng(size)
    rows = [(k, i, None if rng.random() < 0.3 or 40 < i < 52 else float(rng.integers(0, 50)) if rng.random() < 0.95 else float("nan")) for k in range(3) for i in range(90)]
    got = {(r["k"], r["i"]): r["mid"] for r in S.long_median(_shuffled(spark, rows, "k int, i int, v double"), ["k"], "i", "v", size, "mid").collect()}
    by = {(k, i): v for k, i, v in rows}
    for k, i, _ in rows:
        window = [by[k, j] for j in range(i - size // 2, i + size // 2 + size % 2) if (k, j) in by and by[k, j] is not None and not math.isnan(by[k, j])]
        want = float(np.median(window)) if window else None
        assert got[k, i] == (pytest.approx(want) if window else None)
    assert S.long_median(spark.createDataFrame([], "k int, i int, v double"), ["k"], "i", "v", size, "mid").count() == 0


def test_noise_fit_keeps_the_times_of_gaps():
    """A gap counts as zeros, so a fit with a gap is the fit of the series with its median's value there; without data there is no fit."""
    rng = np.random.default_rng(5)
    x = rng.normal(3.0, 1.0, 4096)
    gap = x.copy()
    gap[1000:1100] = np.nan
    filled = np.where(np.isfinite(gap), gap, np.median(gap[np.isfinite(gap)]))
    a, b = S.fit_noise(gap), S.fit_noise(filled)
    assert a[0] == pytest.approx(b[0], rel=0.05) and a[2] == pytest.approx(b[2], abs=0.5)
    assert S.fit_noise(np.full(100, np.nan)) is None and S.fit_noise(np.ones(100)) is None
    t = np.arange(4096) / 50
    wave = np.sin(2 * np.pi * 5 * t) + rng.normal(0, 0.01, 4096)
    wave[500:777] = np.nan  # an odd gap would put the wave's halves out of phase if it were closed
    k, p, _ = S._spectrum(np.where(np.isfinite(wave), wave, 0.0), 50.0, 100)
    assert abs(k[p.argmax()] - 5) < 0.5


def test_robust_trend_readmits_samples_and_has_a_scale_without_deviations():
    t = np.linspace(-1, 1, 400)
    x = np.column_stack([np.ones_like(t), t])
    rng = np.random.default_rng(1)
    y = 2 + 3 * t + rng.normal(0, 0.1, 400)
    y[::50] += 60
    y[25::50] -= 60
    y[::37] = np.nan
    assert np.abs(S.robust_trend(y, x) - (2 + 3 * t)).max() < 0.1
    half = np.where(np.arange(400) % 3 == 0, 1.0, 0.0)  # most residuals of the mean are equal
    assert np.isfinite(S.robust_trend(half, x[:, :1])).all()
    assert (S.robust_trend(y[:20], x[:20]) == 0).all()
    off = S.robust_trend(y, x, usable=t < 0)
    assert np.abs(off - (2 + 3 * t)).max() < 0.3


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_interval_join_against_loops(spark, how):
    rng = np.random.default_rng(3)
    points = [(int(k), i, None if i % 50 == 9 else float(rng.uniform(-40, 300))) for i, k in enumerate(rng.integers(0, 4, 400))] + [(None, 900, 5.0)]
    spans = [(int(rng.integers(0, 3)), j, a, None if j % 13 == 5 else a + float(rng.choice([-3, 0, 0.5, 7, 60, 400]))) for j, a in enumerate(rng.uniform(-60, 280, 60).tolist())] + [(None, 99, 0.0, 10.0)]
    left, right = spark.createDataFrame(points, "k int, i int, t double"), spark.createDataFrame(spans, "k int, j int, lo double, hi double")
    got = O.interval_join(left.repartition(3), right, ["k"], "t", "lo", "hi", 11.0, how)
    hold = {i: [j for kk, j, lo, hi in spans if kk == k and t is not None and hi is not None and lo <= t < hi] for k, i, t in points}
    if how in ("inner", "left"):
        want = sorted((i, j) for i, js in hold.items() for j in (js or ([-1] if how == "left" else [])))
        assert sorted((r["i"], -1 if r["j"] is None else r["j"]) for r in got.collect()) == want
    else:
        assert sorted(r["i"] for r in got.collect()) == sorted(i for i, js in hold.items() if bool(js) == (how == "left_semi"))
    assert O.interval_join(left, right.where("false"), ["k"], "t", "lo", "hi", 11.0, "inner").count() == 0


def test_nearest_without_a_limit_and_near_the_poles(spark):
    rng = np.random.default_rng(8)
    make = lambda n, s: [(f"{s}{i}", float(a), float(b)) for i, (a, b) in enumerate(zip(rng.uniform(-10, 370, n), np.degrees(np.arcsin(rng.uniform(-1, 1, n))), strict=True))]
    left, right = make(150, "p") + [("pole", 5.0, 90.0), ("edge", 359.99, 0.0), ("lost", None, 1.0)], make(12, "q") + [("south", 0.0, -89.0), ("seam", 0.5, 0.1)]

    def sep(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        return math.degrees(math.acos(max(-1, min(1, math.sin(b) * math.sin(d) + math.cos(b) * math.cos(d) * math.cos(a - c)))))

    from tidewheel.operators.nearby import nearest_on_sky

    dl, dr = spark.createDataFrame(left, "p string, l double, b double"), spark.createDataFrame(right, "q string, l double, b double")
    for most in (0.0, 9.0, 70.0):
        got = {r["p"]: (r["q"], r["sep"]) for r in nearest_on_sky(dl, dr, "p", "q", most).collect()}
        for p, a, b in left[:-1]:
            s, q = min((sep(a, b, c, d), q) for q, c, d in right)
            assert got.get(p) == (None if most and s > most else (q, pytest.approx(s, abs=1e-5)))
        assert "lost" not in got


def test_quantiles_narrow_to_the_rank(spark):
    rng = np.random.default_rng(2)
    x = np.round(rng.lognormal(0, 2, 3000), 2)
    x[:400] = 1.25
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)] * 7, "v double").repartition(3)
    shares = [0.0, 0.005, 0.3, 0.5, 0.995, 1.0]
    for few, bins in ((10**6, 4096), (5, 7), (1, 3)):
        assert M.quantiles(df, "v", shares, few, bins) == pytest.approx(np.quantile(x, shares).tolist())
    assert M.quantiles(df.where("false"), "v", shares) == [None] * 6


def test_reflected_median(spark):
    rows = [(k, i, float((i * 37 + k * 11) % 23)) for k in range(3) for i in range(20 + k)]
    got = {(r["k"], r["i"]): r["m"] for r in O.reflected_median(_shuffled(spark, rows, "k int, i int, v double"), ["k"], "i", "v", 7, "m").collect()}
    for k in range(3):
        v = np.array([x for kk, _, x in rows if kk == k])
        wide = np.pad(v, 3, mode="symmetric")
        assert [got[k, i] for i in range(len(v))] == [float(np.median(wide[i : i + 7])) for i in range(len(v))]


def test_regularised_destriper_matches_a_dense_solve(spark):
    rng = np.random.default_rng(7)
    rows = [(o, int(p), float(rng.uniform(1, 3)), float(rng.normal())) for o in range(12) for p in rng.choice(9, 5, replace=False)]
    cells = spark.createDataFrame([(o, p, w, w * v) for o, p, w, v in rows], "offset long, pix long, w double, wd double")
    n = 12
    a, pw = np.zeros((n, n)), np.zeros(9)
    point = np.zeros((n, 9))
    for o, p, w, _ in rows:
        point[o, p] += w
        pw[p] += w
    a = np.diag(point.sum(1)) - point @ np.diag(1 / np.where(pw > 0, pw, 1)) @ point.T
    middle = np.median(point.sum(1))
    lap = np.diag([-1.0, *[-2.0] * (n - 2), -1.0]) + np.diag(np.ones(n - 1), 1) + np.diag(np.ones(n - 1), -1)
    full = a + middle * (0.5 * np.eye(n) + 0.01 * lap + 0.02 * lap @ lap)
    b = {r["offset"]: r["b"] for r in M.right_side(cells).collect()}
    want = np.linalg.solve(full, np.array([b[o] for o in range(n)]))
    got, residuals = M.destriped(cells, 0.5, 1e-10, 200, 0.01, 0.02)
    assert [r["v"] for r in got.orderBy("offset").collect()] == pytest.approx(want.tolist(), abs=1e-6) and residuals[-1] < 1e-10
    with pytest.raises(RuntimeError):
        M.destriped(cells, 0.5, 1e-12, 1)


def test_values_are_set_in_known_columns_only(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "obsid long, source string")
    assert sorted(tuple(r) for r in C.with_value(df, "obsid", 2, "source", "b").collect()) == [(1, "a"), (2, "b")]
    assert {tuple(r) for r in C.with_value(df, "obsid", 9, "source", "b").collect()} == {(1, "a"), (2, None)}
    with pytest.raises(ValueError):
        C.with_value(df, "obsid", 2, "nothing", 1)


def test_calls_as_text():
    from tidewheel.plans.steps import call

    assert call('A.B.C(x=1, y=2.5, z=True, w="t", v=["a","b"], u=word)') == ("A.B", "C", {"x": 1, "y": 2.5, "z": True, "w": "t", "v": ["a", "b"], "u": "word"})
    assert call("A.B()") == ("A", "B", {})
    for bad in ("A.B", "B(x=1)", "A.B(x)", "A.B(x=1", "A.B(x=1=2)"):
        with pytest.raises(ValueError):
            call(bad)


def test_precession_refraction_and_sun(spark):
    row = spark.range(1).select(*K.precessed(F.lit(10.0), F.lit(20.0), F.lit(51544.5)), *K.precessed(F.lit(0.640437), F.lit(0.278368), F.lit(51544.5 + 18262.5)), K.refraction(F.lit(45.0), F.lit(1010.0), F.lit(10.0)), *K.sun(F.lit(51623.316))).first()
    assert (row[0], row[1]) == pytest.approx((10.0, 20.0))
    assert min(row[2], 360 - row[2]) < 2e-3 and abs(row[3]) < 2e-3  # half a century later the old equinox has moved by 0.64 and 0.28 degrees
    assert row[4] * 3600 == pytest.approx(58.2, abs=0.3)
    assert min(row[5], 360 - row[5]) < 0.2 and abs(row[6]) < 0.1 and row[7] == pytest.approx(0.996, abs=0.002)


def test_grid_definitions(tmp_path):
    from tidewheel.sources.readers import wcs_definition

    path = tmp_path / "grids.toml"
    path.write_text("[small]\nNAXIS1 = 15\nNAXIS2 = 9\nCRPIX1 = 8\nCRPIX2 = 5\nCRVAL1 = 10.0\nCRVAL2 = 0.0\nCDELT1 = -0.5\nCDELT2 = 0.5\n")
    assert wcs_definition([str(tmp_path / "none"), str(path)], "small") == {"nx": 15, "ny": 9, "crpix1": 8.0, "crpix2": 5.0, "crval1": 10.0, "crval2": 0.0, "cdelt1": -0.5, "cdelt2": 0.5}
    with pytest.raises(KeyError):
        wcs_definition([str(path)], "large")
    with pytest.raises(FileNotFoundError):
        wcs_definition([str(tmp_path / "none")], "small")
