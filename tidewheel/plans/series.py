"""Ordered operators, as-of joins, noise, gain, atmosphere and map-making over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.operators import maps as M
from tidewheel.operators import ordered as O
from tidewheel.operators import signal as S
from tidewheel.plans.tables import Book, flux, observations, raw, samples, spectra

book = Book()
Q = book.add
#: Housekeeping rows: every 37th sample, on a clock of its own.
HK = "hk as (select obsid, feed, sample * 10 + 3 as t, tod as v from samples where sample % 7 = 2)"


def _hk(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where("sample % 7 = 2").select("obsid", "feed", (F.col("sample") * 10 + 3).alias("t"), F.col("tod").alias("v"))


def _ticks(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", "obsid", "feed", (F.col("sample") * 10).alias("at"))


@Q("wn1_contiguous_blocks", "select obsid, feed, min(sample) as first, max(sample) as last, count(*) as n from (select *, n - row_number() over (partition by obsid, feed order by sample) as isle from (select sample, obsid, feed, k, row_number() over (partition by obsid, feed order by sample) as n from samples) where k % 3 = 0) group by obsid, feed, isle")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.runs(samples(spark, d), ["obsid", "feed"], "sample", F.col("k") % 3 == 0)


@Q("wn2_scan_edges", "with idx as (select obsid, feed, sample, lead(sample) over (partition by obsid, feed order by sample) as nx, lag(sample) over (partition by obsid, feed order by sample) as pv from samples where k < 90), e as (select obsid, feed, sample as a from idx where nx - sample > 1 or nx is null or pv is null), p as (select obsid, feed, a, lead(a) over (partition by obsid, feed order by a) as b from e) select obsid, feed, a + 10 as start, b - 5 as \"end\" from p where b is not null and b - 5 - (a + 10) >= 20")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.scan_edges(samples(spark, d).select("obsid", "feed", "sample", "k"), ["obsid", "feed"], "sample", F.col("k") < 90, 10, 5, 20)


@Q("wn4_moving_mean", "select sample, round(avg(tod) over (partition by obsid, feed order by sample rows between 5 preceding and 4 following), 6) as mean from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.moving_mean(samples(spark, d).select("obsid", "feed", "sample", "tod"), ["obsid", "feed"], "sample", "tod", 10, "mean").select("sample", F.round("mean", 6).alias("mean"))


@Q("wn5_moving_median", "select sample, round(median(tod) over (partition by obsid, feed order by sample rows between 4 preceding and 4 following), 6) as mid from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.moving_median(samples(spark, d).select("obsid", "feed", "sample", "tod"), ["obsid", "feed"], "sample", "tod", 9, "mid").select("sample", F.round("mid", 6).alias("mid"))


@Q("wn6_median_by_row", "select sample, channel, round(median(value) over (partition by sample order by channel rows between 2 preceding and 2 following), 9) as mid from spectra")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.moving_median(spectra(spark, d), ["sample"], "channel", "value", 5, "mid").select("sample", "channel", F.round("mid", 9).alias("mid"))


@Q("wn5_long_median", "select obsid, feed, sample, median(tod) over (partition by obsid, feed order by sample rows between 100 preceding and 100 following) as mid from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.long_median(samples(spark, d), ["obsid", "feed"], "sample", "tod", 201, "mid").select("obsid", "feed", "sample", "mid")


@Q("wn8_dilate", "select sample, bool_or(tod > 470) over (partition by obsid, feed order by sample rows between 3 preceding and 3 following) as near from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("obsid", "feed", "sample", (F.col("tod") > 470).alias("spike"))
    return O.dilate(rows, ["obsid", "feed"], "sample", "spike", 3, "near").select("sample", "near")


@Q("wn9_spike_clip", "with a as (select obsid, feed, sample, case when abs(tod) > 480 then 0 else tod end as t from samples), b as (select *, abs(t - median(t) over (partition by obsid, feed order by sample rows between 3 preceding and 3 following)) > 400 as spike from a) select sample, case when bool_or(spike) over (partition by obsid, feed order by sample rows between 2 preceding and 2 following) then 0 else t end as tod from b")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("obsid", "feed", "sample", F.when(F.abs("tod") > 480, 0.0).otherwise(F.col("tod")).alias("t"))
    rows = O.moving_median(rows, ["obsid", "feed"], "sample", "t", 7, "mid").withColumn("spike", F.abs(F.col("t") - F.col("mid")) > 400)
    return O.dilate(rows, ["obsid", "feed"], "sample", "spike", 2, "near").select("sample", F.when(F.col("near"), 0.0).otherwise(F.col("t")).alias("tod"))


@Q("wn10_gap_fill", "with r as (select obsid, feed, sample, tod, k % 5 <> 0 as ok, row_number() over (partition by obsid, feed order by sample) as n from samples), g as (select *, last_value(case when ok then n end ignore nulls) over a as n0, last_value(case when ok then tod end ignore nulls) over a as v0, first_value(case when ok then n end ignore nulls) over b as n1, first_value(case when ok then tod end ignore nulls) over b as v1 from r window a as (partition by obsid, feed order by sample rows between unbounded preceding and current row), b as (partition by obsid, feed order by sample rows between current row and unbounded following)) select sample, round(coalesce(case when n1 > n0 then v0 + (v1 - v0) * (n - n0) / (n1 - n0) else v0 end, v0, v1), 6) as filled from g")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("obsid", "feed", "sample", "tod", "k")
    return O.fill_gaps(rows, ["obsid", "feed"], "sample", "tod", F.col("k") % 5 != 0, "filled").select("sample", F.round("filled", 6).alias("filled"))


@Q("wn11_good_fraction", "select s.sample from samples s join (select feed, scan from samples group by 1, 2 having avg((k > 10)::int) >= 0.9) using (feed, scan)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    good = rows.groupBy("feed", "scan").agg(F.avg((F.col("k") > 10).cast("double")).alias("f")).where("f >= 0.9")
    return rows.join(good, ["feed", "scan"], "left_semi").select("sample")


@Q("wn12_less_median", "select sample, round(tod - median(tod) over (partition by feed, band), 6) as rest from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.less_median(samples(spark, d).select("feed", "band", "sample", "tod"), ["feed", "band"], "tod", "rest").select("sample", F.round("rest", 6).alias("rest"))


@Q("wn13_drift", "select sample, case when pv is null then nx - az when nx is null then az - pv else (nx - pv) / 2 end > 0 as rising from (select sample, az, lag(az) over w as pv, lead(az) over w as nx from samples window w as (partition by obsid, feed order by sample)) where pv is not null or nx is not null")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = O.gradient(samples(spark, d).select("obsid", "feed", "sample", "az"), ["obsid", "feed"], "sample", "az", "g")
    return rows.where("g is not null").select("sample", (F.col("g") > 0).alias("rising"))


@Q("wn14_log_jumps", "with m as (select scan, median(tod) as mid from samples group by 1) select scan, round(abs(log10(mid) - log10(lag(mid) over (order by scan))), 6) as jump from m order by jump desc nulls last, scan limit 6")
def _(spark: SparkSession, d: str) -> DataFrame:
    mids = samples(spark, d).groupBy("scan").agg(F.percentile("tod", F.lit(0.5)).alias("mid")).withColumn("one", F.lit(1))  # one row a scan
    jump = F.round(F.abs(F.log10("mid") - F.log10(F.lag("mid").over(Window.partitionBy("one").orderBy("scan")))), 6)
    return mids.select("scan", jump.alias("jump")).orderBy(F.desc_nulls_last("jump"), "scan").limit(6)


@Q("wn15_lst_groups", "with v as (select p_partkey as obsid, (p_partkey * 0.37) % 23.9 as lst from part), a as (select *, case when lst - lag(lst) over (order by lst) > 0.025 then 1 else 0 end as new from v), b as (select *, sum(new) over (order by lst rows unbounded preceding) as g from a), c as (select *, case when (min(lst) over () + 24 - max(lst) over ()) <= 0.025 and g = max(g) over () then 0 else g end as h from b) select obsid, dense_rank() over (order by h) - 1 as grp from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = raw(spark, d, "part").select(F.col("p_partkey").alias("obsid"), F.expr("(p_partkey * 0.37D) % 23.9D").alias("lst"))
    return O.circular_groups(rows, "lst", 0.0125).select("obsid", "grp")


@Q("wn16_gap_sessions", "select obsid, feed, grp, count(*) as n, min(sample) as first from (select obsid, feed, sample, sum(case when sample - pv > 40 then 1 else 0 end) over (partition by obsid, feed order by sample rows unbounded preceding)::bigint as grp from (select obsid, feed, sample, lag(sample) over (partition by obsid, feed order by sample) as pv from samples)) group by 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = O.first_difference_groups(samples(spark, d).select("obsid", "feed", "sample"), ["obsid", "feed"], "sample", 40)
    return rows.groupBy("obsid", "feed", F.col("grp").cast("bigint").alias("grp")).agg(F.count(F.lit(1)).alias("n"), F.min("sample").alias("first"))


@Q("wn17_offset_chunks", "select sample, (n // 7)::bigint as chunk from (select sample, row_number() over (partition by feed, scan order by sample) - 1 as n, count(*) over (partition by feed, scan) as c from samples) where n < c // 7 * 7")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.offset_chunks(samples(spark, d).select("feed", "scan", "sample"), ["feed", "scan"], "sample", 7).select("sample", "chunk")


@Q("wn20_chunking", "select obsid, (rn - 1) // 100 as chunk, (rn - 1) % 4 as robin from (select obsid, row_number() over (order by obsid) as rn from observations where source = 'Jupiter')")
def _(spark: SparkSession, d: str) -> DataFrame:
    one = observations(spark, d).where("source = 'Jupiter'").select("obsid", "source")
    rows = one.withColumn("n", F.row_number().over(Window.partitionBy("source").orderBy("obsid")) - 1)
    return rows.select("obsid", F.floor(F.col("n") / 100).alias("chunk"), (F.col("n") % 4).cast("bigint").alias("robin"))


@Q("wn21_cumulative_maps", "with c as (select sample // 2500 as chunk, pix, sum(w * tod) as s, sum(w) as w, count(*) as h from samples group by 1, 2) select chunk, pix, round(sum(s) over k / sum(w) over k, 6) as map, round(sqrt(1 / sum(w) over k), 6) as rms, (sum(h) over k)::bigint as hits from c window k as (partition by pix order by chunk rows unbounded preceding)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("chunk", F.floor(F.col("sample") / 2500))
    c = M.binned(rows, ["chunk", "pix"], F.col("tod"), F.col("w"))
    k = Window.partitionBy("pix").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    w = F.sum("weight").over(k)
    return c.select("chunk", "pix", F.round(F.sum("total").over(k) / w, 6).alias("map"), F.round(F.sqrt(1 / w), 6).alias("rms"), F.sum("hits").over(k).alias("hits"))


@Q("wn23_top_per_group", "select feed, sample, tod from (select *, row_number() over (partition by feed order by tod desc, sample) as n from samples) where n = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    best = samples(spark, d).groupBy("feed").agg(F.min(F.struct((-F.col("tod")).alias("t"), "sample")).alias("m"))
    return best.select("feed", "m.sample", (-F.col("m.t")).alias("tod"))


@Q("wn25_curvature", "select sample, round(coalesce(lag(tod) over w, tod) - 2 * tod + coalesce(lead(tod) over w, tod), 6) as c from samples window w as (partition by obsid, feed order by sample)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.curvature(samples(spark, d).select("obsid", "feed", "sample", "tod"), ["obsid", "feed"], "sample", "tod", "c").select("sample", F.round("c", 6).alias("c"))


@Q("wn27_airmass_template", "select sample, round(1 / sin(radians(el)) - avg(1 / sin(radians(el))) over (partition by feed, scan), 6) as air, round(az - degrees(atan2(avg(sin(radians(az))) over (partition by feed, scan), avg(cos(radians(az))) over (partition by feed, scan))), 6) as dev from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = S.airmass_templates(samples(spark, d), ["feed", "scan"])
    return rows.select("sample", F.round("air", 6).alias("air"), F.round("dev", 6).alias("dev"))


INTERVALS = "iv as (select obsid, feed, min(sample) + scan % 30 as lo, max(sample) + scan % 17 * 20 as hi, scan from samples group by obsid, feed, scan)"


def _intervals(spark: SparkSession, d: str) -> DataFrame:
    """Overlapping intervals of many lengths, some empty."""
    rows = samples(spark, d).groupBy("obsid", "feed", "scan").agg(F.min("sample").alias("a"), F.max("sample").alias("b"))
    return rows.select("obsid", "feed", (F.col("a") + F.col("scan") % 30).alias("lo"), (F.col("b") + F.col("scan") % 17 * 20).alias("hi"), F.col("scan").alias("interval"))


@Q("jn11_interval_join", f"with {INTERVALS} select s.sample, iv.scan as interval, iv.lo from samples s join iv on s.obsid = iv.obsid and s.feed = iv.feed and s.sample >= iv.lo and s.sample < iv.hi")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("obsid", "feed", "sample")
    return O.interval_join(rows, _intervals(spark, d), ["obsid", "feed"], "sample", "lo", "hi", 100).select("sample", "interval", "lo")


@Q("jn11_outside_intervals", f"with {INTERVALS} select s.sample from samples s where not exists (select 1 from iv where s.obsid = iv.obsid and s.feed = iv.feed and s.sample >= iv.lo and s.sample < iv.hi)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("obsid", "feed", "sample")
    return O.interval_join(rows, _intervals(spark, d), ["obsid", "feed"], "sample", "lo", "hi", 100, how="left_anti").select("sample")


@Q("jn12_asof_backward", f"with {HK} select s.sample, h.v from (select sample, obsid, feed, sample * 10 as tm from samples) s asof left join hk h on s.obsid = h.obsid and s.feed = h.feed and s.tm >= h.t")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.asof(_ticks(spark, d), _hk(spark, d), ["obsid", "feed"], "at", "t", "v").select("sample", "v")


@Q("jn13_nearest_join", f"with {HK}, b as (select s.sample, s.obsid, s.feed, s.tm, h.t as t0, h.v as v0 from (select sample, obsid, feed, sample * 10 as tm from samples) s asof left join hk h on s.obsid = h.obsid and s.feed = h.feed and s.tm >= h.t), c as (select b.*, h.t as t1, h.v as v1 from b asof left join hk h on b.obsid = h.obsid and b.feed = h.feed and b.tm <= h.t) select sample, case when t0 is null or t1 is null then null when tm - t0 <= t1 - tm then v0 else v1 end as v from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.nearest(_ticks(spark, d), _hk(spark, d), ["obsid", "feed"], "at", "t", "v").select("sample", "v")


@Q("jn14_linear_join", f"with {HK}, b as (select s.sample, s.obsid, s.feed, s.tm, h.t as t0, h.v as v0 from (select sample, obsid, feed, sample * 10 as tm from samples) s asof left join hk h on s.obsid = h.obsid and s.feed = h.feed and s.tm >= h.t), c as (select b.*, h.t as t1, h.v as v1 from b asof left join hk h on b.obsid = h.obsid and b.feed = h.feed and b.tm <= h.t) select sample, round(coalesce(case when t1 > t0 then v0 + (v1 - v0) * (tm - t0) / (t1 - t0) else v0 end, v0, v1), 9) as v from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.interpolate(_ticks(spark, d), _hk(spark, d), ["obsid", "feed"], "at", "t", "v").select("sample", F.round("v", 9).alias("v"))


@Q("jn28_pixel_gather", "with m as (select pix, sum(w * tod) / sum(w) as sky from samples group by 1) select sample, round(tod - sky, 6) as rest from samples join m using (pix)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("sample", "pix", "tod", "w")
    m = M.binned(rows, ["pix"], F.col("tod"), F.col("w")).select("pix", (F.col("total") / F.col("weight")).alias("sky"))
    return rows.join(m, "pix").select("sample", F.round(F.col("tod") - F.col("sky"), 6).alias("rest"))


@Q("ag12_auto_rms", "with r as (select feed, band, tod, row_number() over (partition by feed, band order by sample) - 1 as n from samples), p as (select feed, band, n // 2 as p, max(case when n % 2 = 1 then tod end) - max(case when n % 2 = 0 then tod end) as d from r group by 1, 2, 3) select feed, band, round(stddev_pop(d) / sqrt(2), 6) as auto_rms from p group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.pair_noise(samples(spark, d), ["feed", "band"], "sample", "tod").select("feed", "band", F.round("auto_rms", 6).alias("auto_rms"))


@Q("ag10_vane", "with m as (select feed, min(k) as least, avg(el) as load from samples group by 1), h as (select feed, avg(case when k * 3 < least * 3 + 4 then tod end) as hot, avg(case when k * 3 > 180 then tod end) as cold, any_value(load) * 0.01 + 273.15 as t from samples join m using (feed) group by 1) select feed, round(hot, 6) as hot, round(cold, 6) as cold, round((t - hot / cold * 2.73) / (hot / cold - 1), 4) as tsys, round((hot - cold) / (t - 2.73), 6) as gain from h")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", (F.col("k") * 3.0).alias("angle"), "tod", "el")
    out = S.vane(rows, ["feed"], "angle", "tod", "el")
    return out.select("feed", F.round("hot", 6).alias("hot"), F.round("cold", 6).alias("cold"), F.round("tsys", 4).alias("tsys"), F.round("gain", 6).alias("gain"))


@Q("ag13_mean_over_scans", "select feed, band, round(avg(m), 8) as mean, round(median(m), 8) as mid from (select feed, band, scan, avg(tod) as m from samples group by 1, 2, 3) group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    per = samples(spark, d).groupBy("feed", "band", "scan").agg(F.avg("tod").alias("m"))
    return per.groupBy("feed", "band").agg(F.round(F.avg("m"), 8).alias("mean"), F.round(F.percentile("m", F.lit(0.5)), 8).alias("mid"))


@Q("ag14_frequency_bins", "with r as (select sample, channel, value, (channel % 4)::double as w, 26 + channel * 0.125 as f from spectra) select sample, channel // 16 as bin, round(sum(w * value) / sum(w), 9) as value, round(sum(w * f) / sum(w), 9) as freq, sum(w) = 0 or 2 * count(*) filter (w = 0) > count(*) as masked from r group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = spectra(spark, d).withColumn("w", (F.col("channel") % 4).cast("double")).withColumn("f", 26 + F.col("channel") * 0.125)
    return S.frequency_bins(rows, ["sample"], "channel", 16, "value", "w", "f").select("sample", "bin", F.round("value", 9).alias("value"), F.round("freq", 9).alias("freq"), "masked")


@Q("ag15_bin_tod_to_map", "select pix, round(sum(w * tod), 4) as total, sum(w) as weight, count(*) as hits from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w")).withColumn("total", F.round("total", 4))


@Q("ag16_bin_tod_to_rhs", "select sample // 50 as \"offset\", round(sum(w * tod), 4) as b from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).groupBy(F.floor(F.col("sample") / 50).alias("offset")).agg(F.round(F.sum(F.col("w") * F.col("tod")), 4).alias("b"))


@Q("ag18_preconditioner", "select sample // 50 as \"offset\", 1 / greatest(sum(w) + 0.5, 1e-12) as m from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return M.preconditioner(_cells(spark, d), 0.5)


@Q("ag19_median_weight", "select median(w) as mid from (select sum(w) as w from samples group by sample // 50)")
def _(spark: SparkSession, d: str) -> DataFrame:
    (middle,) = M.quantiles(_cells(spark, d).groupBy("offset").agg(F.sum("w").alias("w")), "w", [0.5])
    return spark.range(1).select(F.lit(middle).alias("mid"))


@Q("ag21_extent", "select min(az) as az0, max(az) as az1, min(el) as el0, max(el) as el1 from samples where sample % 10 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where("sample % 10 = 0").agg(F.min("az").alias("az0"), F.max("az").alias("az1"), F.min("el").alias("el0"), F.max("el").alias("el1"))


@Q("ag22_mean_pointing", "select feed, round(avg(case when w > 1 then az end), 6) as az, round(avg(case when w > 1 then el end), 6) as el from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    on = F.col("w") > 1
    return samples(spark, d).groupBy("feed").agg(F.round(F.avg(F.when(on, F.col("az"))), 6).alias("az"), F.round(F.avg(F.when(on, F.col("el"))), 6).alias("el"))


@Q("ag23_median_mjd", "select pix, round(median(mjd), 6) as mjd, count(*) as hits from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).groupBy("pix").agg(F.round(F.percentile("mjd", F.lit(0.5)), 6).alias("mjd"), F.count(F.lit(1)).alias("hits"))


@Q("ag24_mean_mjd", "select feed, round(avg(mid), 6) as mjd, count(*) as files from (select feed, scan, (min(mjd) + max(mjd)) / 2 as mid from samples group by 1, 2) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    per = samples(spark, d).groupBy("feed", "scan").agg(((F.min("mjd") + F.max("mjd")) / 2).alias("mid"))
    return per.groupBy("feed").agg(F.round(F.avg("mid"), 6).alias("mjd"), F.count(F.lit(1)).alias("files"))


@Q("ag25_region_statistics", "with m as (select pix, sqrt(1 / sum(w)) as rms, count(*) as hits from samples group by 1) select round(avg(case when r < 5 then rms end), 6) as mean_rms, round(median(case when r < 5 then rms end), 6) as mid_rms, round(avg(case when r between 6 and 9 then hits end), 6) as ring_hits from (select *, sqrt((pix % 15 - 7) ** 2 + (pix // 15 - 7) ** 2) as r from m)")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w")).withColumn("rms", F.sqrt(1 / F.col("weight")))
    r = F.sqrt(F.pow(F.col("pix") % 15 - 7, 2) + F.pow(F.floor(F.col("pix") / 15) - 7, 2))
    m = m.withColumn("r", r)
    (middle,) = M.quantiles(m.where("r < 5"), "rms", [0.5])
    return m.agg(F.round(F.avg(F.when(F.col("r") < 5, F.col("rms"))), 6).alias("mean_rms"), F.round(F.lit(middle), 6).alias("mid_rms"), F.round(F.avg(F.when(F.col("r").between(6, 9), F.col("hits"))), 6).alias("ring_hits"))


@Q("ag27_fold", "with r as (select obsid, feed, tod, row_number() over (partition by obsid, feed order by sample) - 1 as n, count(*) over (partition by obsid, feed) // 25 as f from samples) select obsid, feed, n % 25 as phase, round(avg(tod), 6) as mean, round(stddev_pop(tod) / sqrt(count(*)), 6) as error from r where n < f * 25 and f >= 2 group by 1, 2, 3")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.fold(samples(spark, d).select("obsid", "feed", "sample", "tod"), ["obsid", "feed"], "sample", "tod", 25).select("obsid", "feed", "phase", F.round("mean", 6).alias("mean"), F.round("error", 6).alias("error"))


@Q("ag28_best_fold", "with r as (select obsid, feed, tod, row_number() over (partition by obsid, feed order by sample) - 1 as n, count(*) over (partition by obsid, feed) as c from samples), t as (select obsid, feed, p, n % p as phase, avg(tod) as m from r, range(10, 20) g(p) where n < c // p * p and c // p >= 2 group by 1, 2, 3, 4), s as (select obsid, feed, p, round(max(m) - min(m), 9) as ptp from t group by 1, 2, 3) select obsid, feed, p::bigint as period from (select *, row_number() over (partition by obsid, feed order by ptp desc, p) as k from s) where k = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return O.best_fold(samples(spark, d).select("obsid", "feed", "sample", "tod"), ["obsid", "feed"], "sample", "tod", 10, 19).select("obsid", "feed", "period")


@Q("ag30_window_medians", "select floor((mjd - m0) / 2)::bigint as bin, round(median(tod), 6) as mid, count(*) as n from samples, (select min(mjd) as m0 from samples) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("mjd", "tod")
    first = F.broadcast(rows.agg(F.min("mjd").alias("m0")))  # one row
    return rows.crossJoin(first).groupBy(F.floor((F.col("mjd") - F.col("m0")) / 2).alias("bin")).agg(F.round(F.percentile("tod", F.lit(0.5)), 6).alias("mid"), F.count(F.lit(1)).alias("n"))


@Q("ag31_factor_table", "select feed, round(avg(tod) filter (band = 0), 6) as b0, round(avg(tod) filter (band = 1), 6) as b1, round(avg(tod) filter (band = 2), 6) as b2, round(avg(tod) filter (band = 3), 6) as b3 from samples where k > 5 group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    out = samples(spark, d).where("k > 5").groupBy("feed").pivot("band", [0, 1, 2, 3]).agg(F.round(F.avg("tod"), 6))
    return out.toDF("feed", "b0", "b1", "b2", "b3")


@Q("ag32_histogram", "with c as (select quantile_cont(tod, 0.01) as lo, quantile_cont(tod, 0.99) as hi from samples) select floor((tod - lo) / (hi - lo) * 20)::bigint as bin, count(*) as n from samples, c where tod >= lo and tod < hi group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("tod")
    lo, hi = M.quantiles(rows, "tod", [0.01, 0.99])
    return rows.where((F.col("tod") >= lo) & (F.col("tod") < hi)).groupBy(F.floor((F.col("tod") - lo) / F.lit(hi - lo) * 20).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@Q("ag35_binned_image", "select floor((az - 100) / 18.5 * 8)::bigint as x, floor((el - 40) / 20 * 8)::bigint as y, round(avg(tod), 6) as mean from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.floor((F.col("az") - 100) / 18.5 * 8), F.floor((F.col("el") - 40) / 20 * 8)
    return samples(spark, d).groupBy(x.alias("x"), y.alias("y")).agg(F.round(F.avg("tod"), 6).alias("mean"))


@Q("ag42_channel_mean", "select sample, round(avg(value), 9) as mean from spectra group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return spectra(spark, d).groupBy("sample").agg(F.round(F.avg("value"), 9).alias("mean"))


@Q("ag43_offset_counts", "select feed, sum(n - n % 7)::bigint as samples, sum(n // 7)::bigint as offsets from (select feed, scan, count(*) as n from samples group by 1, 2) group by 1".replace("as samples", "as kept"))
def _(spark: SparkSession, d: str) -> DataFrame:
    per = samples(spark, d).groupBy("feed", "scan").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("feed").agg(F.sum(F.col("n") - F.col("n") % 7).alias("kept"), F.sum(F.floor(F.col("n") / 7)).alias("offsets"))


def _cells(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("chunk", F.floor(F.col("sample") / 50))
    return M.compressed(rows, "chunk", "pix", F.col("tod"), F.col("w"))


CELLS = "cells as (select sample // 50 as o, pix, sum(w) as w, sum(w * tod) as wd from samples group by 1, 2)"


@Q("kn1_atmosphere", "select feed, band, round(regr_intercept(tod, 1 / sin(radians(el))), 3) as \"offset\", round(regr_slope(tod, 1 / sin(radians(el))), 3) as tau from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    fit = S.atmosphere(samples(spark, d), ["feed", "band"], "tod")
    return fit.select("feed", "band", F.round("offset", 3).alias("offset"), F.round("tau", 3).alias("tau"))


@Q("kn3_flat_scans", "select scan, round(median(tod), 6) as \"offset\" from samples where el between 44 and 44.15 group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    fit = S.atmosphere(samples(spark, d).where("el between 44 and 44.15"), ["scan"], "tod")
    return fit.select("scan", F.round("offset", 6).alias("offset"))


@Q("kn32_less_atmosphere", "with f as (select feed, regr_intercept(tod, 1 / sin(radians(el))) as c, regr_slope(tod, 1 / sin(radians(el))) as t from samples group by 1) select sample, round(tod - c - t / sin(radians(el)), 4) as rest from samples join f using (feed)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", "tod", "el")
    return S.less_atmosphere(rows, S.atmosphere(rows, ["feed"], "tod"), ["feed"], "tod", "rest").select("sample", F.round("rest", 4).alias("rest"))


@Q("kn7_gain_solution", "with r as (select sample, band, channel, value, 1 / (40 + channel % 7) as a, (channel - 31.5) / 31.5 / (40 + channel % 7) as b from spectra), m as (select sum(a * a) as aa, sum(a * b) as ab, sum(a) as sa, sum(b * b) as bb, sum(b) as sb, count(*)::double as n from (select distinct channel, a, b from r)), s as (select sample, sum(a * value) as x, sum(b * value) as y, sum(value) as z from r group by 1) select sample, round((aa * (bb * z - sb * y) - ab * (ab * z - sa * y) + x * (ab * sb - bb * sa)) / (aa * (bb * n - sb * sb) - ab * (ab * n - sb * sa) + sa * (ab * sb - bb * sa)), 6) as gain from s, m")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("channel")
    rows = spectra(spark, d).withColumns({"a": 1 / (40 + c % 7), "b": (c - 31.5) / 31.5 / (40 + c % 7), "all": F.lit(0)})
    return S.gain(rows, ["all"], "sample", "channel", "value", ("a", "b")).select("sample", F.round("gain", 6).alias("gain"))


@Q("kn12_normalise", "select sample, round(tod / median(tod) over (partition by feed) - 1, 9) as rel from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", "tod")
    mid = rows.groupBy("feed").agg(F.percentile("tod", F.lit(0.5)).alias("m"))
    return rows.join(mid, "feed").select("sample", F.round(F.try_divide(F.col("tod"), F.col("m")) - 1, 9).alias("rel"))


@Q("kn15_noise_fit")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.noise_spectra(samples(spark, d), ["obsid", "feed"], "sample", "tod")


@Q("kn16_detrend")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.detrended(samples(spark, d), ["feed", "scan"], "sample", "tod", ["el", "az"])


@Q("kn10_prior_gain")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.prior_gain(samples(spark, d), ["obsid", "feed"], "sample", "tod", 1.0, 0.5, -2.0)


@Q("kn21_right_side", f"with {CELLS}, m as (select pix, sum(wd) / sum(w) as sky from cells group by 1) select o as \"offset\", round(sum(wd - w * sky), 4) as b from cells join m using (pix) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return M.right_side(_cells(spark, d)).select("offset", F.round("b", 4).alias("b"))


@Q("kn23_destriper_matvec", f"with {CELLS}, v as (select *, w * (o % 7 - 3) as wv from cells), m as (select pix, sum(wv) / sum(w) as sky from v group by 1) select o as \"offset\", round(sum(wv - w * sky) + 0.1 * any_value(o % 7 - 3), 6) as a from v join m using (pix) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = _cells(spark, d)
    v = cells.select("offset").distinct().withColumn("v", (F.col("offset") % 7 - 3).cast("double"))
    return M.applied(cells, v, 0.1).select("offset", F.round("a", 6).alias("a"))


@Q("kn24_destriper")
def _(spark: SparkSession, d: str) -> DataFrame:
    return M.destriped(_cells(spark, d))[0]


@Q("kn28_map_masks", "with m as (select pix, sum(w * tod) / sum(w) as naive, sqrt(1 / sum(w)) as rms, count(*) as hits from samples group by 1), e as (select *, pix % 15 < 2 or pix // 15 < 2 or pix % 15 >= 13 or pix // 15 >= 13 as edge from m), c as (select greatest(quantile_cont(hits, 0.05), 1) as low, quantile_cont(naive, 0.005) filter (not edge) as lo, quantile_cont(naive, 0.995) filter (not edge) as hi from e) select pix, case when mask = 0 then round(naive, 6) end as naive, case when mask = 0 then round(rms, 6) end as rms, case when mask = 0 then hits end as hits, mask from (select *, ((case when hits < low then 2 else 0 end) + (case when edge and not naive between lo and hi then 4 else 0 end))::bigint as mask from e, c)")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w"))
    return M.masked(m, 15, 15).select("pix", F.round("naive", 6).alias("naive"), F.round("rms", 6).alias("rms"), "hits", "mask")


@Q("kn33_line_maps", "select band as ifreq, pix, round(sum(w * tod) / sum(w), 6) as map, count(*) as hits from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d).withColumnRenamed("band", "ifreq"), ["ifreq", "pix"], F.col("tod"), F.col("w"))
    return m.select("ifreq", "pix", F.round(F.col("total") / F.col("weight"), 6).alias("map"), "hits")


@Q("kn40_polynomial_fit", "with t as (select feed, band, channel, (mjd - 59000) / 365.25 as t, measured / expected as g from flux where expected > 0), c as (select feed, band, channel, avg(t) as m from t group by all), u as (select t.*, t.t - m as u, m from t join c using (feed, band, channel)), s as (select feed, band, channel, any_value(m) as m, count(*) as n, sum(u) as s1, sum(u ** 2) as s2, sum(u ** 3) as s3, sum(u ** 4) as s4, sum(g) as y0, sum(u * g) as y1, sum(u ** 2 * g) as y2 from u group by all), k as (select *, n * (s2 * s4 - s3 * s3) - s1 * (s1 * s4 - s3 * s2) + s2 * (s1 * s3 - s2 * s2) as det, n * (s2 * y2 - y1 * s3) - s1 * (s1 * y2 - y1 * s2) + y0 * (s1 * s3 - s2 * s2) as dc, y0 * (s2 * s4 - s3 * s3) - s1 * (y1 * s4 - s3 * y2) + s2 * (y1 * s3 - s2 * y2) as da, n * (y1 * s4 - s3 * y2) - y0 * (s1 * s4 - s3 * s2) + s2 * (s1 * y2 - y1 * s2) as db from s) select feed, band, channel, n, round(da / det - db / det * m + dc / det * m * m, 4) as c0, round(db / det - 2 * dc / det * m, 4) as c1, round(dc / det, 4) as c2 from k where n >= 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).where("expected > 0").withColumn("g", F.col("measured") / F.col("expected"))
    fit = S.polynomial_fit(rows, ["feed", "band", "channel"], "mjd", "g")
    return fit.where("n >= 10").select("feed", "band", "channel", "n", *[F.round(c, 4).alias(c) for c in ("c0", "c1", "c2")])


@Q("ct9_split_maps", "select feed % 2 as split, pix, round(sum(w * tod) / sum(w), 6) as map, count(*) as hits from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("split", F.col("feed") % 2)  # a split is one more key: one job for all
    m = M.binned(rows, ["split", "pix"], F.col("tod"), F.col("w"))
    return m.select("split", "pix", F.round(F.col("total") / F.col("weight"), 6).alias("map"), "hits")
