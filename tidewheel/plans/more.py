"""Calibration models, line maps, splits, integration depth and further catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.functions import values as V
from tidewheel.operators import catalogue as C
from tidewheel.operators import maps as M
from tidewheel.operators import models as D
from tidewheel.operators import ordered as O
from tidewheel.operators import signal as S
from tidewheel.plans import steps
from tidewheel.plans.tables import Book, fields, flags, flux, observations, raw, regions, samples, spectra, summaries

book = Book()
Q = book.add


def r(c: str, n: int = 6) -> Column:
    return F.round(c, n).alias(c)


@Q("jn2_summary_inner", "select obsid, source, processing_status from summaries join observations using (obsid) where n_scans > 8")
def _(spark: SparkSession, d: str) -> DataFrame:
    return summaries(spark, d).where("n_scans > 8").join(observations(spark, d), "obsid").select("obsid", "source", "processing_status")


@Q("jn10_flag_application", "select f.obsid, pixel, band from flags f where exists (select 1 from summaries s where s.obsid = f.obsid and s.n_scans % 8 = f.band)")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = summaries(spark, d).select("obsid", (F.col("n_scans") % 8).alias("band"))
    return flags(spark, d).join(cells, ["obsid", "band"], "left_semi").select("obsid", "pixel", "band")


@Q("jn15_nearest_calibrator", "with cal as (select feed, mjd as t, max(tod) as g from samples where k < 4 group by 1, 2), a as (select s.sample, s.feed, s.mjd, c.t as t0, c.g as g0 from samples s asof left join cal c on s.feed = c.feed and s.mjd >= c.t), b as (select a.*, c.t as t1, c.g as g1 from a asof left join cal c on a.feed = c.feed and a.mjd <= c.t) select sample, case when t0 is not null and (t1 is null or mjd - t0 <= t1 - mjd) then g0 else g1 end as g from b")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    cal = rows.where("k < 4").groupBy("feed", "mjd").agg(F.max("tod").alias("g"))
    return D.nearest_in_time(rows.select("sample", "feed", "mjd"), cal, ["feed"], "mjd", "g").select("sample", "g")


@Q("jn18_paths_of_fields", "select f.field, o.obsid, o.level2_path from fields f join (select *, list_extract(['NATION_1', 'NATION_2', 'NATION_3', 'NATION_9'], obsid % 4 + 1) as field from observations where source_group in ('Galactic', 'Foreground') and level2_path <> '') o using (field)")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).where(F.col("source_group").isin("Galactic", "Foreground") & (F.col("level2_path") != ""))
    o = o.withColumn("field", F.element_at(F.array(*map(F.lit, ["NATION_1", "NATION_2", "NATION_3", "NATION_9"])), (F.col("obsid") % 4 + 1).cast("int")))
    return fields(spark, d).select("field").join(o, "field").select("field", "obsid", "level2_path")


@Q("jn20_map_stems", "select obsid, split_part(split_part(stem, '_band', 1), '_feed', 1) as key, coalesce(s.n_scans, -1) as n from (select obsid, 'map' || obsid || case when obsid % 2 = 0 then '_band1' else '_feed3' end as stem from observations) o left join summaries s using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    stem = F.concat(F.lit("map"), F.col("obsid"), F.when(F.col("obsid") % 2 == 0, "_band1").otherwise("_feed3"))
    rows = observations(spark, d).select("obsid", F.regexp_extract(stem, r"^(.*?)(_band|_feed)", 1).alias("key"))
    return rows.join(summaries(spark, d).select("obsid", "n_scans"), "obsid", "left").select("obsid", "key", F.coalesce("n_scans", F.lit(-1).cast("bigint")).alias("n"))


@Q("jn21_level1_level2", "with g as (select band, channel, avg(value) as g from spectra group by 1, 2) select sample, channel, round(value / nullif(g, 0), 6) as cal from spectra join g using (band, channel) where abs(g) > 1e-3 and channel between 3 and 20")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = spectra(spark, d).where("channel between 3 and 20")
    g = rows.groupBy("band", "channel").agg(F.avg("value").alias("g")).where("abs(g) > 1e-3")
    return rows.join(g, ["band", "channel"]).select("sample", "channel", F.round(F.try_divide("value", "g"), 6).alias("cal"))


@Q("jn22_calibration_factors", "with m as (select feed, avg(tod) / 250 as c from samples group by 1 having feed <> 4) select sample, round(tod / (case when coalesce(c, 1) >= 0.3 then coalesce(c, 1) end), 6) as tod from samples left join m using (feed)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("sample", "feed", "tod", "mjd")
    models = rows.where("feed <> 4").groupBy("feed").agg(F.array(F.avg("tod") / 250).alias("coeffs"))
    return D.calibrated(rows, models, ["feed"], "tod").select("sample", r("tod"))


@Q("jn23_noise_prior", "select sample, round(1 + p * p * pow(k + 1, -1.5), 6) as prior from samples join (select feed, avg(w) as p from samples group by 1) using (feed)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    prior = rows.groupBy("feed").agg(F.avg("w").alias("p"))
    return rows.join(F.broadcast(prior), "feed").select("sample", F.round(K.power_law(F.lit(1.0), F.col("p"), F.lit(-1.5), F.col("k") + 1.0), 6).alias("prior"))


@Q("jn26_model_residual", "with m as (select feed, band, channel, avg(expected) as e from flux group by all) select obsid, feed, band, channel, round(measured - e, 7) as res from flux join m using (feed, band, channel)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d)
    m = rows.groupBy("feed", "band", "channel").agg(F.avg("expected").alias("e"))
    return rows.join(m, ["feed", "band", "channel"]).select("obsid", "feed", "band", "channel", F.round(F.col("measured") - F.col("e"), 7).alias("res"))


@Q("jn27_best_observation", "select band, obsid, level2_path from (select band, obsid, row_number() over (partition by band order by auto_rms, obsid, pixel) as n from flags where is_good) join observations using (obsid) where n = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    best = D.top_row(flags(spark, d).where("is_good"), ["band"], F.col("auto_rms"), F.col("obsid"), F.col("pixel")).select("band", "obsid")
    return best.join(observations(spark, d).select("obsid", "level2_path"), "obsid").select("band", "obsid", "level2_path")


@Q("ag17_offset_to_map", "with c as (select sample // 50 as o, pix, sum(w) as w from samples group by 1, 2) select pix, round(sum(w * (o % 5)) / sum(w), 6) as offset_map from c group by 1 having sum(w) > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = M.compressed(samples(spark, d).withColumn("o", F.floor(F.col("sample") / 50)), "o", "pix", F.col("tod"), F.col("w"))
    v = cells.select("offset").distinct().withColumn("v", (F.col("offset") % 5).cast("double"))
    return M.offset_map(cells, v).select("pix", r("offset_map"))


@Q("ag20_global_sums", "select round(sum(w * tod), 3) as dot, sum(w) as weight, count(*) as n from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).agg(F.round(F.sum(F.col("w") * F.col("tod")), 3).alias("dot"), F.sum("w").alias("weight"), F.count(F.lit(1)).alias("n"))


@Q("ag26_aperture", "select f.field, count(*) as n, round(median(brightness), 6) as mid, round(quantile_cont(brightness, 0.16), 6) as p16, round(quantile_cont(brightness, 0.84), 6) as p84 from fields f join regions r on sqrt((f.l - r.l) ** 2 + (f.b - r.b) ** 2) < 12 group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    # both sides lie in cells of 12 degrees; an aperture reaches the neighbouring cells
    cell = lambda c, k=0: F.floor(F.col(c) / 12) + k
    f = fields(spark, d).select("field", F.col("l").alias("fl"), F.col("b").alias("fb"), F.explode(F.array(*[F.struct(cell("l", i).alias("i"), cell("b", j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("c"))
    near = f.select("field", "fl", "fb", "c.i", "c.j").join(regions(spark, d).withColumn("i", cell("l")).withColumn("j", cell("b")), ["i", "j"])
    near = near.where(F.sqrt(F.pow(F.col("fl") - F.col("l"), 2) + F.pow(F.col("fb") - F.col("b"), 2)) < 12)
    p = F.percentile("brightness", F.array(F.lit(0.5), F.lit(0.16), F.lit(0.84)))
    return near.groupBy("field").agg(F.count(F.lit(1)).alias("n"), p.alias("p")).select("field", "n", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("mid", "p16", "p84"))])


@Q("ag29_noise_table", "select pixel, band, round(median(auto_rms), 6) as tsys, round(avg(nullif(red_noise, 0)), 9) as red, round(avg(nullif(noise_index, 0)), 9) as idx from flags group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    zero = lambda c: F.nullif(F.col(c), F.lit(0.0))
    return flags(spark, d).groupBy("pixel", "band").agg(F.round(F.percentile("auto_rms", F.lit(0.5)), 6).alias("tsys"), F.round(F.avg(zero("red_noise")), 9).alias("red"), F.round(F.avg(zero("noise_index")), 9).alias("idx"))


@Q("ag33_log_bins", "select floor(log10(k + 1) * 10)::bigint as bin, count(*) as n, round(avg(tod), 6) as p from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).groupBy(F.floor(F.log10(F.col("k") + 1.0) * 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("tod"), 6).alias("p"))


@Q("ag34_angle_profile", "with n as (select k, (tod - min(tod) over (partition by feed)) / (max(tod) over (partition by feed) - min(tod) over (partition by feed)) as v from samples) select k // 8 as bin, round(avg(v), 6) as mean from n group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "k", "tod")
    ends = rows.groupBy("feed").agg(F.min("tod").alias("lo"), F.max("tod").alias("hi"))
    v = F.try_divide(F.col("tod") - F.col("lo"), F.col("hi") - F.col("lo"))
    return rows.join(ends, "feed").groupBy(F.floor(F.col("k") / 8).alias("bin")).agg(F.round(F.avg(v), 6).alias("mean"))


@Q("wn3_feature_fallback", "select scan, case when bool_or(k = 8) then 8 when bool_or(k = 9) then 9 when bool_or(k = 10) then 10 end::bigint as feature from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    has = [F.max(F.when(F.col("k") == f, f)) for f in (8, 9, 10)]
    return samples(spark, d).groupBy("scan").agg(F.coalesce(*has).cast("bigint").alias("feature"))


@Q("wn7_trend", "with r as (select obsid, feed, measured, row_number() over (partition by feed, source order by mjd, obsid, measured, channel, band) as n, count(*) over (partition by feed, source) as c, source from flux), p as (select *, unnest([n, case when n <= 4 then 1 - n end, case when n > c - 4 then 2 * c + 1 - n end]) as pos from r), m as (select *, median(measured) over (partition by feed, source order by pos range between 4 preceding and 4 following) as mid from p where pos is not null) select obsid, feed, source, round(mid, 4) as trend from m where pos = n")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).select("obsid", "feed", "source", "measured", F.struct("mjd", "obsid", "measured", "channel", "band").alias("order"))
    return O.reflected_median(rows, ["feed", "source"], "order", "measured", 9, "trend").select("obsid", "feed", "source", r("trend", 4))


@Q("wn19_alternate", "select obsid, (n % 2)::bigint as half from (select obsid, row_number() over (partition by source_group order by obsid) - 1 as n from observations)")
def _(spark: SparkSession, d: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("source_group").orderBy("obsid")) - 1
    return observations(spark, d).select("obsid", (n % 2).cast("bigint").alias("half"))


@Q("wn22_reference_curve", "with c as (select pix, chunk, sum(h) over (partition by pix order by chunk rows unbounded preceding) as h, sum(w) over (partition by pix order by chunk rows unbounded preceding) as w from (select pix, sample // 2500 as chunk, count(*) as h, sum(w) as w from samples group by 1, 2)) select pix, chunk, round(first_value(sqrt(1 / w) * sqrt(h)) over (partition by pix order by chunk) / sqrt(h), 6) as ref from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = M.binned(samples(spark, d).withColumn("chunk", F.floor(F.col("sample") / 2500)), ["chunk", "pix"], F.col("tod"), F.col("w"))
    k = Window.partitionBy("pix").orderBy("chunk")
    run = k.rowsBetween(Window.unboundedPreceding, 0)
    c = c.select("pix", "chunk", F.sum("hits").over(run).alias("h"), F.sum("weight").over(run).alias("w"))
    return c.select("pix", "chunk", F.round(F.first(F.sqrt(1 / F.col("w")) * F.sqrt("h"), ignorenulls=True).over(run) / F.sqrt("h"), 6).alias("ref"))


@Q("wn24_down_sampling", "with r as (select feed, sample, az, row_number() over (partition by feed order by sample) - 1 as n from samples), g as (select *, last_value(case when n % 10 = 0 then n end ignore nulls) over a as n0, last_value(case when n % 10 = 0 then az end ignore nulls) over a as v0, first_value(case when n % 10 = 0 then n end ignore nulls) over b as n1, first_value(case when n % 10 = 0 then az end ignore nulls) over b as v1 from r window a as (partition by feed order by sample rows between unbounded preceding and current row), b as (partition by feed order by sample rows between current row and unbounded following)) select sample, round(coalesce(case when n1 > n0 then v0 + (v1 - v0) * (n - n0) / (n1 - n0) else v0 end, v0, v1), 6) as az from g")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", "az").withColumn("n", F.row_number().over(Window.partitionBy("feed").orderBy("sample")) - 1)
    return O.fill_gaps(rows, ["feed"], "sample", "az", F.col("n") % 10 == 0, "out").select("sample", F.round("out", 6).alias("az"))


@Q("st4_multi_key", "select source, started, obsid from observations order by source desc, started, obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("source", "started", "obsid").orderBy(F.desc("source"), "started", "obsid")


@Q("st8_first_passing", "select obsid, level2_path from observations where level2_path <> '' and source = 'CygA' order by obsid limit 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where("level2_path <> '' and source = 'CygA'").select("obsid", "level2_path").orderBy("obsid").limit(1)


@Q("st9_frequency_sort", "select sample, list(value order by -channel)[1] as first, list(value order by -channel)[64] as last from spectra group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = spectra(spark, d).groupBy("sample").agg(F.sort_array(F.collect_list(F.struct((-F.col("channel")).alias("c"), "value"))).alias("v"))
    return rows.select("sample", F.col("v")[0]["value"].alias("first"), F.element_at("v", 64)["value"].alias("last"))


@Q("st10_valid_by_longitude", "select region, l from regions where brightness > 0 order by l, region")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).where("brightness > 0").select("region", "l").orderBy("l", "region")


@Q("so3_concat", "select region as name, l, b, brightness from regions union all select field, l, b, null from fields")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).withColumnRenamed("region", "name").unionByName(fields(spark, d).select(F.col("field").alias("name"), "l", "b"), allowMissingColumns=True)


@Q("so8_day_night", "select sample, case when sin(mjd * 6.283) > 0.1 then 'day' else 'night' end as split from samples where abs(sin(mjd * 6.283) - 0.1) > 1e-9")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("sun_altitude", F.sin(F.col("mjd") * 6.283)).where("abs(sun_altitude - 0.1) > 1e-9")
    return steps.split_keys(rows, "day_night", threshold=0.1).select("sample", "split")


@Q("mu3_add_flags", "with c as (select obsid, pixel, band, false as is_good from flags where n_spikes > 1) select f.obsid, f.pixel, f.band, coalesce(c.is_good, f.is_good) as is_good from flags f left join c using (obsid, pixel, band)")
def _(spark: SparkSession, d: str) -> DataFrame:
    old = flags(spark, d)
    new = old.where("n_spikes > 1").select("obsid", "pixel", "band", F.lit(False).alias("is_good"))
    return C.upsert(old.select("obsid", "pixel", "band", "is_good"), new, ["obsid", "pixel", "band"])


@Q("mu5_update_statistics", "with c as (select obsid, pixel, band, auto_rms * 2 as auto_rms from flags where band = 2 union all select 900000000, 1, 1, 5.0) select coalesce(f.obsid, c.obsid) as obsid, coalesce(f.pixel, c.pixel) as pixel, coalesce(f.band, c.band) as band, case when f.obsid is null then true else f.is_good end as is_good, coalesce(c.auto_rms, f.auto_rms) as auto_rms from flags f full join c on f.obsid = c.obsid and f.pixel = c.pixel and f.band = c.band")
def _(spark: SparkSession, d: str) -> DataFrame:
    old = flags(spark, d).select("obsid", "pixel", "band", "is_good", "auto_rms")
    new = old.where("band = 2").select("obsid", "pixel", "band", (F.col("auto_rms") * 2).alias("auto_rms")).unionByName(spark.createDataFrame([(900000000, 1, 1, 5.0)], "obsid long, pixel long, band long, auto_rms double"))
    return C.upsert(old, new, ["obsid", "pixel", "band"], {"is_good": F.lit(True)})


@Q("mu6_update_summary", "select obsid, case when obsid = 42 then 'complete' else processing_status end as processing_status, median_tsys from summaries")
def _(spark: SparkSession, d: str) -> DataFrame:
    old = summaries(spark, d).select("obsid", "processing_status", "median_tsys")
    return C.upsert(old, spark.createDataFrame([(42, "complete")], "obsid long, processing_status string"), ["obsid"])


@Q("mu9_upsert_model", "with m as (select feed, band, channel, avg(measured) as g from flux where source <> 'CygA' group by all), n as (select feed, band, channel, max(measured) as g from flux where source = 'CygA' and feed < 5 group by all) select coalesce(m.feed, n.feed) as feed, coalesce(m.band, n.band) as band, coalesce(m.channel, n.channel) as channel, round(coalesce(n.g, m.g), 4) as g from m full join n on m.feed = n.feed and m.band = n.band and m.channel = n.channel")
def _(spark: SparkSession, d: str) -> DataFrame:
    keys = ["feed", "band", "channel"]
    old = flux(spark, d).where("source <> 'CygA'").groupBy(*keys).agg(F.avg("measured").alias("g"))
    new = flux(spark, d).where("source = 'CygA' and feed < 5").groupBy(*keys).agg(F.max("measured").alias("g"))
    return C.upsert(old, new, keys).select(*keys, r("g", 4))


@Q("sf3_name_digits", "select obsid, nullif(regexp_extract(level2_path, '([0-9]{7})', 1), '')::bigint as id from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.nullif(F.regexp_extract("level2_path", "([0-9]{7})", 1), F.lit("")).cast("bigint").alias("id"))


@Q("sf4_stem_tokens", "select obsid, split_part(stem, '_', 2) as epoch, array_to_string(str_split(stem, '_')[3:], '_') as rest from (select obsid, 'map_e' || obsid % 5 || '_lstgrp_' || obsid % 3 || '_x' as stem from observations)")
def _(spark: SparkSession, d: str) -> DataFrame:
    parts = F.split(F.concat(F.lit("map_e"), F.col("obsid") % 5, F.lit("_lstgrp_"), F.col("obsid") % 3, F.lit("_x")), "_")
    return observations(spark, d).select("obsid", F.get(parts, F.lit(1)).alias("epoch"), F.array_join(F.slice(parts, 3, 9), "_").alias("rest"))


@Q("sf7_strict_time", "select obsid, strptime(strftime(started, '%d/%m/%Y'), '%d/%m/%Y') as day from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.to_timestamp(F.date_format("started", "dd/MM/yyyy"), "dd/MM/yyyy").cast("timestamp_ntz").alias("day"))


@Q("sf30_dynamic_grid", "select (min(az) + max(az)) / 2 as az0, (min(el) + max(el)) / 2 as el0, (ceil((max(az) - min(az) + 2) / 0.5)::bigint // 2 * 2 + 1) as nx, (ceil((max(el) - min(el) + 2) / 0.5)::bigint // 2 * 2 + 1) as ny from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    size = lambda c: (F.floor(F.ceil((F.max(c) - F.min(c) + 2) / 0.5) / 2) * 2 + 1).cast("bigint")
    return samples(spark, d).agg(((F.min("az") + F.max("az")) / 2).alias("az0"), ((F.min("el") + F.max("el")) / 2).alias("el0"), size("az").alias("nx"), size("el").alias("ny"))


@Q("sf34_dispatch", "with x as (select distinct source, mjd, log10(30) as x, 2000 + (mjd - 51544.5) / 365.25 - 2005 as y from flux) select source, count(*) as n from x where source in ('TauA', 'CasA', 'CygA') group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).select("source", "mjd").distinct().withColumn("jy", K.model_flux(F.col("source"), F.lit(30.0), F.col("mjd")))
    return rows.where("jy is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@Q("sf36_seasonal_factor", "with f as (select sample, 0.4 * sin(2 * pi() * (mjd - 59000 - 20) / 365.25) + 0.01 * (mjd - 59000) / 365.25 + 0.5 as f from samples) select sample, round(case when f >= 0.3 then f end, 6) as f from f")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(D.seasonal_factor(F.col("mjd"), 0.4, 20.0, 365.25, 0.01, 0.5), 6).alias("f"))


@Q("sf38_legendre", "with u as (select sample, 2 * (el - min(el) over (partition by scan)) / nullif(max(el) over (partition by scan) - min(el) over (partition by scan), 0) - 1 as x from samples) select sample, round(coalesce(x, 0), 6) as p1, round(coalesce((3 * x * x - 1) / 2, -0.5), 6) as p2 from u")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("scan", "sample", "el")
    ends = rows.groupBy("scan").agg(F.min("el").alias("lo"), F.max("el").alias("hi"))
    x = F.coalesce(2 * F.try_divide(F.col("el") - F.col("lo"), F.col("hi") - F.col("lo")) - 1, F.lit(0.0))
    return rows.join(ends, "scan").withColumn("x", x).select("sample", F.round("x", 6).alias("p1"), F.round((3 * F.col("x") * F.col("x") - 1) / 2, 6).alias("p2"))


@Q("sf42_json", "select obsid, sha256('{\"obsid\":' || obsid || ',\"n\":' || obsid % 7 || '}') as digest from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.sha2(F.to_json(F.struct("obsid", (F.col("obsid") % 7).alias("n"))), 256).alias("digest"))


@Q("sf43_wildcards", "select obsid, source from observations where source ilike 'g_ield1%' or source ilike 'gfield1_, %'")
def _(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("source")
    return observations(spark, d).where(V.wildcard(s, "g?ield1*") | V.wildcard(s, "gfield1?, *")).select("obsid", "source")


@Q("sf45_mask_bits", "select pix, (case when h = 0 then 1 else 0 end | case when h < 40 then 2 else 0 end | case when pix < 15 then 4 else 0 end)::bigint as bits from (select pix, count(*) as h from samples group by 1)")
def _(spark: SparkSession, d: str) -> DataFrame:
    h = samples(spark, d).groupBy("pix").agg(F.count(F.lit(1)).alias("h"))
    return h.select("pix", V.map_mask(F.col("h"), F.col("h") < 40, F.col("pix") < 15).cast("bigint").alias("bits"))


@Q("kn13_valid_noise", "with e as (select feed, min(sample) as a, max(sample) as b from samples where k = 7 group by 1), r as (select s.feed, tod, row_number() over (partition by s.feed order by sample) - 1 as n from samples s join e on s.feed = e.feed and sample >= a and sample < b), p as (select feed, n // 2 as p, max(case when n % 2 = 1 then tod end) - max(case when n % 2 = 0 then tod end) as d from r group by 1, 2) select feed, round(stddev_pop(d) / sqrt(2), 6) as auto_rms from p group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", "tod", "k")
    ends = rows.where("k = 7").groupBy("feed").agg(F.min("sample").alias("a"), F.max("sample").alias("b"))
    return O.pair_noise(rows.join(ends, "feed").where("sample >= a and sample < b"), ["feed"], "sample", "tod").select("feed", r("auto_rms"))


@Q("kn4_post_clean")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Running median, outliers by the residual's noise, an atmosphere fit of the rest, a second running median."""
    keys = ["feed"]
    rows = S.long_median(samples(spark, d).select("feed", "sample", "tod"), keys, "sample", "tod", 51, "mid").withColumn("rest", F.col("tod") - F.col("mid"))
    noise = O.pair_noise(rows, keys, "sample", "rest")
    rows = rows.join(noise, keys).join(samples(spark, d).select("sample", "el"), "sample")
    fit = S.atmosphere(rows.where("abs(rest) <= 5 * auto_rms"), keys, "tod")
    clean = S.less_atmosphere(rows.select("feed", "sample", "tod", "el"), fit, keys, "tod", "flat")
    return S.long_median(clean.select("feed", "sample", "flat"), keys, "sample", "flat", 51, "slow").select("feed", "sample", (F.col("flat") - F.col("slow")).alias("clean"))


@Q("kn27_convergence", "with c as (select sample // 50 as o, sum(w * tod) / sum(w) as v from samples group by 1) select round(sqrt(sum(v * v)), 4) as norm, count(*) as n from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = samples(spark, d).groupBy(F.floor(F.col("sample") / 50).alias("o")).agg((F.sum(F.col("w") * F.col("tod")) / F.sum("w")).alias("v"))
    return c.agg(F.round(F.sqrt(F.sum(F.col("v") * F.col("v"))), 4).alias("norm"), F.count(F.lit(1)).alias("n"))


@Q("kn29_line_mask", "with m as (select pix, sum(w * tod) / sum(w) as m, count(*) as h from samples group by 1) select pix, round(case when h > q then m end, 6) as map from m, (select quantile_cont(h, 0.05) as q from m)")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w"))
    (q,) = M.quantiles(m, "hits", [0.05])
    return m.select("pix", F.round(F.when(F.col("hits") > q, F.col("total") / F.col("weight")), 6).alias("map"))


@Q("kn30_line_window", "with c as (select band, channel, 26 + band * 2 + channel * 0.03125 as f from (select distinct band, channel from spectra)), b as (select band, min(f) as f0, max(f) as f1, arg_min(channel, abs(f - 28.51)) as nearest, max(channel) as top from c group by 1) select band, greatest(nearest - 5, 0) as low, least(nearest + 5, top) as high, nearest from b where f0 < 28.51 and f1 > 28.51 order by band limit 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = spectra(spark, d).select("band", "channel").distinct().withColumn("freq", 26 + F.col("band") * 2 + F.col("channel") * 0.03125)
    return D.line_window(c, 28.51, 5)


@Q("kn31_bad_flags", "select obsid, pixel, band, (not is_good or coalesce(red_noise > 0.08, false) or coalesce(auto_rms > 48, false) or coalesce(noise_index < -1.5, false)) as bad from flags")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).select("obsid", "pixel", "band", D.bad_flags(0.08, 48.0).alias("bad"))


@Q("kn38_pointing_table", "select region, round((l - 180) * cos(radians(b)) * 60, 6) as daz, round((b - 1) * 60, 6) as del from regions where b > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = regions(spark, d).where("b > 0")
    return rows.select("region", F.round((F.col("l") - 180) * F.cos(F.radians("b")) * 60, 6).alias("daz"), F.round((F.col("b") - 1) * 60, 6).alias("del"))


@Q("kn39_gain_ratios", "with g as (select *, measured / expected as gain from flux where chi2 < 30 and expected > 0 and measured / expected between 0.3 and 3) select obsid, feed, band, channel, round(gain, 6) as gain from g where (feed, band, channel) in (select (feed, band, channel) from g group by feed, band, channel having count(*) >= 10)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return D.gain_ratios(flux(spark, d), 30.0).select("obsid", "feed", "band", "channel", r("gain"))


@Q("kn40_mean_model", "with g as (select feed, band, channel, measured / expected as gain from flux where chi2 < 30 and expected > 0 and measured / expected between 0.3 and 3) select feed, band, channel, round(avg(gain), 6) as c0, round(stddev_pop(gain), 6) as rms, count(*) as n from g group by all having count(*) >= 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = D.mean_models(D.gain_ratios(flux(spark, d), 30.0))
    return m.select("feed", "band", "channel", F.round(F.col("coeffs")[0], 6).alias("c0"), r("rms"), "n")


@Q("kn41_load_models", "select obsid, round(1.5 + 0.25 * x, 9) as g from (select obsid, case when obsid % 3 = 0 then -2.0 else (obsid % 11)::double end as x from observations) where x >= 0 union all select obsid, 1.0 from observations where obsid % 3 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("obsid") % 3 == 0, F.lit("")).otherwise(F.lit("[1.5,0.25]"))
    coeffs = F.coalesce(F.from_json(F.nullif(text, F.lit("")), "array<double>"), F.array(F.lit(1.0)))
    return observations(spark, d).select("obsid", F.round(V.polynomial(coeffs, (F.col("obsid") % 11).cast("double")), 9).alias("g"))


@Q("kn42_temperature_line", "select round(regr_slope(log10(p_retailprice), log10(p_size)), 6) as slope, round(regr_intercept(log10(p_retailprice), log10(p_size)), 6) as intercept from part where p_size > 0 and p_retailprice > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    fit = D.power_fit(raw(spark, d, "part").where("p_size > 0 and p_retailprice > 0"), "p_size", "p_retailprice")
    return fit.select(r("slope"), r("intercept"))


@Q("kn43_calibration_factor", "select obsid, feed, round(expected / nullif(measured, 0), 6) as f from flux where source = 'TauA'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).where("source = 'TauA'").select("obsid", "feed", F.round(F.try_divide("expected", "measured"), 6).alias("f"))


@Q("kn45_region_masks", "select pix, sqrt((pix % 15 - 7) ** 2 + (pix // 15 - 7) ** 2) < 4 as inside from (select distinct pix from samples)")
def _(spark: SparkSession, d: str) -> DataFrame:
    x, y = F.col("pix") % 15 - 7, F.floor(F.col("pix") / 15) - 7
    return samples(spark, d).select("pix").distinct().select("pix", (F.sqrt(F.pow(x, 2) + F.pow(y, 2)) < 4).alias("inside"))


@Q("kn34_source_fit")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", ((F.col("az") - 109) / 10).alias("x"), ((F.col("el") - 50) / 10).alias("y"), "tod")
    return S.source_fits(rows, ["feed"], "sample", "x", "y", "tod", 0.3, 0.8)


@Q("ct7_resolve_files", "select obsid, level2_path from observations o where source_group in ('Galactic', 'Foreground') and level2_path <> '' and exists (select 1 from flags f where f.obsid = o.obsid and is_good)")
def _(spark: SparkSession, d: str) -> DataFrame:
    good = flags(spark, d).where("is_good").select("obsid")
    return C.by_group(observations(spark, d), "Galactic", least=None, most=None).where("level2_path <> ''").join(good, "obsid", "left_semi").select("obsid", "level2_path")


@Q("ct11_chunk_files", "select obsid, (row_number() over (order by obsid) - 1) // 20 as chunk from observations o where source ilike '%field%' and obsid between 50 and 2000 and level2_path is not null and not exists (select 1 from flags f where f.obsid = o.obsid group by f.obsid having not bool_or(is_good))")
def _(spark: SparkSession, d: str) -> DataFrame:
    bad = flags(spark, d).groupBy("obsid").agg(F.bool_or("is_good").alias("g")).where("not g")
    rows = observations(spark, d).where(F.col("source").ilike("%field%") & F.col("obsid").between(50, 2000) & F.col("level2_path").isNotNull()).join(bad, "obsid", "left_anti")
    n = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("obsid")) - 1  # a list of files, as small as a job's plan
    return rows.select("obsid", F.floor(n / 20).alias("chunk"))
