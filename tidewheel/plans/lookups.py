"""Catalogue lookups, joins, counts, set operations and updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import values as V
from tidewheel.operators import catalogue as C
from tidewheel.plans.tables import Book, fields, flags, flux, observations, raw, regions, samples, summaries

book = Book()
Q = book.add
BLANK = "(level2_path is null or level2_path = '')"


@Q("pr1_query_data", "select * from observations where obsid = 42")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where("obsid = 42")


@Q("pr2_obsid_exists", "select obsid, obsid in (select obsid from observations) as found from (values (5::bigint), (999999999::bigint)) t(obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    asked = spark.createDataFrame([(5,), (999999999,)], "obsid long")
    have = observations(spark, d).select("obsid").distinct().withColumn("_f", F.lit(True))
    return have.join(F.broadcast(asked), "obsid", "right").select("obsid", F.coalesce("_f", F.lit(False)).alias("found"))


@Q("pr3_all_obsids", "select obsid from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid")


@Q("pr4_source_group_list", "select obsid, source, source_group from observations where source_group in ('Galactic', 'Foreground') and source ilike 'gfield1%' and obsid between 100 and 1000000")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.by_group(observations(spark, d), "Galactic", "gfield1*", 100).select("obsid", "source", "source_group")


@Q("pr4_strict_group", "select obsid, source_group from observations where source_group = 'CO' and obsid between 100 and 1000000")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.by_group(observations(spark, d), "CO", None, 100, strict=True).select("obsid", "source_group")


@Q("pr5_obsid_list", "select obsid, source from observations where obsid >= 700 and obsid in (select l_orderkey from lineitem where l_quantity > 45)")
def _(spark: SparkSession, d: str) -> DataFrame:
    ids = raw(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("obsid"))
    return C.by_ids(observations(spark, d), ids, 700).select("obsid", "source")


@Q("pr6_get_files", "select obsid, level2_path from observations where source_group = 'Calibrator' and source = 'Field of view' and obsid > 50")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where((F.col("source_group") == "Calibrator") & (F.col("source") == "Field of view") & (F.col("obsid") > 50)).select("obsid", "level2_path")


@Q("pr7_quality_flags", "select pixel, band, is_good, auto_rms from flags where obsid = 42")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).where("obsid = 42").select("pixel", "band", "is_good", "auto_rms")


@Q("pr8_bad_data_points", "select obsid, pixel, band from flags where not is_good")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).where(~F.col("is_good")).select("obsid", "pixel", "band")


@Q("pr9_scan_flags", "select o.obsid, case when not f.is_good then false end as usable from observations o left join flags f on o.obsid = f.obsid and f.pixel = 3 and f.band = 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = flags(spark, d).where("pixel = 3 and band = 2").select("obsid", "is_good")
    return observations(spark, d).join(own, "obsid", "left").select("obsid", F.when(~F.col("is_good"), F.lit(False)).alias("usable"))


@Q("pr10_calibration_flux", "select obsid, source, mjd, measured from flux where source = 'CasA' and obsid between 10 and 400")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).where((F.col("source") == "CasA") & F.col("obsid").between(10, 400)).select("obsid", "source", "mjd", "measured").orderBy("obsid")


@Q("pr11_tsys_range", "select obsid, source, median_tsys from observations join summaries using (obsid) where median_tsys between 50 and 400 and source ilike '%field%' order by median_tsys desc, obsid limit 25")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).join(summaries(spark, d), "obsid").where(F.col("median_tsys").between(50, 400) & F.col("source").ilike("%field%"))
    return rows.select("obsid", "source", "median_tsys").orderBy(F.desc("median_tsys"), "obsid").limit(25)


@Q("pr12_failed_and_status", "select obsid, processing_status, source from observations join summaries using (obsid) where processing_status = 'failed' order by obsid limit 40")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).join(summaries(spark, d), "obsid").where("processing_status = 'failed'")
    return rows.select("obsid", "processing_status", "source").orderBy("obsid").limit(40)


@Q("pr13_query_target", "select obsid, source, source_group from observations where source ilike '%field%' and level2_path is not null and source_group in ('Foreground', 'Galactic', 'Calibrator') and obsid between 20 and 900")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where(F.col("source").ilike("%field%") & F.col("level2_path").isNotNull() & F.col("source_group").isin("Foreground", "Galactic", "Calibrator"))
    return rows.where(F.col("obsid").between(20, 900)).select("obsid", "source", "source_group")


@Q("pr14_stats_exist", "select obsid, pixel, band, coalesce(red_noise, white_noise) is not null as has_stats from flags")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).select("obsid", "pixel", "band", F.coalesce("red_noise", "white_noise").isNotNull().alias("has_stats"))


@Q("pr15_missing_level2", f"select obsid, source from observations where {BLANK} and coalesce(source_group, '') <> 'SkyDip'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where(V.blank(F.col("level2_path")) & (F.coalesce("source_group", F.lit("")) != "SkyDip")).select("obsid", "source")


@Q("pr15_path_search", "select obsid, level2_path from observations where level2_path ilike '%scope-00001%' or source ilike '%jup%'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where(F.col("level2_path").ilike("%scope-00001%") | F.col("source").ilike("%jup%")).select("obsid", "level2_path")


@Q("pr16_flags_in_window", "select f.obsid, pixel, band from flags f join observations o using (obsid) where source_group in ('Galactic', 'CO') and epoch_us(started) / 86400e6 + 40587.0 between 50000 and 50400")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = observations(spark, d).where(F.col("source_group").isin("Galactic", "CO") & V.mjd(F.col("started")).between(50000, 50400)).select("obsid")
    return flags(spark, d).join(own, "obsid").select("obsid", "pixel", "band")


@Q("pr18_download_list", "select obsid, source from observations where not contains(lower(source), 'co') and obsid > 30 and obsid not in (select obsid from summaries)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where(~F.lower("source").contains("co") & (F.col("obsid") > 30)).select("obsid", "source")
    return rows.join(summaries(spark, d).select("obsid"), "obsid", "left_anti")


@Q("pr21_finite_masks", "select sample, tod / nullif(k - 50, 0) as ratio from samples where k <> 50 and el > 45")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("ratio", V.clean(F.try_divide(F.col("tod"), (F.col("k") - 50).cast("double"))))
    return rows.where("ratio is not null and el > 45").select("sample", "ratio")


@Q("pr22_elevation_sanity", "select s.sample, s.scan from samples s join (select feed, scan from samples group by 1, 2 having bool_and(el is not null and el >= 0 and el <= 59.5)) using (feed, scan)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    good = rows.groupBy("feed", "scan").agg(F.bool_and(F.col("el").isNotNull() & F.col("el").between(0, 59.5)).alias("ok")).where("ok")
    return rows.join(good, ["feed", "scan"], "left_semi").select("sample", "scan")


@Q("pr23_edge_mask", "select sample, channel, case when channel < 4 or channel >= 60 or abs(channel - 32) <= 2 then 0 else value end as value from spectra")
def _(spark: SparkSession, d: str) -> DataFrame:
    from tidewheel.plans.tables import spectra

    c = F.col("channel")
    return spectra(spark, d).select("sample", "channel", F.when((c < 4) | (c >= 60) | (F.abs(c - 32) <= 2), 0.0).otherwise(F.col("value")).alias("value"))


@Q("pr24_mapmaking_pass", "select o.obsid from observations o join (select obsid from flags group by obsid having bool_or(is_good)) using (obsid) where level2_path is not null")
def _(spark: SparkSession, d: str) -> DataFrame:
    good = flags(spark, d).groupBy("obsid").agg(F.bool_or("is_good").alias("g")).where("g")
    return observations(spark, d).where("level2_path is not null").join(good, "obsid", "left_semi").select("obsid")


@Q("pr25_select_rows", "select obsid, pixel, band, auto_rms from flags where auto_rms < 10 and is_good and band = 3 order by auto_rms, obsid, pixel limit 50")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flags(spark, d).where("auto_rms < 10 and is_good and band = 3").select("obsid", "pixel", "band", "auto_rms")
    return rows.orderBy("auto_rms", "obsid", "pixel").limit(50)


@Q("pr26_failed_fits", "select obsid, pixel, band from flags where noise_index is not null and abs(noise_index) < 1e-9")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).where("noise_index is not null and abs(noise_index) < 1e-9").select("obsid", "pixel", "band")


@Q("pr27_quality_mask", "select obsid, feed, measured from flux where chi2 < 20 and abs(measured - expected) / 60 < 300 and measured > 1000")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).where((F.col("chi2") < 20) & (F.abs(F.col("measured") - F.col("expected")) / 60 < 300) & (F.col("measured") > 1000)).select("obsid", "feed", "measured")


@Q("pr29_choose_fields", "select field, grp from fields where grp = 'ASIA' or (not exists (select 1 from fields where grp = 'ASIA') and lower(field) = 'nation_3')")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = fields(spark, d)
    first = rows.where("grp = 'ASIA'")
    none = first.limit(1).groupBy().count().where("count = 0")
    return first.select("field", "grp").unionByName(rows.where("lower(field) = 'nation_3'").join(F.broadcast(none)).select("field", "grp"))


@Q("pr30_work_list", f"select o.obsid from observations o left join summaries s using (obsid) where {BLANK} or s.obsid is null or s.processing_status <> 'complete'")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).join(summaries(spark, d).select("obsid", F.col("processing_status").alias("st")), "obsid", "left")
    return rows.where(V.blank(F.col("level2_path")) | F.col("st").isNull() | (F.col("st") != "complete")).select("obsid")


@Q("pr31_jackknife", "select feed, scan from (select feed, scan, row_number() over (partition by feed order by scan) as n from (select distinct feed, scan from samples)) where n % 2 = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "scan").distinct()
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("feed").orderBy("scan"))).where("n % 2 = 1").select("feed", "scan")


@Q("pr32_query_observations", "select obsid, source from observations where lower(source) in ('jupiter', 'cyga', 'co2') and level2_path <> '' and lower(coalesce(source_group, '')) = 'galactic' order by source, obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where(F.lower("source").isin("jupiter", "cyga", "co2") & ~V.blank(F.col("level2_path")) & (F.lower(F.coalesce("source_group", F.lit(""))) == "galactic"))
    return rows.select("obsid", "source").orderBy("source", "obsid")


@Q("pr33_calibrator_rows", "select o.obsid, o.source, round(median(measured), 4) as mid, count(*) as n from observations o join flux f using (obsid) where o.obsid between 5 and 500 and level2_path is not null and o.source in ('Jupiter', 'CygA') group by all")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = observations(spark, d).where(F.col("obsid").between(5, 500) & F.col("level2_path").isNotNull() & F.col("source").isin("Jupiter", "CygA")).select("obsid", F.col("source").alias("name"))
    rows = flux(spark, d).join(own, "obsid")
    return rows.groupBy("obsid", F.col("name").alias("source")).agg(F.round(F.percentile("measured", F.lit(0.5)), 4).alias("mid"), F.count(F.lit(1)).alias("n"))


@Q("pr35_no_vane", "select scan, not bool_or(k = 13) as no_vane from samples group by scan")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).groupBy("scan").agg((~F.bool_or(F.col("k") == 13)).alias("no_vane"))


@Q("jn1_flags_catalogue", "select f.obsid, f.pixel, f.band, o.source_group, o.utc_start from flags f join observations o using (obsid) where obsid between 100 and 2000")
def _(spark: SparkSession, d: str) -> DataFrame:
    near = F.col("obsid").between(100, 2000)
    return flags(spark, d).where(near).join(observations(spark, d).where(near), "obsid").select("obsid", "pixel", "band", "source_group", "utc_start")


@Q("jn3_summaries_left", "select o.obsid, source, processing_status, median_tsys from observations o left join summaries s using (obsid) where source_group = 'Calibrator' and (median_tsys is null or median_tsys < 300)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where("source_group = 'Calibrator'").join(summaries(spark, d), "obsid", "left")
    return rows.where("median_tsys is null or median_tsys < 300").select("obsid", "source", "processing_status", "median_tsys")


@Q("jn4_snapshot", "select o.obsid, coalesce(n, 0) as n_flags, coalesce(good, 0) as n_good, first_cell, s.processing_status from observations o left join (select obsid, count(*) as n, count(*) filter (is_good) as good, min(pixel * 10 + band) as first_cell from flags group by obsid) f using (obsid) left join summaries s using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    nested = flags(spark, d).groupBy("obsid").agg(F.sort_array(F.collect_list(F.struct("pixel", "band", "is_good"))).alias("flags"))  # at most 152 cells each
    rows = observations(spark, d).select("obsid").join(nested, "obsid", "left").join(summaries(spark, d).select("obsid", "processing_status"), "obsid", "left")
    count = lambda c: F.coalesce(F.when(c.isNotNull(), F.size(c)), F.lit(0)).cast("bigint")
    return rows.select("obsid", count(F.col("flags")).alias("n_flags"), count(F.filter("flags", lambda x: x["is_good"])).alias("n_good"), (F.col("flags")[0]["pixel"] * 10 + F.col("flags")[0]["band"]).alias("first_cell"), "processing_status")


@Q("jn5_coverage", "select coalesce(a.source_group, b.source_group) as source_group, n_flags, n_sum from (select source_group, count(*) as n_flags from flags join observations using (obsid) group by 1) a full join (select source_group, count(*) as n_sum from summaries join observations using (obsid) group by 1) b on a.source_group is not distinct from b.source_group")
def _(spark: SparkSession, d: str) -> DataFrame:
    obs = observations(spark, d).select("obsid", "source_group")
    a = flags(spark, d).join(obs, "obsid").groupBy("source_group").agg(F.count(F.lit(1)).alias("n_flags")).alias("a")
    b = summaries(spark, d).join(obs, "obsid").groupBy("source_group").agg(F.count(F.lit(1)).alias("n_sum")).alias("b")
    both = a.join(b, F.col("a.source_group").eqNullSafe(F.col("b.source_group")), "full_outer")
    return both.select(F.coalesce("a.source_group", "b.source_group").alias("source_group"), "n_flags", "n_sum")


def _files(spark: SparkSession, d: str) -> DataFrame:
    c = raw(spark, d, "customer").where("c_custkey % 4 <> 1")
    path = F.concat(F.when(F.col("c_custkey") % 10 == 0, "/old/").otherwise("/data/"), F.lit("Level2_scope-"), F.lpad((F.col("c_custkey") * 2).cast("string"), 7, "0"), F.lit("-2020.hd5"))
    return c.select((F.col("c_custkey") * 2).alias("obsid"), path.alias("path"))


FILES = "files as (select c_custkey * 2 as obsid, case when c_custkey % 10 = 0 then '/old/' else '/data/' end || 'Level2_scope-' || lpad((c_custkey * 2)::varchar, 7, '0') || '-2020.hd5' as path from customer where c_custkey % 4 <> 1)"


@Q("jn6_reconcile", f"with {FILES} select coalesce(o.obsid, f.obsid) as obsid, level2_path, path as found, case when o.obsid is null then 'orphan' when {BLANK} and f.obsid is null then 'absent' when f.obsid is null then 'missing' when {BLANK} then 'backfill' when level2_path = path then 'matched' else 'remapped' end as state from observations o full join files f on o.obsid = f.obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.reconcile(observations(spark, d), _files(spark, d))


@Q("jn7_missing_obsids", f"with {FILES} select obsid from files where obsid not in (select obsid from summaries)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("obsid").join(summaries(spark, d), "obsid", "left_anti")


@Q("jn8_backfill", f"with {FILES} select o.obsid, path from observations o join files using (obsid) where {BLANK}")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where(V.blank(F.col("level2_path"))).select("obsid").join(_files(spark, d), "obsid")


RANGES = [("10", "200", "All", "BandA"), ("300", None, "1, 3, 5", "All"), ("900", "ongoing", "2,4", "BandB"), (None, "5", "All", "All"), ("50", "60", "All", "BandX")]


@Q("jn9_observer_flag_ranges", "with r(first, last, pixels, bands) as (values (10, 200, range(1, 20), [0, 1]), (300, 300, [1, 3, 5], [0, 1, 2, 3]), (900, 4611686018427387904, [2, 4], [2, 3])) select distinct o.obsid, p::bigint as pixel, b::bigint as band from (select r.first, r.last, unnest(pixels) as p, bands from r) x, unnest(x.bands) t(b), observations o where o.obsid between x.first and x.last")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = spark.createDataFrame(RANGES, "obsid_start string, obsid_end string, pixels string, sidebands string")
    r = C.flag_ranges(text).withColumn("pixel", F.explode("pixels")).withColumn("band", F.explode("bands"))
    o = observations(spark, d).select("obsid")
    return o.join(F.broadcast(r), F.col("obsid").between(F.col("first"), F.col("last"))).select("obsid", "pixel", "band").distinct()


@Q("mu14_observer_flags", "select obsid, pixel, band, not ((obsid between 10 and 200 and band in (0, 1)) or (obsid = 300 and pixel in (1, 3, 5) and band < 4) or (obsid >= 900 and pixel in (2, 4) and band in (2, 3))) as is_good, 'Observer Flag' as comment from flags")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = spark.createDataFrame(RANGES, "obsid_start string, obsid_end string, pixels string, sidebands string")
    return C.apply_flag_ranges(flags(spark, d).select("obsid", "pixel", "band", "is_good"), C.flag_ranges(text)).select("obsid", "pixel", "band", "is_good", "comment")


@Q("jn25_next_observation", "select o.obsid, coalesce(s.median_tsys, n.median_tsys) as tsys from observations o left join summaries s on o.obsid = s.obsid left join summaries n on n.obsid = o.obsid + 1 where o.source_group = 'SkyDip'")
def _(spark: SparkSession, d: str) -> DataFrame:
    s = summaries(spark, d).select("obsid", "median_tsys")
    n = s.select((F.col("obsid") - 1).alias("obsid"), F.col("median_tsys").alias("_next"))
    rows = observations(spark, d).where("source_group = 'SkyDip'").select("obsid").join(s, "obsid", "left").join(n, "obsid", "left")
    return rows.select("obsid", F.coalesce("median_tsys", "_next").alias("tsys"))


@Q("ag1_missing_by_source", f"select case when grouping(g) = 1 then 'TOTAL' else g end as grp, count(*) as total, sum(m)::bigint as missing, round(100.0::double * sum(m)::double / count(*), 2) as pct from (select coalesce(source_group, 'Unknown') as g, case when {BLANK} then 1 else 0 end as m from observations) group by rollup(g)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.missing_paths(observations(spark, d), "source_group")


@Q("ag2_summary_counts", "select processing_status, count(*) as n, count(median_tsys) as n_tsys, count(mean_tau) as n_tau from summaries group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return summaries(spark, d).groupBy("processing_status").agg(F.count(F.lit(1)).alias("n"), F.count("median_tsys").alias("n_tsys"), F.count("mean_tau").alias("n_tau"))


@Q("ag3_overview", "select coalesce(source_group, '<NULL>') as grp, count(*) as n from observations group by 1 order by n desc")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).groupBy(F.coalesce("source_group", F.lit("<NULL>")).alias("grp")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"))


@Q("ag4_coverage_by_group", "select source_group, count(distinct obsid) as n_obs, count(*) as n_rows, round(avg((red_noise is not null)::int), 6) as has_red_noise, round(avg((white_noise is not null)::int), 6) as has_white_noise from flags join observations using (obsid) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.coverage(flags(spark, d).join(observations(spark, d).select("obsid", "source_group"), "obsid"), "source_group", ["red_noise", "white_noise"])


@Q("ag5_feed_band_grid", "select pixel, band, round(median(auto_rms), 6) as mid, round(avg(auto_rms), 6) as mean, round(stddev_pop(auto_rms), 6) as spread, count(*) as n from flags group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("auto_rms")
    return flags(spark, d).groupBy("pixel", "band").agg(F.round(F.percentile(x, F.lit(0.5)), 6).alias("mid"), F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_pop(x), 6).alias("spread"), F.count(F.lit(1)).alias("n"))


@Q("ag6_obsids_per_source", "select source, count(distinct obsid) as n, count(distinct case when good then obsid end) as passing from (select o.obsid, source, coalesce(f.good, false) as good from observations o left join (select obsid, bool_or(is_good) as good from flags group by 1) f using (obsid) where coalesce(source_group, '') <> 'SkyDip') group by 1 order by n desc, source limit 8")
def _(spark: SparkSession, d: str) -> DataFrame:
    good = flags(spark, d).groupBy("obsid").agg(F.bool_or("is_good").alias("good"))
    rows = observations(spark, d).where("coalesce(source_group, '') <> 'SkyDip'").join(good, "obsid", "left").groupBy("obsid", "source").agg(F.bool_or(F.coalesce("good", F.lit(False))).alias("good"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("passing")).orderBy(F.desc("n"), "source").limit(8)


@Q("ag7_cross_tab", "select pixel, count(*) filter (source_group = 'Galactic') as galactic, count(*) filter (source_group = 'Calibrator') as calibrator from flags join observations using (obsid) where not is_good group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flags(spark, d).where(~F.col("is_good")).join(observations(spark, d).select("obsid", "source_group"), "obsid")
    return rows.groupBy("pixel").pivot("source_group", ["Galactic", "Calibrator"]).count().na.fill(0).withColumnsRenamed({"Galactic": "galactic", "Calibrator": "calibrator"})


@Q("ag8_percentiles", "select band, round(quantile_cont(auto_rms, 0.01), 6) as p1, round(quantile_cont(auto_rms, 0.16), 6) as p16, round(quantile_cont(auto_rms, 0.84), 6) as p84, round(quantile_cont(auto_rms, 0.99), 6) as p99 from flags group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    p = F.percentile("auto_rms", F.array(*map(F.lit, [0.01, 0.16, 0.84, 0.99])))
    rows = flags(spark, d).groupBy("band").agg(p.alias("p"))
    return rows.select("band", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(["p1", "p16", "p84", "p99"])])


@Q("ag9_collapse_stat", "select obsid, round(median(measured), 8) as mid, round(avg(measured), 8) as mean, count(*) filter (measured > 20000) as n_high from flux group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = F.col("measured")
    return flux(spark, d).groupBy("obsid").agg(F.round(F.percentile(m, F.lit(0.5)), 8).alias("mid"), F.round(F.avg(m), 8).alias("mean"), F.count_if(m > 20000).alias("n_high"))


@Q("ag11_observation_scalars", "select obsid, round(median(auto_rms), 6) as tsys, round(avg(red_noise), 6) as tau from flags group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).groupBy("obsid").agg(F.round(F.percentile("auto_rms", F.lit(0.5)), 6).alias("tsys"), F.round(F.avg("red_noise"), 6).alias("tau"))


@Q("ag36_dashboard", f"select source_group, count(*) as total, count(*) filter (not {BLANK}) as processed from observations where coalesce(source_group, 'none') <> 'SkyDip' and started >= timestamp '1995-01-01' group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where((F.coalesce("source_group", F.lit("none")) != "SkyDip") & (F.col("started") >= F.lit("1995-01-01").cast("timestamp_ntz")))
    return rows.groupBy("source_group").agg(F.count(F.lit(1)).alias("total"), F.count_if(~V.blank(F.col("level2_path"))).alias("processed"))


@Q("ag37_residuals", "select source, feed, band, channel, count(*) as n, round(avg(measured - expected), 3) as mean, round(stddev_pop(measured - expected), 3) as spread from flux group by all")
def _(spark: SparkSession, d: str) -> DataFrame:
    r = F.col("measured") - F.col("expected")
    return flux(spark, d).groupBy("source", "feed", "band", "channel").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(r), 3).alias("mean"), F.round(F.stddev_pop(r), 3).alias("spread"))


@Q("ag38_source_median", "select source, round(median(measured), 4) as mid from flux group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).groupBy("source").agg(F.round(F.percentile("measured", F.lit(0.5)), 4).alias("mid"))


@Q("ag39_gain_groups", "select feed, band, channel, count(*) as n, round(avg(measured / expected), 6) as gain from flux where expected > 0 and measured / expected between 0.3 and 3 group by all having count(*) >= 10")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).withColumn("g", F.try_divide("measured", "expected")).where("expected > 0 and g between 0.3 and 3")
    return rows.groupBy("feed", "band", "channel").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("g"), 6).alias("gain")).where("n >= 10")


@Q("ag40_duplicates", "select l_orderkey as obsid, min(l_shipdate) as first, count(*) as n from lineitem group by 1 having count(*) > 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("obsid")).agg(F.min("l_shipdate").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")


@Q("ag41_distinct_features", "select distinct k from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("k").distinct()


@Q("st1_order_by_obsid", "select obsid, source from observations order by obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", "source").orderBy("obsid")


@Q("st2_top_statistic", "select obsid, median_tsys from summaries where median_tsys is not null order by median_tsys desc, obsid limit 20")
def _(spark: SparkSession, d: str) -> DataFrame:
    return summaries(spark, d).where("median_tsys is not null").select("obsid", "median_tsys").orderBy(F.desc("median_tsys"), "obsid").limit(20)


@Q("st3_most_recent", "select obsid, utc_start from observations order by obsid desc limit 15")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", "utc_start").orderBy(F.desc("obsid")).limit(15)


@Q("st6_frequency_top_k", "select source, count(*) as n from observations group by 1 order by n desc, source limit 5")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "source").limit(5)


@Q("st11_unique_obsids", "select distinct obsid from flags order by obsid limit 30")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).select("obsid").distinct().orderBy("obsid").limit(30)


@Q("so1_union_ids", f"with {FILES} select obsid from files union select obsid from summaries")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _files(spark, d).select("obsid").union(summaries(spark, d).select("obsid")).distinct()


@Q("so2_union_all_sources", "select obsid, source from observations where source = 'Jupiter' union all select obsid, source from observations where source ilike 'c%'")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).select("obsid", "source")
    return o.where("source = 'Jupiter'").unionByName(o.where(F.col("source").ilike("c%")))


@Q("so4_difference", f"with {FILES} select obsid from observations except select obsid from files")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid").distinct().join(_files(spark, d).select("obsid"), "obsid", "left_anti")


@Q("so5_distinct_cells", "select distinct obsid, pixel % 4 as cell from flags")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).select("obsid", (F.col("pixel") % 4).alias("cell")).dropDuplicates(["obsid", "cell"])


@Q("so6_feed_complement", "select obsid, unnest(list_filter(range(1, 20), lambda x: not list_contains(own, x)))::bigint as pixel from (select obsid, list(distinct pixel) as own from flags group by 1)")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = flags(spark, d).groupBy("obsid").agg(F.collect_set("pixel").alias("own"))
    return own.select("obsid", F.explode(F.array_except(F.sequence(F.lit(1).cast("bigint"), F.lit(19).cast("bigint")), "own")).alias("pixel"))


@Q("so7_shared_columns", "select obsid, source_group as shared from observations union all select obsid, null from summaries")
def _(spark: SparkSession, d: str) -> DataFrame:
    a = observations(spark, d).select("obsid", F.col("source_group").alias("shared"))
    return a.unionByName(summaries(spark, d).select("obsid"), allowMissingColumns=True)


CHANGE = "change as (select o_orderkey * 3 as obsid, case when o_orderkey % 4 <> 0 then 'complete' end as processing_status, case when o_orderkey % 5 <> 0 then round(o_totalprice / 500, 3) end as median_tsys from orders where o_orderkey % 6 = 0)"


def _change(spark: SparkSession, d: str) -> DataFrame:
    o = raw(spark, d, "orders").where("o_orderkey % 6 = 0")
    return o.select((F.col("o_orderkey") * 3).alias("obsid"), F.when(F.col("o_orderkey") % 4 != 0, "complete").alias("processing_status"), F.when(F.col("o_orderkey") % 5 != 0, F.round(F.col("o_totalprice") / 500, 3)).alias("median_tsys"))


@Q("mu1_insert_or_update", f"with {CHANGE} select coalesce(s.obsid, c.obsid) as obsid, coalesce(c.processing_status, s.processing_status, case when s.obsid is null then 'pending' end) as processing_status, coalesce(c.median_tsys, s.median_tsys) as median_tsys, s.mean_tau, s.n_scans from summaries s full join change c on s.obsid = c.obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    old = summaries(spark, d).select("obsid", "processing_status", "median_tsys", "mean_tau", "n_scans")
    return C.upsert(old, _change(spark, d).withColumn("unknown", F.lit(1)), ["obsid"], {"processing_status": F.lit("pending")})


@Q("mu2_initialize_flags", "select o.obsid, p::bigint as pixel, b::bigint as band, true as is_good from observations o, range(1, 20) p(p), range(8) b(b) where not exists (select 1 from flags f where f.obsid = o.obsid and f.pixel = p and f.band = b)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.missing_flags(observations(spark, d).select("obsid"), flags(spark, d))


@Q("mu4_flag_all", "select obsid, pixel, band, case when obsid = 42 then false else is_good end as is_good from flags")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flags(spark, d).select("obsid", "pixel", "band", F.when(F.col("obsid") == 42, False).otherwise(F.col("is_good")).alias("is_good"))


@Q("mu8_insert_flux", "select obsid, feed, band, channel, measured from (select f.*, row_number() over (partition by obsid, feed, band, channel order by measured desc) as n from flux f where measured > 5000) where n = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).where("measured > 5000")
    return rows.groupBy("obsid", "feed", "band", "channel").agg(F.max("measured").alias("measured"))


@Q("mu10_clear_level2", "select obsid, case when obsid % 100 = 7 then null else level2_path end as level2_path from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.when(F.col("obsid") % 100 == 7, F.lit(None)).otherwise(F.col("level2_path")).alias("level2_path"))


@Q("mu11_scrub_missing", f"with {FILES} select o.obsid, case when f.obsid is null then null else level2_path end as level2_path, f.obsid is null and not {BLANK} as scrubbed from observations o left join files f on o.obsid = f.obsid and o.level2_path = f.path")
def _(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d).select("obsid", F.col("path").alias("level2_path"), F.lit(True).alias("_f"))
    rows = observations(spark, d).select("obsid", "level2_path").join(f, ["obsid", "level2_path"], "left")
    return rows.select("obsid", F.when(F.col("_f"), F.col("level2_path")).alias("level2_path"), (F.col("_f").isNull() & ~V.blank(F.col("level2_path"))).alias("scrubbed"))


@Q("mu12_remap_paths", "select obsid, case when starts_with(level2_path, '/data') then '/archive/x' || substr(level2_path, 6) else level2_path end as level2_path from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.remap_paths(observations(spark, d).select("obsid", "level2_path"), "/data/", "/archive/x/")


@Q("mu13_delete", "select obsid, source from observations where obsid not in (select obsid from flags where not is_good and pixel = 5)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", "source").join(flags(spark, d).where("not is_good and pixel = 5"), "obsid", "left_anti")


@Q("mu15_merge_databases", f"with {CHANGE} select coalesce(s.obsid, c.obsid) as obsid, coalesce(c.processing_status, s.processing_status) as processing_status, coalesce(c.median_tsys, s.median_tsys) as median_tsys from summaries s full join change c on s.obsid = c.obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.merge(summaries(spark, d), _change(spark, d), ["obsid"], prefer="secondary")


@Q("mu17_status_transitions", "select obsid, case when processing_status = 'failed' then false else is_good end as is_good, pixel, band from flags join summaries using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flags(spark, d).join(summaries(spark, d).select("obsid", "processing_status"), "obsid")
    return rows.select("obsid", F.when(F.col("processing_status") == "failed", False).otherwise(F.col("is_good")).alias("is_good"), "pixel", "band")


@Q("sf1_source_info", "select obsid, trim(split_part(source, ',', 1)) as name, case when contains(lower(comment), 'sky nod') then 'SkyDip' when trim(split_part(source, ',', 1)) = '' then null when contains(lower(trim(split_part(source, ',', 1))), 'co') then 'CO' when contains(lower(trim(split_part(source, ',', 1))), 'field') then 'Galactic' when regexp_matches(lower(trim(split_part(source, ',', 1))), 'taua|casa|cyga|jupiter|venus|mars') then 'Calibrator' when contains(lower(trim(split_part(source, ',', 1))), 'fg') then 'Foreground' else 'Other' end as grp from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", V.source_name(F.col("source")).alias("name"), V.source_group(F.col("source"), F.col("comment")).alias("grp"))


@Q("sf2_obsid_from_path", "select obsid, try_cast(split_part(regexp_replace(regexp_replace(level2_path, '^.*/', ''), '^.*_', ''), '-', 2) as bigint) as parsed, nullif(regexp_extract(level2_path, 'Level2_scope-([0-9]{7})-', 1), '')::bigint as digits from observations where level2_path <> ''")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where("level2_path <> ''")
    return rows.select("obsid", V.obsid_of_path(F.col("level2_path")).alias("parsed"), V.obsid_by_digits(F.col("level2_path")).alias("digits"))


@Q("sf6_utc_to_mjd", "select obsid, epoch_us(strptime(utc_start, '%Y-%m-%d-%H:%M:%S')) / 86400e6 + 40587.0 as mjd from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", V.mjd(V.parse_utc(F.col("utc_start"))).alias("mjd"))


@Q("sf8_pacific", "select obsid, strftime(started - interval 8 hours, '%Y-%m-%d %H:%M:%S') as local from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.date_format(F.col("started") - F.expr("interval 8 hours"), "yyyy-MM-dd HH:mm:ss").alias("local"))


@Q("sf9_output_path", "select obsid, strftime(started, '%Y-%m') || '/' || trim(split_part(source, ',', 1)) || '/level2/Level2_' || obsid as path from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", F.concat_ws("/", F.date_format("started", "yyyy-MM"), V.source_name(F.col("source")), F.lit("level2"), F.concat(F.lit("Level2_"), F.col("obsid"))).alias("path"))


@Q("sf5_feature_bits", "select sample, case when k > 0 then floor(log2(k))::bigint else -1 end as bit from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", V.feature_bit(F.col("k")).alias("bit"))


@Q("sf48_percent", "select source, round(100.0::double * count(*) filter (source_group = 'CO')::double / count(*), 2) as pct from observations group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    g = observations(spark, d).groupBy("source").agg(F.count_if(F.col("source_group") == "CO").alias("a"), F.count(F.lit(1)).alias("b"))
    return g.select("source", V.percent(F.col("a"), F.col("b")).alias("pct"))


@Q("jn16_nearest_field", "select region, field, round(sep, 6) as sep from (select region, field, degrees(acos(greatest(-1, least(1, sin(radians(r.b)) * sin(radians(f.b)) + cos(radians(r.b)) * cos(radians(f.b)) * cos(radians(r.l - f.l)))))) as sep, row_number() over (partition by region order by round(degrees(acos(greatest(-1, least(1, sin(radians(r.b)) * sin(radians(f.b)) + cos(radians(r.b)) * cos(radians(f.b)) * cos(radians(r.l - f.l)))))), 9), field) as n from regions r, fields f) where n = 1 and sep <= 15")
def _(spark: SparkSession, d: str) -> DataFrame:
    from tidewheel.operators.nearby import nearest_on_sky

    return nearest_on_sky(regions(spark, d), fields(spark, d), "region", "field", 15.0)


@Q("jn17_match_or_null", "with m as (INNER) select r.region, m.field, m.sep from regions r left join m using (region)".replace("INNER", book.plain["jn16_nearest_field"].replace("<= 15", "<= 6")))
def _(spark: SparkSession, d: str) -> DataFrame:
    from tidewheel.operators.nearby import nearest_on_sky

    near = nearest_on_sky(regions(spark, d), fields(spark, d), "region", "field", 6.0)
    return regions(spark, d).select("region").join(near, "region", "left")
