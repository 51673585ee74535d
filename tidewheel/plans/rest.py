"""Scans, sinks (written and read back), reduction steps and the remaining rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.functions import values as V
from tidewheel.operators import catalogue as C
from tidewheel.operators import maps as M
from tidewheel.operators import ordered as O
from tidewheel.operators import scans as P
from tidewheel.operators import signal as S
from tidewheel.plans import skies, steps
from tidewheel.plans.tables import Book, fields, flags, flux, observations, raw, regions, samples, spectra, summaries
from tidewheel.sources import readers as R
from tidewheel.sources import writers as W
from tidewheel.sources.scratch import folder

book = Book()
Q = book.add
BLANK = "(level2_path is null or level2_path = '')"


@Q("sc2_discovered_files", f"select nullif(regexp_extract(level2_path, 'Level2_scope-([0-9]{{7}})-', 1), '')::bigint as obsid, min(level2_path) as path, count(*) as n from observations where not {BLANK} group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.level2_files(observations(spark, d).where("level2_path <> ''").select(F.col("level2_path").alias("path")))


@Q("sc4_feed_slice", "select event_id, value from events where event_id between 100 and 400 and event_type = 'view'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return raw(spark, d, "events").where("event_id between 100 and 400 and event_type = 'view'").select("event_id", "value")


@Q("sc5_catalogue_scan", "select * from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d)


@Q("sc6_bound_parameters", "select o_orderkey as obsid, o_totalprice as price from orders where o_orderkey between 10 and 500 and o_orderstatus = 'F'")
def _(spark: SparkSession, d: str) -> DataFrame:
    raw(spark, d, "orders").createOrReplaceTempView("_orders")
    return spark.sql("select o_orderkey as obsid, o_totalprice as price from _orders where o_orderkey between :lo and :hi and o_orderstatus = :status", args={"lo": 10, "hi": 500, "status": "F"})


@Q("sc7_optional_table", "select 0::bigint as n")
def _(spark: SparkSession, d: str) -> DataFrame:
    return R.optional(spark, f"{d}/no_such_table.parquet", "obsid bigint, status string").agg(F.count(F.lit(1)).alias("n"))


@Q("sc8_flux_of_source", "select obsid, measured from flux where source = 'TauA'")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).where("source = 'TauA'").select("obsid", "measured")


@Q("sc9_models_from_json", "select obsid, case when obsid % 4 <> 0 then 1.5::double end as c0, case when obsid % 4 <> 0 then obsid % 7 * 1.0::double end as c1 from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("obsid") % 4 == 0, "").otherwise(F.concat(F.lit("[1.5,"), F.col("obsid") % 7, F.lit(".0]")))
    return observations(spark, d).select("obsid", F.from_json(F.nullif(text, F.lit("")), "array<double>").alias("c")).select("obsid", F.col("c")[0].alias("c0"), F.col("c")[1].alias("c1"))


@Q("sc10_per_scan", "select vec_id, (i // 16)::bigint as feed, (i // 4 % 4)::bigint as band, (i % 4)::bigint as channel, embedding[i + 1]::double as v from embeddings, range(64) t(i)")
def _(spark: SparkSession, d: str) -> DataFrame:
    cut = lambda a, n: F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice(a, i * n + 1, n))
    cube = F.transform(cut(F.col("embedding"), 16), lambda a: F.transform(cut(a, 4), lambda b: F.transform(b, lambda v: F.array(v.cast("double")))))
    rows = R.per_scan(raw(spark, d, "embeddings").select("vec_id", cube.alias("v")), ["v"])
    return rows.select("vec_id", *[F.col(c).cast("bigint").alias(c) for c in ("feed", "band", "channel")], "v")


@Q("sc13_regions_with_places", "select region, l, b from regions where l is not null and b is not null")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).dropna(subset=["l", "b"]).select("region", "l", "b")


@Q("sc16_id_list", "select obsid, source from observations where obsid in (select n_nationkey * 11 from nation)")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "ids")
    raw(spark, d, "nation").select((F.col("n_nationkey") * 11).cast("string").alias("value")).write.text(path)
    return observations(spark, d).join(R.id_list(spark, path), "obsid", "left_semi").select("obsid", "source")


@Q("sc17_remote_listing", "select o_orderkey as obsid, '/path/' || o_orderkey as path, case when o_orderkey % 3 = 0 then 'TauA' else 'Unknown' end as target from orders")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = raw(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"))
    files = o.select(F.concat(F.col("k"), F.lit(" _  L1 /path/"), F.col("k"), F.lit(" data")).alias("value"))
    targets = o.where("k % 3 = 0").select(F.concat(F.col("k"), F.lit(" TauA (raster)")).alias("value"))
    return R.remote_listing(files, targets).select("obsid", "path", "target")


@Q("sc18_scan_reader", "select sample, feed, scan, tod from samples where feed in (1, 5, 7)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).where(F.col("feed").isin(1, 5, 7)).select("sample", "feed", "scan", "tod")


@Q("sc21_prior_map", "with p as (select pix, avg(k) as t from samples group by 1) select sample, round(t, 6) as t from samples join p using (pix) where t > 45")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    prior = rows.groupBy("pix").agg(F.avg("k").alias("t")).where("t > 45")
    return rows.join(prior, "pix").select("sample", F.round("t", 6).alias("t"))


@Q("sc26_resolve", "select obsid, level2_path from observations where obsid = 41")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).where("obsid = 41").select("obsid", "level2_path")


def _written(spark: SparkSession, tag: str, write, columns: str | None = None) -> DataFrame:
    path = folder(spark, tag)
    write(path)
    return spark.read.schema(columns).parquet(path) if columns else spark.read.parquet(path)


@Q("sk1_level2_product", "select obsid, median_tsys * 0.5 as tsys, strftime(started, '%Y-%m') as year_month, source from observations join summaries using (obsid) where source <> '' and median_tsys is not null")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where("source <> ''").join(summaries(spark, d), "obsid").where("median_tsys is not null").select("obsid", F.col("median_tsys").alias("tsys"), "started", "source")
    out = _written(spark, "level2", lambda p: W.level2(rows, p, {"tsys": 0.5}), "obsid bigint, tsys double, started timestamp_ntz, year_month string, source string")
    return out.select("obsid", "tsys", "year_month", "source")


@Q("sk2_replaced_group", "select feed, sample, case when feed = 3 then tod * 2 else tod end as tod from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "sample", "tod")

    def write(p: str) -> None:
        W.replaced(rows, p, ["feed"])
        W.replaced(rows.where("feed = 3").withColumn("tod", F.col("tod") * 2), p, ["feed"])

    return _written(spark, "group", write, "sample bigint, tod double, feed bigint").select("feed", "sample", "tod")


@Q("sk3_snapshot", "select o.obsid, count(f.obsid) as n, coalesce(sum(case when f.red_noise is null then 1 else 0 end) filter (f.obsid is not null), 0)::bigint as nan from observations o left join flags f using (obsid) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    out = _written(spark, "snapshot", lambda p: W.snapshot(observations(spark, d), flags(spark, d), p))
    nan = F.size(F.filter(F.coalesce("flags", F.array()), lambda c: F.isnan(c["red_noise"])))
    return out.select("obsid", F.size(F.coalesce("flags", F.array())).cast("bigint").alias("n"), nan.cast("bigint").alias("nan"))


@Q("sk4_map_product", "with m as (select pix, sum(w * tod) / sum(w) as naive, count(*) as hits from samples group by pix), e as (select *, pix % 15 < 2 or pix // 15 < 2 or pix % 15 >= 13 or pix // 15 >= 13 as edge from m), c as (select greatest(quantile_cont(hits, 0.05), 1) as low, quantile_cont(naive, 0.005) filter (not edge) as lo, quantile_cont(naive, 0.995) filter (not edge) as hi from e) select round(min(naive), 6) as datamin, round(max(naive), 6) as datamax from e, c where hits >= low and not (edge and not naive between lo and hi)")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "product")
    m = M.masked(M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w")), 15, 15)
    W.map_product(m, path, {"nx": 15, "ny": 15})
    return spark.read.schema("datamin double, datamax double, header string").json(f"{path}/header").select(F.round("datamin", 6).alias("datamin"), F.round("datamax", 6).alias("datamax"))


@Q("sk7_csv_report", "select source, count(*) as n from observations where source <> '' group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "report")
    W.report(observations(spark, d).where("source <> ''").groupBy("source").agg(F.count(F.lit(1)).alias("n")), path)
    return spark.read.csv(path, header=True, schema="source string, n bigint", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


@Q("sk8_tsv_report", "select obsid, source_group from observations where source_group is not null")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "tsv")
    W.report(observations(spark, d).where("source_group is not null").select("obsid", "source_group"), path, "\t")
    return spark.read.csv(path, header=True, sep="\t", schema="obsid bigint, source_group string")


@Q("sk9_model_table", "select feed, band, channel, round(avg(measured), 4) as c0 from flux group by all")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = flux(spark, d).groupBy("feed", "band", "channel").agg(F.array(F.round(F.avg("measured"), 4)).alias("coeffs"))
    return _written(spark, "models", lambda p: W.model_table(m, p)).select("feed", "band", "channel", F.col("coeffs")[0].alias("c0"))


@Q("sk11_group_lists", "select 'f' || obsid % 3 as field, (obsid % 4)::bigint as grp, obsid from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).select(F.concat(F.lit("f"), F.col("obsid") % 3).alias("field"), (F.col("obsid") % 4).alias("grp"), "obsid")
    path = folder(spark, "lists")
    W.group_lists(rows, path)
    back = spark.read.schema("value string, field string, grp bigint").text(path)
    return back.select("field", "grp", F.col("value").cast("bigint").alias("obsid"))


@Q("sk12_path_export", f"select level2_path as path from observations where not {BLANK}")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "paths")
    W.path_list(observations(spark, d), path)
    return spark.read.text(path).select(F.col("value").alias("path"))


@Q("pr28_validate_fit", "select obsid, feed from flux where measured > 0 and chi2 between 0 and 30 and sqrt(chi2 * chi2 + 4) < 25")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).where((F.col("measured") > 0) & F.col("chi2").between(0, 30) & (F.sqrt(F.col("chi2") * F.col("chi2") + 4) < 25)).select("obsid", "feed")


@Q("pr34_calibrator_gate", "select o.obsid from observations o where source_group = 'Calibrator' and obsid not in (select obsid from summaries where processing_status = 'complete')")
def _(spark: SparkSession, d: str) -> DataFrame:
    done = summaries(spark, d).where("processing_status = 'complete'")
    return observations(spark, d).where("source_group = 'Calibrator'").join(done, "obsid", "left_anti").select("obsid")


@Q("jn24_sky_prior", "select key as sample, (pix % 97)::double as temperature from (" + skies.healpix_sql("select sample as key, pix * 1.7::double as lon, el - 50 as lat from samples", 16) + ") where pix % 97 > 40")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Positions to HEALPix pixels to a prior's temperature, above a threshold."""
    prior = spark.range(12 * 16 * 16).select(F.col("id").alias("hpx"), (F.col("id") % 97).cast("double").alias("temperature"))
    rows = samples(spark, d).select("sample", K.healpix_ring(F.col("pix") * 1.7, F.col("el") - 50, 16).alias("hpx"))
    return rows.join(F.broadcast(prior), "hpx").where("temperature > 40").select("sample", "temperature")


@Q("wn18_scan_index", "select distinct feed, scan, dense_rank() over (partition by feed order by scan) as idx from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).select("feed", "scan").distinct()
    return rows.withColumn("idx", F.row_number().over(Window.partitionBy("feed").orderBy("scan")).cast("bigint"))


@Q("wn26_unwrapped_mean", "with v as (select feed, sample, mjd * 24 % 24 as h, mjd * 24 % 24 - lag(mjd * 24 % 24) over (partition by feed order by sample) as s from samples), u as (select feed, h + 24 * sum(case when s < -12 then 1 when s > 12 then -1 else 0 end) over (partition by feed order by sample rows unbounded preceding) as x from v) select feed, round(((avg(x) % 24) + 24) % 24, 4) as mean from u group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("feed").orderBy("sample")
    rows = samples(spark, d).select("feed", "sample", (F.col("mjd") * 24 % 24).alias("h"))
    rows = rows.withColumn("s", F.col("h") - F.lag("h").over(w)).withColumn("turn", F.when(F.col("s") < -12, 1).when(F.col("s") > 12, -1).otherwise(0))
    rows = rows.withColumn("x", F.col("h") + 24 * F.sum("turn").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("feed").agg(F.round(F.pmod(F.avg("x"), F.lit(24.0)), 4).alias("mean"))


@Q("st5_no_limit", "select obsid from observations where source = 'fg3' order by obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    limit = 0
    rows = observations(spark, d).where("source = 'fg3'").select("obsid").orderBy("obsid")
    return rows.limit(limit) if limit > 0 else rows


@Q("mu7_single_value", "select obsid, case when obsid = 17 then 'CygA' else source end as source from observations")
def _(spark: SparkSession, d: str) -> DataFrame:
    return observations(spark, d).select("obsid", "source").transform(C.with_value, "obsid", 17, "source", "CygA")


@Q("mu16_reconcile_writes", f"with f as (select c_custkey as obsid, '/data/new/' || c_custkey as path from customer where c_custkey % 5 <> 0) select o.obsid, case when {BLANK} then level2_path when f.path is null then null else f.path end as level2_path from observations o left join f using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    files = raw(spark, d, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("obsid"), F.concat(F.lit("/data/new/"), F.col("c_custkey")).alias("path"))
    state = C.reconcile(observations(spark, d), files).where("state <> 'orphan'")
    new = F.when(F.col("state") == "missing", F.lit(None)).when(F.col("state") == "remapped", F.col("found")).otherwise(F.col("level2_path"))
    return state.select("obsid", new.alias("level2_path"))


@Q("mu19_successive_merges", "with a as (select o_orderkey as obsid, 'one' as tag from orders where o_orderkey % 3 = 0), b as (select o_orderkey as obsid, 'two' as tag from orders where o_orderkey % 5 = 0) select coalesce(x.obsid, b.obsid) as obsid, coalesce(b.tag, x.tag) as tag from a x full join b on x.obsid = b.obsid")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = raw(spark, d, "orders").select(F.col("o_orderkey").alias("obsid"))
    a, b = o.where("obsid % 3 = 0").withColumn("tag", F.lit("one")), o.where("obsid % 5 = 0").withColumn("tag", F.lit("two"))
    return C.upsert(C.upsert(a.where("false"), a, ["obsid"]), b, ["obsid"])


@Q("sf15_galactic_wrapped", f"select region, round((({skies._TO[0]}) % 360 + 360) % 360, 6) as lon from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    lon, _ = K.to_galactic(F.col("l"), F.col("b"))
    return regions(spark, d).select("region", F.round(F.pmod(lon, F.lit(360.0)), 6).alias("lon"))


@Q("sf17_hour_angle", "select sample, round((((mjd * 361 % 360) - pix + 180) % 360 + 360) % 360 - 180, 6) as ha from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    lst = F.col("mjd") * 361 % 360
    return samples(spark, d).select("sample", F.round(K.hour_angle(lst, F.col("pix")), 6).alias("ha"))


@Q("sf40_receiver", "with v as (select sample, tod + 100 as hot, tod / 4 + 10 as cold, (300 + k) * 1.0 as t from samples) select sample, round((t - hot / cold * 2.73) / (hot / cold - 1), 6) as tsys, round((hot - cold) / (t - 2.73), 9) as gain from v")
def _(spark: SparkSession, d: str) -> DataFrame:
    tsys, gain = K.receiver(F.col("tod") + 100, F.col("tod") / 4 + 10, F.col("k") + 300.0)
    return samples(spark, d).select("sample", F.round(tsys, 6).alias("tsys"), F.round(gain, 9).alias("gain"))


@Q("sf41_defaults", "select o.obsid, coalesce(nullif(source, ''), 'Unknown') as source, coalesce(processing_status, '<NULL>') as status from observations o left join summaries using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).join(summaries(spark, d).select("obsid", "processing_status"), "obsid", "left")
    return rows.select("obsid", F.coalesce(F.nullif("source", F.lit("")), F.lit("Unknown")).alias("source"), F.coalesce("processing_status", F.lit("<NULL>")).alias("status"))


@Q("sf46_plane_names", "select field, regexp_matches(lower(grp), 'asia|europe') as hit from fields")
def _(spark: SparkSession, d: str) -> DataFrame:
    return fields(spark, d).select("field", F.lower("grp").rlike("asia|europe").alias("hit"))


@Q("sf47_feed_list", "select distinct sample, feed from samples where feed in (2, 4, 11)")
def _(spark: SparkSession, d: str) -> DataFrame:
    want = F.transform(F.filter(F.transform(F.split(F.lit(" 2, 4,,11 "), ","), F.trim), lambda x: x != ""), lambda x: x.cast("bigint"))
    return samples(spark, d).where(F.array_contains(want, F.col("feed"))).select("sample", "feed").distinct()


@Q("kn2_vane_atmosphere", "select scan, round(regr_slope(tod, 1 / sin(radians(el))), 3) as tau from samples group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    return S.atmosphere(samples(spark, d), ["scan"], "tod").select("scan", F.round("tau", 3).alias("tau"))


@Q("kn5_binned_spectra", "with n as (select sample, channel, band, value, avg(value) over (partition by sample) as m from spectra), b as (select sample, channel // 32 as bin, sum((channel % 3 + 1) * (value - m)) / sum(channel % 3 + 1) as v from n group by 1, 2) select sample, bin, round(v, 9) as v from b")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = spectra(spark, d)
    mean = rows.groupBy("sample").agg(F.avg("value").alias("m"))
    rows = rows.join(mean, "sample").withColumns({"x": F.col("value") - F.col("m"), "w": (F.col("channel") % 3 + 1).cast("double"), "f": F.col("channel").cast("double")})
    return S.frequency_bins(rows, ["sample"], "channel", 32, "x", "w", "f").select("sample", "bin", F.round("value", 9).alias("v"))


@Q("kn8_normalised", "select sample, round((tod - avg(tod) over (partition by feed)) / median(tod) over (partition by feed), 9) as rel from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.normalised(samples(spark, d).select("feed", "sample", "tod"), ["feed"], "tod", "rel").select("sample", F.round("rel", 9).alias("rel"))


@Q("kn8_projected", "with f as (select feed, regr_slope(tod, az) as s, avg(az) as m from samples group by 1) select sample, round(tod - s * (az - m), 6) as rest from samples join f using (feed)")
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.projected(samples(spark, d).select("feed", "sample", "tod", "az"), ["feed"], "tod", "az", "rest").select("sample", F.round("rest", 6).alias("rest"))


@Q("kn9_bounded_fit", "select feed, band, round(case when regr_slope(tod, k) >= 0 then regr_slope(tod, k) else 0 end, 6) as a, round(case when regr_slope(tod, k) >= 0 then regr_intercept(tod, k) else avg(tod) end, 6) as b from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return P.nonnegative(samples(spark, d), ["feed", "band"], "k", "tod").select("feed", "band", F.round("a", 6).alias("a"), F.round("b", 6).alias("b"))


@Q("kn18_process_scan", "with n as (select obsid, feed, sample, tod, row_number() over (partition by obsid, feed order by sample) - 1 as n, count(*) over (partition by obsid, feed) as c from samples), m as (select obsid, feed, sample, n, n // 10 as chunk, tod - median(tod) over (partition by obsid, feed) as v from n where n < c // 10 * 10), a as (select obsid, feed, stddev_pop(d) / sqrt(2) as rms from (select obsid, feed, n // 2 as p, max(case when n % 2 = 1 then v end) - max(case when n % 2 = 0 then v end) as d from m group by 1, 2, 3) group by 1, 2), k as (select m.*, rms, abs(v) <= 3 * rms as ok from m join a using (obsid, feed) where rms > 0), g as (select obsid, feed from k group by 1, 2 having avg(ok::int) >= 0.5) select sample, chunk, round(v, 6) as clean, round(1 / (rms * rms), 9) as weight from k join g using (obsid, feed) where ok")
def _(spark: SparkSession, d: str) -> DataFrame:
    out = P.process(samples(spark, d), ["obsid", "feed"], "sample", "tod", 10, 3.0, 0.5)
    return out.select("sample", "chunk", F.round("clean", 6).alias("clean"), F.round("weight", 9).alias("weight"))


@Q("kn19_gated_files", "select s.sample from samples s where scan in (select scan from samples where feed = 1 group by 1 having avg(k) <= 55)")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d)
    noise = rows.groupBy("scan", "feed").agg(F.avg("k").alias("red"))
    return P.gated(rows, ["scan"], noise, 55.0).select("sample")


@Q("kn20_map_and_rhs", "with c as (select sample // 50 as o, pix, sum(w) as w, sum(w * tod) as wd from samples group by 1, 2), m as (select pix, sum(wd) / sum(w) as sky from c group by 1) select 'map' as part, pix as id, round(sky, 7) as v from m union all select 'rhs', o, round(sum(wd - w * sky), 4) from c join m using (pix) group by o")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("o", F.floor(F.col("sample") / 50))
    m, b = P.accumulated(rows, "o", F.col("tod"), F.col("w"))
    return m.select(F.lit("map").alias("part"), F.col("pix").alias("id"), F.round("sky", 7).alias("v")).unionByName(b.select(F.lit("rhs").alias("part"), F.col("offset").alias("id"), F.round("b", 4).alias("v")))


@Q("kn22_offset_rhs", "with c as (select sample // 50 as o, pix, sum(w) as w, sum(w * tod) as wd from samples group by 1, 2), m as (select pix, sum(wd) / sum(w) as sky from c group by 1) select o as \"offset\", round(sum(w * (o % 5 - sky)), 4) as b from c join m using (pix) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = M.compressed(samples(spark, d).withColumn("o", F.floor(F.col("sample") / 50)), "o", "pix", F.col("tod"), F.col("w"))
    rows = cells.join(M.sky(cells, "wd"), "pix")
    return rows.groupBy("offset").agg(F.round(F.sum(F.col("w") * (F.col("offset") % 5 - F.col("sky"))), 4).alias("b"))


@Q("kn26_smooth_prior", "with m as (select pix, sum(w * tod) / sum(w) as v from samples group by 1), s as (select p.pix + x + y * 15 as pix, exp(-(x * x + y * y) / 4.5) as k, v from m p, range(-2, 3) a(x), range(-2, 3) b(y) where p.pix % 15 + x between 0 and 14) select pix, round(sum(k * v) / sum(k), 6) as smooth from s where pix in (select pix from m) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w")).select("pix", (F.col("total") / F.col("weight")).alias("naive"))
    return P.smoothed(m, "naive", 15, 2, 1.5, "smooth").select("pix", F.round("smooth", 6).alias("smooth"))


@Q("kn37_fit_in_map")
def _(spark: SparkSession, d: str) -> DataFrame:
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w"))
    rows = m.select(F.lit(1).alias("source"), "pix", ((F.col("pix") % 15 - 7) / 7.0).alias("x"), ((F.floor(F.col("pix") / 15) - 7) / 7.0).alias("y"), (F.col("total") / F.col("weight")).alias("v"))
    return S.source_fits(rows, ["source"], "pix", "x", "y", "v", 0.3, 1.0)


@Q("kn46_first_plane", "select sample, value from spectra where channel = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    return spectra(spark, d).where("channel = 0").select("sample", "value")


@Q("ct6_error_policy", "with e as (select obsid, case when n_scans <= 2 then 'few scans' else 'no system temperature' end as m from summaries where n_scans <= 2 or median_tsys is null) select f.obsid, pixel, band, is_good and m is null as is_good, m as comment from flags f left join e using (obsid)")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = summaries(spark, d)
    _, errors = steps.errors(own, "obsid", {"few scans": F.col("n_scans") > 2, "no system temperature": F.col("median_tsys").isNotNull()})
    return C.failed(flags(spark, d), own, errors)[0].select("obsid", "pixel", "band", "is_good", "comment")


@Q("ct6_failed_status", "select obsid, case when n_scans <= 2 or median_tsys is null then 'failed' else processing_status end as processing_status from summaries")
def _(spark: SparkSession, d: str) -> DataFrame:
    own = summaries(spark, d)
    _, errors = steps.errors(own, "obsid", {"few scans": F.col("n_scans") > 2, "no system temperature": F.col("median_tsys").isNotNull()})
    return C.failed(flags(spark, d), own, errors)[1].select("obsid", "processing_status")


@Q("ct8_line_files", "select obsid from observations where source_group in ('Galactic', 'Foreground') and obsid in (select obsid from summaries where median_tsys is not null)")
def _(spark: SparkSession, d: str) -> DataFrame:
    gain = summaries(spark, d).where("median_tsys is not null")
    return C.by_group(observations(spark, d), "Galactic", least=0, most=1 << 62).join(gain, "obsid", "left_semi").select("obsid")


@Q("ct12_chunked_depth", "with c as (select sample // 2500 as chunk, pix, sum(w) as w from samples group by 1, 2), r as (select chunk, pix, sum(w) over (partition by pix order by chunk rows unbounded preceding) as w from c) select chunk, count(*) as n, round(avg(sqrt(1 / w)), 6) as rms from r group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = M.binned(samples(spark, d).withColumn("chunk", F.floor(F.col("sample") / 2500)), ["chunk", "pix"], F.col("tod"), F.col("w"))
    run = Window.partitionBy("pix").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    return c.withColumn("r", F.sqrt(1 / F.sum("weight").over(run))).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("r"), 6).alias("rms"))


@Q("kn14_noise_after_masking")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Bright samples filled from their neighbours, residual spikes clipped, then the spectrum's fit."""
    rows = O.fill_gaps(samples(spark, d).select("feed", "sample", "tod"), ["feed"], "sample", "tod", F.col("tod") < 480, "filled")
    mid = S.long_median(rows.select("feed", "sample", "filled"), ["feed"], "sample", "filled", 51, "mid").withColumn("rest", F.col("filled") - F.col("mid"))
    noise = O.pair_noise(mid, ["feed"], "sample", "rest")
    clipped = mid.join(noise, "feed").withColumn("ok", F.abs("rest") <= 3 * F.col("auto_rms"))
    good = clipped.groupBy("feed").agg(F.avg(F.col("ok").cast("double")).alias("f")).where("f >= 0.5")
    whole = O.fill_gaps(clipped.join(good, "feed", "left_semi"), ["feed"], "sample", "filled", F.col("ok"), "series")
    return S.noise_spectra(whole, ["feed"], "sample", "series")
