"""Configured reductions, map jobs, complete products and reading."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.operators import jobs as J
from tidewheel.operators import signal as S
from tidewheel.plans import library, steps  # noqa: F401 (the library's steps are registered on import)
from tidewheel.plans.tables import Book, observations, raw, regions, samples, summaries
from tidewheel.sources import readers as R
from tidewheel.sources import writers as W
from tidewheel.sources.scratch import folder

book = Book()
Q = book.add

GRIDS = str(Path(__file__).with_name("grids.toml"))

FEED_MAPS = """
[pipeline]
steps = ["Clean.Between", "Reduce.Atmosphere", {name = "Maps.Split", mode = "per_feed"}, "Maps.Binned"]
[Clean.Between]
column = "el"
low = 42.0
high = 58.0
[Reduce.Atmosphere]
keys = ["feed", "band"]
value = "tod"
out = "rest"
[Maps.Binned]
keys = ["split", "pix"]
value = "rest"
weight = "w"
"""

DEEP_MAP = """
[pipeline]
steps = ["Clean.Finite", "Maps.Binned"]
[Clean.Finite]
columns = ["tod"]
[Maps.Binned]
keys = ["pix"]
value = "tod"
weight = "w"
"""


def _rounded(maps: DataFrame, *keys: str, places: int = 6) -> DataFrame:
    return maps.select(*keys, F.round("map", places).alias("map"), "hits")


@Q("sc14_text_catalogue", "select c_name as field_name, c_custkey::varchar as id, lpad(c_nationkey::varchar, 3, '0') as \"group\" from customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "catalogue")
    raw(spark, d, "customer").select(F.col("c_name").alias("field_name"), F.col("c_custkey").alias("id"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("group")).write.csv(path, header=True)
    return R.text_csv(spark, path)


@Q("sc25_named_grid", "select region, case when b >= -12 and b < 12 and l >= 0 and l < 360 then (floor((b + 12) / 0.5) * 720 + floor(l / 0.5))::bigint end as pix from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    grid = R.wcs_definition(["/no/such/grids.toml", GRIDS], "tests")
    return regions(spark, d).select("region", K.pixel(F.col("l"), F.col("b"), grid).alias("pix"))


JOB_SQL = "j as (select coalesce(source_group, 'none') as label, level2_path as path from observations where level2_path is not null and level2_path <> '')"


@Q("sk13_map_jobs", f"with {JOB_SQL}, t as (select label, count(*) as n, sum(('0x' || substr(md5(path), 1, 15))::bigint)::varchar as s from j group by 1) select label, n, substr(sha256(label || '|' || '{{\"feeds\": [1, 2]}}' || '|' || n || '|' || s), 1, 12) as token from t")
def _(spark: SparkSession, d: str) -> DataFrame:
    files = observations(spark, d).where("level2_path <> ''").select(F.coalesce("source_group", F.lit("none")).alias("label"), F.col("level2_path").alias("path"))
    path = folder(spark, "map-jobs")
    W.job_files(files, J.map_jobs(files, {"feeds": [1, 2]}), path)
    lists = spark.read.option("basePath", f"{path}/lists").schema("value string, label string, token string").text(f"{path}/lists")
    return lists.groupBy("label", "token").agg(F.count(F.lit(1)).alias("n"))


@Q("pr19_incomplete", "select obsid, concat_ws(',', case when median_tsys is null then 'median_tsys' end, case when mean_tau is null then 'mean_tau' end, case when calibrator_flux is null then 'calibrator_flux' end) as lacking from summaries where median_tsys is null or mean_tau is null or calibrator_flux is null")
def _(spark: SparkSession, d: str) -> DataFrame:
    required = ["median_tsys", "mean_tau", "calibrator_flux"]
    return summaries(spark, d).where(~J.processed(required)).select("obsid", F.array_join(J.lacking(required), ",").alias("lacking"))


@Q("pr20_absent_files", "select obsid, 'files' as step, case when coalesce(level2_path, '') = '' then 'no path' else 'no file ' || level2_path end as message from observations where coalesce(level2_path, '') = '' or obsid % 4 = 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    obs = observations(spark, d).withColumnRenamed("level2_path", "path")
    return J.absent(obs.select("obsid", "path"), obs.where("path <> '' and obsid % 4 <> 1"))[1]


@Q("pr36_processed", "select obsid, median_tsys is not null and mean_tau is not null as processed from summaries")
def _(spark: SparkSession, d: str) -> DataFrame:
    nested = summaries(spark, d).select("obsid", F.struct(F.struct("median_tsys", "mean_tau").alias("vane")).alias("level2"))
    return nested.select("obsid", J.processed(["level2.vane.median_tsys", "level2.vane.mean_tau"]).alias("processed"))


@Q("kn6_atmosphere_templates", "select sample, round(1 / sin(radians(el)) - avg(1 / sin(radians(el))) over (partition by scan, band), 6) as air, round(az - degrees(atan2(avg(sin(radians(az))) over (partition by scan, band), avg(cos(radians(az))) over (partition by scan, band))), 6) as dev from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = S.airmass_templates(samples(spark, d), ["scan", "band"])
    return rows.select("sample", F.round("air", 6).alias("air"), F.round("dev", 6).alias("dev"))


@Q("ct4_run_pipeline", "with s as (select * from samples where el between 42 and 58), f as (select feed, band, regr_intercept(tod, 1 / sin(radians(el))) as c, regr_slope(tod, 1 / sin(radians(el))) as t from s group by 1, 2) select 'feed' || feed as split, pix, round(sum(w * (tod - c - t / sin(radians(el)))) / sum(w), 4) as map, count(*) as hits from s join f using (feed, band) group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(steps.Config.loads(FEED_MAPS).apply(samples(spark, d)), "split", "pix", places=4)


@Q("ct5_level2_run", "select pix, round(sum(w * tod) / sum(w), 6) as map, count(*) as hits from samples where scan in (select obsid from observations where level2_path <> '' and source_group is not null) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("obsid", F.col("scan"))
    checks = {"no file": F.col("level2_path") != "", "no group": F.col("source_group").isNotNull()}
    return _rounded(steps.run(steps.Config.loads(DEEP_MAP), observations(spark, d), rows, checks)[0], "pix")


@Q("ct10_map_per_feed", "select 'feed' || feed as split, pix, round(sum(w * tod) / sum(w), 6) as map, count(*) as hits from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(steps.preset(samples(spark, d), "map_per_feed", "pix", "tod", "w"), "split", "pix")


@Q("ct10_map_day_night", "select case when sample % 7 > 3 then 'day' else 'night' end as split, pix, round(sum(w * tod) / sum(w), 6) as map, count(*) as hits from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = samples(spark, d).withColumn("sun_altitude", F.col("sample") % 7 - 3.0)
    return _rounded(steps.preset(rows, "map_day_night", "pix", "tod", "w"), "split", "pix")


@Q("ct15_read_rates", "select band as workers, round(max(sample * 0.001 + tod) - min(sample * 0.001), 6) as wall, round(sum(case when k % 9 <> 0 then k * 1000 end) / 1048576.0::double / (max(sample * 0.001 + tod) - min(sample * 0.001)), 6) as mb_per_second, round(median(case when k % 9 <> 0 then sample * 0.001 + tod - sample * 0.001 end), 5) as median, round(quantile_cont(case when k % 9 <> 0 then sample * 0.001 + tod - sample * 0.001 end, 0.95), 5) as p95, count(*) filter (k % 9 = 0) as errors from (select band, sample::double as sample, tod, k from samples) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    began = F.col("sample").cast("double") * 0.001
    reads = samples(spark, d).select(F.col("band").alias("workers"), began.alias("began"), (began + F.col("tod")).alias("ended"), (F.col("k") * 1000).alias("bytes"), F.when(F.col("k") % 9 == 0, "failed").alias("error"))
    rates = J.read_rates(reads, ["workers"])
    return rates.select("workers", *[F.round(c, 6 if c in ("wall", "mb_per_second") else 5).alias(c) for c in ("wall", "mb_per_second", "median", "p95")], "errors")


@Q("ct16_registered_tables", "select n_regionkey as region, count(*) as n from nation group by 1 union all select 99, 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    nations, none = R.registered(spark, d, {"nation": "n_nationkey int, n_regionkey int", "not_there_yet": "obsid bigint"}, "tidewheel_")
    return spark.sql(f"select n_regionkey as region, count(*) as n from {nations} group by 1 union all select 99, count(*) from {none}")
