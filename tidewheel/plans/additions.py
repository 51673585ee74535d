"""Products, parameter tables, positions and scans that the other books don't call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.operators import catalogue as C
from tidewheel.operators import maps as M
from tidewheel.operators import ordered as O
from tidewheel.operators import scans as P
from tidewheel.plans import skies
from tidewheel.plans.tables import Book, fields, flux, observations, raw, regions, samples, spectra, summaries
from tidewheel.sources import readers as R
from tidewheel.sources import writers as W
from tidewheel.sources.scratch import folder

book = Book()
Q = book.add
MAP = "m as (select pix, sum(w * tod) / sum(w) as naive, sqrt(1 / sum(w)) as rms, count(*) as hits from samples group by 1)"


@Q("sc1_file_metadata", "with f as (select obsid, '/raw/c-' || lpad(obsid::varchar, 7, '0') || '-' || k || '.hd5' as path, obsid + case when obsid % 10 = 0 then 1 else 0 end as own from observations, range(2) t(k) where obsid % 7 <> 3) select own as obsid, max(path) as path from f group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).select("obsid", F.explode(F.array(F.lit(0), F.lit(1))).alias("k"))
    own = F.col("obsid") + F.when(F.col("obsid") % 10 == 0, 1).otherwise(0)
    path = F.concat(F.lit("/raw/c-"), F.lpad(F.col("obsid").cast("string"), 7, "0"), F.lit("-"), F.col("k"), F.lit(".hd5"))
    text = F.when(F.col("obsid") % 7 == 3, "{broken").otherwise(F.concat(F.lit('{"obsid": '), own, F.lit("}")))
    found, _ = R.file_metadata(o.select(path.alias("path"), text.alias("attributes")))
    return found.select("obsid", "path")


@Q("sc1_mismatched_files", "select '/raw/c-' || lpad(obsid::varchar, 7, '0') || '-0.hd5' as path, obsid as named, obsid + 1 as obsid from observations where obsid % 10 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    o = observations(spark, d).select("obsid")
    own = F.col("obsid") + F.when(F.col("obsid") % 10 == 0, 1).otherwise(0)
    files = o.select(F.concat(F.lit("/raw/c-"), F.lpad(F.col("obsid").cast("string"), 7, "0"), F.lit("-0.hd5")).alias("path"), F.concat(F.lit('{"obsid": '), own, F.lit("}")).alias("attributes"))
    return R.file_metadata(files)[1]


@Q("sc11_flag_csv", "select c_custkey as first, case when c_custkey % 3 = 0 then c_custkey + 5 when c_custkey % 3 = 1 then c_custkey else 4611686018427387904 end as last from customer")
def _(spark: SparkSession, d: str) -> DataFrame:
    path, k = folder(spark, "flag-csv"), F.col("c_custkey")
    end = F.when(k % 3 == 0, (k + 5).cast("string")).when(k % 3 == 2, "ongoing")
    raw(spark, d, "customer").select(k.cast("string").alias("obsid_start"), end.alias("obsid_end"), F.lit("All").alias("pixels"), F.lit("BandA").alias("sidebands")).write.csv(path, header=True)
    return C.flag_ranges(R.flag_csv(spark, path)).select("first", "last")


@Q("sc12_field_csv", "select field, round(15 * (floor(abs(l) / 15) + 0.5), 9) as ra, round(case when b < 0 then -1 else 1 end * (abs(b) + 0.25), 9) as dec from fields")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "field-csv")
    ra = F.concat(F.lpad(F.floor(F.abs("l") / 15).cast("string"), 2, "0"), F.lit(":30:00"))
    dec = F.concat(F.when(F.col("b") < 0, "-").otherwise(""), F.lpad(F.abs("b").cast("int").cast("string"), 2, "0"), F.lit(":15:00"))
    fields(spark, d).select(F.col("field").alias("field_name"), ra.alias("ra"), dec.alias("dec"), F.col("grp").alias("group"), F.lit("").alias("notes")).write.csv(path, header=True)
    return R.field_csv(spark, path).select(F.col("field_name").alias("field"), F.round("ra_deg", 9).alias("ra"), F.round("dec_deg", 9).alias("dec"))


@Q("sc15_file_list", "select level2_path as path from observations where level2_path <> '' and obsid % 2 = 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "file-list")
    line = F.when(F.col("obsid") % 2 == 0, F.concat(F.lit("  "), "level2_path", F.lit(" "))).otherwise(F.concat(F.lit("# "), "level2_path"))
    observations(spark, d).where("level2_path <> ''").select(line.alias("value")).write.text(path)
    return R.lines(spark, path).select(F.col("value").alias("path"))


@Q("pr17_stale_files", "select obsid, level2_path from observations where level2_path <> '' and started < timestamp '1995-01-01'")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = observations(spark, d).where("level2_path <> ''").withColumn("modified", F.col("started").cast("timestamp"))
    return R.stale(rows, "1995-01-01 00:00:00").select("obsid", "level2_path")


@Q("sc19_line_samples", "with g as (select band, channel, 1.5 + channel % 3 as gain, 0.1 + channel % 5 as rms from (select distinct band, channel from spectra)), s as (select *, 26 + band * 2 + channel * 0.03125 as freq from spectra) select s.sample, s.band, s.channel, round(299792.458 * (28.5 - freq) / 28.5, 6) as velocity, round(value / gain, 9) as value, round((gain / rms) ** 2, 9) as weight from s join g using (band, channel) where abs(freq - 28.51) <= 0.2")
def _(spark: SparkSession, d: str) -> DataFrame:
    one = spectra(spark, d).withColumn("freq", 26 + F.col("band") * 2 + F.col("channel") * 0.03125)
    two = spectra(spark, d).select("band", "channel").distinct().select("band", "channel", (1.5 + F.col("channel") % 3).alias("gain"), (0.1 + F.col("channel") % 5).alias("rms"))
    rows = P.line_samples(one, two, ["band"], 28.51, 0.2, 28.5)
    return rows.select("sample", "band", "channel", F.round("velocity", 6).alias("velocity"), F.round("value", 9).alias("value"), F.round("weight", 9).alias("weight"))


@Q("sk5_line_cube", "select band as ifreq, pix, round(sum(w * tod) / sum(w), 6) as map from samples group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "line-cube")
    cube = M.binned(samples(spark, d).withColumnRenamed("band", "ifreq"), ["ifreq", "pix"], F.col("tod"), F.col("w")).withColumn("map", F.round(F.col("total") / F.col("weight"), 6))
    W.line_cube(cube, path)
    return spark.read.schema("pix bigint, map double, ifreq bigint").parquet(path).select("ifreq", "pix", "map")


@Q("sc20_map_products", f"with {MAP} select pix, round(naive, 6) as naive, round(rms, 6) as rms, hits from m")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "map-product")
    m = M.binned(samples(spark, d), ["pix"], F.col("tod"), F.col("w"))
    W.map_product(m.select("pix", F.round(F.col("total") / F.col("weight"), 6).alias("naive"), F.round(F.sqrt(1 / F.col("weight")), 6).alias("rms"), "hits"), path, {"nx": 15})
    return R.map_products(spark, path)


@Q("sc22_parameter_table", "select s.sample, round(tod / g, 6) as tod from samples s join (select feed, band, 1 + feed * 0.1::double + band as g from (select distinct feed, band from samples)) using (feed, band)")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "parameters")
    rows = samples(spark, d).select("sample", "feed", "band", "tod")
    rows.select("feed", "band").distinct().withColumn("g", 1 + F.col("feed") * F.lit(0.1) + F.col("band")).write.parquet(path)
    return rows.join(R.parameters(spark, path, ["feed", "band"], ["g"]), ["feed", "band"]).select("sample", F.round(F.col("tod") / F.col("g"), 6).alias("tod"))


@Q("sc23_calibrator_cache", "select source, feed, count(*) as n, round(avg(measured), 4) as mean from flux group by 1, 2")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "calibrators")
    make = lambda: flux(spark, d).groupBy("source", "feed").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("measured"), 4).alias("mean"))
    R.cached(spark, path, make)
    return R.cached(spark, path, lambda: spark.range(0).toDF("never"))


@Q("sk6_cumulative_stages", "with c as (select sample // 2500 as stage, pix, sum(w) as w, count(*) as h from samples group by 1, 2) select stage, pix, (sum(h) over (partition by pix order by stage rows unbounded preceding))::bigint as hits from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "stages")
    c = M.binned(samples(spark, d).withColumn("stage", F.floor(F.col("sample") / 2500)), ["stage", "pix"], F.col("tod"), F.col("w"))
    run = Window.partitionBy("pix").orderBy("stage").rowsBetween(Window.unboundedPreceding, 0)
    W.stages(c.select("stage", "pix", F.sum("hits").over(run).alias("hits")), path, "stage")
    return spark.read.schema("pix bigint, hits bigint, stage bigint").parquet(path).select("stage", "pix", "hits")


@Q("sk10_remote_inventory", "select o_orderkey as obsid, '/path/' || o_orderkey as path from orders where o_orderkey % 4 <> 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    path = folder(spark, "inventory")
    o = raw(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("k"))
    listing = R.remote_listing(o.select(F.concat("k", F.lit(" _ L1 /path/"), "k").alias("value")), o.where("false").select(F.col("k").alias("value")))
    listing.where("obsid % 4 <> 1").select("obsid", "path").write.parquet(path)
    return spark.read.parquet(path)


@Q("st7_random_subset", "select obsid, level2_path from observations where level2_path <> '' order by md5('7:' || obsid), obsid limit 25")
def _(spark: SparkSession, d: str) -> DataFrame:
    return C.random_subset(observations(spark, d).where("level2_path <> ''").select("obsid", "level2_path"), "obsid", 25, 7)


@Q("mu18_legacy_copy", "select obsid, processing_status, median_tsys from summaries union all select o_orderkey, 'F' || o_orderstatus, null from orders where o_orderkey not in (select obsid from summaries)")
def _(spark: SparkSession, d: str) -> DataFrame:
    new = summaries(spark, d).select("obsid", "processing_status", "median_tsys")
    old = raw(spark, d, "orders").select("o_orderkey", F.concat(F.lit("F"), "o_orderstatus").alias("state"), "o_totalprice")
    return C.copied(old, new, {"o_orderkey": "obsid", "state": "processing_status"})


@Q("sf24_precession", """with p as (select region, radians(l) as a, radians(b) as d, (51544.5 + l * 40 - 51544.5) / 36525 as t from regions),
q as (select region, a, d, radians((2306.2181 * t + 0.30188 * t * t + 0.017998 * t * t * t) / 3600) as zeta, radians((2306.2181 * t + 1.09468 * t * t + 0.018203 * t * t * t) / 3600) as z, radians((2004.3109 * t - 0.42665 * t * t - 0.041833 * t * t * t) / 3600) as th from p)
select region, round((degrees(atan2(cos(d) * sin(a - z), cos(th) * cos(d) * cos(a - z) + sin(th) * sin(d)) - zeta) % 360 + 360) % 360, 7) as ra, round(degrees(asin(cos(th) * sin(d) - sin(th) * cos(d) * cos(a - z))), 7) as dec from q""")
def _(spark: SparkSession, d: str) -> DataFrame:
    ra, dec = K.precessed(F.col("l"), F.col("b"), 51544.5 + F.col("l") * 40)
    return regions(spark, d).select("region", F.round(ra, 7).alias("ra"), F.round(dec, 7).alias("dec"))


EPHEMERIS = "eph as (select obsid, feed, sample * 10 + 3 as t, pix * 1.5::double as ra from samples where sample % 7 = 2)"


@Q("sf25_ephemeris", f"with {EPHEMERIS}, b as (select s.sample, s.obsid, s.feed, s.tm, h.t as t0, h.ra as v0 from (select sample, obsid, feed, sample * 10 as tm from samples) s asof left join eph h on s.obsid = h.obsid and s.feed = h.feed and s.tm >= h.t), c as (select b.*, h.t as t1, h.ra as v1 from b asof left join eph h on b.obsid = h.obsid and b.feed = h.feed and b.tm <= h.t) select sample, round(coalesce(case when t1 > t0 then v0 + (v1 - v0) * (tm - t0) / (t1 - t0) else v0 end, v0, v1), 9) as ra from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    """Positions of a moving source from a table sampled every few minutes, linear in time between its rows."""
    rows = samples(spark, d).select("sample", "obsid", "feed", (F.col("sample") * 10).alias("at"))
    table = samples(spark, d).where("sample % 7 = 2").select("obsid", "feed", (F.col("sample") * 10 + 3).alias("t"), (F.col("pix") * F.lit(1.5)).alias("ra"))
    return O.interpolate(rows, table, ["obsid", "feed"], "at", "t", "ra").select("sample", F.round("ra", 9).alias("ra"))


@Q("sf25_sun", """with p as (select distinct scan, min(mjd) as mjd from samples group by scan), q as (select scan, mjd - 51544.5 as n, radians(357.528 + 0.9856003 * (mjd - 51544.5)) as g from p),
r as (select scan, g, radians(280.460 + 0.9856474 * n + 1.915 * sin(g) + 0.020 * sin(2 * g)) as lon, radians(23.439 - 0.0000004 * n) as tilt from q)
select scan, round((degrees(atan2(cos(tilt) * sin(lon), cos(lon))) % 360 + 360) % 360, 6) as ra, round(degrees(asin(sin(tilt) * sin(lon))), 6) as dec, round(1.00014 - 0.01671 * cos(g) - 0.00014 * cos(2 * g), 9) as au from r""")
def _(spark: SparkSession, d: str) -> DataFrame:
    ra, dec, au = K.sun(F.col("mjd"))
    rows = samples(spark, d).groupBy("scan").agg(F.min("mjd").alias("mjd"))
    return rows.select("scan", F.round(ra, 6).alias("ra"), F.round(dec, 6).alias("dec"), F.round(au, 9).alias("au"))


@Q("sf26_refraction", "with c as (select sample, 1 / tan(radians(greatest(el - 36, 5))) as c, 900 + k::double as p from samples) select sample, round((58.294 * c - 0.0668 * c * c * c) / 3600 * (p / 1010) * (283.0 / (273.0 + 5)), 9) as lift from c")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.refraction(F.col("el") - 36, 900 + F.col("k").cast("double"), F.lit(5.0)), 9).alias("lift"))


@Q("kn36_relative_to_source", """with p as (select sample, radians(az - 109) as d, radians(el) as a, radians(50.0::double) as b from samples) select sample, round(degrees(atan2(cos(a) * sin(d), cos(a) * cos(d) * cos(b) + sin(a) * sin(b))), 6) as dx, round(degrees(asin(sin(a) * cos(b) - cos(a) * cos(d) * sin(b))), 6) as dy from p""")
def _(spark: SparkSession, d: str) -> DataFrame:
    x, y = K.relative(F.col("az"), F.col("el"), F.lit(109.0), F.lit(50.0))
    return samples(spark, d).select("sample", F.round(x, 6).alias("dx"), F.round(y, 6).alias("dy"))


@Q("kn25_offsets_in_map", "with c as (select sample // 50 as o, pix, sum(w) as w, sum(w * tod) as wd from samples group by 1, 2), v as (select o, sum(wd) / sum(w) as v from c group by 1) select pix, round((sum(wd) - sum(c.w * v)) / sum(c.w), 6) as sky from c join v using (o) group by 1")
def _(spark: SparkSession, d: str) -> DataFrame:
    """The naive map less what the offsets put into it."""
    cells = M.compressed(samples(spark, d).withColumn("o", F.floor(F.col("sample") / 50)), "o", "pix", F.col("tod"), F.col("w"))
    v = cells.groupBy("offset").agg((F.sum("wd") / F.sum("w")).alias("v"))
    both = M.sky(cells, "wd").join(M.offset_map(cells, v), "pix")
    return both.select("pix", F.round(F.col("sky") - F.col("offset_map"), 6).alias("sky"))


@Q("kn23_regularised_matvec", """with c as (select sample // 50 as o, pix, sum(w) as w from samples group by 1, 2), v as (select distinct o, (o % 7 - 3)::double as v from c), x as (select c.o, pix, w, w * v as wv from c join v using (o)), m as (select pix, sum(wv) / sum(w) as sky from x group by 1), a as (select o, sum(wv - w * sky) as a from x join m using (pix) group by 1),
g as (select v.o, v.v, coalesce(p.v - v.v, 0) + coalesce(n.v - v.v, 0) as g from v left join v p on p.o = v.o - 1 left join v n on n.o = v.o + 1),
h as (select g.o, g.v, g.g, coalesce(p.g - g.g, 0) + coalesce(n.g - g.g, 0) as h from g left join g p on p.o = g.o - 1 left join g n on n.o = g.o + 1)
select o as "offset", round(a + 0.1 * v + 0.3 * g + 0.2 * h, 6) as a from a join h using (o)""")
def _(spark: SparkSession, d: str) -> DataFrame:
    cells = M.compressed(samples(spark, d).withColumn("o", F.floor(F.col("sample") / 50)), "o", "pix", F.col("tod"), F.col("w"))
    v = cells.select("offset").distinct().withColumn("v", (F.col("offset") % 7 - 3).cast("double"))
    return M.applied(cells, v, 0.1, 0.3, 0.2).select("offset", F.round("a", 6).alias("a"))


VANE = "vane as (select feed, band, channel, 30 + channel % 7 + feed * 0.5::double as tsys, 1.5::double + band * 0.25::double as gain, 0.2::double + channel % 3 as rms from (select distinct sample % 19 + 1 as feed, band, channel from spectra)), atm as (select feed, band, 0.1::double * feed as c, 0.02::double * band as tau from (select distinct feed, band from vane))"


def _vane(tod: DataFrame) -> tuple[DataFrame, DataFrame]:
    vane = tod.select("feed", "band", "channel").distinct().withColumns({"tsys": 30 + F.col("channel") % 7 + F.col("feed") * F.lit(0.5), "gain": 1.5 + F.col("band") * 0.25, "rms": 0.2 + F.col("channel") % 3})
    return vane, tod.select("feed", "band").distinct().withColumns({"offset": F.lit(0.1) * F.col("feed"), "tau": F.lit(0.02) * F.col("band")})


@Q("kn47_gain_filter_and_bin", f"""with {VANE}, s as (select sample, sample % 19 + 1 as feed, band, channel, value, 26 + band * 2 + channel * 0.03125::double as freq, 40 + sample % 30 as el from spectra),
r as (select s.sample, s.feed, s.band, s.channel, freq, tsys, (gain / rms) ** 2 as w, value / gain - c - tau / sin(radians(el)) as v from s join vane using (feed, band, channel) join atm using (feed, band) where s.feed <> 19),
f0 as (select feed, avg(freq) as f0 from (select distinct feed, band, channel, freq from r) group by 1),
q as (select r.*, 1 / tsys as a, (freq - f0) / tsys as b from r join f0 using (feed)),
m as (select feed, sum(a * a) as aa, sum(a * b) as ab, sum(a) as sa, sum(b * b) as bb, sum(b) as sb, count(*)::double as n from (select distinct feed, band, channel, a, b from q) group by 1),
t as (select feed, sample, sum(a * v / tsys) as x, sum(b * v / tsys) as y, sum(v / tsys) as z from q group by 1, 2),
g as (select feed, sample, (aa * (bb * z - sb * y) - ab * (ab * z - sa * y) + x * (ab * sb - bb * sa)) / (aa * (bb * n - sb * sb) - ab * (ab * n - sb * sa) + sa * (ab * sb - bb * sa)) as g from t join m using (feed))
select feed, band, sample, channel // 32 as bin, round(sum(w * v) / sum(w), 6) as value, round(sum(w * (v - g * tsys)) / sum(w), 4) as filtered from q join g using (feed, sample) group by 1, 2, 3, 4""")
def _(spark: SparkSession, d: str) -> DataFrame:
    tod = spectra(spark, d).withColumns({"feed": F.col("sample") % 19 + 1, "freq": 26 + F.col("band") * 2 + F.col("channel") * F.lit(0.03125), "el": 40 + F.col("sample") % 30})
    out = P.gain_filter_and_bin(tod, *_vane(tod), "sample", 32, skip_feeds=(19,))
    return out.select("feed", "band", "sample", "bin", F.round("value", 6).alias("value"), F.round("filtered", 4).alias("filtered"))


@Q("kn11_continuum", "with r as (select sample, channel, value, 1 / (40 + channel % 7) as a, (channel - 31.5) / 31.5 / (40 + channel % 7) as b from spectra), f as (select sample, (sum(a * value) * sum(b * b) - sum(b * value) * sum(a * b)) / (sum(a * a) * sum(b * b) - sum(a * b) ** 2) as t from r group by 1) select sample, channel, round(t, 6) as t from r join f using (sample)")
def _(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("channel")
    rows = spectra(spark, d).withColumns({"a": 1 / (40 + c % 7), "b": (c - 31.5) / 31.5 / (40 + c % 7)})
    return P.continuum(rows, [], "sample", "channel", "value", ("a", "b"), "t").select("sample", "channel", F.round("t", 6).alias("t"))


@Q("sf19_galactic_horizon", f"with p as (select region, {skies._FROM[0]} as ra, {skies._FROM[1]} as dec from regions), q as (select region, radians(6.5 * 15 - ra) as h, radians(dec) as d, radians(37.2) as p from p) select region, round(((degrees(atan2(-cos(d) * sin(h), sin(d) * cos(p) - cos(d) * cos(h) * sin(p))) % 360) + 360) % 360, 6) as az, round(degrees(asin(sin(d) * sin(p) + cos(d) * cos(p) * cos(h))), 6) as el from q")
def _(spark: SparkSession, d: str) -> DataFrame:
    az, el = K.galactic_horizon(F.col("l"), F.col("b"), F.lit(6.5), 37.2)
    return regions(spark, d).select("region", F.round(az, 6).alias("az"), F.round(el, 6).alias("el"))
