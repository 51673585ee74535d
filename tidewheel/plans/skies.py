"""Sky coordinates, time and flux models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import sky as K
from tidewheel.plans.tables import Book, fields, flux, regions, samples

book = Book()
Q = book.add
WCS = {"crpix1": 91.0, "crpix2": 46.0, "crval1": 180.0, "crval2": 0.0, "cdelt1": -2.0, "cdelt2": 2.0, "nx": 181, "ny": 91}
LATITUDE, LONGITUDE = 37.2314, -118.2941
LST = "((((280.46061837 + 360.98564736629 * (mjd - 51544.5) + 0.000387933 * ((mjd - 51544.5) / 36525) ** 2 - ((mjd - 51544.5) / 36525) ** 3 / 38710000 - 118.2941) % 360) + 360) % 360) / 15"


def _matrix(rows: list[list[float]], lon: str, lat: str) -> tuple[str, str]:
    x, y, z = f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"
    u, v, w = (f"({a!r}::double * {x} + {b!r}::double * {y} + {c!r}::double * {z})" for a, b, c in rows)
    return f"((degrees(atan2({v}, {u})) % 360) + 360) % 360", f"degrees(asin(greatest(-1, least(1, {w}))))"


_TO = _matrix(K.GALACTIC, "l", "b")
_FROM = _matrix([list(c) for c in zip(*K.GALACTIC, strict=True)], "l", "b")


@Q("sf14_equatorial_to_galactic", f"select region, round({_TO[0]}, 6) as lon, round({_TO[1]}, 6) as lat from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = K.to_galactic(F.col("l"), F.col("b"))
    return regions(spark, d).select("region", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@Q("sf14_galactic_to_equatorial", f"select region, round({_FROM[0]}, 6) as ra, round({_FROM[1]}, 6) as dec from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    ra, dec = K.to_equatorial(F.col("l"), F.col("b"))
    return regions(spark, d).select("region", F.round(ra, 6).alias("ra"), F.round(dec, 6).alias("dec"))


@Q("sf10_sexagesimal", "with t as (select region, case when b < 0 then '-' else '' end || lpad(abs(b)::bigint::varchar, 2, '0') || ':30:' || lpad((abs(l)::bigint % 60)::varchar, 2, '0') as txt from regions) select region, txt, round(case when starts_with(txt, '-') then -1 else 1 end * (abs(split_part(txt, ':', 1)::double) + 0.5 + split_part(txt, ':', 3)::double / 3600), 9) as deg from t")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = regions(spark, d).select("region", F.concat(F.when(F.col("b") < 0, "-").otherwise(""), F.lpad(F.abs("b").cast("bigint").cast("string"), 2, "0"), F.lit(":30:"), F.lpad((F.round(F.abs("l")).cast("bigint") % 60).cast("string"), 2, "0")).alias("txt"))
    return rows.select("region", "txt", F.round(K.sexagesimal(F.col("txt")), 9).alias("deg"))


@Q("sf11_to_sexagesimal", "with v as (select region, round(abs(l) / 15 * 360000)::bigint as r, l < 0 as rn, round(abs(b) * 360000)::bigint as c, b < 0 as dn from regions) select region, case when rn then '-' else '' end || lpad((r // 360000)::varchar, 2, '0') || ':' || lpad((r // 6000 % 60)::varchar, 2, '0') || ':' || lpad((r // 100 % 60)::varchar, 2, '0') || '.' || lpad((r % 100)::varchar, 2, '0') as ra, case when dn then '-' else '' end || lpad((c // 360000)::varchar, 2, '0') || ':' || lpad((c // 6000 % 60)::varchar, 2, '0') || ':' || lpad((c // 100 % 60)::varchar, 2, '0') || '.' || lpad((c % 100)::varchar, 2, '0') as dec from v")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).select("region", K.to_sexagesimal(F.col("l"), hours=True).alias("ra"), K.to_sexagesimal(F.col("b")).alias("dec"))


@Q("sf12_separation", "select region, round(degrees(acos(greatest(-1, least(1, sin(radians(b)) * sin(radians(10)) + cos(radians(b)) * cos(radians(10)) * cos(radians(l - 30)))))), 6) as sep from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).select("region", F.round(K.separation(F.col("l"), F.col("b"), F.lit(30.0), F.lit(10.0)), 6).alias("sep"))


@Q("sf13_relative_frame", "select region, round(degrees(atan2(cos(radians(b)) * sin(radians(l - 30)), cos(radians(b)) * cos(radians(l - 30)) * cos(radians(10)) + sin(radians(b)) * sin(radians(10)))), 6) as x, round(degrees(asin(greatest(-1, least(1, sin(radians(b)) * cos(radians(10)) - cos(radians(b)) * cos(radians(l - 30)) * sin(radians(10)))))), 6) as y from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    x, y = K.relative(F.col("l"), F.col("b"), F.lit(30.0), F.lit(10.0))
    return regions(spark, d).select("region", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@Q("sf18_horizon", "with h as (select sample, radians(az * 2 - pix) as h, radians(el - 30) as d, radians(37.2314) as p from samples) select sample, round(((degrees(atan2(-cos(d) * sin(h), sin(d) * cos(p) - cos(d) * cos(h) * sin(p))) % 360) + 360) % 360, 5) as az, round(degrees(asin(greatest(-1, least(1, sin(d) * sin(p) + cos(d) * cos(p) * cos(h))))), 6) as el from h")
def _(spark: SparkSession, d: str) -> DataFrame:
    az, el = K.horizon(F.col("pix").cast("double"), F.col("el") - 30, F.col("az") * 2 / 15, LATITUDE)
    return samples(spark, d).select("sample", F.round(az, 5).alias("az"), F.round(el, 6).alias("el"))


@Q("sf16_horizon_to_equatorial", "with h as (select sample, el, radians(az) as a, radians(el) as e, radians(37.2314) as p, pix from samples) select sample, round(degrees(asin(sin(e) * sin(p) + cos(e) * cos(p) * cos(a))), 6) as dec from h")
def _(spark: SparkSession, d: str) -> DataFrame:
    _, dec = K.from_horizon(F.col("az"), F.col("el"), F.col("pix") / 10.0, LATITUDE)
    return samples(spark, d).select("sample", F.round(dec, 6).alias("dec"))


@Q("sf20_sidereal_time", f"select sample, round({LST}, 5) as lst from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.sidereal_hours(F.col("mjd"), LONGITUDE), 5).alias("lst"))


@Q("sf21_parallactic_angle", "with h as (select sample, radians(az * 2 - pix) as h, radians(el - 30) as d, radians(37.2314) as p from samples) select sample, round(degrees(atan2(sin(h) * cos(p), sin(p) * cos(d) - cos(p) * sin(d) * cos(h))), 5) as pa from h")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.parallactic(F.col("pix").cast("double"), F.col("el") - 30, F.col("az") * 2 / 15, LATITUDE), 5).alias("pa"))


@Q("sf22_bearing", "select region, round(degrees(atan2(sin(radians(50 - l)) * cos(radians(20)), cos(radians(b)) * sin(radians(20)) - sin(radians(b)) * cos(radians(20)) * cos(radians(50 - l)))), 6) as pa from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).select("region", F.round(K.bearing(F.col("l"), F.col("b"), F.lit(50.0), F.lit(20.0)), 6).alias("pa"))


@Q("sf23_rotate", "select region, round(l * cos(radians(30)) + b * sin(radians(30)), 6) as x, round(b * cos(radians(30)) - l * sin(radians(30)), 6) as y, round(sqrt(l * l * 0.75 + b * b * 0.25), 6) as ex from regions")
def _(spark: SparkSession, d: str) -> DataFrame:
    x, y = K.rotated(F.col("l"), F.col("b"), F.lit(30.0))
    ex, _ = K.rotated_error(F.col("l"), F.col("b"), F.lit(30.0))
    return regions(spark, d).select("region", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"), F.round(ex, 6).alias("ex"))


@Q("sf27_pointing_model", "with r as (select sample, radians(az) as a, radians(el) as e from samples) select sample, round(degrees((0.001 + tan(e) * (0.003 + 0.004 * cos(a) + 0.005 * sin(a))) / cos(e)), 8) as daz, round(degrees(0.002 + 0.006 * cos(e) + 0.004 * sin(a + 0.1) + 0.005 * cos(a + 0.1)), 8) as del from r")
def _(spark: SparkSession, d: str) -> DataFrame:
    az, el = K.pointing_offsets(F.col("az"), F.col("el"), [0.001, 0.002, 0.003, 0.004, 0.005, 0.006, 0.1])
    return samples(spark, d).select("sample", F.round(az, 8).alias("daz"), F.round(el, 8).alias("del"))


@Q("sf28_world_to_pixel", "with p as (select region, 90.0 + (l - 180) / -2.0 as x, 45.0 + b / 2.0 as y from regions) select region, case when x >= 0 and y >= 0 and x < 181 and y < 91 then (floor(y) * 181 + floor(x))::bigint end as pix from p")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).select("region", K.pixel(F.col("l"), F.col("b"), WCS).alias("pix"))


@Q("sf29_pixel_to_world", "select pix, 180 + (pix % 181 - 90) * -2.0::double as lon, (pix // 181 - 45) * 2.0::double as lat from (select distinct pix from samples)")
def _(spark: SparkSession, d: str) -> DataFrame:
    lon, lat = K.pixel_centre(F.col("pix"), WCS)
    return samples(spark, d).select("pix").distinct().select("pix", lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def healpix_sql(rows: str, n: int) -> str:
    """(key, pix) of rows (key, lon, lat): the RING number by the same formulas."""
    return f"""with p as (select key, sin(radians(lat)) as z, ((lon % 360) + 360) % 360 / 90 as tt from ({rows})),
q as (select key, z, tt, floor({n} * (0.5 + tt) - {n} * 0.75 * z)::bigint as jp, floor({n} * (0.5 + tt) + {n} * 0.75 * z)::bigint as jm, {n} * sqrt(3.0 * (1 - abs(z))) as root, tt - floor(tt) as tp from p),
r as (select *, {n + 1} + jp - jm as ir, floor(tp * root)::bigint + floor((1 - tp) * root)::bigint + 1 as ring from q)
select key, case when abs(z) <= 2.0 / 3 then {2 * n * (n - 1)} + (ir - 1) * {4 * n} + (((jp + jm - {n} + case when ir % 2 = 0 then 1 else 0 end + 1) // 2) % {4 * n} + {4 * n}) % {4 * n}
  when z > 0 then 2 * ring * (ring - 1) + floor(tt * ring)::bigint % (4 * ring) else {12 * n * n} - 2 * ring * (ring + 1) + floor(tt * ring)::bigint % (4 * ring) end as pix from r"""


@Q("sf31_healpix_ring", "select key as region, pix from (" + healpix_sql("select region as key, l as lon, b * 8 as lat from regions", 64) + ")")
def _(spark: SparkSession, d: str) -> DataFrame:
    return regions(spark, d).select("region", K.healpix_ring(F.col("l"), F.col("b") * 8, 64).alias("pix"))


@Q("sf32_flux_density", "select obsid, feed, round(measured * 2 * pi() * radians(chi2 / 60) * radians(chi2 / 50) * 2 * 1.380649e-23 * (30e9 / 299792458) ** 2 * 1e26 / 1e6, 4) as jy from flux")
def _(spark: SparkSession, d: str) -> DataFrame:
    return flux(spark, d).select("obsid", "feed", F.round(K.gaussian_flux(F.col("measured"), F.col("chi2") / 60, F.col("chi2") / 50, F.lit(30.0)) / 1e6, 4).alias("jy"))


@Q("sf33_model_flux", "with x as (select distinct source, mjd, log10(30 / 40.0) as x from flux) select source, mjd, round(case source when 'TauA' then pow(10, 2.506 - 0.302 * x) * (1 - 0.0021 * (mjd - 53371) / 365.25) when 'CasA' then pow(10, 2.204 - 0.682 * x + 0.038 * x * x) * (1 - 0.0051 * (mjd - 51544) / 365.25) when 'CygA' then pow(10, 1.480 - 1.172 * x) end, 6) as jy from x")
def _(spark: SparkSession, d: str) -> DataFrame:
    rows = flux(spark, d).select("source", "mjd").distinct()
    return rows.select("source", "mjd", F.round(K.model_flux(F.col("source"), F.lit(30.0), F.col("mjd")), 6).alias("jy"))


@Q("sf35_polynomial", "select sample, round(1.5 + -0.25 * x + 0.125 * x * x, 9) as y from (select sample, (mjd - 59000) / 365.25 as x from samples)")
def _(spark: SparkSession, d: str) -> DataFrame:
    from tidewheel.functions.values import polynomial

    x = (F.col("mjd") - 59000) / 365.25
    return samples(spark, d).select("sample", F.round(polynomial(F.array(F.lit(1.5), F.lit(-0.25), F.lit(0.125)), x), 9).alias("y"))


@Q("sf37_power_law", "select sample, round(1 + 0.25 * pow(abs(k + 1), -2.0), 9) as p from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.power_law(F.lit(1.0), F.lit(0.5), F.lit(-2.0), F.col("k") + 1.0), 9).alias("p"))


@Q("sf39_knee", "select sample, round(pow(2.0 / w, 2 / -1.5), 9) as knee from samples")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.knee(F.lit(2.0), F.col("w"), F.lit(-1.5)), 9).alias("knee"))


@Q("jn19_rounded_coordinates", "select region, field from regions r join fields f on round(r.l, 6) = round(f.l + 0.25, 6)")
def _(spark: SparkSession, d: str) -> DataFrame:
    r = regions(spark, d).select("region", F.round("l", 6).alias("key"))
    return r.join(fields(spark, d).select("field", F.round(F.col("l") + 0.25, 6).alias("key")), "key").select("region", "field")


@Q("sf33_jupiter_flux", "with t as (select 34.688 - 0.5 * i as f, list_extract([151.013, 150.385, 149.615, 149.876, 148.534, 147.707, 147.235, 146.635, 145.72, 145.347, 144.794, 143.911, 143.225, 142.369, 141.757], i + 1) as k from range(15) t(i)), l as (select regr_slope(log10(k), log10(f / 30)) as s, regr_intercept(log10(k), log10(f / 30)) as c from t) select sample, round(pow(10, c + s * log10((26 + band * 2) / 30.0)) * 2.481e-8 * pow(5.2 / (4 + k / 50.0), 2) * 2 * 1.380649e-23 * pow((26 + band * 2) * 1e9 / 299792458, 2) * 1e26, 6) as jy from samples, l")
def _(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample", F.round(K.jupiter_flux(26.0 + F.col("band") * 2, 4 + F.col("k") / 50.0), 6).alias("jy"))


@Q("sf32_flux_error", "select obsid, feed, round(abs(measured) * sqrt((0.5 / measured) ** 2 + (0.1 / chi2) ** 2 + (0.2 / chi2) ** 2), 6) as err from flux where measured > 0 and chi2 > 0")
def _(spark: SparkSession, d: str) -> DataFrame:
    m, c = F.col("measured"), F.col("chi2")
    rows = flux(spark, d).where("measured > 0 and chi2 > 0")
    return rows.select("obsid", "feed", F.round(K.flux_error(m, (m, F.lit(0.5)), (c, F.lit(0.1)), (c, F.lit(0.2))), 6).alias("err"))
