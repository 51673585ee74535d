"""Readers: file discovery, text lists, CSV catalogues, optional tables, map products."""

from __future__ import annotations

import os
import random
import time
import tomllib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewheel.functions.sky import sexagesimal, to_galactic
from tidewheel.functions.values import obsid_by_digits, obsid_of_path

FLAG_COLUMNS = "obsid_start string, obsid_end string, pixels string, sidebands string"
FIELD_COLUMNS = "field_name string, ra string, dec string, `group` string, notes string"


class BadFile(Exception):
    """A file that can't be read; ``obsid`` is the id in its name, or -1."""

    def __init__(self, obsid: int, message: str) -> None:
        super().__init__(f"{obsid}: {message}")
        self.obsid = obsid


def retried(read: Callable[[str], object], path: str, most: int = 8, delay: float = 2.0, factor: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> object:
    """What ``read`` gives of a path on the driver: after an OSError it waits, each time ``factor`` times longer and up to 30 % more or less, and tries again, at most ``most`` times more; then BadFile.

    Spark's own scans need none of this: their tasks are tried again by the scheduler.
    """
    for n in range(most + 1):
        try:
            return read(path)
        except OSError as e:
            last = e
            if n < most:
                sleep(delay * factor**n * random.uniform(0.7, 1.3))
    parts = os.path.basename(path).split("-")
    obsid = int(parts[1]) if len(parts) > 1 and parts[1].isascii() and parts[1].isdigit() else -1
    raise BadFile(obsid, f"can't read {path} after {most} further tries: {last}")


def timed_reads(read: Callable[[str], int], paths: list[str], workers: int) -> list[tuple[int, str, float, float, int, str | None]]:
    """(workers, path, began, ended, bytes, error) of reading each path once with so many threads; for ``operators.jobs.read_rates``."""

    def one(path: str) -> tuple[int, str, float, float, int, str | None]:
        began = time.perf_counter()
        try:
            size, error = read(path), None
        except (OSError, BadFile) as e:
            size, error = 0, str(e)
        return workers, path, began, time.perf_counter(), size, error

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, paths))


def listed(spark: SparkSession, root: str, pattern: str = "*.hd5") -> DataFrame:
    """(path, modified, size) of the files below a folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def level2_files(files: DataFrame) -> DataFrame:
    """(obsid, path, n): for each id the first path in order and the number of paths; names without an id go."""
    named = files.select(obsid_by_digits(F.col("path")).alias("obsid"), "path").where("obsid is not null")
    return named.groupBy("obsid").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("n"))


def level1_files(files: DataFrame) -> DataFrame:
    """(obsid, path): ids parsed from raw names, the last path winning."""
    named = files.select(obsid_of_path(F.col("path")).alias("obsid"), "path").where("obsid is not null")
    return named.groupBy("obsid").agg(F.max("path").alias("path"))


def stale(files: DataFrame, before: str) -> DataFrame:
    """Files last changed before a time."""
    return files.where(F.col("modified") < F.lit(before).cast("timestamp"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): trimmed lines of a text file, without blank ones and ``#`` comments."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and value not like '#%'")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return lines(spark, path).select(F.col("value").try_cast("bigint").alias("obsid")).where("obsid is not null").distinct()


def flag_csv(spark: SparkSession, path: str) -> DataFrame:
    """Observer flags as text columns, for ``catalogue.flag_ranges``."""
    return spark.read.csv(path, header=True, schema=FLAG_COLUMNS, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def field_csv(spark: SparkSession, path: str) -> DataFrame:
    """The field catalogue with positions in degrees, equatorial and galactic."""
    rows = spark.read.csv(path, header=True, schema=FIELD_COLUMNS)
    rows = rows.withColumn("ra_deg", sexagesimal(F.col("ra"), hours=True)).withColumn("dec_deg", sexagesimal(F.col("dec")))
    lon, lat = to_galactic(F.col("ra_deg"), F.col("dec_deg"))
    return rows.withColumn("l", lon).withColumn("b", lat)


def text_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns of a CSV file with a header, as they stand, as text."""
    return spark.read.csv(path, header=True, inferSchema=False)


def region_csv(spark: SparkSession, path: str, lon: str, lat: str) -> DataFrame:
    """Catalogue rows that have both coordinates, renamed l and b; a missing column is an error."""
    rows = spark.read.csv(path, header=True, inferSchema=True)
    lost = {lon, lat} - set(rows.columns)
    if lost:
        raise ValueError(f"the catalogue lacks {sorted(lost)}")
    return rows.dropna(subset=[lon, lat]).withColumnsRenamed({lon: "l", lat: "b"})


def remote_listing(files: DataFrame, targets: DataFrame) -> DataFrame:
    """(obsid, path, target, comment) of listing lines: white-space columns ``id _ L1 path ...`` and ``id target (comment``; lines without a whole id go."""
    f = files.select(F.split(F.trim("value"), r"\s+").alias("c")).select(F.get("c", F.lit(0)).try_cast("bigint").alias("obsid"), F.get("c", F.lit(3)).alias("path")).where("obsid is not null")
    t = targets.select(F.split(F.trim("value"), r"\s+", 2).alias("c")).select(F.get("c", F.lit(0)).try_cast("bigint").alias("obsid"), F.get("c", F.lit(1)).alias("rest")).where("obsid is not null")
    t = t.select("obsid", F.trim(F.split_part("rest", F.lit("("), F.lit(1))).alias("target"), F.rtrim(F.split_part("rest", F.lit("("), F.lit(2)), F.lit(")")).alias("comment"))
    return f.join(t, "obsid", "left").select("obsid", "path", F.coalesce("target", F.lit("Unknown")).alias("target"), "comment")


def optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A table, or no rows where it doesn't exist."""
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(empty.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return empty
        raise


def registered(spark: SparkSession, folder: str, schemas: dict[str, str], prefix: str = "") -> list[str]:
    """Names the tables of a folder as views that ``spark.sql`` can ask; a table that isn't there yet has no rows."""
    for name, schema in schemas.items():
        optional(spark, f"{folder}/{name}.parquet", schema).createOrReplaceTempView(prefix + name)
    return [prefix + name for name in schemas]


def per_scan(cubes: DataFrame, names: list[str]) -> DataFrame:
    """One row for each (feed, band, channel, scan) of nested array columns ``names``, all of one shape."""
    rows = cubes.select(*[c for c in cubes.columns if c not in names], F.arrays_zip(*names).alias("_z"))
    for level in ("feed", "band", "channel", "scan"):
        parts = [c for c in rows.columns if c != "_z"]
        rows = rows.select(*parts, F.posexplode("_z").alias(level, "_e"))
        if level != "scan":
            rows = rows.select(*parts, level, F.arrays_zip(*[F.col(f"_e.{n}").alias(n) for n in names]).alias("_z"))
        else:
            rows = rows.select(*parts, level, *[F.col(f"_e.{n}").alias(n) for n in names])
    return rows


def file_metadata(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((obsid, path, attributes), mismatches) of (path, attributes) rows: attributes are a JSON object with ``obsid``.

    Files whose name has no id, or whose attributes don't parse or have no id, are left out; of several files of one
    attribute id the last path stays. Mismatches are the files whose name has another id than their attributes.
    """
    rows = files.select("path", "attributes", obsid_of_path(F.col("path")).alias("named"), F.get_json_object("attributes", "$.obsid").try_cast("bigint").alias("obsid"))
    rows = rows.where("named is not null and obsid is not null")
    last = rows.groupBy("obsid").agg(F.max(F.struct("path", "attributes")).alias("f")).select("obsid", "f.path", "f.attributes")
    return last, rows.where("named <> obsid").select("path", "named", "obsid")


def wcs_definition(paths: list[str], name: str) -> dict[str, float]:
    """A named grid of the first file of definitions that exists, as ``functions.sky.pixel`` takes it; no such file or name is an error."""
    for path in paths:
        if os.path.exists(path):
            with open(path, "rb") as f:
                known = tomllib.load(f)
            if name not in known:
                raise KeyError(f"{path} defines no grid {name}")
            own = {k.lower(): v for k, v in known[name].items()}
            return {"nx": own["naxis1"], "ny": own["naxis2"]} | {k: float(own[k]) for k in ("crpix1", "crpix2", "crval1", "crval2", "cdelt1", "cdelt2")}
    raise FileNotFoundError(f"none of {paths} exists")


def map_products(spark: SparkSession, path: str, columns: tuple[str, ...] = ("naive", "rms", "hits")) -> DataFrame:
    """The images of a map product, a column each."""
    return spark.read.parquet(f"{path}/map").select("pix", *columns)


def parameters(spark: SparkSession, path: str, keys: list[str], values: list[str]) -> DataFrame:
    """A small table of parameters by key, of distinct keys: a key that comes twice is an error."""
    rows = spark.read.parquet(path).select(*keys, *values)
    again = rows.groupBy(*keys).count().where("count > 1").first()
    if again:
        raise ValueError(f"parameters of {tuple(again)[:-1]} come twice")
    return rows


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], rebuild: bool = False) -> DataFrame:
    """The table at ``path``, made and written first if it is not there or ``rebuild`` is asked."""
    if not rebuild:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
