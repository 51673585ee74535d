"""What a reduction keeps book of: complete products, absent files, map jobs, read rates."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lacking(required: list[str]) -> Column:
    """The names, in order, of required columns (nested ones with dots) that are null; none for a complete product."""
    return F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())


def processed(required: list[str]) -> Column:
    """Whether a product has everything that a step would make."""
    return F.size(lacking(required)) == 0


def absent(wanted: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ``wanted`` (obsid, path, ...) whose file is listed, errors (obsid, step, message) of the others)."""
    there = files.select("path").distinct()
    lost = wanted.join(there, "path", "left_anti")
    message = F.when(F.coalesce("path", F.lit("")) == "", "no path").otherwise(F.concat(F.lit("no file "), F.col("path")))
    return wanted.join(there, "path", "left_semi"), lost.select("obsid", F.lit("files").alias("step"), message.alias("message"))


def map_jobs(files: DataFrame, parameters: dict[str, object]) -> DataFrame:
    """(label, n, token) of (label, path) rows: twelve digits that change with the label, its files and the parameters.

    The files enter through the sum of their digests, so their order doesn't matter, a path that comes twice counts
    twice, and a label's files are never gathered.
    """
    digest = F.conv(F.substring(F.md5("path"), 1, 15), 16, 10).cast("decimal(20,0)")
    sums = files.where("path is not null").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(digest).cast("string").alias("_sum"))
    text = F.concat_ws("|", "label", F.lit(json.dumps(parameters, sort_keys=True)), F.col("n").cast("string"), "_sum")
    return sums.select("label", "n", F.substring(F.sha2(text, 256), 1, 12).alias("token"))


def read_rates(timings: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, wall, mb_per_second, median, p95, errors) of timed reads (began, ended in seconds, bytes, error).

    The wall time goes from the first start to the last end, the rate is in units of 2**20 bytes, and failed reads
    (with an error) count only as errors; a key without time or reads has null rates.
    """
    good = F.col("error").isNull()
    took = F.when(good, F.col("ended") - F.col("began"))
    wall = F.max("ended") - F.min("began")
    return timings.groupBy(*keys).agg(
        wall.alias("wall"), F.try_divide(F.sum(F.when(good, F.col("bytes"))) / float(1 << 20), wall).alias("mb_per_second"),
        F.percentile(took, F.lit(0.5)).alias("median"), F.percentile(took, F.lit(0.95)).alias("p95"), F.count_if(~good).alias("errors"))
