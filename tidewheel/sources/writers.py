"""Writers: partitioned products, replaced groups, reports, catalogue snapshots and map tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def level2(samples: DataFrame, path: str, scale: dict[str, float]) -> None:
    """Samples with scaled columns, partitioned by month and source."""
    rows = samples.withColumns({c: (F.col(c) * k).cast(samples.schema[c].dataType) for c, k in scale.items()})
    rows.withColumn("year_month", F.date_format("started", "yyyy-MM")).write.mode("overwrite").partitionBy("year_month", "source").parquet(path)


def replaced(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Replaces only the partitions that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def report(rows: DataFrame, path: str, separator: str = ",") -> None:
    rows.write.mode("overwrite").csv(path, header=True, sep=separator, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def path_list(obs: DataFrame, path: str) -> None:
    """The non-empty paths in order of id, one a line."""
    obs.where("level2_path <> ''").orderBy("obsid").select(F.col("level2_path").alias("value")).write.mode("overwrite").text(path)


def group_lists(rows: DataFrame, path: str) -> None:
    """Ids by field and group, one folder each."""
    rows.select("field", "grp", F.col("obsid").cast("string").alias("value")).write.mode("overwrite").partitionBy("field", "grp").text(path)


def snapshot(obs: DataFrame, flags: DataFrame, path: str) -> None:
    """Each observation with its flags nested; nulls become NaN, -1 or the empty text by type."""
    defaults = {"double": F.lit(float("nan")), "bigint": F.lit(-1).cast("bigint"), "int": F.lit(-1), "string": F.lit("")}
    cells = flags.select("obsid", F.struct(*[F.coalesce(c, defaults[t]).alias(c) if t in defaults else F.col(c) for c, t in flags.dtypes if c != "obsid"]).alias("cell"))
    obs.join(cells.groupBy("obsid").agg(F.sort_array(F.collect_list("cell")).alias("flags")), "obsid", "left").write.mode("overwrite").parquet(path)


def map_product(maps: DataFrame, path: str, header: dict[str, object]) -> None:
    """A map table (pix, naive, rms, hits, mask and others) and a one-row header with the least and largest finite value."""
    maps.write.mode("overwrite").parquet(f"{path}/map")
    spark = maps.sparkSession
    ends = spark.read.parquet(f"{path}/map").agg(F.min(F.nanvl("naive", F.lit(None).cast("double"))).alias("datamin"), F.max(F.nanvl("naive", F.lit(None).cast("double"))).alias("datamax"))
    ends.withColumn("header", F.lit(json.dumps(header, sort_keys=True))).write.mode("overwrite").json(f"{path}/header")


def model_table(models: DataFrame, path: str) -> None:
    """Calibration models with coefficients as arrays."""
    models.write.mode("overwrite").parquet(path)


def line_cube(cube: DataFrame, path: str) -> None:
    """A line's cube (ifreq, pix, map and others), only its sky, one folder for each frequency."""
    cube.select("ifreq", "pix", "map").write.mode("overwrite").partitionBy("ifreq").parquet(path)


def stages(maps: DataFrame, path: str, stage: str) -> None:
    """Cumulative maps, one folder for each stage."""
    maps.write.mode("overwrite").partitionBy(stage).parquet(path)


def job_files(files: DataFrame, jobs: DataFrame, path: str) -> None:
    """A map job's list of files (label, path) and its row (label, n, token), one folder for each label and token."""
    jobs.write.mode("overwrite").parquet(f"{path}/jobs")
    own = files.sparkSession.read.parquet(f"{path}/jobs").select(F.col("label").alias("_label"), "token")
    rows = files.where("path is not null").join(own, F.col("label").eqNullSafe(F.col("_label")))
    rows.select("label", "token", F.col("path").alias("value")).write.mode("overwrite").partitionBy("label", "token").text(f"{path}/lists")
