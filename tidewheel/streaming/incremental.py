"""Streams: discovery of new observations, maps that deepen with every batch, windowed statistics of late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def source(spark: SparkSession, path: str, schema: StructType, files_a_batch: int = 8) -> DataFrame:
    """New Parquet files of a folder, some a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def windowed(stream: DataFrame, time: str, value: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts, sums and extremes for each window; rows later than ``late`` behind the newest are dropped with their state."""
    rows = stream.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", late)
    out = rows.groupBy(F.window("_t", width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most"))
    return out.select(F.col("window.start").alias("start"), *keys, "n", "total", "least", "most")


def deepening_map(stream: DataFrame, pix: str, value: str, weight: str) -> DataFrame:
    """Running weighted sums by pixel: the state is one row a pixel."""
    w, v = F.col(weight), F.col(value)
    return stream.where(F.col(pix).isNotNull()).groupBy(pix).agg(F.sum(v * w).alias("total"), F.sum(w).alias("weight"), F.count(F.lit(1)).alias("hits"))


def unprocessed(stream: DataFrame, done: DataFrame, key: str = "obsid") -> DataFrame:
    """Observations that a table of finished ones lacks."""
    return stream.join(done.select(key).distinct(), key, "left_anti")


def written(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Processes what is there and stops; the checkpoint lets the next call go on."""
    return stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", path).start()


def replaced(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Writes the whole state after every batch (complete mode), replacing the last one."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return stream.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
