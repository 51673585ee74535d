"""The steps that a configuration can name without registering any of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.operators import maps as M
from tidewheel.operators import signal as S
from tidewheel.plans.steps import split_keys, step


@step("Clean.Where")
def where(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which a condition in SQL holds."""
    return df.where(condition)


@step("Clean.Finite")
def finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which no one of the columns is null, NaN or infinite."""
    for c in columns:
        df = df.where(F.col(c).isNotNull() & (F.abs(F.col(c).cast("double")) < float("inf")))
    return df


@step("Clean.Between")
def between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows with a value from low to high, both included; nulls go."""
    return df.where(F.col(column).between(low, high))


@step("Reduce.Atmosphere")
def less_atmosphere(df: DataFrame, keys: list[str], value: str, out: str, el: str = "el") -> DataFrame:
    """Adds the value less its own fit of the atmosphere."""
    return S.less_atmosphere(df, S.atmosphere(df, keys, value, el), keys, value, out, el)


@step("Reduce.Detrend")
def detrended(df: DataFrame, keys: list[str], order: str, value: str, along: list[str], degree: int = 3) -> DataFrame:
    return S.detrended(df, keys, order, value, along, degree)


@step("Reduce.NoiseWeights")
def noise_weights(df: DataFrame, keys: list[str], order: str, value: str, out: str = "w") -> DataFrame:
    """Sets a weight for all rows of a key from its pair noise."""
    return df.drop(out).join(S.noise_weights(df, keys, order, value).withColumnRenamed("w", out), keys, "left")


@step("Reduce.LongMedian")
def long_median(df: DataFrame, keys: list[str], order: str, value: str, size: int, out: str) -> DataFrame:
    return S.long_median(df, keys, order, value, size, out)


@step("Maps.Split")
def split(df: DataFrame, mode: str, **how: object) -> DataFrame:
    return split_keys(df, mode, **how)


@step("Maps.Binned")
def binned(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """(keys, map, weight, hits); the last key is the pixel. Pixels without weight have a null map."""
    m = M.binned(df, keys, F.col(value), F.col(weight))
    return m.select(*keys, F.try_divide("total", "weight").alias("map"), "weight", "hits")
