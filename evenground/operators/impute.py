"""Preparation of sample tables: recodes and imputation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.session import durable, small_side


def recode_codes(df: DataFrame, column: str, codes: Mapping[float, float | None]) -> DataFrame:
    """Values from 0 up stay; listed codes are replaced; the rest is missing."""
    value = F.col(column).cast("double")
    out = F.when(value >= 0, value)
    for code, new in codes.items():
        out = out.when(value == code, F.lit(new).cast("double"))
    return df.withColumn(column, out)


def _with_mean(df: DataFrame, column: str, by: str | None) -> DataFrame:
    """Attach the mean as a one-column table per group, not as a window:
    a window over everything would put all rows into one task."""
    if by is None:
        mean = df.agg(F.avg(column).alias("mean_value"))
        return df.withColumn("mean_value", mean.scalar())
    # a group's rows stay where they are while its means are few
    means = durable(df.groupBy(by).agg(F.avg(column).alias("mean_value")))
    return df.join(small_side(means), by, "left")


def impute_mean(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    return (
        _with_mean(df, column, by)
        .withColumn(column, F.coalesce(column, "mean_value"))
        .drop("mean_value")
    )


def impute_fallback(df: DataFrame, column: str, other: str, by: str | None = None) -> DataFrame:
    """Own value, else the other column, else the mean of own values."""
    return (
        _with_mean(df, column, by)
        .withColumn(column, F.coalesce(column, other, "mean_value"))
        .drop("mean_value")
    )


# Codes of the library table, -3 closed outlet, -1 missing.
LIBRARY_HOURS = {-3: 0.0, -1: None}


def prepare_libraries(df: DataFrame) -> DataFrame:
    return impute_mean(recode_codes(df, "HOURS", LIBRARY_HOURS), "HOURS")


def prepare_housing(df: DataFrame) -> DataFrame:
    return impute_fallback(df, "LI_UNITS", "N_UNITS")
