"""Counts per area: completion with zeros, roll-up, shares and coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def complete_counts(areas: DataFrame, counts: DataFrame, keys: Sequence[str] = ("dataset_id", "GEOID")) -> DataFrame:
    """All areas, with a count of 0 where there is no point."""
    filled = areas.join(counts.select(*keys, "weighted_counts"), list(keys), "left")
    return filled.withColumn("weighted_counts", F.coalesce("weighted_counts", F.lit(0.0)))


def roll_up(tracts: DataFrame, length: int, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Sum of tract counts per id prefix."""
    return tracts.groupBy(*keys, F.substring("GEOID", 1, length).alias("GEOID")).agg(
        F.sum("weighted_counts").alias("weighted_counts")
    )


def roll_up_all(tracts: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """State and county sums in one pass, as grouping sets."""
    state, county = F.substring("GEOID", 1, 2), F.substring("GEOID", 1, 5)
    return (
        tracts.select(*keys, "weighted_counts", state.alias("state"), county.alias("county"))
        .groupingSets(
            [[*[F.col(k) for k in keys], F.col("state")], [*[F.col(k) for k in keys], F.col("state"), F.col("county")]],
            *keys, "state", "county",
        )
        .agg(F.sum("weighted_counts").alias("weighted_counts"))
        .select(*keys, F.coalesce("county", "state").alias("GEOID"), "weighted_counts")
    )


def attach_counts(areas: DataFrame, rolled: DataFrame, keys: Sequence[str] = ("dataset_id", "GEOID")) -> DataFrame:
    """Higher-level areas with their counts; areas without tracts stay NULL."""
    return areas.join(rolled.select(*keys, "weighted_counts"), list(keys), "left")


def point_share(df: DataFrame, by: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Share of each area in the total of its group.

    The window holds areas, at most as many as the geography has, no points.
    """
    total = F.sum("weighted_counts").over(W.partitionBy(*by))
    return df.withColumn("data_prop", F.try_divide("weighted_counts", total))


def totals_differ(tracts: DataFrame, areas: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Check: tract and rolled totals agree.  Empty when the check holds."""

    def total(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("dataset_id").agg(F.sum("weighted_counts").alias(name))

    return (
        total(tracts, "tract_total").join(total(areas, "area_total"), "dataset_id", "full")
        .where(F.coalesce(F.abs(F.col("tract_total") - F.col("area_total")) >= tolerance, F.lit(True)))
    )


def sub_area_coverage(areas: DataFrame, keys: Sequence[str] = ("dataset_id",)) -> DataFrame:
    """Areas, areas with points, and a flag when at most half have any."""
    with_points = F.count_if(F.col("weighted_counts") > 0)
    return areas.groupBy(*keys).agg(
        F.count("*").alias("num_sub_geo_total"),
        with_points.alias("num_sub_geo_data"),
        (with_points / F.count("*") <= 0.5).alias("few_sub_geos_flag"),
    )
