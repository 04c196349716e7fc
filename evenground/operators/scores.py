"""Geographic and demographic disparity scores."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.catalogs import BASELINES, PERCENTS, Z_90, Z_95
from evenground.functions.margins import divide, square, unpivot
from evenground.functions.names import baseline_population


def geo_difference(share: str, prop: str) -> str:
    return f"bround({share}, 3) - bround({prop}, 3)"


def geo_significant(share: str, prop: str, margin: str, strict_se: bool = False) -> str:
    """True when the share lies outside the 95 % band of the proportion.

    The band is 1.96 margins wide on each side; ``strict_se`` turns margins
    into standard errors first.
    """
    spread = f"{Z_95 / Z_90 if strict_se else Z_95}D * {margin}"
    return f"coalesce({share} <= {prop} - {spread} OR {share} >= {prop} + {spread}, false)"


def geo_scores(df: DataFrame, baselines: Iterable[str] = BASELINES, strict_se: bool = False) -> DataFrame:
    """Add ``diff_x`` and ``sig_diff_x`` for each baseline of a wide table."""
    new = []
    for b in baselines:
        significant = geo_significant("data_prop", f"prop_{b}", f"prop_{b}_margin", strict_se)
        new.append(f"{geo_difference('data_prop', f'prop_{b}')} AS diff_{b}")
        new.append(f"if({significant}, 'TRUE', 'FALSE') AS sig_diff_{b}")
    return df.selectExpr("*", *new)


def weighted_partials(tracts: DataFrame, keys: Sequence[str], percents: Iterable[str] = PERCENTS) -> DataFrame:
    """Sums behind point-weighted means, wide: one row per key.

    They add up, so sums of sub-areas give those of the main area, and the
    tract rows are read once without being multiplied by the variables.
    """
    sums = ["sum(weighted_counts) AS w"]
    for p in percents:
        spread = square(f"weighted_counts * {p}_margin")
        sums += [f"sum(weighted_counts * {p}) AS {p}", f"sum({spread}) AS {p}_margin"]
    return tracts.groupBy(*keys).agg(*map(F.expr, sums))


def merge_partials(partials: DataFrame, keys: Sequence[str], percents: Iterable[str] = PERCENTS) -> DataFrame:
    names = ["w", *[c for p in percents for c in (p, f"{p}_margin")]]
    return partials.groupBy(*keys).agg(*[F.expr(f"sum({n}) AS {n}") for n in names])


def partials_long(partials: DataFrame, keys: Sequence[str], percents: Iterable[str] = PERCENTS) -> DataFrame:
    """(keys, census_var, data_value, data_value_sd)."""
    rows = [
        (
            f"'{p}'",
            divide(f"coalesce({p}, 0D)", "w"),
            f"{divide(f'sqrt(coalesce({p}_margin, 0D))', 'abs(w)')} / {Z_90}D",
        )
        for p in percents
    ]
    return partials.selectExpr(*keys, unpivot(rows, ("census_var", "data_value", "data_value_sd")))


def demo_scores(values: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """Difference to the area-wide value and its Z-test.

    ``values``: (on..., census_var, data_value, data_value_sd); ``stats``:
    (on..., census_var, summary_value, summary_value_margin, names).  Without
    a margin there is no evidence, so the difference is not significant.
    """
    spread = f"sqrt({square('data_value_sd')} + {square('summary_value_margin')})"
    diff = "(data_value - summary_value)"
    significant = f"CASE WHEN {spread} = 0 THEN {diff} != 0 ELSE abs({divide(diff, spread)}) > {Z_95} END"
    known = "summary_value_margin IS NOT NULL"
    return values.join(stats, [*on, "census_var"]).withColumns(
        {
            "diff_data_city": F.expr(diff),
            "sig_diff": F.expr(f"coalesce({known} AND {significant}, false)"),
            "data_value_sd": F.expr(f"if({known}, data_value_sd, NULL)"),
            "baseline_pop": baseline_population(F.col("census_var")),
        }
    )
