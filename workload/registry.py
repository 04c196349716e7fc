"""Registry of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from evenground.operators.outputs import rounded
from workload.views import sql

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def query(oracle: str | None = None, extra: dict[str, str] | None = None, name: str | None = None):
    """Register a query; ``oracle`` is shared text with names in braces."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        QUERIES[key] = f
        if oracle is not None:
            ORACLES[key] = sql(oracle, extra)
        return f

    return register


def settle(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round doubles, so that the order of a sum does not show."""
    out = rounded(df, digits)
    # bigint for counts, so that both engines agree on the type
    return out.selectExpr(
        *[f"CAST(`{n}` AS BIGINT) AS `{n}`" if t in ("int", "smallint") else f"`{n}`" for n, t in out.dtypes]
    )


def r(expression: str, name: str, digits: int = DIGITS) -> str:
    """SQL for a settled double: half-even rounding, no negative zero."""
    e = f"round_even(CAST({expression} AS DOUBLE), {digits})"
    return f"CASE WHEN {e} = 0 THEN CAST(0 AS DOUBLE) ELSE {e} END AS {name}"
