"""Cleaning of point tables: casts, filters, drop reasons, row accounting.

Rows are never removed here.  Each row gets the first reason that applies
(``null_latlon`` > ``null_filter`` > ``null_weight`` > ``filtered``) or NULL,
so one grouped count later gives every counter of the report.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenground.catalogs import NA_TOKENS
from evenground.spec import DisparitySpec, Filter, RESERVED_ID, filter_date, input_name

POINT_COLUMNS = ["dataset_id", "geo", "lon", "lat", "weight", "drop_reason", "row_error"]
REASONS = ("null_latlon", "null_filter", "null_weight", "filtered")

_COMPARE = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt,
    "<=": operator.le, ">": operator.gt, ">=": operator.ge,
}
_DATE_FORMATS = ("MM/dd/yyyy", "MM/dd/yyyy HH:mm", "MM/dd/yyyy HH:mm:ss", "yyyyMMdd")


def missing_to_null(df: DataFrame, tokens=NA_TOKENS) -> DataFrame:
    """Cell texts that mean "missing" become NULL in every text column."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    return df.select(
        *[F.when(~_c(n).isin(*tokens), _c(n)).alias(n) if n in texts else _c(n) for n in df.columns]
    )


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def keep_input_id(df: DataFrame) -> DataFrame:
    """Rename an uploaded GEOID column; the new name must be free."""
    if RESERVED_ID in df.columns:
        raise ValueError(f"invalid_column_in_data: {RESERVED_ID}")
    return df.withColumnRenamed("GEOID", RESERVED_ID)


def as_number(c: Column) -> Column:
    """Double, or NULL when the text is no number; NaN and infinity are
    missing too."""
    number = F.nanvl(c.try_cast("double"), F.lit(None).cast("double"))
    return F.when(F.abs(number) < float("inf"), number)


def as_timestamp(c: Column) -> Column:
    return F.coalesce(
        c.try_cast("timestamp_ntz"),
        *[F.try_to_timestamp(c.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in _DATE_FORMATS],
    )


def typed(c: Column, kind: str) -> Column:
    if kind == "number":
        return as_number(c)
    if kind == "date":
        return as_timestamp(c)
    if kind == "string":
        return c.cast("string")
    raise ValueError(f"unknown filter type {kind!r}")


def _midnight(text: str) -> Column:
    return F.lit(filter_date(text).isoformat(sep=" ")).cast("timestamp_ntz")


def predicate(f: Filter, value: Column) -> Column:
    """Filter -> boolean column on its typed value."""
    text = str(f.value)
    if f.op == "singleDate":
        return value == _midnight(text)
    if f.op == "dateRange":
        first, last = text.split("-")
        return value.between(_midnight(first), _midnight(last))
    if f.op not in _COMPARE:
        raise ValueError(f"unknown comparison {f.op!r}")
    if f.kind == "string" and "," in text:
        if f.op not in ("==", "!="):
            raise ValueError("a list of texts allows == and != only")
        listed = value.isin(*text.split(","))
        return listed if f.op == "==" else ~listed
    literal = F.lit(text) if f.kind == "string" else F.lit(float(f.value))
    return _COMPARE[f.op](value, literal)


# the order in which filters are combined
def _order(f: Filter) -> int:
    if f.op in ("singleDate", "dateRange"):
        return 3 + (f.op == "dateRange")
    return {"number": 0, "string": 1}.get(f.kind, 2) + ("," in str(f.value) and f.kind == "string")


def all_filters(filters, values: list[Column]) -> Column:
    ordered = sorted(zip(filters, values, strict=True), key=lambda fv: _order(fv[0]))
    return reduce(operator.and_, [predicate(f, v) for f, v in ordered], F.lit(True))


def missing_columns(df: DataFrame, spec: DisparitySpec) -> list[str]:
    """Names of the errors for columns the table does not have."""
    have = set(df.columns)
    return [
        f"{error}:{','.join(lost)}"
        for error, wanted in spec.required_columns().items()
        if (lost := [c for c in wanted if c not in have])
    ]


def prepare_points(raw: DataFrame, spec: DisparitySpec) -> DataFrame:
    """User table -> the narrow point table all later steps read."""
    df = keep_input_id(raw)
    lost = missing_columns(df, spec)
    if lost:
        raise ValueError("; ".join(lost))
    raw = {"lon": _c(input_name(spec.lon_column)), "lat": _c(input_name(spec.lat_column))}
    casts = {"lon": as_number(raw["lon"]), "lat": as_number(raw["lat"])}
    if spec.weight_column:
        raw["weight"] = _c(input_name(spec.weight_column))
        casts["weight"] = as_number(raw["weight"])
    else:
        raw["weight"] = casts["weight"] = F.lit(1.0)
    for i, f in enumerate(spec.filters):
        raw[f"f{i}"] = _c(input_name(f.column))
        casts[f"f{i}"] = typed(raw[f"f{i}"], f.kind)
    dataset = _c(spec.dataset_column).cast("string") if spec.dataset_column else F.lit(spec.dataset_id)
    # a generator is evaluated once per row; as plain columns the casts would
    # be repeated in every condition below and in filters pushed towards the scan
    typed_rows = df.select(F.inline(F.array(F.struct(
        dataset.alias("dataset_id"),
        *[c.alias(n) for n, c in casts.items()],
        *[r.isNotNull().alias(f"has_{n}") for n, r in raw.items()],
    ))))

    def lost(name: str) -> Column:
        """The cast lost a value that was there."""
        return F.col(f"has_{name}") & F.col(name).isNull()

    lon, lat, weight = F.col("lon"), F.col("lat"), F.col("weight")
    values = [F.col(f"f{i}") for i in range(len(spec.filters))]
    null_filter = reduce(operator.or_, [v.isNull() for v in values], F.lit(False))
    reason = (
        F.when(lon.isNull() | lat.isNull(), F.lit("null_latlon"))
        .when(null_filter, F.lit("null_filter"))
        .when(weight.isNull() | (weight == 0), F.lit("null_weight"))
        .when(~F.coalesce(all_filters(spec.filters, values), F.lit(False)), F.lit("filtered"))
    )
    error = F.when(
        lost("lon") | lost("lat"), F.lit("lat_lon_cannot_be_converted_numeric")
    ).when(lost("weight"), F.lit("weight_coltypes_mismatch"))
    for i, f in enumerate(spec.filters):
        error = error.when(lost(f"f{i}"), F.lit(f"filter_coltypes_mismatch:{f.column}"))
    return typed_rows.select(
        "dataset_id", F.lit(spec.geo).alias("geo"), "lon", "lat", "weight",
        reason.alias("drop_reason"), error.alias("row_error"),
    )


def usable(points: DataFrame) -> DataFrame:
    return points.where(F.col("drop_reason").isNull() & F.col("row_error").isNull())


def row_accounting(points: DataFrame) -> DataFrame:
    """Rows per dataset, drop reason and cast error: one partial aggregate."""
    return points.groupBy("dataset_id", "geo", "drop_reason", "row_error").agg(
        F.count("*").alias("n_rows")
    )


def _rows(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("n_rows"))), F.lit(0)).cast("bigint")


def row_counters(accounting: DataFrame) -> DataFrame:
    """Counters of the report that do not need the spatial join."""
    reason = F.col("drop_reason")
    return accounting.groupBy("dataset_id").agg(
        F.sum("n_rows").cast("bigint").alias("num_rows_file"),
        _rows(reason == "null_latlon").alias("num_null_latlon_rows_dropped"),
        _rows(reason == "null_filter").alias("num_null_filter_rows_dropped"),
        _rows(reason == "null_weight").alias("num_null_weight_rows_dropped"),
        _rows(reason.isin("null_latlon", "null_filter", "null_weight")).alias("num_null_rows_dropped"),
        _rows(reason == "filtered").alias("num_filter_rows_dropped"),
        _rows(reason.isNull()).alias("num_rows_for_processing"),
    )
