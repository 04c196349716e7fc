"""Queries on points: cleaning, filters, accounting, spatial joins, areas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenground.functions.geometry import box_rings
from evenground.functions.names import padded_id
from evenground.operators import baseline as bl
from evenground.operators.clean import as_timestamp, missing_to_null, prepare_points, row_accounting, row_counters, usable
from evenground.operators.overlay import dissolve
from evenground.operators.spatial import (
    area_hits, cell_index, dominant_area, oriented_points, point_in_polygon, sampled, weighted_counts,
)
from evenground.spec import DisparitySpec, Filter
from workload.formulas import EXTRA
from workload.registry import query, r, settle
from workload.views import view


def spec(*filters: Filter, geo: str = "national", weight: str | None = "weight") -> DisparitySpec:
    return DisparitySpec("all", "lat", "lon", geo, filters, weight, dataset_column="dataset_id")


def points(spark, sf, *filters: Filter) -> DataFrame:
    return prepare_points(view(spark, sf, "fx_point"), spec(*filters))


def upload_points(spark, sf, *filters: Filter) -> DataFrame:
    return prepare_points(missing_to_null(view(spark, sf, "fx_upload")), spec(*filters))


def tract_shapes(spark, sf) -> DataFrame:
    return view(spark, sf, "fx_square").select("GEOID", box_rings(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))


def place_shapes(spark, sf) -> DataFrame:
    return view(spark, sf, "fx_place").select("place_geoid", box_rings(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))


def upper_shapes(spark, sf, length: int) -> DataFrame:
    keyed = tract_shapes(spark, sf).withColumn("area", F.substring("GEOID", 1, length))
    return dissolve(keyed, "area").withColumnRenamed("area", "GEOID")


def tract_counts(spark, sf) -> DataFrame:
    counts = weighted_counts(usable(points(spark, sf)), cell_index(tract_shapes(spark, sf)))
    return counts.where(F.col("GEOID").isNotNull())


# --- spatial join ----------------------------------------------------------


@query(f"SELECT dataset_id, GEOID, {r('weighted_counts', 'weighted_counts', 2)}, n AS n_joined FROM {{fx_count}}", EXTRA)
def point_in_tract_count(spark, sf):
    return settle(tract_counts(spark, sf).select("dataset_id", "GEOID", "weighted_counts", "n_joined"), 2)


@query(f"SELECT dataset_id, GEOID, {r('weighted_counts', 'weighted_counts', 2)}, n AS n_joined FROM {{fx_count}}", EXTRA)
def point_in_tract_count_shuffled(spark, sf):
    """The same join when the index is too large to broadcast."""
    index = cell_index(tract_shapes(spark, sf))
    counts = weighted_counts(usable(points(spark, sf)), index, broadcast_bytes=-1, rows_per_task=10_000)
    return settle(
        counts.where(F.col("GEOID").isNotNull()).select("dataset_id", "GEOID", "weighted_counts", "n_joined"), 2
    )


@query("SELECT dataset_id, count(*) AS n_points, CAST(sum(CASE WHEN GEOID IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_outside"
       " FROM {fx_hit} GROUP BY dataset_id", EXTRA)
def out_of_area_points(spark, sf):
    joined = point_in_polygon(usable(points(spark, sf)), cell_index(tract_shapes(spark, sf)))
    return joined.groupBy("dataset_id").agg(
        F.count_if("first_match").alias("n_points"), F.count_if(F.col("GEOID").isNull()).alias("n_outside")
    )


@query("SELECT p.dataset_id, c.place_geoid, count(*) AS n FROM {fx_usable} p JOIN {fx_place} c"
       " ON p.lon > c.x0 AND p.lon < c.x1 AND p.lat > c.y0 AND p.lat < c.y1 GROUP BY p.dataset_id, c.place_geoid", EXTRA)
def point_in_overlapping_places(spark, sf):
    """A point in two polygons counts for both."""
    index = cell_index(place_shapes(spark, sf), "place_geoid")
    joined = point_in_polygon(usable(points(spark, sf)), index, "place_geoid")
    return joined.where(F.col("place_geoid").isNotNull()).groupBy("dataset_id", "place_geoid").agg(F.count("*").alias("n"))


# --- row accounting and filters --------------------------------------------

_TOKENS = "('NA', '', 'n/a', 'NULL', '#N/A')"
_TYPED = {
    "up": "SELECT dataset_id, " + ", ".join(f"CASE WHEN {c} IN {_TOKENS} THEN NULL ELSE {c} END AS {c}" for c in ("lon", "lat", "weight", "quantity", "status", "shipdate")) + " FROM {fx_upload}",
    "up_typed": "SELECT dataset_id, TRY_CAST(lon AS DOUBLE) AS lon, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(weight AS DOUBLE) AS weight,"
                " TRY_CAST(quantity AS DOUBLE) AS quantity, status, TRY_CAST(shipdate AS TIMESTAMP) AS shipdate FROM {up}",
}


def _counters(null_filter: str, keep: str) -> tuple[str, dict[str, str]]:
    reason = (
        "CASE WHEN lon IS NULL OR lat IS NULL THEN 'null_latlon'"
        f" WHEN {null_filter} THEN 'null_filter' WHEN weight IS NULL OR weight = 0 THEN 'null_weight'"
        f" WHEN NOT ({keep}) THEN 'filtered' ELSE 'kept' END"
    )
    n = lambda *xs: "CAST(sum(CASE WHEN reason IN (" + ", ".join(f"'{x}'" for x in xs) + ") THEN 1 ELSE 0 END) AS BIGINT)"
    text = (
        f"SELECT dataset_id, count(*) AS num_rows_file, {n('null_latlon')} AS num_null_latlon_rows_dropped,"
        f" {n('null_filter')} AS num_null_filter_rows_dropped, {n('null_weight')} AS num_null_weight_rows_dropped,"
        f" {n('null_latlon', 'null_filter', 'null_weight')} AS num_null_rows_dropped,"
        f" {n('filtered')} AS num_filter_rows_dropped, {n('kept')} AS num_rows_for_processing"
        f" FROM (SELECT dataset_id, {reason} AS reason FROM {{up_typed}}) x GROUP BY dataset_id"
    )
    return text, _TYPED


def _counted(spark, sf, *filters: Filter) -> DataFrame:
    return row_counters(row_accounting(upload_points(spark, sf, *filters)))


@query(*_counters("quantity IS NULL OR status IS NULL", "quantity > 5 AND status = 'O'"))
def row_accounting_all_reasons(spark, sf):
    return _counted(spark, sf, Filter("quantity", "number", ">", 5), Filter("status", "string", "==", "O"))


@query(*_counters("1 = 0", "1 = 1"))
def null_and_zero_weight_drop(spark, sf):
    return _counted(spark, sf)


_FILTERS = {
    "filter_number": ((Filter("quantity", "number", "<=", 20),), "quantity IS NULL", "quantity <= 20"),
    "filter_number_not_equal": ((Filter("quantity", "number", "!=", "20"),), "quantity IS NULL", "quantity <> 20"),
    "filter_text": ((Filter("status", "string", "==", "F"),), "status IS NULL", "status = 'F'"),
    "filter_text_list": ((Filter("status", "string", "!=", "F,X"),), "status IS NULL", "status NOT IN ('F', 'X')"),
    "filter_single_date": (
        (Filter("shipdate", "date", "singleDate", "01/15/1996"),), "shipdate IS NULL", "shipdate = TIMESTAMP '1996-01-15 00:00:00'",
    ),
    "filter_date_range": (
        (Filter("shipdate", "date", "dateRange", "01/01/1996-12/31/1998"),), "shipdate IS NULL",
        "shipdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'",
    ),
    "filter_conjunction": (
        (Filter("shipdate", "date", "dateRange", "01/01/1996-12/31/1998"), Filter("status", "string", "==", "F,O"),
         Filter("quantity", "number", ">=", 10)),
        "shipdate IS NULL OR status IS NULL OR quantity IS NULL",
        "shipdate BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'"
        " AND status IN ('F', 'O') AND quantity >= 10",
    ),
}
for _name, (_filters, _null, _keep) in _FILTERS.items():
    query(*_counters(_null, _keep), name=_name)(
        lambda spark, sf, _filters=_filters: _counted(spark, sf, *_filters)
    )


@query("SELECT dataset_id, lon_error, count(*) AS n FROM (SELECT dataset_id, CASE WHEN status IS NOT NULL THEN"
       " 'lat_lon_cannot_be_converted_numeric' ELSE 'none' END AS lon_error FROM {up}) x GROUP BY dataset_id, lon_error", _TYPED)
def cast_errors(spark, sf):
    """A text column used as longitude: every value present is an error."""
    up = missing_to_null(view(spark, sf, "fx_upload"))
    bad = prepare_points(up, DisparitySpec("all", "lat", "status", "national", (), "weight", dataset_column="dataset_id"))
    return bad.groupBy("dataset_id", F.coalesce("row_error", F.lit("none")).alias("lon_error")).agg(F.count("*").alias("n"))


@query("SELECT CAST(count(lon) AS BIGINT) AS lon, CAST(count(lat) AS BIGINT) AS lat, CAST(count(weight) AS BIGINT) AS weight,"
       " CAST(count(quantity) AS BIGINT) AS quantity, CAST(count(status) AS BIGINT) AS status,"
       " CAST(count(shipdate) AS BIGINT) AS shipdate FROM {up}", _TYPED)
def missing_tokens(spark, sf):
    up = missing_to_null(view(spark, sf, "fx_upload"))
    return up.agg(*[F.count(c).alias(c) for c in ("lon", "lat", "weight", "quantity", "status", "shipdate")])


@query("SELECT year(shipdate) AS y, count(*) AS n FROM {up_typed} GROUP BY year(shipdate)", _TYPED)
def date_cast(spark, sf):
    up = view(spark, sf, "fx_upload")
    typed = missing_to_null(up).select(as_timestamp(F.col("shipdate")).alias("t"))
    return typed.groupBy(F.year("t").cast("bigint").alias("y")).agg(F.count("*").alias("n"))


# --- area detection ---------------------------------------------------------

_DETECT = {
    **EXTRA,
    "hit_area": "SELECT dataset_id, substring(GEOID, 1, 5) AS area, count(*) AS n FROM {fx_hit}"
                " WHERE GEOID IS NOT NULL GROUP BY dataset_id, substring(GEOID, 1, 5)",
    "ranked": "SELECT dataset_id, area, row_number() OVER (PARTITION BY dataset_id ORDER BY n DESC, area) AS rk,"
              " count(*) OVER (PARTITION BY dataset_id) AS n_areas FROM {hit_area}",
}


def _county_areas(spark, sf):
    shapes = upper_shapes(spark, sf, 5)
    return cell_index(shapes), shapes.select("GEOID", F.concat(F.lit("County "), "GEOID").alias("cleaned_name"))


def _detected(df: DataFrame) -> DataFrame:
    return df.select(
        "dataset_id", "denom_geoid", "g_disp", "flipped", "multiple_geographies_flag",
        F.size("multiple_geographies_list").cast("bigint").alias("n_listed"),
    )


def _detect_sql(flipped: str = "FALSE") -> str:
    return (
        f"SELECT dataset_id, area AS denom_geoid, 'County ' || area AS g_disp, {flipped} AS flipped,"
        " n_areas > 1 AS multiple_geographies_flag, CASE WHEN n_areas > 1 THEN n_areas ELSE NULL END AS n_listed"
        " FROM {ranked} WHERE rk = 1"
    )


@query(_detect_sql(), _DETECT)
def dominant_county(spark, sf):
    index, areas = _county_areas(spark, sf)
    return _detected(dominant_area(area_hits(usable(points(spark, sf)), index), areas))


@query(_detect_sql("dataset_id = 'R'"), _DETECT)
def flip_retry(spark, sf):
    """One dataset arrives with its coordinates exchanged."""
    index, areas = _county_areas(spark, sf)
    exchanged = F.col("dataset_id") == "R"
    p = usable(points(spark, sf)).withColumns(
        {"lon": F.when(exchanged, F.col("lat")).otherwise(F.col("lon")),
         "lat": F.when(exchanged, F.col("lon")).otherwise(F.col("lat"))}
    )
    return _detected(dominant_area(area_hits(p, index), areas))


@query(f"SELECT dataset_id, GEOID, {r('weighted_counts', 'weighted_counts', 2)} FROM {{fx_count}}", EXTRA)
def flipped_counts(spark, sf):
    """Counts after flipped datasets were turned back."""
    p = usable(points(spark, sf))
    exchanged = F.col("dataset_id") == "R"
    wrong = p.withColumns(
        {"lon": F.when(exchanged, F.col("lat")).otherwise(F.col("lon")),
         "lat": F.when(exchanged, F.col("lon")).otherwise(F.col("lat"))}
    )
    index, areas = _county_areas(spark, sf)
    found = dominant_area(area_hits(wrong, index), areas)
    counts = weighted_counts(oriented_points(wrong, found), cell_index(tract_shapes(spark, sf)))
    return settle(counts.where(F.col("GEOID").isNotNull()).select("dataset_id", "GEOID", "weighted_counts"), 2)


@query("SELECT dataset_id, count(*) AS n, " + r("sum(weight)", "weight", 2) + " FROM {fx_usable}"
       " WHERE ('0x' || substring(md5(concat_ws('|', CAST(lon AS STRING), CAST(lat AS STRING), CAST(weight AS STRING))), 1, 8))::BIGINT"
       " < CAST(floor(0.05 * 4294967296) AS BIGINT) GROUP BY dataset_id", EXTRA)
def detection_sample(spark, sf):
    """The repeatable 5 % sample area detection works on."""
    return settle(
        sampled(usable(points(spark, sf)), None, 0.05)
        .groupBy("dataset_id").agg(F.count("*").alias("n"), F.sum("weight").alias("weight")), 2
    )


@query("SELECT place_geoid, namelsad, k.id AS padded FROM {fx_place} JOIN (SELECT place_geoid AS g,"
       " CASE WHEN length(ltrim(place_geoid, '0')) < 11 THEN lpad(ltrim(place_geoid, '0'), 11, '0') ELSE ltrim(place_geoid, '0') END AS id"
       " FROM {fx_place}) k ON k.g = place_geoid")
def id_pad(spark, sf):
    return view(spark, sf, "fx_place").select(
        "place_geoid", "namelsad", padded_id(F.ltrim(F.col("place_geoid"), F.lit("0")), 11).alias("padded")
    )


_STEP = "CASE WHEN strpos({0}, '{1}') > 0 THEN substring({0}, 1, length({0}) - strpos(reverse({0}), reverse('{1}')) - length('{1}') + 1) || substring({0}, length({0}) - strpos(reverse({0}), reverse('{1}')) + 2) ELSE {0} END"
_WORDS = ("city", "CDP", "town", "village", "(balance)", "unified government", "consolidated government",
          "metropolitan government", "metro government", "urban county", "municipality")
_PLACE = {"pn_0": "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN s_name || ' city' WHEN 1 THEN 'Carson City city ' || s_name || ' city'"
                  " WHEN 2 THEN s_name || ' metropolitan government (balance)' WHEN 3 THEN s_name || ' CDP' ELSE 'Midtown ' || s_name || ' town' END AS n FROM {supplier}"}
for _i, _w in enumerate(_WORDS):
    _PLACE[f"pn_{_i + 1}"] = f"SELECT s_suppkey, {_STEP.format('n', _w)} AS n FROM {{pn_{_i}}}"


@query(f"SELECT s_suppkey, trim(n) AS cleaned FROM {{pn_{len(_WORDS)}}}", _PLACE)
def place_name_cleanup(spark, sf):
    from evenground.functions.names import clean_place_name

    s = view(spark, sf, "supplier")
    names = s.selectExpr("s_suppkey", _PLACE["pn_0"].split(", ", 1)[1].rsplit(" AS n FROM", 1)[0] + " AS n")
    return names.select("s_suppkey", clean_place_name(F.col("n")).alias("cleaned"))


@query("SELECT GEOID, substring(GEOID, 1, 2) AS state_fips, substring(GEOID, 3, 3) AS county_fips,"
       " split_part(NAME, '; ', 1) AS tract_name, split_part(NAME, '; ', 2) AS county_name FROM {fx_square}")
def tract_name_split(spark, sf):
    t = bl.tract_columns(view(spark, sf, "fx_square").select("GEOID", "NAME"), "2022")
    return t.drop("NAME")


def union_all(parts):
    return reduce(DataFrame.unionByName, parts)
