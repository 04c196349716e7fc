"""Queries on sources and sinks: written by one job, read back by the next."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenground.functions.geometry import area, box_rings, normalised
from evenground.operators.clean import prepare_points, row_accounting, row_counters
from evenground.operators.impute import impute_fallback, impute_mean, prepare_housing, prepare_libraries
from evenground.operators import baseline as bl
from evenground.operators.outputs import bounding_box
from evenground.operators.spatial import CellIndex, cell_index, weighted_counts
from evenground.operators.clean import usable
from evenground.session import fresh_path
from evenground.sources.delimited import file_encodings, read_delimited, write_delimited
from evenground.sources.geojson import (
    point_coordinates, polygon_rings, property_columns, read_features, read_nested, write_features, write_records,
)
from evenground.sources.reference import catalog_rows, read_catalog, region_crosswalk, write_split
from evenground.streaming.counts import latest_counts, stream_counts, write_counts
from workload.areas import _BOX
from workload.formulas import EXTRA
from workload.points import _counters, points, spec, tract_shapes
from workload.registry import query, r, settle
from workload.views import VIEWS, names_in, view


# --- delimited files ---------------------------------------------------------


@query(*_counters("1 = 0", "1 = 1"))
def csv_points_source(spark, sf):
    """Point file with missing tokens, read as text and cleaned."""
    path = fresh_path(spark, "points-csv")
    write_delimited(view(spark, sf, "fx_upload"), path)
    return row_counters(row_accounting(prepare_points(read_delimited(spark, path), spec())))


_PARTS = {"pe": "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'iso-8859-1' ELSE 'utf-16' END AS enc, p_name || ' caf' || chr(233) AS name FROM {part}"}


@query("SELECT enc, count(*) AS n, count(DISTINCT name) AS n_names, CAST(sum(p_partkey) AS BIGINT) AS keys,"
       " CAST(sum(CASE WHEN name LIKE '%caf' || chr(233) THEN 1 ELSE 0 END) AS BIGINT) AS n_accents FROM {pe} GROUP BY enc", _PARTS)
def encoding_fallback(spark, sf):
    """The same kind of table in three encodings, told apart by content."""
    path = fresh_path(spark, "encodings")
    p = view(spark, sf, "part").selectExpr(
        "p_partkey", "CASE p_size % 3 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'iso-8859-1' ELSE 'utf-16' END AS enc",
        "concat(p_name, ' caf\\u00e9') AS name",
    )
    for enc in ("utf-8", "iso-8859-1", "utf-16"):
        p.where(F.col("enc") == enc).write.option("header", True).option("encoding", enc).csv(f"{path}/{enc}")
    back = read_delimited(spark, f"{path}/*")
    return back.groupBy("enc").agg(
        F.count("*").alias("n"), F.count_distinct("name").alias("n_names"),
        F.sum(F.col("p_partkey").cast("bigint")).alias("keys"), F.count_if(F.col("name").endswith("café")).alias("n_accents"),
    )


@query("SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN p_name || chr(10) || p_brand ELSE p_name END AS name, " + r("p_retailprice", "price", 2) + " FROM {part}")
def csv_records(spark, sf):
    """Quoted line breaks, and two orders of columns in one folder."""
    path = fresh_path(spark, "records")
    p = view(spark, sf, "part").selectExpr(
        "p_partkey", "CASE WHEN p_partkey % 5 = 0 THEN concat_ws('\n', p_name, p_brand) ELSE p_name END AS name", "p_retailprice AS price")
    # quotes in values are doubled, as the reader expects
    for part, columns in ((0, ("p_partkey", "name", "price")), (1, ("price", "name", "p_partkey")), (2, ("name", "price", "p_partkey"))):
        p.where(F.col("p_partkey") % 3 == part).select(*columns).write.mode("append").option("header", True).option("escape", '"').csv(path)
    back = read_delimited(spark, path)
    return settle(back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), "name", F.col("price").cast("double").alias("price")), 2)


_CATALOG = {"cat": "SELECT CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_name END AS colnames,"
                   " CASE WHEN p_partkey % 7 = 0 THEN 'sum of below 4' ELSE p_brand END AS acs_vars,"
                   " CASE WHEN p_size > 25 THEN p_type ELSE NULL END AS notes FROM {part}"}


@query("SELECT DISTINCT colnames, acs_vars, notes FROM {cat} WHERE colnames IS NOT NULL AND acs_vars <> 'sum of below 4'", _CATALOG)
def catalog_distinct(spark, sf):
    """Lists with and without notes: union, blank rows, notes, repeats."""
    cat = spark.sql(_CATALOG["cat"], part=view(spark, sf, "part"))
    return catalog_rows(cat.where("notes IS NULL").drop("notes"), cat.where("notes IS NOT NULL"))


@query("SELECT DISTINCT colnames, acs_vars FROM {cat} WHERE colnames IS NOT NULL AND acs_vars <> 'sum of below 4'", _CATALOG)
def catalog_files(spark, sf):
    path = fresh_path(spark, "catalog")
    cat = spark.sql(_CATALOG["cat"], part=view(spark, sf, "part")).drop("notes")
    write_delimited(cat, path)
    return read_catalog(spark, [path])


_GEO_CSV = f"SELECT dataset_id, count(*) AS n, {r('sum(weighted_counts)', 'total', 2)} FROM {{fx_count}} GROUP BY dataset_id"


def _counts(spark, sf):
    return weighted_counts(usable(points(spark, sf)), cell_index(tract_shapes(spark, sf))).where("GEOID IS NOT NULL")


def _totals(df):
    return settle(df.groupBy("dataset_id").agg(
        F.count("*").alias("n"), F.sum(F.col("weighted_counts").cast("double")).alias("total")), 2)


@query(_GEO_CSV, EXTRA)
def csv_sink(spark, sf):
    path = fresh_path(spark, "counts-csv")
    write_delimited(_counts(spark, sf), path, ("dataset_id",))
    return _totals(spark.read.option("header", True).csv(path))


@query(_GEO_CSV, EXTRA)
def json_records_sink(spark, sf):
    path = fresh_path(spark, "counts-json")
    write_records(_counts(spark, sf), path, ("dataset_id",))
    return _totals(spark.read.json(path))


@query(_GEO_CSV, EXTRA)
def saved_index(spark, sf):
    """The polygon index is written once and loaded by later jobs."""
    path = fresh_path(spark, "index")
    cell_index(tract_shapes(spark, sf)).save(path)
    counts = weighted_counts(usable(points(spark, sf)), CellIndex.load(spark, path))
    return _totals(counts.where("GEOID IS NOT NULL"))


# --- GeoJSON and nested JSON -----------------------------------------------------


@query(f"SELECT GEOID, {r('(x1 - x0) * (y1 - y0)', 'area')}, 1 AS n_rings FROM {{fx_square}}")
def geojson_features(spark, sf):
    """Areas written as features, one per line, and read back."""
    path = fresh_path(spark, "features")
    write_features(tract_shapes(spark, sf), path)
    features = read_features(spark, path, lines=True)
    rings = polygon_rings(features, *property_columns(features, ["GEOID"]))
    return settle(rings.select("GEOID", area(F.col("rings")).alias("area"), F.size("rings").alias("n_rings")))


@query(f"SELECT GEOID, {r('(x1 - x0) * (y1 - y0) * 1.75', 'area')}, 3 AS n_rings, 2 AS n_parts FROM {{fx_square}}")
def geojson_holes(spark, sf):
    """Areas of two parts, one with a hole, written and read back."""
    path = fresh_path(spark, "holes")
    x, y = lambda t: F.col("x0") + (F.col("x1") - F.col("x0")) * t, lambda t: F.col("y0") + (F.col("y1") - F.col("y0")) * t
    box = lambda a, b: box_rings(x(a), y(a), x(b), y(b))[0]
    parts = F.array(F.array(box(0.0, 1.0), box(0.25, 0.75)), F.array(box(2.0, 3.0)))
    write_features(view(spark, sf, "fx_square").select("GEOID", normalised(parts).alias("rings")), path)
    features = read_features(spark, path, lines=True)
    back = polygon_rings(features, *property_columns(features, ["GEOID"]), F.size(F.from_json("coordinates", "array<string>")).alias("n_parts"))
    return settle(back.select("GEOID", area(F.col("rings")).alias("area"), F.size("rings").alias("n_rings"), "n_parts"))


@query("SELECT c_custkey, c_nationkey, " + r("c_acctbal / 100.0", "lon", 5) + ", " + r("c_nationkey", "lat", 5) + " FROM {customer}")
def geojson_collection(spark, sf):
    """Feature collections of points, properties kept."""
    path = fresh_path(spark, "collections")
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("c_custkey"), F.col("c_nationkey")).alias("properties"),
        F.struct(F.lit("Point").alias("type"), F.array(F.col("c_acctbal") / 100, F.col("c_nationkey").cast("double")).alias("coordinates")).alias("geometry"),
    ))
    # files of at most 200 features
    files = (
        view(spark, sf, "customer").select(F.floor(F.col("c_custkey") / 200).alias("file"), feature.alias("f"))
        .groupBy("file").agg(F.array_join(F.collect_list("f"), ",").alias("fs"))
    )
    files.select("file", F.concat(F.lit('{"type":"FeatureCollection","features":['), "fs", F.lit("]}")).alias("value")).write.partitionBy(
        "file").text(path)
    features = read_features(spark, f"{path}/*", "struct<c_custkey:bigint,c_nationkey:bigint>")
    return settle(point_coordinates(features, "properties.c_custkey", "properties.c_nationkey"), 5)


@query(f"SELECT s_suppkey AS station_id, s_name AS name, {r('s_acctbal', 'capacity', 2)} FROM {{supplier}}")
def nested_json_source(spark, sf):
    """Nested station lists -> rows without their list columns."""
    path = fresh_path(spark, "stations")
    station = F.struct(
        F.col("s_suppkey").alias("station_id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("capacity"),
        F.array(F.lit("KEY"), F.lit("CARD")).alias("rental_methods"), F.array(F.col("s_nationkey")).alias("services"),
    )
    files = (
        view(spark, sf, "supplier").groupBy(F.floor(F.col("s_suppkey") / 50).alias("file"))
        .agg(F.to_json(F.struct(F.struct(F.collect_list(station).alias("stations")).alias("data"))).alias("value"))
    )
    files.write.partitionBy("file").text(path)
    return settle(read_nested(spark, f"{path}/*"), 2)


# --- reference layout ---------------------------------------------------------------


@query("SELECT substring(GEOID, 1, 2) AS state, substring(GEOID, 1, 5) AS county, count(*) AS n, CAST(sum(num_pop) AS BIGINT) AS pop"
       " FROM {fx_tract} GROUP BY substring(GEOID, 1, 2), substring(GEOID, 1, 5)")
def split_write(spark, sf):
    """One folder per area, read back through its partition columns."""
    path = fresh_path(spark, "split")
    df = view(spark, sf, "fx_tract").select(
        F.concat(F.lit("s"), F.substring("GEOID", 1, 2)).alias("state"), F.concat(F.lit("c"), F.substring("GEOID", 1, 5)).alias("county"),
        "GEOID", "num_pop")
    write_split(df, path, ("state",), "county")
    back = spark.read.parquet(path)
    return back.groupBy(F.substring("state", 2, 2).alias("state"), F.substring("county", 2, 5).alias("county")).agg(
        F.count("*").alias("n"), F.sum("num_pop").cast("bigint").alias("pop"))


_REGION_ROWS = (
    "SELECT CAST(n_regionkey + 1 AS STRING) AS region, CASE WHEN n_nationkey % 5 = 0 THEN '0' ELSE '1' END AS division,"
    " lpad(CAST(n_nationkey + 1 AS STRING), 2, '0') AS state, n_name AS name FROM {nation}"
    " UNION ALL SELECT CAST(r_regionkey + 1 AS STRING), '0', '00', r_name || ' Region' FROM {region}"
    " UNION ALL SELECT 'Region', 'Division', 'State', r_name FROM {region}"
)


@query("SELECT n.n_name AS disp_name, r.r_name || ' Region' AS region_name FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey")
def region_names(spark, sf):
    """Crosswalk sheet with header lines -> region of every state."""
    rows = spark.sql(_REGION_ROWS, nation=view(spark, sf, "nation"), region=view(spark, sf, "region"))
    return region_crosswalk(rows)


@query("SELECT GEOID, coalesce(CASE WHEN substring(GEOID, 1, 2) = '01' THEN coalesce(num_pop_margin, 0) ELSE num_pop_margin END, -1) AS m FROM {fx_tract}")
def county_repair(spark, sf):
    """Missing values of one county become 0 in the survey years concerned."""
    t = view(spark, sf, "fx_tract").select(
        F.col("GEOID").alias("id"), F.when(F.substring("GEOID", 1, 2) == "01", F.concat(F.lit("35039"), F.substring("GEOID", 6, 6))).otherwise(F.col("GEOID")).alias("GEOID"),
        "num_pop_margin")
    return bl.repair_county(t, "2018").select(F.col("id").alias("GEOID"), F.coalesce("num_pop_margin", F.lit(-1.0)).alias("m"))


@query(f"SELECT CASE WHEN substring(GEOID, 1, 5) IN ('01001', '02002') THEN 'merged' ELSE GEOID END AS place, {r('max(a)', 'area')}, count(*) AS n FROM"
       " (SELECT GEOID, CASE WHEN substring(GEOID, 1, 5) IN ('01001', '02002') THEN sum((x1 - x0) * (y1 - y0)) OVER"
       " (PARTITION BY substring(GEOID, 1, 5) IN ('01001', '02002')) ELSE (x1 - x0) * (y1 - y0) END AS a FROM {fx_square}) x GROUP BY 1")
def merged_places(spark, sf):
    """Parts of one place get the shape of all parts."""
    part = F.when(F.substring("GEOID", 1, 5) == "01001", "2148000").when(F.substring("GEOID", 1, 5) == "02002", "2148006")
    places = tract_shapes(spark, sf).withColumn("GEOID", F.coalesce(part, "GEOID"))
    whole = bl.merge_places(places, area=area).withColumn("place", F.when(F.col("GEOID").isin("2148000", "2148006"), "merged").otherwise(F.col("GEOID")))
    return settle(whole.groupBy("place").agg(F.max("area").alias("area"), F.count("*").alias("n")))


@query("SELECT GEOID, '1150000' AS denom_geoid, CAST(num_pop AS BIGINT) AS pop FROM {fx_tract} WHERE substring(GEOID, 1, 5) = '01001'")
def district_city(spark, sf):
    """The district's county stands in for its city."""
    t = view(spark, sf, "fx_tract").withColumn("denom_geoid", F.concat(F.lit("1"), F.substring("GEOID", 2, 4)))
    stats = t.select(F.col("denom_geoid").alias("GEOID"), "disp_name")
    return bl.district_city(t, stats)[0].select("GEOID", "denom_geoid", F.col("num_pop").cast("bigint").alias("pop"))


@query(f"SELECT 'county' AS dataset_id, {_BOX} FROM {{fx_square}} UNION ALL SELECT 'nation', -179.148909, 18.910365, -66.94989, 71.365162")
def bbox_by_level(spark, sf):
    """The nation has a fixed box, other levels that of their areas."""
    t = tract_shapes(spark, sf)
    both = t.withColumns({"dataset_id": F.lit("county"), "geo": F.lit("county")}).unionByName(
        t.withColumns({"dataset_id": F.lit("nation"), "geo": F.lit("national")}))
    return settle(bounding_box(both))


# --- sample tables --------------------------------------------------------------------

_HOURS = "CASE l_linenumber WHEN 1 THEN -1.0 WHEN 2 THEN -3.0 WHEN 3 THEN -9.0 ELSE l_quantity END"
_RECODED = f"CASE WHEN h >= 0 THEN h WHEN h = -3 THEN 0 ELSE NULL END"
_IMP = {"hr": f"SELECT l_returnflag, l_linestatus, {_RECODED} AS h FROM (SELECT l_returnflag, l_linestatus, {_HOURS} AS h FROM {{lineitem}}) x"}


@query(f"SELECT l_returnflag, l_linestatus, count(*) AS n, {r('sum(coalesce(h, (SELECT avg(h) FROM {hr})))', 'hours', 3)} FROM {{hr}} GROUP BY l_returnflag, l_linestatus", _IMP)
def recode_and_mean_impute(spark, sf):
    df = view(spark, sf, "lineitem").selectExpr("l_returnflag", "l_linestatus", f"CAST({_HOURS} AS DOUBLE) AS HOURS")
    return settle(prepare_libraries(df).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("HOURS").alias("hours")), 3)


@query(f"SELECT l_returnflag, l_linestatus, {r('sum(coalesce(h, m))', 'hours', 3)} FROM (SELECT *, avg(h) OVER (PARTITION BY l_returnflag) AS m FROM {{hr}}) x GROUP BY l_returnflag, l_linestatus", _IMP)
def mean_impute_by_group(spark, sf):
    df = view(spark, sf, "lineitem").selectExpr("l_returnflag", "l_linestatus", f"CAST({_HOURS} AS DOUBLE) AS h").selectExpr(
        "l_returnflag", "l_linestatus", f"CAST({_RECODED} AS DOUBLE) AS h")
    return settle(impute_mean(df, "h", "l_returnflag").groupBy("l_returnflag", "l_linestatus").agg(F.sum("h").alias("hours")), 3)


_UNITS = ("CASE WHEN l_linenumber <= 2 THEN NULL ELSE l_quantity END", "CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity + 1 END")


@query(f"SELECT l_returnflag, l_linestatus, {r('sum(coalesce(a, b, (SELECT avg(a) FROM {un})))', 'units', 3)} FROM {{un}} GROUP BY l_returnflag, l_linestatus",
       {"un": f"SELECT l_returnflag, l_linestatus, {_UNITS[0]} AS a, {_UNITS[1]} AS b FROM {{lineitem}}"})
def fallback_impute(spark, sf):
    df = view(spark, sf, "lineitem").selectExpr("l_returnflag", "l_linestatus", f"{_UNITS[0]} AS LI_UNITS", f"{_UNITS[1]} AS N_UNITS")
    return settle(prepare_housing(df).groupBy("l_returnflag", "l_linestatus").agg(F.sum("LI_UNITS").alias("units")), 3)


# --- stream -----------------------------------------------------------------------------


@query(f"SELECT dataset_id, GEOID, {r('sum(weight)', 'weighted_counts', 2)}, count(*) AS n_joined FROM {{fx_hit}} GROUP BY dataset_id, GEOID", EXTRA)
def stream_tract_count(spark, sf):
    """Points arrive as a stream and are counted per tract."""
    schema = view(spark, sf, "lineitem").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf)
    text = VIEWS["fx_point"].replace('"', "`")
    arriving = prepare_points(spark.sql(text, **{names_in(text)[0]: stream}), spec())
    path = fresh_path(spark, "stream")
    running = write_counts(stream_counts(arriving, cell_index(tract_shapes(spark, sf))), f"{path}/out", f"{path}/state")
    running.awaitTermination()
    return settle(latest_counts(spark, f"{path}/out"), 2)
