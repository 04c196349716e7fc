"""Formulas, names, cleaning and custom columns on hand-worked rows."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from evenground.catalogs import CITY_PERCENTS, DERIVED_PERCENTS, PERCENTS, SUMS, SUMS_OF_SUMS, variable_codes
from evenground.functions import margins as mg
from evenground.functions.geometry import box_rings
from evenground.functions.names import clean_place_name, padded_id
from evenground.operators import custom as cu
from evenground.operators.clean import as_number, prepare_points, row_accounting, row_counters
from evenground.operators.scores import demo_scores, geo_scores
from evenground.operators.spatial import cell_index, point_in_polygon, sampled
from evenground.plans.score import Upload, _static_errors
from evenground.session import shared_dir
from evenground.spec import RESERVED_ID, DisparitySpec, Filter


def value(spark, text, **columns):
    row = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{c} double" for c in columns))
    return row.selectExpr(f"{text} AS v").first()[0]


def test_catalog_sizes():
    assert len(variable_codes()) == 162
    assert (len(SUMS) + len(SUMS_OF_SUMS), len(DERIVED_PERCENTS), len(CITY_PERCENTS), len(PERCENTS)) == (18, 36, 41, 41)


@pytest.mark.parametrize("n,d,expected", [(0.0, 0.0, 0.0), (1.0, 4.0, 0.25), (1.0, 0.0, None), (None, 1.0, None), (1.0, None, None)])
def test_safe_divide(spark, n, d, expected):
    assert value(spark, mg.safe_divide("n", "d"), n=n, d=d) == expected


@pytest.mark.parametrize("e,expected", [
    ((5.0, 6.0, 7.0), math.sqrt(9 + 16 + 144)), ((0.0, 6.0, 7.0), math.sqrt(9 + 16 + 144)), ((0.0, 0.0, 0.0), 12.0), ((0.0, 0.0, 7.0), math.sqrt(16 + 144)),
])
def test_moe_sum_zero_rule(spark, e, expected):
    text = mg.moe_sum(["a", "b", "c"], ["ma", "mb", "mc"])
    assert value(spark, text, a=e[0], b=e[1], c=e[2], ma=3.0, mb=4.0, mc=12.0) == pytest.approx(expected)


def test_moe_sum_of_rows_equals_columns(spark):
    df = spark.createDataFrame([(0.0, 3.0), (0.0, 4.0), (7.0, 12.0)], "e double, m double")
    assert df.agg(F.expr(mg.moe_sum_agg("e", "m"))).first()[0] == pytest.approx(math.sqrt(16 + 144))


def test_moe_prop_and_fallback(spark):
    assert value(spark, mg.moe_prop("n", "d", "a", "b"), n=10.0, d=100.0, a=5.0, b=10.0) == pytest.approx(math.sqrt(25 - 1) / 100)
    assert value(spark, mg.moe_prop("n", "d", "a", "b"), n=90.0, d=100.0, a=5.0, b=10.0) == pytest.approx(math.sqrt(25 + 81) / 100)
    assert value(spark, mg.ratio_se("n", "d", "a", "b"), n=90.0, d=100.0, a=5.0, b=10.0) is None


def test_half_even_rounding(spark):
    assert value(spark, "bround(x, 3)", x=0.0625) == 0.062


def test_names(spark):
    names = {"Carson City city": "Carson City", "Nashville-Davidson metropolitan government (balance)": "Nashville-Davidson",
             "Augusta-Richmond County consolidated government (balance)": "Augusta-Richmond County", "Anchorage municipality": "Anchorage"}
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert {r[0]: r[1] for r in df.select("n", clean_place_name(F.col("n"))).collect()} == names
    ids = spark.createDataFrame([("1001",), ("01001",), ("123456789012",)], "i string")
    assert [r[0] for r in ids.select(padded_id(F.col("i"), 11)).collect()] == ["00000001001", "00000001001", "123456789012"]


def table(spark):
    return spark.createDataFrame([
        ("1.5", "2", "3", "a b", "2020-01-31", "x"), (None, "2", "3", "a b", "2020-01-31", "x"), ("1", "2", "0", "a b", "2020-01-31", "x"),
        ("1", "2", None, "a b", "2020-01-31", "x"), ("1", "2", "1", None, "2020-01-31", "x"), ("1", "2", "1", "c", "2020-01-31", "x"),
        ("1", "2", "1", "a b", "2020-01-31 23:59:00", "x"), ("1", "2", "1", "a b", "2020-01-01", "x"),
    ], "`the lon` string, lat string, w string, `a col` string, day string, GEOID string")


def test_drop_reasons_in_order_and_late_hours(spark):
    spec = DisparitySpec("d", "lat", "the lon", "county", (
        Filter("a col", "string", "==", "a b"), Filter("day", "date", "dateRange", "01/01/2020-01/31/2020"),
        Filter("GEOID", "string", "==", "x,y")), "w")
    points = prepare_points(table(spark), spec)
    counters = row_counters(row_accounting(points)).first().asDict()
    assert counters == {
        "dataset_id": "d", "num_rows_file": 8, "num_null_latlon_rows_dropped": 1, "num_null_filter_rows_dropped": 1,
        "num_null_weight_rows_dropped": 2, "num_null_rows_dropped": 4, "num_filter_rows_dropped": 2, "num_rows_for_processing": 2,
    }


def test_reserved_and_missing_columns(spark):
    spec = DisparitySpec("d", "lat", "nowhere", "county")
    with pytest.raises(ValueError, match="latlon_cols_not_in_data"):
        prepare_points(table(spark), spec)
    with pytest.raises(ValueError, match="invalid_column_in_data"):
        prepare_points(table(spark).withColumnRenamed("GEOID", RESERVED_ID), spec)


def test_specs():
    form = {"resource_lat_column": "lat", "resource_lon_column": "lon", "geo": "city", "resource_weight": "", "resource_filters": [
        {"filter_column": "a", "filter_type": "number", "filter_comparison": ">", "filter_val": 3}]}
    spec = DisparitySpec.from_form("d", form, "2018")
    assert spec.problems() == [] and spec.used_year == "2022" and spec.weight_column is None and spec.warnings
    assert DisparitySpec.from_form("d", {**form, "geo": "planet"}).problems()
    assert DisparitySpec.from_form("d", {"geo": "city"}).problems()


def test_bad_uploads_are_set_apart(spark):
    good = Upload(DisparitySpec("g", "lat", "the lon", "county"), table(spark))
    bad = Upload(DisparitySpec("b", "lat", "the lon", "county", (Filter("a col", "string", "<", "a,b"),)), table(spark))
    kept, errors, _ = _static_errors([good, bad])
    assert [u.spec.dataset_id for u in kept] == ["g"] and errors[0][0] == "b"


def test_geo_scores_without_margin(spark):
    df = spark.createDataFrame([(0.5, 0.1, None), (0.5, 0.1, 0.1), (0.12, 0.1, 0.1)], "data_prop double, prop_x double, prop_x_margin double")
    rows = geo_scores(df, ["x"]).collect()
    assert [r["sig_diff_x"] for r in rows] == ["FALSE", "TRUE", "FALSE"] and rows[0]["diff_x"] == pytest.approx(0.4)


def test_demo_scores_edge_cases(spark):
    values = spark.createDataFrame([("a", 5.0, 0.0), ("b", 5.0, 1.0), ("c", 5.0, 0.0), ("d", 9.0, 1.0)], "census_var string, data_value double, data_value_sd double").withColumn("k", F.lit(1))
    stats = spark.createDataFrame([("a", 4.0, 0.0), ("b", 1.0, None), ("c", 5.0, 0.0), ("d", 5.0, 1.0)], "census_var string, summary_value double, summary_value_margin double").withColumn("k", F.lit(1))
    got = {r["census_var"]: (r["sig_diff"], r["data_value_sd"]) for r in demo_scores(values, stats, ["k"]).collect()}
    assert got == {"a": (True, 0.0), "b": (False, None), "c": (False, 0.0), "d": (True, 1.0)}


def test_custom_columns_are_dropped_clamped_and_kept(spark):
    areas = spark.createDataFrame([("d", str(i), 10.0, 1.0, 0.25) for i in range(4)], "dataset_id string, GEOID string, num_pop double, num_pop_margin double, prop_pop double")
    user = spark.createDataFrame([("0", 20.0, 1.0, None, 3.0), ("1", -1.0, -1.0, None, 3.0), ("2", 5.5, 1.0, None, 3.0)], "GEOID string, a double, a_m double, b double, c double")
    columns = {"a": "a_m", "b": None, "c": None}
    long = cu.attach_custom(areas, cu.select_custom(user, "GEOID", columns, "demographic", 1).drop("cast_error"), columns, "demographic")
    profiles = cu.profile(long)
    clean = {(r["var"], r["GEOID"]): (r["est"], r["moe"]) for r in cu.clean_custom(long, profiles).collect()}
    assert clean[("a_demographic", "0")] == (10.0, None) and clean[("a_demographic", "1")] == (0.0, None)
    assert clean[("a_demographic", "3")] == (0.0, None) and not any(v == "b_demographic" for v, _ in clean)
    told = {(r["warning"], r["column"]) for r in cu.warnings(profiles, "demographic").collect()}
    assert ("demographic_dropped_any_values_negative_margin", "a_demographic_margin") in told
    assert ("demographic_dropped_cols_over_half_missing_values", "b_demographic") in told
    assert cu.duplicate_ids(user.union(user)).count() == 3


def test_sample_is_repeatable_and_keeps_small_sets(spark):
    points = spark.range(4000).selectExpr("if(id < 40, 's', 'l') AS dataset_id", "id / 7D AS lon", "id / 3D AS lat", "1D AS weight")
    sizes = points.groupBy("dataset_id").agg(F.count("*").alias("n_rows"))
    first, again = sampled(points, sizes, 0.05, 50), sampled(points.repartition(5), sizes, 0.05, 50)
    n = {r[0]: r[1] for r in first.groupBy("dataset_id").count().collect()}
    assert n["s"] == 40 and 100 < n["l"] < 320
    assert first.exceptAll(again).count() == 0


def _spec(**changed):
    return DisparitySpec(**{"dataset_id": "d", "lat_column": "lat", "lon_column": "lon", "geo": "state", **changed})


@pytest.mark.parametrize("f,good", [
    (Filter("when", "date", "singleDate", "01/15/2020"), True), (Filter("when", "date", "singleDate", "2020-01-15"), False),
    (Filter("when", "date", "dateRange", "01/01/2020 - 02/01/2020"), True), (Filter("when", "date", "dateRange", "01/01/2020"), False),
    (Filter("n", "number", ">", "3.5"), True), (Filter("n", "number", ">", "many"), False), (Filter("n", "number", ">", None), False),
])
def test_bad_filter_values_are_reported_before_any_job(f, good):
    assert _spec(filters=(f,)).problems() == ([] if good else [f"filter_value_not_valid:{f.column}"])


def test_one_bad_request_leaves_the_others(spark):
    table = spark.sql("SELECT '1' AS lat, '2' AS lon, 'x' AS when")
    bad = [_spec(dataset_id="date", filters=(Filter("when", "date", "singleDate", "soon"),)), _spec(dataset_id="level", geo="moon"),
           _spec(dataset_id="column", lon_column="nowhere")]
    good, errors, prepared = _static_errors([Upload(s, table) for s in [*bad, _spec(dataset_id="good")]])
    assert [u.spec.dataset_id for u in good] == ["good"] and len(prepared) == 1
    assert [e[0] for e in errors] == ["date", "level", "column"]


def test_far_and_infinite_coordinates_are_outside(spark):
    rows = [("0.5", "0.5"), ("1e12", "0.5"), ("inf", "0.5"), ("1e300", "-1e300"), ("-Infinity", "NaN"), ("0.5", "x")]
    table = spark.createDataFrame(rows, "lon string, lat string")
    points = table.select(as_number(F.col("lon")).alias("lon"), as_number(F.col("lat")).alias("lat"))
    square = spark.range(1).select(F.lit("a").alias("GEOID"), box_rings(*map(F.lit, (0.0, 0.0, 1.0, 1.0))).alias("rings"))
    for limit in (1 << 30, -1):
        out = point_in_polygon(points, cell_index(square), broadcast_bytes=limit)
        assert sorted(str(r["GEOID"]) for r in out.collect()) == ["None"] * 5 + ["a"]
    assert points.where("lon IS NULL").count() == 2


class _Session:
    """Just what the folder lookup reads."""

    def __init__(self, configured, master):
        self.conf = {"spark.checkpoint.dir": configured} if configured else {}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_shared_folder_comes_from_the_session():
    assert shared_dir(_Session("/shared/folder", "yarn")) == "/shared/folder"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session(None, "yarn"))
    assert shared_dir(_Session(None, "local[2]")).startswith(tempfile.gettempdir())
