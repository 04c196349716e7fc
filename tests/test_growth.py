"""Steps whose cost grows with the rows: what a plan shuffles, sorts and repeats."""

import collections

from pyspark.sql import functions as F

from evenground.functions.geometry import RING_TYPE, area, box_rings
from evenground.operators import baseline as bl
from evenground.operators import spatial
from evenground.operators.outputs import geometry_struct
from evenground.operators.spatial import area_hits, cell_index, dominant_area, point_in_polygon, weighted_counts
from evenground.sources.delimited import _looked_at


def squares(spark):
    rows = [("a", 0.0, 0.0, 1.0, 1.0), ("b", 1.0, 0.0, 2.0, 1.0), ("c", 10.0, 10.0, 11.0, 11.0)]
    return spark.createDataFrame(rows, "GEOID string, x0 double, y0 double, x1 double, y1 double").select("GEOID", box_rings(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("rings"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_large_index_shuffles_points_by_cell_only(spark):
    points = spark.range(400).selectExpr("'d' AS dataset_id", "CASE WHEN id < 300 THEN 0.5 ELSE 1 + (id - 299) / 200.0D END AS lon", "0.5D AS lat", "1.0D AS weight")
    points = points.withColumn("lon", F.col("lon").cast("double")).unionByName(spark.sql("SELECT 'd' AS dataset_id, CAST(NULL AS DOUBLE) AS lon, 1.0D AS lat, 2.0D AS weight"))
    index = cell_index(squares(spark))
    # three fourths of the rows are at one place, and a task takes fifty
    spread = weighted_counts(points, index, broadcast_bytes=-1, rows_per_task=50)
    assert ", lon#" not in "".join(x for x in plan(spread).splitlines() if "hashpartitioning" in x)
    got = {(r["GEOID"], r["weighted_counts"], r["n_joined"], r["n_points"]) for r in spread.collect()}
    assert got == {("a", 300.0, 300, 300), ("b", 100.0, 100, 100), (None, 2.0, 1, 1)}


def test_only_datasets_without_a_match_are_turned(spark):
    rows = [("plain", 0.5, 0.6), ("plain", 0.4, 0.3), ("turned", 0.5, 1.5), ("turned", 0.7, 1.2), (None, 0.5, 1.5), ("far", 50.0, 60.0)]
    points = spark.createDataFrame(rows, "dataset_id string, lon double, lat double")
    shapes = squares(spark)
    for limit in (1 << 40, -1):
        hits = area_hits(points, cell_index(shapes), broadcast_bytes=limit)
        # "plain" matches both ways round, and is looked up one way
        assert collections.Counter(tuple(r) for r in hits.select("dataset_id", "flipped", "GEOID", "n").collect()) == collections.Counter(
            [("plain", False, "a", 2), ("turned", True, "b", 2), (None, True, "b", 1)])
    found = dominant_area(hits, shapes.select("GEOID", F.col("GEOID").alias("cleaned_name")))
    assert {(r["dataset_id"], r["denom_geoid"], r["flipped"]) for r in found.collect()} == {("plain", "a", False), ("turned", "b", True), (None, "b", True)}


def test_overlapping_cells_covered_by_one_or_two(spark):
    both = squares(spark).unionByName(squares(spark).where("GEOID = 'a'").withColumn("GEOID", F.lit("z")))
    points = spark.createDataFrame([(0.6, 0.6), (1.6, 0.6), (1.0, 0.6), (5.0, 5.0), (10.6, 10.6)], "lon double, lat double")
    got = collections.Counter((r["lon"], r["GEOID"]) for r in point_in_polygon(points, cell_index(both)).collect())
    assert got == collections.Counter([(0.6, "a"), (0.6, "z"), (1.6, "b"), (1.0, None), (5.0, None), (10.6, "c")])


def test_measures_of_a_merged_shape_are_taken_once(spark):
    parts = spark.createDataFrame(
        [("2148000", float(i)) for i in range(5)] + [("2148006", 9.0), ("x", 20.0), ("x", 22.0), (None, 30.0)], "GEOID string, x0 double").select(
        "GEOID", box_rings(F.col("x0"), F.lit(0.0), F.col("x0") + 1, F.lit(1.0)).alias("rings"))
    whole = bl.merge_places(parts, area=area)
    assert whole.columns == [*bl.merge_places(parts).columns, "area"]
    for r in whole.select("GEOID", "area", area(F.col("rings")).alias("own"), F.size("rings").alias("n")).collect():
        assert (r["area"], r["own"], r["n"]) == ((6.0, 6.0, 6) if r["GEOID"] in ("2148000", "2148006") else (1.0, 1.0, 1))
    # the shape is not carried to its parts by who reads the area only
    assert "all_rings" not in plan(whole.groupBy("GEOID").agg(F.max("area")))


def test_lines_are_not_sorted_for_their_header(spark, tmp_path):
    (tmp_path / "one.csv").write_bytes("h1,h2\n1,é\n2,b\n".encode())
    (tmp_path / "two.csv").write_bytes('h2,h1\n1,\xe9\n"2\n3",b\n'.encode("latin-1"))
    looked = _looked_at(spark, f"file://{tmp_path}")
    assert "SortAggregate" not in plan(looked)
    got = {r["path"].rsplit("/", 1)[1]: (r["encoding"], bytes.fromhex(r["header"]), r["broken_lines"]) for r in looked.collect()}
    assert got == {"one.csv": ("utf-8", b"h1,h2", False), "two.csv": ("iso-8859-1", b"h2,h1", True)}


def test_column_errors_are_counted_once(spark, monkeypatch):
    import workload.uploads as up

    kept = []
    table = spark.createDataFrame(
        [("A", "1.5", "2.5", "3", "4", "F", "1996-01-01"), ("A", "1.5", "2.5", "3", "4", "#N/A", "1996-01-01")],
        "dataset_id string, lon string, lat string, weight string, quantity string, status string, shipdate string")
    monkeypatch.setattr(up, "view", lambda *_: table)
    monkeypatch.setattr(up, "durable", lambda df: kept.append(df) or df.localCheckpoint())
    out = up.upload_column_errors(spark, "")
    assert len(kept) == 1
    assert {(r["dataset_id"], r["error"], r["n_rows"], r["n_status"]) for r in out.collect()} == {(k, e, 2, 1) for k, e in up._TOLD.items()}


def test_index_leaves_out_neighbours_that_only_touch_a_cell(spark):
    index = cell_index(squares(spark))
    cells = index.table.select("cx", "cy", F.inline("candidates")).collect()
    # sixteen cells of each square; the neighbour's border on a cell's lower left sides is no candidate
    assert collections.Counter(r["poly_id"] for r in cells) == {"a": 16, "b": 16, "c": 16}
    assert all(r["held"] and r["full"] for r in cells)


def test_flat_polygons_have_cells_of_about_their_height(spark):
    flat = spark.createDataFrame([(0.5, 0.3, 10.0, 2.1)], "x0 double, y0 double, x1 double, y1 double").select(
        F.lit("f").alias("GEOID"), box_rings(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("rings"))
    assert cell_index(flat).scales == (0,)


def test_cells_are_not_salted_without_a_hot_tile(spark):
    points = spark.createDataFrame([("d", 0.5, 0.5, 1.0), ("d", None, 0.5, 1.0), ("d", 1.0, 0.5, 1.0)], "dataset_id string, lon double, lat double, weight double")
    counts = weighted_counts(points, cell_index(squares(spark)), broadcast_bytes=-1)
    assert "salt" not in plan(counts)
    assert {(r["GEOID"], r["weighted_counts"], r["n_points"]) for r in counts.collect()} == {("a", 1.0, 1), (None, 2.0, 2)}


def test_large_index_is_written_and_measured(spark, monkeypatch):
    by_bound = cell_index(squares(spark)).bytes_bound
    monkeypatch.setattr(spatial, "BROADCAST_BYTES", by_bound - 1)
    index = cell_index(squares(spark))
    assert index.bytes_bound < by_bound and "Scan parquet" in plan(index.table)
    sizes = index.table.select(F.inline("candidates")).agg(F.count("*").alias("n"), F.sum(F.size("edges")).alias("e")).first()
    assert index.bytes_bound == (sizes["n"] + sizes["e"]) * spatial.ENTRY_BYTES


def test_index_saved_without_the_mark_is_read(spark, tmp_path):
    index = cell_index(squares(spark))
    old = index.table.withColumn("candidates", F.transform("candidates", lambda c: c.dropFields("full")))
    spatial.CellIndex(old, index.scales, index.bytes_bound).save(str(tmp_path / "old"))
    points = spark.createDataFrame([(0.6, 0.6), (1.0, 0.6), (1.6, 0.0)], "lon double, lat double")
    found = point_in_polygon(points, spatial.CellIndex.load(spark, str(tmp_path / "old")))
    assert {(r["lon"], r["GEOID"]) for r in found.collect()} == {(0.6, "a"), (1.0, None), (1.6, None)}


def test_holes_of_a_shape_with_many_rings_are_sliced(spark):
    ring = lambda x, turn: [{"x": x + a, "y": b} for a, b in [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)][::turn]]
    # outer, hole, outer, outer, hole, hole
    rings = [ring(float(i), turn) for i, turn in enumerate([1, -1, 1, 1, -1, -1])]
    shapes = spark.createDataFrame([("a", rings), ("none", [])], f"GEOID string, rings {RING_TYPE}")
    made = shapes.select("GEOID", geometry_struct(F.col("rings")).alias("g"))
    # no list of parts is copied for each ring
    assert "aggregate(rings" not in made._jdf.queryExecution().optimizedPlan().toString()
    got = {r["GEOID"]: [[part[0][0], len(part)] for part in r["g"]["coordinates"]] for r in made.collect()}
    assert got["none"] == [] and [(p[0], n) for p, n in got["a"]] == [(0.0, 2), (2.0, 1), (3.0, 3)]
