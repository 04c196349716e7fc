"""Ray casting, index, overlap area and projection on small known shapes."""

import random

import pytest
from pyspark.sql import functions as F

from evenground.functions.geometry import RING_TYPE, area, bad_polygon, edges, equal_area, normalised, strictly_inside
from evenground.operators.overlay import overlap_area
from evenground.operators.spatial import cell_index, point_in_polygon, weighted_counts

L_SHAPE = [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4)]]
HOLE = [[(0, 0), (4, 0), (4, 4), (0, 4)], [(1, 1), (1, 3), (3, 3), (3, 1)]]
TWO_PARTS = [[(0, 0), (1, 0), (1, 1), (0, 1)], [(50, 0), (51, 0), (51, 1), (50, 1)]]
TRIANGLE = [[(10.1, 10.2), (13.3, 10.7), (11.4, 14.9)]]


def polygons(spark, shapes):
    rows = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in v]) for k, v in shapes.items()]
    return spark.createDataFrame(rows, f"GEOID string, rings {RING_TYPE}")


def inside(rings, x, y):
    """Plain even-odd test; None on an edge."""
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
    return odd


@pytest.mark.parametrize("rings,x,y,expected", [
    (L_SHAPE, 1, 1, True), (L_SHAPE, 3, 3, False), (L_SHAPE, 2, 3, False), (L_SHAPE, 0, 0, False), (L_SHAPE, 3, 2, False),
    (HOLE, 0.5, 0.5, True), (HOLE, 2, 2, False), (HOLE, 1, 2, False), (HOLE, 5, 2, False),
    (TWO_PARTS, 0.5, 0.5, True), (TWO_PARTS, 50.5, 0.5, True), (TWO_PARTS, 25, 0.5, False),
])
def test_strictly_inside(spark, rings, x, y, expected):
    df = polygons(spark, {"a": rings})
    got = df.select(strictly_inside(edges(F.col("rings")), F.lit(float(x)), F.lit(float(y)))).first()[0]
    assert got is expected


@pytest.mark.parametrize("broadcast_bytes", [1 << 40, -1])
def test_index_join_equals_brute_force(spark, broadcast_bytes):
    shapes = {"L": L_SHAPE, "H": HOLE, "T": TWO_PARTS, "t": TRIANGLE}
    rng = random.Random(7)
    pts = [(round(rng.uniform(-1, 15), 2), round(rng.uniform(-1, 15), 2)) for _ in range(400)]
    pts += [(50.5, 0.5), (2.0, 2.0), (4.0, 1.0)] + [(1.5, 0.5)] * 200
    points = spark.createDataFrame([("d", float(x), float(y), 2.0) for x, y in pts], "dataset_id string, lon double, lat double, weight double")
    index = cell_index(polygons(spark, shapes))
    expected = {}
    for x, y in pts:
        hits = [k for k, v in shapes.items() if inside(v, x, y)]
        for k in hits or [None]:
            expected[k] = expected.get(k, 0) + 1
    joined = point_in_polygon(points, index, broadcast_bytes=broadcast_bytes, rows_per_task=50)
    got = {r["GEOID"]: r["count"] for r in joined.groupBy("GEOID").count().collect()}
    assert got == expected
    assert joined.where("first_match").count() == len(pts)
    counts = weighted_counts(points, index, broadcast_bytes=broadcast_bytes, rows_per_task=50).collect()
    assert {r["GEOID"]: r["weighted_counts"] for r in counts} == {k: 2.0 * n for k, n in expected.items()}
    assert sum(r["n_points"] for r in counts) == len(pts)


def test_counts_do_not_depend_on_partitions(spark):
    index = cell_index(polygons(spark, {"L": L_SHAPE, "H": HOLE}))
    points = spark.range(500).selectExpr("'d' AS dataset_id", "(id % 50) / 10D AS lon", "(id % 41) / 10D AS lat", "1D AS weight")
    one = sorted(map(tuple, weighted_counts(points.coalesce(1), index).collect()), key=str)
    many = sorted(map(tuple, weighted_counts(points.repartition(7), index).collect()), key=str)
    assert one == many


@pytest.mark.parametrize("a,b,expected", [
    ([[(0, 0), (2, 0), (2, 2), (0, 2)]], [[(1, 1), (3, 1), (3, 3), (1, 3)]], 1.0),
    (HOLE, [[(0, 0), (4, 0), (4, 4), (0, 4)]], 12.0),
    (HOLE, [[(1, 1), (3, 1), (3, 3), (1, 3)]], 0.0),
    ([[(0, 0), (4, 0), (0, 4)]], [[(0, 0), (2, 0), (2, 2), (0, 2)]], 4.0),
    ([[(0, 0), (4, 0), (0, 4)]], [[(1, 1), (3, 1), (3, 3), (1, 3)]], 2.0),
])
def test_overlap_area(spark, a, b, expected):
    left = polygons(spark, {"a": a})
    right = polygons(spark, {"b": b}).withColumnRenamed("GEOID", "place_geoid")
    row = overlap_area(left, right).first()
    assert (row["overlap"] if row else 0.0) == pytest.approx(expected, abs=1e-9)


def test_disjoint_polygons_make_no_pair(spark):
    left = polygons(spark, {"a": [[(0, 0), (1, 0), (1, 1), (0, 1)]]})
    right = polygons(spark, {"b": [[(5, 5), (6, 5), (6, 6), (5, 6)]]}).withColumnRenamed("GEOID", "place_geoid")
    assert overlap_area(left, right).count() == 0


def test_normalised_rings_and_area(spark):
    clockwise = list(reversed(HOLE[0]))
    df = polygons(spark, {"a": [clockwise, list(reversed(HOLE[1]))]})
    assert df.select(area(normalised(F.array("rings")))).first()[0] == pytest.approx(12.0)


def test_equal_area_keeps_area(spark):
    # one square degree at 40 N is about 9,460 square kilometres
    df = polygons(spark, {"a": [[(-96, 40), (-95, 40), (-95, 41), (-96, 41)]]})
    km2 = df.select(area(equal_area(F.col("rings"))) / 1e6).first()[0]
    assert 9350 < km2 < 9500


def test_bad_polygons(spark):
    df = polygons(spark, {"a": [[(0, 0), (1, 0)]], "b": [[(0, 0), (1, 0), (2, 0)]], "c": L_SHAPE, "d": []})
    got = {r[0]: r[1] for r in df.select("GEOID", bad_polygon(F.col("rings"))).collect()}
    assert got == {"a": "too_few_points", "b": "zero_area", "c": None, "d": "empty"}
