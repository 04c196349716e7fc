"""Index over shapes of all sizes, exact samples, outlines: against brute force."""

import collections
import math
import random

import pytest
from pyspark.sql import functions as F

from evenground.functions.geometry import RING_TYPE, area, box_rings, edges
from evenground.operators.overlay import dissolved, outline_edges
from evenground.operators.spatial import CellIndex, cell_index, exact_sample, point_in_polygon


def star(rnd, x, y, radius, n, low=0.4):
    return [(x + radius * rnd.uniform(low, 1) * math.cos(2 * math.pi * i / n), y + radius * rnd.uniform(low, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]


def shapes(seed):
    """Large states with many vertices, holes and parts far away; islets; boxes
    on the lines of the grid; flat slivers; degenerate rings."""
    rnd = random.Random(seed)
    out = {}
    for i in range(4):
        x, y = rnd.uniform(-100, 100), rnd.uniform(-60, 60)
        out[f"state{i}"] = [star(rnd, x, y, 12, 400, 0.7), star(rnd, x, y, 3, 30), star(rnd, x + 0.01, y, 0.02, 9), star(rnd, x + 40, y + 3, 0.5, 12)]
    for i in range(25):
        out[f"islet{i}"] = [star(rnd, rnd.uniform(-100, 100), rnd.uniform(-60, 60), 10 ** rnd.uniform(-4, -1), rnd.randint(3, 20))]
    for i in range(8):
        x, y, w = rnd.randint(-20, 20), rnd.randint(-20, 20), rnd.choice([0.25, 1, 4])
        out[f"box{i}"] = [[(x, y), (x + w, y), (x + w, y + w), (x, y + w)]]
    out["sliver"] = [[(-30, 1), (30, 1.0000001), (30, 1.0000002)]]
    out["nothing"] = [[(1, 1), (1, 1), (1, 1)]]
    out["line"] = [[(0, 0), (5, 5)]]
    return out


def polygons(spark, found):
    rows = [(k, [[{"x": float(x), "y": float(y)} for x, y in ring] for ring in v]) for k, v in found.items()]
    return spark.createDataFrame(rows, f"GEOID string, rings {RING_TYPE}")


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (x1, y1) == (x2, y2):
                continue
            turn = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
            if turn == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and (turn > 0) == (y2 > y1):
                odd = not odd
    return odd


def places(found, seed):
    rnd = random.Random(seed)
    out = [(rnd.uniform(-110, 110), rnd.uniform(-70, 70)) for _ in range(300)]
    for rings in found.values():
        for ring in rings:
            for x, y in rnd.sample(ring, min(3, len(ring))):
                side = max(abs(x - ring[0][0]), abs(y - ring[0][1]), 1e-4)
                out += [(x, y), (x + rnd.uniform(-1, 1) * side, y + rnd.uniform(-1, 1) * side), (x, y + rnd.uniform(-1, 1) * side)]
            cx, cy = sum(p[0] for p in ring) / len(ring), sum(p[1] for p in ring) / len(ring)
            out += [(cx, cy), (cx + 1e-3, cy), ((ring[0][0] + ring[1][0]) / 2, (ring[0][1] + ring[1][1]) / 2)]
    return out + [(float(i), float(j)) for i in range(-20, 24, 2) for j in range(-20, 24, 2)]


@pytest.mark.parametrize("seed,limit", [(1, 1 << 40), (2, 1 << 40), (3, -1)])
def test_index_of_all_sizes(spark, seed, limit):
    found = shapes(seed)
    points = places(found, seed)
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "id int, lon double, lat double")
    index = cell_index(polygons(spark, found))
    assert len(index.scales) > 2
    got = collections.defaultdict(set)
    firsts = collections.Counter()
    for row in point_in_polygon(df, index, broadcast_bytes=limit, rows_per_task=50).collect():
        firsts[row["id"]] += row["first_match"]
        if row["GEOID"] is not None:
            assert row["GEOID"] not in got[row["id"]]
            got[row["id"]].add(row["GEOID"])
    want = {i: {k for k, v in found.items() if inside(v, x, y)} for i, (x, y) in enumerate(points)}
    assert {i: got[i] for i in want} == want
    assert set(firsts.values()) == {1} and len(firsts) == len(points)
    assert sum(map(bool, want.values())) > 100


def test_entries_grow_with_the_edges(spark):
    """Five states and sixty islets: under 100,000 entries, and the bound holds."""
    rnd = random.Random(5)
    found = {f"s{i}": [star(rnd, 20 * i, 0, 9, 2000, 0.8)] for i in range(5)}
    found |= {f"i{i}": [star(rnd, rnd.uniform(0, 80), rnd.uniform(-8, 8), 0.004, 8)] for i in range(60)}
    index = cell_index(polygons(spark, found))
    sizes = index.table.select(F.explode("candidates").alias("c")).agg(F.count("*").alias("n"), F.sum(F.size("c.edges")).alias("e")).first()
    n_edges = sum(len(r) for v in found.values() for r in v)
    assert sizes["n"] + sizes["e"] < 6 * n_edges < 100_000
    assert (sizes["n"] + sizes["e"]) * 160 <= index.bytes_bound


def test_saved_index(spark, tmp_path):
    index = cell_index(polygons(spark, shapes(1)))
    index.save(f"{tmp_path}/index")
    again = CellIndex.load(spark, f"{tmp_path}/index")
    assert (again.scales, again.bytes_bound) == (index.scales, index.bytes_bound)
    assert again.table.count() == index.table.count()
    empty = cell_index(polygons(spark, {}))
    assert empty.scales == () and point_in_polygon(spark.createDataFrame([(1.0, 2.0)], "lon double, lat double"), empty).collect()[0]["GEOID"] is None


def sample_counts(spark, sizes, share=0.05, above=50, distinct=True):
    rows = [(f"d{n}", float(i if distinct else 1), 2.0, 3.0) for n in sizes for i in range(n)]
    df = spark.createDataFrame(rows, "dataset_id string, lon double, lat double, weight double").repartition(5)
    out = exact_sample(df, share, above)
    assert out.exceptAll(df).count() == 0
    return {r["dataset_id"]: r["count"] for r in out.groupBy("dataset_id").count().collect()}, df, out


@pytest.mark.parametrize("distinct", [True, False])
def test_exact_sample(spark, distinct):
    sizes = [1, 50, 51, 70, 90, 1000, 5000]
    got, _, out = sample_counts(spark, sizes, distinct=distinct)
    # as a rounded share, half to even; small datasets whole
    assert got == {f"d{n}": n if n <= 50 else round(0.05 * n) for n in sizes}
    again = sample_counts(spark, sizes, distinct=distinct)[2]
    assert out.exceptAll(again).count() == 0
    none = sample_counts(spark, [3], share=0.0, above=0)[0]
    assert none == {}


def squares(spark, cells):
    rows = [(k, float(x), float(y)) for k, x, y in cells]
    df = spark.createDataFrame(rows, "key string, x double, y double")
    return df.select("key", box_rings(F.col("x"), F.col("y"), F.col("x") + 1, F.col("y") + 1).alias("rings"))


def test_dissolved(spark):
    cells = [("ring", x, y) for x in range(3) for y in range(3) if (x, y) != (1, 1)]
    cells += [("block", x, y) for x in range(10, 14) for y in range(5)] + [("corner", 20, 20), ("corner", 21, 21)] + [("apart", 30, 1), ("apart", 40, 1)]
    out = {r["key"]: r for r in dissolved(squares(spark, cells), "key").select("key", "rings", area(F.col("rings")).alias("a"), F.size(edges(F.col("rings"))).alias("n")).collect()}
    assert {k: (len(r["rings"]), r["a"], r["n"]) for k, r in out.items()} == {
        "ring": (2, 8.0, 16), "block": (1, 20.0, 18), "corner": (2, 2.0, 8), "apart": (2, 2.0, 8)}
    # rings are walks along neighbouring corners
    for r in out.values():
        for ring in r["rings"]:
            points = [(p["x"], p["y"]) for p in ring]
            for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1], strict=True):
                assert abs(x1 - x2) + abs(y1 - y2) == 1


def test_outline_of_a_point_inside(spark):
    """A point on a border that the parts share lies inside the whole."""
    whole = dissolved(squares(spark, [("a", 0, 0), ("a", 1, 0)]), "key").withColumnRenamed("key", "GEOID")
    index = cell_index(whole)
    got = point_in_polygon(spark.createDataFrame([(1.0, 0.5), (0.0, 0.5)], "lon double, lat double"), index)
    assert {(r["lon"], r["GEOID"]) for r in got.collect()} == {(1.0, "a"), (0.0, None)}
    assert outline_edges(squares(spark, []), "key").count() == 0
