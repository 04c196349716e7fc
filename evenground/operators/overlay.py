"""Polygon-with-polygon overlap area, without a geometry library.

A polygon is the signed sum of the strips between its edges and a baseline
below it, so the area of A and B together is the sum over edge pairs of
``sign * sign * integral of min(edge_a, edge_b)`` on their common x range.
Each polygon's edges are cut at the borders of x strips once, whatever the number
of its partners; a pair of polygons asks only for the strips of their common
range, and leaves out edges that lie below the whole other polygon, whose
integrals cancel.  So the join is an equi-join on polygon and strip, and its rows
follow the edges where the two meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evenground.catalogs import COVERED_SHARE
from evenground.functions.geometry import area, edges, with_bounds
from evenground.session import written


def _boxes(polygons: DataFrame, id_column: str, name: str) -> DataFrame:
    return polygons.select(
        F.col(id_column).alias(name), area(F.col("rings")).alias("area"), F.inline(with_bounds(F.col("rings")))
    ).where(F.size("edges") > 0)


def _typical_side(boxes: DataFrame) -> tuple[float, float]:
    """Median box side and median edge width: one small aggregate."""
    edge_width = F.array_max(F.transform("edges", lambda e: F.abs(e.x2 - e.x1)))
    row = boxes.agg(
        F.percentile_approx(F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin")), 0.5),
        F.percentile_approx(edge_width, 0.5),
    ).first()
    return row[0] or 1.0, row[1] or 1.0


def _power_of_two(size: float) -> float:
    return 2.0 ** math.ceil(math.log2(size)) if size > 0 else 1.0


def _step(c: Column, size: float) -> Column:
    return F.floor(c * (1.0 / size)).cast("bigint")


def candidate_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: float) -> DataFrame:
    """Pairs whose boxes overlap, found through the cells they share.

    Each pair is kept in the one cell that holds the lower left corner of the
    common box, so no distinct is needed.
    """

    def in_cells(boxes: DataFrame, name: str, side: str) -> DataFrame:
        return boxes.select(
            name,
            *[F.col(c).alias(f"{side}_{c}") for c in ("xmin", "ymin", "xmax", "ymax")],
            F.explode(F.sequence(_step(F.col("xmin"), cell), _step(F.col("xmax"), cell))).alias("cx"),
        ).select(
            "*",
            F.explode(F.sequence(_step(F.col(f"{side}_ymin"), cell), _step(F.col(f"{side}_ymax"), cell))).alias("cy"),
        )

    a, b = in_cells(left, left_id, "a"), in_cells(right, right_id, "b")
    corner_x, corner_y = F.greatest("a_xmin", "b_xmin"), F.greatest("a_ymin", "b_ymin")
    return (
        a.join(b, ["cx", "cy"])
        .where(
            (corner_x < F.least("a_xmax", "b_xmax")) & (corner_y < F.least("a_ymax", "b_ymax"))
            & (_step(corner_x, cell) == F.col("cx")) & (_step(corner_y, cell) == F.col("cy"))
        )
        .select(
            left_id, right_id, F.least("a_ymin", "b_ymin").alias("base"), "a_ymin", "b_ymin",
            corner_x.alias("from_x"), F.least("a_xmax", "b_xmax").alias("to_x"))
    )


def _edge_strips(boxes: DataFrame, name: str, side: str, strip: float) -> DataFrame:
    """Edges of each polygon, cut at the strip borders."""
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    slope = (F.col("y2") - F.col("y1")) / (F.col("x2") - F.col("x1"))
    left = F.greatest(F.col("low"), F.col("strip") * strip)
    right = F.least(F.col("high"), (F.col("strip") + 1) * strip)

    def at(x: Column) -> Column:
        return F.col("y1") + (x - F.col("x1")) * F.col("slope")

    return (
        boxes.select(name, F.inline("edges"))
        .where("x1 != x2")
        .select(
            name, "x1", "y1", slope.alias("slope"), low.alias("low"), high.alias("high"),
            F.when(F.col("x2") > F.col("x1"), F.lit(-1.0)).otherwise(F.lit(1.0)).alias(f"{side}_sign"),
            F.explode(F.sequence(_step(low, strip), _step(high, strip))).alias("strip"),
        )
        .where(left < right)
        .select(
            name, "strip", f"{side}_sign", left.alias(f"{side}_l"), right.alias(f"{side}_r"),
            at(left).alias(f"{side}_yl"), at(right).alias(f"{side}_yr"),
        )
    )


def _common_area() -> Column:
    """Signed integral of the lower of two edges over their common x range."""
    l, r = F.greatest("a_l", "b_l"), F.least("a_r", "b_r")

    def height(side: str, x: Column) -> Column:
        run = F.col(f"{side}_r") - F.col(f"{side}_l")
        rise = F.col(f"{side}_yr") - F.col(f"{side}_yl")
        return F.col(f"{side}_yl") - F.col("base") + (x - F.col(f"{side}_l")) / run * rise

    al, ar, bl, br = height("a", l), height("a", r), height("b", l), height("b", r)
    dl, dr = al - bl, ar - br
    mean_gap = F.when(dl * dr >= 0, (F.abs(dl) + F.abs(dr)) / 2).otherwise(
        (dl * dl + dr * dr) / (2 * (F.abs(dl) + F.abs(dr)))
    )
    lower = (al + ar + bl + br) / 4 - mean_gap / 2
    return F.col("a_sign") * F.col("b_sign") * (r - l) * lower


def overlap_area(left: DataFrame, right: DataFrame, left_id: str = "GEOID", right_id: str = "place_geoid") -> DataFrame:
    """(left_id, right_id, area, overlap) of all pairs that share area.

    Both tables hold an id and normalised ``rings``.
    """
    a, b = _boxes(left, left_id, left_id), _boxes(right, right_id, right_id)
    side, width = _typical_side(a)
    pairs = candidate_pairs(a, b, left_id, right_id, _power_of_two(side))
    keep = [left_id, right_id]
    strip = _power_of_two(width)
    asked = pairs.select(
        *keep, "base", "a_ymin", "b_ymin", F.explode(F.sequence(_step(F.col("from_x"), strip), _step(F.col("to_x"), strip))).alias("strip"))
    common = (
        asked.join(_edge_strips(a, left_id, "a", strip), [left_id, "strip"])
        .where("greatest(a_yl, a_yr) > b_ymin")
        .join(_edge_strips(b, right_id, "b", strip), [right_id, "strip"])
        .where("greatest(b_yl, b_yr) > a_ymin AND greatest(a_l, b_l) < least(a_r, b_r)")
        .groupBy(*keep)
        .agg(F.sum(_common_area()).alias("overlap"))
    )
    return common.join(a.select(left_id, "area"), left_id).select(*keep, "area", "overlap")


def covered_tracts(tracts: DataFrame, places: DataFrame, share: float = COVERED_SHARE) -> DataFrame:
    """Tract-place pairs where more than ``share`` of the tract is covered."""
    pairs = overlap_area(tracts, places)
    return (
        pairs.withColumn("covered_share", F.try_divide("overlap", "area"))
        .where(F.col("covered_share") > share)
        .select("GEOID", "place_geoid", "covered_share")
    )


def dissolve(polygons: DataFrame, key: str) -> DataFrame:
    """One multi-part polygon per key from parts that do not overlap."""
    return polygons.groupBy(key).agg(F.flatten(F.collect_list("rings")).alias("rings"))


def outline_edges(polygons: DataFrame, key: str) -> DataFrame:
    """Directed edges ``(key, x1, y1, x2, y2)`` of the outlines of each key's parts.

    Parts turn counter-clockwise and their holes clockwise, so an edge that two
    parts share runs both ways and cancels in a grouped count.  Every edge is
    one row of a sum; nothing gathers the parts of a key.
    """
    each = polygons.select(key, F.inline(edges(F.col("rings"))))
    ahead = F.struct("x1", "y1") < F.struct("x2", "y2")
    ends = [F.when(ahead, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (("x1", "x2", "xa"), ("y1", "y2", "ya"), ("x2", "x1", "xb"), ("y2", "y1", "yb"))]
    net = each.select(key, *ends, F.when(ahead, F.lit(1)).otherwise(F.lit(-1)).alias("way")).groupBy(key, "xa", "ya", "xb", "yb").agg(F.sum("way").alias("way"))
    copies = net.where("way != 0").withColumn("copy_", F.explode(F.sequence(F.lit(1), F.abs("way").cast("int"))))
    forth = F.col("way") > 0
    return copies.select(key, *[F.when(forth, F.col(a)).otherwise(F.col(b)).alias(n) for a, b, n in (
        ("xa", "xb", "x1"), ("ya", "yb", "y1"), ("xb", "xa", "x2"), ("yb", "ya", "y2"))])


def _followed(outline: DataFrame, key: str) -> DataFrame:
    """``edge`` number, its start and the number of the ``next`` edge.

    As many edges arrive at a vertex as leave it.  Around a vertex they
    alternate; each that arrives goes on with the one that leaves next in
    clockwise order, which keeps parts that touch in a point apart.
    """
    order = Window.partitionBy(key, "x", "y").orderBy("angle", "edge")
    numbered = written(outline.withColumn("edge", F.monotonically_increasing_id()), "outline")

    def ends(x: str, y: str, ox: str, oy: str, name: str) -> DataFrame:
        angle = F.atan2(F.col(oy) - F.col(y), F.col(ox) - F.col(x))
        at = numbered.select(key, "edge", F.col(x).alias("x"), F.col(y).alias("y"), angle.alias("angle"))
        return at.select(key, "x", "y", F.col("edge").alias(name), F.col("angle").alias(f"{name}_angle"), (F.row_number().over(order) - 1).alias("rank"))

    into, out = ends("x2", "y2", "x1", "y1", "arrives"), ends("x1", "y1", "x2", "y2", "leaves")
    least = out.where("rank = 0").select(key, "x", "y", F.col("leaves_angle").alias("first_out"))
    counted = into.groupBy(key, "x", "y").agg(F.count("*").cast("int").alias("n"), F.min("arrives_angle").alias("first_in"))
    # the smallest angle may belong to an edge that arrives; then the last that leaves comes before it
    shift = F.when(F.col("first_in") < F.col("first_out"), F.lit(-1)).otherwise(F.lit(0))
    paired = into.join(counted.join(least, [key, "x", "y"]).select(key, "x", "y", "n", shift.alias("shift")), [key, "x", "y"]).withColumn(
        "rank", F.pmod(F.col("rank") + F.col("shift"), F.col("n")))
    following = paired.join(out, [key, "x", "y", "rank"]).select(F.col("arrives").alias("edge"), F.col("leaves").alias("next"))
    return numbered.join(following, "edge").select(key, "edge", "next", "x1", "y1")


def chained_rings(outline: DataFrame, key: str) -> DataFrame:
    """``(key, rings)`` from directed edges, by pointer doubling.

    After k rounds an edge knows the smallest edge number among the 2^k that
    follow it, and how far away that is.  When the edges of every ring agree,
    the smallest number names the ring and the distances are the order, so a
    ring of n edges takes log2 n rounds of one equi-join each, written to the shared
    folder.
    """
    start = written(_followed(outline, key), "ring-edges")
    state = start.select("edge", "next", F.col("edge").alias("ring"), F.lit(0).cast("bigint").alias("away"))
    span = 1
    while True:
        ahead = state.select(F.col("edge").alias("next"), F.col("next").alias("next_"), F.col("ring").alias("ring_"), F.col("away").alias("away_"))
        joined = state.join(ahead, "next")
        nearer = F.col("ring_") < F.col("ring")
        state = written(joined.select(
            "edge", F.col("next_").alias("next"), F.least("ring", "ring_").alias("ring"),
            F.when(nearer, F.col("away_") + span).otherwise(F.col("away")).alias("away"), (F.col("ring") != F.col("ring_")).alias("open")), "ring-state")
        span *= 2
        if not state.where("open").limit(1).count():
            break
    placed = start.drop("next").join(state.select("edge", "ring", "away"), "edge")
    # the edge that names a ring comes first, then the one furthest from coming round to it
    place = F.when(F.col("away") == 0, F.lit(0)).otherwise(-F.col("away"))
    first = F.when(F.col("edge") == F.col("ring"), F.lit(0)).otherwise(F.lit(1))
    rings = placed.groupBy(key, "ring").agg(F.array_sort(F.collect_list(F.struct(first.alias("f"), place.alias("p"), F.col("x1").alias("x"), F.col("y1").alias("y")))).alias("points"))
    plain = rings.select(key, "ring", F.transform("points", lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("points"))
    return plain.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("ring", "points"))), lambda r: r.points).alias("rings"))


def dissolved(polygons: DataFrame, key: str) -> DataFrame:
    """One polygon per key, with its outline only, from parts that don't overlap
    and share their borders' vertices."""
    return chained_rings(outline_edges(polygons, key), key)
