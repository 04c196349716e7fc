"""Point-in-polygon joins on a grid-cell index, and area detection.

Each polygon has a grid of its own scale, a power of four that follows from its
size and its number of edges, so a state and an islet both have cells in
proportion to their edges.  The index has one row per scale and cell with the
polygons that reach into it.  A polygon that covers a whole cell is stored
without edges.  One whose border passes through a cell is stored with the edges
that cross the cell, and with one bit that says whether it holds the cell's
reference point: a point is inside like the reference point unless an odd number
of edges cross the line between the two.  The bits of a row of cells come from a
running sum of the edges that cross the line through their reference points.
Edges on the lower or left border of a cell have nothing of its inside beyond
them: a polygon with no others in a cell is left out when it does not hold the
reference point, and is marked ``full`` when it does.

A point looks up one cell for each scale in use, so it meets at most one index
row per scale, and unmatched points survive left joins without a point id.

The join has two forms, chosen by an upper bound of the index size, which one
aggregate over the polygons gives before the index is built.  An index beyond the
limit by this bound is written and measured:

* small index: broadcast, the points are not shuffled at all;
* large index: shuffle on the cell, with the cells of hot tiles split by salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenground.catalogs import NATION_GEOID, NATION_NAME
from evenground.functions.geometry import edge_turn, edges, separates
from evenground.operators.clean import usable
from evenground.session import durable, small_side, written

#: cells along the longer side of a small polygon, and edges for each cell of a large one
CELLS_PER_SIDE = 4
EDGES_PER_CELL = 2
#: times as many cells along the longer side that a flat polygon may have
FLATTEST = 4
ENTRY_BYTES = 160
FAR = 2.0**52
BROADCAST_BYTES = 512 * 1024 * 1024
ROWS_PER_TASK = 2_000_000
#: cells along the side of a tile
TILE = 16
# place of the reference point in its cell: fractions that no border written in
# decimals passes through
REF_X, REF_Y = 0.3819660112501051, 0.6180339887498949


@dataclass(frozen=True)
class CellIndex:
    """Index table, the exponents of its cell sizes and an upper bound of its
    size in memory."""

    table: DataFrame
    scales: tuple[int, ...]
    bytes_bound: int

    def save(self, path: str) -> None:
        """The rows by scale; the bound stands in the folders' names, so that it
        is there without a row, too."""
        self.table.withColumn("bytes_bound", F.lit(self.bytes_bound)).write.mode("overwrite").partitionBy("bytes_bound", "scale").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CellIndex:
        table = spark.read.parquet(path)
        if "scale" not in table.columns:
            return cls(table.withColumn("scale", F.lit(0)), (), 0)
        if "full" not in table.schema["candidates"].dataType.elementType.names:
            # saved before candidates had the mark
            table = table.withColumn("candidates", F.transform(
                "candidates", lambda c: F.struct(c.poly_id.alias("poly_id"), c.edges.alias("edges"), c.held.alias("held"), (c.held & (F.size(c.edges) == 0)).alias("full"))))
        found = table.select("scale", "bytes_bound").distinct().collect()  # one row per scale
        return cls(table.drop("bytes_bound"), tuple(sorted(r["scale"] for r in found)), max((r["bytes_bound"] for r in found), default=0))


def _cell_no(c: Column, cell: float | Column) -> Column:
    # cell sizes are powers of two, so the quotient is exact; a number too far
    # away for any polygon has no cell
    number = c / cell
    return F.when(F.abs(number) < FAR, F.floor(number))


def _reference(cx: Column, cy: Column, cell: float | Column) -> tuple[Column, Column]:
    return (cx + REF_X) * cell, (cy + REF_Y) * cell


def _scaled_edges(polygons: DataFrame, id_column: str, cells_per_side: int) -> DataFrame:
    """``poly_id``, ``scale``, ``edges`` and the ``side`` of the largest ring.

    The side is that of a square as large as the ring's box, so that a long flat
    polygon has cells of about its height, too.
    """

    def extent(ring: Column, axis: str) -> Column:
        each = F.transform(ring, lambda p: p[axis])
        return F.array_max(each) - F.array_min(each)

    def side(ring: Column) -> Column:
        w, h = extent(ring, "x"), extent(ring, "y")
        return F.greatest(F.sqrt(w * h), F.greatest(w, h) / FLATTEST)

    rings = polygons.select(F.col(id_column).alias("poly_id"), "rings", F.inline(F.array(F.struct(
        edges(F.col("rings")).alias("edges"),
        F.array_max(F.transform("rings", side)).alias("side")))))
    # of a ring, as the side is: a polygon of many parts has no finer cells for them
    most = F.array_max(F.transform("rings", F.size))
    along = F.greatest(F.lit(float(cells_per_side)), F.sqrt(most / EDGES_PER_CELL))
    return rings.where((F.size("edges") > 0) & (F.col("side") > 0)).select(
        "poly_id", "rings", "edges", "side", (2 * F.round(F.log2(F.col("side") / along) / 2)).cast("int").alias("scale"))


def measure_grid(polygons: DataFrame, id_column: str = "GEOID", cells_per_side: int = CELLS_PER_SIDE) -> tuple[tuple[int, ...], int]:
    """Scales in use and an upper bound of the index entries, from one aggregate.

    An edge meets at most ``(width + height) / cell + 3`` cells, and a ring covers
    at most as many as its box has.  A cell is the power of four next to the
    side of the polygon's largest ring over ``cells_per_side``, or over the root
    of half a ring's edges where that is more; then its box has about as many
    cells as the ring has edges, and the index grows with the edges.
    """
    cell = F.pow(F.lit(2.0), F.col("scale"))
    along = F.aggregate("edges", F.lit(0.0), lambda s, e: s + F.abs(e.x2 - e.x1) + F.abs(e.y2 - e.y1))
    box = F.aggregate("rings", F.lit(0.0), lambda s, r: s + _box_cells(r, cell))
    row = (
        _scaled_edges(polygons, id_column, cells_per_side)
        .agg(F.sum(along / cell + 3 * F.size("edges") + box).alias("n"), F.array_sort(F.collect_set("scale")).alias("scales"))
        .first()
    )
    return tuple(row["scales"]), int(row["n"] or 0)


def _box_cells(ring: Column, cell: Column) -> Column:
    def cells(axis: str) -> Column:
        each = F.transform(ring, lambda p: p[axis])
        return (F.array_max(each) - F.array_min(each)) / cell + 2

    return F.coalesce(cells("x") * cells("y"), F.lit(0.0))


def _border_cells(rows: DataFrame) -> DataFrame:
    """Cells of a row that an edge crosses.

    The edge is cut to the row; the cut is widened by what rounding may take,
    for an edge too many in a cell changes nothing.
    """
    low_x, high_x = F.least("x1", "x2"), F.greatest("x1", "x2")
    slack = (F.abs("y1") + F.abs("y2") + F.col("cell")) * 2.0**-50
    first = F.greatest(F.least("y1", "y2"), F.col("cy") * F.col("cell") - slack)
    last = F.least(F.greatest("y1", "y2"), (F.col("cy") + 1) * F.col("cell") + slack)
    slope = (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))

    def at(y: Column) -> Column:
        return F.col("x1") + (y - F.col("y1")) * slope

    flat = F.col("y1") == F.col("y2")
    spare = F.when(F.col("x1") == F.col("x2"), F.lit(0.0)).otherwise((F.abs("x1") + F.abs("x2")) * 2.0**-50)
    left = F.when(flat, low_x).otherwise(F.greatest(low_x, F.least(at(first), at(last)) - spare))
    right = F.when(flat, high_x).otherwise(F.least(high_x, F.greatest(at(first), at(last)) + spare))
    return rows.select(
        "poly_id", "scale", "cy", F.struct("x1", "y1", "x2", "y2").alias("edge"),
        F.explode(F.sequence(_cell_no(left, F.col("cell")), _cell_no(right, F.col("cell")))).alias("cx"))


def _held_cells(rows: DataFrame) -> DataFrame:
    """Cells whose reference point the polygon holds.

    An edge that crosses the line of a row's reference points is counted at the
    last cell whose reference point lies left of it.  Counted from the right, a
    reference point is inside after an odd number of edges; sorted, these places
    are the ends of the runs of cells inside.
    """
    y = (F.col("cy") + REF_Y) * F.col("cell")
    guess = _cell_no(F.col("x1") + (y - F.col("y1")) * ((F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))), F.col("cell"))
    e = {c: F.col(c) for c in ("x1", "y1", "x2", "y2")}

    def left_of_edge(cx: Column) -> Column:
        x, _ = _reference(cx, F.col("cy"), F.col("cell"))
        return (edge_turn(e["x1"], e["y1"], e["x2"], e["y2"], x, y) > 0) == (e["y2"] > e["y1"])

    last = (
        F.when(left_of_edge(F.col("guess") + 1), F.col("guess") + 1).when(left_of_edge(F.col("guess")), F.col("guess"))
        .when(left_of_edge(F.col("guess") - 1), F.col("guess") - 1).otherwise(F.col("guess") - 2)
    )
    crossing = rows.where((e["y1"] > y) != (e["y2"] > y)).withColumn("guess", guess)
    ends = crossing.groupBy("poly_id", "scale", "cy").agg(F.array_sort(F.collect_list(last)).alias("ends"))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size("ends") / 2).cast("int") - 1),
        lambda i: F.struct((F.get("ends", 2 * i) + 1).alias("first"), F.get("ends", 2 * i + 1).alias("last")))
    each = ends.where(F.size("ends") > 1).select("poly_id", "scale", "cy", F.inline(runs)).where("first <= last")
    return each.select("poly_id", "scale", "cy", F.explode(F.sequence("first", "last")).alias("cx"))


def cell_index(polygons: DataFrame, id_column: str = "GEOID", cells_per_side: int = CELLS_PER_SIDE) -> CellIndex:
    """Build the index of a polygon table (``id_column``, ``rings``)."""
    scales, n_entries = measure_grid(polygons, id_column, cells_per_side)
    per_edge = _scaled_edges(polygons, id_column, cells_per_side).select(
        "poly_id", "scale", F.pow(F.lit(2.0), F.col("scale")).alias("cell"), F.inline("edges"))
    low_y, high_y = F.least("y1", "y2"), F.greatest("y1", "y2")
    rows = per_edge.select(
        "*", F.explode(F.sequence(_cell_no(low_y, F.col("cell")), _cell_no(high_y, F.col("cell")))).alias("cy"))
    entries = _border_cells(rows).select("scale", "cx", "cy", "poly_id", "edge", F.lit(0).alias("held")).unionByName(
        _held_cells(rows).select("scale", "cx", "cy", "poly_id", F.lit(None).alias("edge"), F.lit(1).alias("held")))
    cell = F.pow(F.lit(2.0), F.col("scale"))
    left, low = F.col("cx") * cell, F.col("cy") * cell
    on_border = F.forall("edges", lambda e: ((e.x1 == left) & (e.x2 == left)) | ((e.y1 == low) & (e.y2 == low)))
    # one shuffle by cell serves both groupings
    table = (
        entries.repartition("scale", "cx", "cy")
        .groupBy("scale", "cx", "cy", "poly_id").agg(F.collect_list("edge").alias("edges"), (F.max("held") == 1).alias("held"))
        .withColumn("on_border", on_border).where("held OR NOT on_border")
        .select("scale", "cx", "cy", F.struct("poly_id", "edges", "held", F.col("on_border").alias("full")).alias("candidate"))
        .groupBy("scale", "cx", "cy").agg(F.collect_list("candidate").alias("candidates"))
    )
    bound = n_entries * ENTRY_BYTES
    if bound > BROADCAST_BYTES:
        table = written(table, "cell-index")
        entry = F.aggregate("candidates", F.lit(0), lambda n, c: n + 1 + F.size(c.edges))
        bound = int(table.agg(F.sum(entry)).first()[0] or 0) * ENTRY_BYTES
    return CellIndex(table, scales, bound)


def _inside(candidate: Column, x: Column, y: Column, ref_x: Column, ref_y: Column, off_border: Column) -> Column:
    """The polygon of a candidate holds the point of its cell; a point on an edge
    is not inside."""
    crossed = F.aggregate(candidate["edges"], F.lit(0), lambda n, e: n + separates(e, x, y, ref_x, ref_y))
    return F.when(F.size(candidate["edges"]) == 0, candidate["held"]).when(candidate["full"] & off_border, F.lit(True)).otherwise(
        (crossed >= 0) & ((F.pmod(crossed, F.lit(2)) == 1) != candidate["held"]))


def _hot_tiles(points: DataFrame, rows_per_task: int) -> DataFrame:
    """Tiles with more rows than one task should take, with their salts.

    Tiles of ``TILE`` cells a side are counted instead of cells, as the count of
    cells would be shuffled with nearly as many rows as there are points; a cell
    with too many rows lies in a tile with too many.  At most
    ``rows / rows_per_task`` tiles can be hot, which bounds the table: 10^12
    rows give at most 500,000 entries of three integers.
    """
    return (
        points.groupBy("tx", "ty").agg(F.count("*").alias("n"))
        .where(F.col("n") > rows_per_task)
        .select("tx", "ty", F.ceil(F.col("n") / rows_per_task).cast("int").alias("n_salts"))
    )


def _lookup(rows: DataFrame, points: DataFrame, table: DataFrame, cell: float, small: bool, rows_per_task: int) -> DataFrame:
    """``rows``, which are ``points`` with further columns, with ``cx``, ``cy``
    and the candidates of their cell of one scale."""
    place = {"cx": _cell_no(F.col("lon"), cell), "cy": _cell_no(F.col("lat"), cell)}
    placed = rows.withColumns(place)
    if small:
        return placed.join(F.broadcast(table), ["cx", "cy"], "left")
    if points.isStreaming:
        # a micro-batch is small; an aggregate of the stream can't be joined to it
        return placed.join(table.hint("shuffle_hash"), ["cx", "cy"], "left")
    # counted on the points as they came, so that the plan of a scale does not
    # repeat those before it
    tile = {"tx": F.floor(F.col("cx") / TILE), "ty": F.floor(F.col("cy") / TILE)}
    # written, as both sides of the join ask for it
    hot = durable(_hot_tiles(points.select("lon", "lat").withColumns(place).withColumns(tile), rows_per_task))
    if not hot.limit(1).count():
        return placed.join(table.hint("shuffle_hash"), ["cx", "cy"], "left")
    hot = F.broadcast(hot)
    # null cells (rows that are not joined) and hot tiles spread by row hash
    row_hash = F.xxhash64(*[F.col(c) for c in points.columns])
    n_salts = F.coalesce("n_salts", F.lit(1))
    hot_tile = hot.withColumnsRenamed({"tx": "hot_tx", "ty": "hot_ty"})
    same_tile = tile["tx"].eqNullSafe(F.col("hot_tx")) & tile["ty"].eqNullSafe(F.col("hot_ty"))
    salted = (
        placed.join(hot_tile, same_tile, "left")
        .withColumn("salt", F.pmod(row_hash, n_salts).cast("int"))
        .drop("hot_tx", "hot_ty", "n_salts")
    )
    salted_table = (
        table.withColumns(tile).join(hot, ["tx", "ty"], "left")
        .select("cx", "cy", "candidates", F.explode(F.sequence(F.lit(0), n_salts - 1)).alias("salt"))
        .hint("shuffle_hash")
    )
    return salted.join(salted_table, ["cx", "cy", "salt"], "left").drop("salt")


def point_in_polygon(points: DataFrame, index: CellIndex, id_name: str = "GEOID",
                     broadcast_bytes: int = BROADCAST_BYTES,
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Left join of points to the polygons that strictly contain them.

    Adds ``id_name`` (NULL when none) and ``first_match``, true on exactly one
    output row per point.
    """
    kind = index.table.schema["candidates"].dataType.elementType["poly_id"].dataType.simpleString()
    empty = F.array().cast(f"array<{kind}>")
    joined, found = points, []
    for scale in index.scales:
        cell = 2.0**scale
        table = index.table.where(F.col("scale") == scale).select("cx", "cy", "candidates")
        rows = _lookup(joined, points, table, cell, index.bytes_bound <= broadcast_bytes, rows_per_task)
        ref = _reference(F.col("cx"), F.col("cy"), cell)
        off_border = (F.col("lon") > F.col("cx") * cell) & (F.col("lat") > F.col("cy") * cell)
        # each join's candidates are reduced to ids before the next one
        held = F.filter("candidates", lambda c: _inside(c, F.col("lon"), F.col("lat"), *ref, off_border))  # noqa: B023
        # lambdas are interpreted; a cell that one polygon covers needs none
        only = F.get("candidates", F.lit(0))
        covered = (F.size("candidates") == 1) & only["full"] & (off_border | (F.size(only["edges"]) == 0))
        ids = F.when(F.col("candidates").isNull(), empty).when(covered, F.array(only["poly_id"])).otherwise(F.transform(held, lambda c: c.poly_id))
        found.append(f"found_{len(found)}_")
        joined = rows.select(*joined.columns, ids.alias(found[-1]))
    return (
        joined.select(*points.columns, F.concat(empty, *found).alias("found"))
        .select(*points.columns, F.posexplode_outer("found").alias("pos", id_name))
        .withColumn("first_match", F.coalesce(F.col("pos") == 0, F.lit(True)))
        .drop("pos")
    )


def weighted_counts(points: DataFrame, index: CellIndex, keys: Sequence[str] = ("dataset_id",),
                    broadcast_bytes: int = BROADCAST_BYTES,
                    rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Sum of weights, joined rows and points per key and containing polygon.

    A place that holds a large part of all rows lies in a hot tile, whose rows
    are spread; points are not added up per place before, which would shuffle
    them all once more.
    """
    places = points.select(*keys, "lon", "lat", "weight")
    joined = point_in_polygon(places, index, "GEOID", broadcast_bytes, rows_per_task)
    return joined.groupBy(*keys, "GEOID").agg(
        F.sum("weight").alias("weighted_counts"),
        F.count("*").alias("n_joined"),
        F.count_if("first_match").alias("n_points"),
    )


def sampled(points: DataFrame, sizes: DataFrame | None, share: float,
            above: int = 0, key: Sequence[str] = ("lon", "lat", "weight")) -> DataFrame:
    """Repeatable sample of the datasets with more than ``above`` rows.

    All rows of a place are drawn or none, so the sample of a dataset may be
    empty; nothing draws one unless it is asked to.

    ``sizes`` (dataset_id, n_rows) names the small datasets, which stay whole.
    """
    bucket = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key])), 1, 8), 16, 10)
    chosen = bucket.cast("bigint") < int(share * 2**32)
    if sizes is None:
        return points.where(chosen)
    small = small_side(sizes.where(F.col("n_rows") <= above).select("dataset_id", F.lit(True).alias("whole")))
    return (
        points.join(small, "dataset_id", "left")
        .where(F.coalesce("whole", F.lit(False)) | chosen)
        .drop("whole")
    )


def exact_sample(points: DataFrame, share: float, above: int = 0, key: Sequence[str] = ("lon", "lat", "weight")) -> DataFrame:
    """Repeatable sample of exactly ``round(share * rows)`` rows, half to even, of
    each dataset with more than ``above`` rows; smaller ones stay whole.

    Rows are taken by ascending hash.  A histogram of the hashes' leading bits
    finds for each dataset the bucket in which its sample ends: all rows of the
    buckets before it are taken where they are, and only rows of that bucket
    are sorted out by hash.  Equal rows are counted there, not listed, so a
    place that holds a third of a dataset is one row.
    """
    names = points.columns
    hashed = points.withColumn("hash_", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key])))
    hashed = hashed.withColumn("bucket_", F.conv(F.substring("hash_", 1, 4), 16, 10).cast("int"))
    histogram = durable(hashed.groupBy("dataset_id", "bucket_").agg(F.count("*").alias("n")))
    # at most 65,536 rows per dataset
    per_dataset = W.partitionBy("dataset_id")
    whole = F.sum("n").over(per_dataset)
    wanted = F.when(whole > above, F.bround(whole * F.lit(share), 0).cast("bigint")).otherwise(whole)
    upto = F.sum("n").over(per_dataset.orderBy("bucket_").rowsBetween(W.unboundedPreceding, W.currentRow))
    running = histogram.select("dataset_id", "bucket_", "n", upto.alias("upto"), wanted.alias("wanted"))
    cuts = running.where((F.col("upto") - F.col("n") < F.col("wanted")) & (F.col("upto") >= F.col("wanted"))).select(
        "dataset_id", F.col("bucket_").alias("last_"), (F.col("wanted") - F.col("upto") + F.col("n")).alias("rest_"))
    cut = hashed.join(small_side(cuts), "dataset_id")
    before = cut.where(F.col("bucket_") < F.col("last_")).select(*names)
    ends = cut.where(F.col("bucket_") == F.col("last_")).groupBy(*names, "hash_", "rest_").agg(F.count("*").alias("n"))
    order = per_dataset.orderBy("hash_", *[F.col(c) for c in names]).rowsBetween(W.unboundedPreceding, W.currentRow)
    taken = F.least(F.col("n"), F.col("rest_") - (F.sum("n").over(order) - F.col("n")))
    last = ends.select(*names, taken.alias("taken_")).where("taken_ > 0").select(*names, F.explode(F.sequence(F.lit(1), F.col("taken_"))).alias("copy_"))
    return before.unionByName(last.select(*names))


def area_hits(points: DataFrame, index: CellIndex, **join) -> DataFrame:
    """Points per dataset, orientation and area.

    Flipped coordinates count only where nothing matches unflipped, so only
    datasets without a match are looked up the other way round; when there are
    none, the points are not read again.
    """

    def counted(rows: DataFrame, flipped: bool) -> DataFrame:
        counts = weighted_counts(rows.withColumns({"weight": F.lit(1.0), "flipped": F.lit(flipped)}), index, ("dataset_id", "flipped"), **join)
        return counts.select("dataset_id", "flipped", "GEOID", F.col("n_joined").alias("n"))

    plain = durable(counted(points, False))
    hits = plain.where(F.col("GEOID").isNotNull())
    lost = plain.groupBy("dataset_id").agg(F.count("GEOID").alias("n")).where("n = 0").select(F.col("dataset_id").alias("lost_id"))
    if not lost.limit(1).count():
        return hits
    again = points.join(small_side(lost), F.col("dataset_id").eqNullSafe(F.col("lost_id")), "left_semi")
    turned = again.withColumns({"lon": F.col("lat"), "lat": F.col("lon")})
    return hits.unionByName(counted(turned, True).where(F.col("GEOID").isNotNull()))


def dominant_area(hits: DataFrame, areas: DataFrame) -> DataFrame:
    """One area per dataset: most points first, smallest id on ties.

    Flipped coordinates only count when nothing matched unflipped.  ``areas``
    is (GEOID, cleaned_name).
    """
    per_dataset = W.partitionBy("dataset_id")
    oriented = (
        hits.withColumn("any_plain", F.max(~F.col("flipped")).over(per_dataset))
        .where(F.col("flipped") != F.col("any_plain"))
        .join(areas.select("GEOID", "cleaned_name"), "GEOID", "left")
    )
    rank = F.row_number().over(per_dataset.orderBy(F.desc("n"), "GEOID"))
    names = F.array_sort(F.collect_list("cleaned_name").over(per_dataset))
    return (
        oriented.select(
            "dataset_id", F.col("GEOID").alias("denom_geoid"), F.col("cleaned_name").alias("g_disp"),
            "flipped", rank.alias("rank"), names.alias("names"),
            F.count("*").over(per_dataset).alias("n_areas"),
        )
        .where(F.col("rank") == 1)
        .select(
            "dataset_id", "denom_geoid", "g_disp", "flipped",
            (F.col("n_areas") > 1).alias("multiple_geographies_flag"),
            F.when(F.col("n_areas") > 1, F.col("names")).alias("multiple_geographies_list"),
        )
    )


def national_area(dataset_ids: DataFrame) -> DataFrame:
    """The nation needs no detection."""
    return dataset_ids.select(
        "dataset_id", F.lit(NATION_GEOID).alias("denom_geoid"), F.lit(NATION_NAME).alias("g_disp"),
        F.lit(False).alias("flipped"), F.lit(False).alias("multiple_geographies_flag"),
        F.lit(None).cast("array<string>").alias("multiple_geographies_list"),
    )


def oriented_points(points: DataFrame, detected: DataFrame) -> DataFrame:
    """Swap the coordinates of the datasets that were uploaded flipped."""
    flips = small_side(detected.where("flipped").select("dataset_id", "flipped"))
    flipped = F.coalesce("flipped", F.lit(False))
    return (
        points.join(flips, "dataset_id", "left")
        .withColumns(
            {
                "lon": F.when(flipped, F.col("lat")).otherwise(F.col("lon")),
                "lat": F.when(flipped, F.col("lon")).otherwise(F.col("lat")),
            }
        )
        .drop("flipped")
    )


def detect_areas(points: DataFrame, levels: dict[str, tuple[CellIndex, DataFrame]],
                 accounting: DataFrame | None = None) -> DataFrame:
    """Area of every dataset: (dataset_id, geo, denom_geoid, g_disp, flipped ...).

    ``levels`` maps a level to its index and its (GEOID, cleaned_name) table.
    All rows are looked up, once, and added up before the choice.
    """
    rows = usable(points)
    ids = (accounting if accounting is not None else points).select("dataset_id", "geo").distinct()
    parts = [
        national_area(ids.where(F.col("geo") == "national")).withColumn("geo", F.lit("national"))
    ]
    for level, (index, areas) in levels.items():
        found = dominant_area(area_hits(rows.where(F.col("geo") == level), index), areas)
        parts.append(found.withColumn("geo", F.lit(level)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return durable(out)
