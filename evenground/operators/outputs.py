"""Result tables: projections, short names, bounds, boxes and documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from evenground.catalogs import NATION_BBOX, SHORT_DEMO, SHORT_GEO
from evenground.functions.geometry import with_bounds, signed_ring_area
from evenground.functions.margins import unpivot

DIGITS = 5
_GEO_KEEP = ("dataset_id", "GEOID", "disp_name", "NAME", "weighted_counts", "rings", "data_prop")


def geo_output(df: DataFrame, baselines: Iterable[str]) -> DataFrame:
    """Columns of the geographic result."""
    wanted = {f"prop_{b}" for b in baselines} | set(_GEO_KEEP)
    return df.select(
        *[c for c in df.columns if c in wanted or c.startswith(("diff_", "sig_diff_"))]
    )


def short_geo(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SHORT_GEO)


def short_demo(df: DataFrame, keep: Iterable[str] = ("dataset_id",)) -> DataFrame:
    """Only the renamed columns stay."""
    return df.withColumnsRenamed(SHORT_DEMO).select(*keep, *SHORT_DEMO.values())


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.selectExpr(
        *[f"bround(`{n}`, {digits}) AS `{n}`" if t == "double" else f"`{n}`" for n, t in df.dtypes]
    )


def column_bounds(short: DataFrame, keys: Iterable[str] = ("dataset_id",), digits: int = DIGITS) -> DataFrame:
    """Long minimum and maximum of all short columns ``p_...`` and ``d...``."""
    keys = list(keys)
    names = [n for n, t in short.dtypes if t == "double" and (n.startswith("p_") or n.startswith("d")) and n not in keys]
    both = [(n, f) for n in names for f in ("min", "max")]
    wide = short.groupBy(*keys).agg(*[F.expr(f"{f}({n}) AS {n}_{f}") for n, f in both])
    rows = [(f"'{n}_{f}'", f"bround({n}_{f}, {digits})") for n, f in both]
    return wide.selectExpr(*keys, unpivot(rows, ("bound", "value")))


def bounding_box(areas: DataFrame, keys: Iterable[str] = ("dataset_id",)) -> DataFrame:
    """Box of all areas per key; the nation has a fixed one."""
    keys = list(keys)
    level = ["geo"] if "geo" in areas.columns and "geo" not in keys else []
    extents = areas.select(*keys, *level, F.inline(with_bounds(F.col("rings"))))
    out = extents.groupBy(*keys).agg(
        F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"),
        *[F.bool_or(F.col(c) == "national").alias("nation") for c in level],
    )
    if "nation" not in out.columns:
        return out
    for name, fixed in zip(("xmin", "ymin", "xmax", "ymax"), NATION_BBOX, strict=True):
        out = out.withColumn(name, F.when(F.col("nation"), F.lit(fixed)).otherwise(F.col(name)))
    return out.drop("nation")


def sub_area_list(areas: DataFrame) -> DataFrame:
    """(dataset_id, disp, g_fips, grey): sub-areas, and regions of the nation.

    Grey means that no point fell there.  Regions are the rows with a
    ``region_name``; their id is ``00``.
    """
    name = F.split("disp_name", ",")[0]
    grey = F.coalesce(F.col("weighted_counts") == 0, F.lit(False))
    listed = areas.select("dataset_id", name.alias("disp"), F.col("GEOID").alias("g_fips"), grey.alias("grey"))
    if "region_name" not in areas.columns:
        return listed
    regions = (
        areas.where(F.col("region_name").isNotNull())
        .groupBy("dataset_id", F.col("region_name").alias("disp"))
        .agg(F.coalesce(F.sum("weighted_counts"), F.lit(0.0)).alias("weighted_counts"))
        .select("dataset_id", "disp", F.lit("00").alias("g_fips"), (F.col("weighted_counts") == 0).alias("grey"))
    )
    return listed.unionByName(regions)


def generalized(df: DataFrame, shapes: DataFrame, key: str = "GEOID") -> DataFrame:
    """Swap the shapes for simpler ones; areas without one are left out."""
    return df.drop("rings").join(shapes.select(key, "rings"), key)


def _closed(ring: Column) -> Column:
    same = ring[0] == F.element_at(ring, -1)
    return F.when(same, ring).otherwise(F.concat(ring, F.slice(ring, 1, 1)))


def geometry_struct(rings: Column) -> Column:
    """GeoJSON geometry of normalised rings: a ring that turns clockwise is a
    hole of the outer ring before it."""

    # numbers of the outer rings, bound once; each part is a slice up to the next
    starts = F.when(F.size(rings) == 0, F.array().cast("array<int>")).otherwise(F.filter(
        F.sequence(F.lit(0), F.size(rings) - 1), lambda i: (i == 0) | (signed_ring_area(F.get(rings, i)) >= 0)))

    def sliced(found: Column) -> Column:
        return F.transform(found, lambda i, k: F.slice(rings, i + 1, F.coalesce(F.get(found, k + 1), F.size(rings)) - i))

    parts = F.transform(F.array(starts), sliced)[0]
    points = lambda r: F.transform(_closed(r), lambda p: F.array(p.x, p.y))
    coordinates = F.transform(parts, lambda part: F.transform(part, points))
    return F.struct(F.lit("MultiPolygon").alias("type"), coordinates.alias("coordinates"))


def feature(df: DataFrame) -> Column:
    """One GeoJSON feature from the columns of a row."""
    properties = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in ("rings", "dataset_id")])
    parts = [F.lit("Feature").alias("type"), properties.alias("properties")]
    if "rings" in df.columns:
        parts.append(geometry_struct(F.col("rings")).alias("geometry"))
    return F.struct(*parts)


def result_documents(geo: DataFrame, demo: DataFrame, report: DataFrame, bounds_long: DataFrame,
                     boxes: DataFrame, sub_areas: DataFrame) -> DataFrame:
    """One JSON document per dataset.

    The lists hold areas and variables of one geography, whose number does not
    grow with the points.
    """

    def listed(df: DataFrame, item: Column, name: str) -> DataFrame:
        return df.groupBy("dataset_id").agg(F.sort_array(F.collect_list(F.to_json(item))).alias(name))

    def fields(df: DataFrame) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "dataset_id"])

    def raw(name: str) -> Column:
        return F.concat(F.lit("["), F.array_join(F.coalesce(name, F.array().cast("array<string>")), ","), F.lit("]"))

    bound_map = bounds_long.groupBy("dataset_id").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("bound", "value"))))).alias("bounds")
    )
    box = boxes.select("dataset_id", F.to_json(F.array("xmin", "ymin", "xmax", "ymax")).alias("bbox"))
    joined = (
        report.select("dataset_id", F.to_json(fields(report)).alias("messages"))
        .join(listed(rounded(geo), feature(geo), "features"), "dataset_id", "left")
        .join(listed(rounded(demo), fields(demo), "demo"), "dataset_id", "left")
        .join(bound_map, "dataset_id", "left")
        .join(box, "dataset_id", "left")
        .join(listed(sub_areas, fields(sub_areas), "subs"), "dataset_id", "left")
    )
    document = F.concat(
        F.lit('{"geo_bias_data":{"type":"FeatureCollection","features":'), raw("features"),
        F.lit('},"demographic_bias_data":'), raw("demo"),
        F.lit(',"messages":'), F.col("messages"),
        F.lit(',"bounds":'), F.coalesce("bounds", F.lit("{}")),
        F.lit(',"bbox":'), F.coalesce("bbox", F.lit("null")),
        F.lit(',"demographic_bias_sub_geo_list":'), raw("subs"), F.lit("}"),
    )
    return joined.select("dataset_id", document.alias("document"))


def document_pages(geo: DataFrame, demo: DataFrame, report: DataFrame, bounds_long: DataFrame, boxes: DataFrame,
                   sub_areas: DataFrame, rows_per_page: int = 2_000) -> DataFrame:
    """Result documents in bounded parts: ``dataset_id``, ``section``, ``part``
    (from 1), ``n_parts`` and the JSON text ``document`` of each part.

    The section ``head`` has the messages, bounds and box; ``geo``, ``demo`` and
    ``sub`` have ``rows_per_page`` items at most, areas with the most points first.
    """

    def fields(df: DataFrame) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "dataset_id"])

    def paged(df: DataFrame, item: Column, section: str, order: list[Column]) -> DataFrame:
        # the window holds the areas or variables of one geography, no points
        numbered = df.select("dataset_id", F.to_json(item).alias("line"), F.row_number().over(W.partitionBy("dataset_id").orderBy(*order)).alias("n"))
        parts = numbered.withColumn("part", (F.floor((F.col("n") - 1) / rows_per_page) + 1).cast("int")).groupBy("dataset_id", "part").agg(
            F.array_sort(F.collect_list(F.struct("n", "line"))).alias("lines"))
        text = F.concat(F.lit('{"items":['), F.array_join(F.transform("lines", lambda x: x.line), ","), F.lit("]}"))
        return parts.select(
            "dataset_id", F.lit(section).alias("section"), "part", F.max("part").over(W.partitionBy("dataset_id")).alias("n_parts"), text.alias("document"))

    bound_map = bounds_long.groupBy("dataset_id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("bound", "value")))).alias("bounds"))
    box = boxes.select("dataset_id", F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"))
    head = (
        report.select("dataset_id", fields(report).alias("messages")).join(bound_map, "dataset_id", "left").join(box, "dataset_id", "left")
        .select("dataset_id", F.lit("head").alias("section"), F.lit(1).alias("part"), F.lit(1).alias("n_parts"),
                F.to_json(F.struct("messages", "bounds", "bbox")).alias("document"))
    )
    share, area = SHORT_GEO["data_prop"], SHORT_GEO["GEOID"]
    geo, demo = rounded(geo), rounded(demo)
    return (
        head.unionByName(paged(geo, feature(geo), "geo", [F.desc_nulls_last(share), F.col(area)]))
        .unionByName(paged(demo, fields(demo), "demo", [F.to_json(fields(demo))]))
        .unionByName(paged(sub_areas, fields(sub_areas), "sub", [F.to_json(fields(sub_areas))]))
    )
