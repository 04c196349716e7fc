"""Queries on areas: roll-ups, shares, coverage of places, outputs of shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenground.functions.geometry import area, bad_polygon, box_rings, equal_area
from evenground.operators import baseline as bl
from evenground.operators.outputs import bounding_box, generalized, sub_area_list
from evenground.operators.overlay import covered_tracts, overlap_area
from evenground.operators.rollup import (
    attach_counts, complete_counts, point_share, roll_up, roll_up_all, sub_area_coverage, totals_differ,
)
from evenground.operators.spatial import national_area
from evenground.session import durable, small_side
from workload.formulas import EXTRA, _rect
from workload.points import place_shapes, tract_counts, tract_shapes, upper_shapes
from workload.registry import query, r, settle
from workload.views import view


def all_tracts(spark, sf):
    """The tracts of each dataset's area, counted; 0 where there is no point.

    The area of all datasets is the nation here: a dataset is joined to its
    area, the area to its tracts.
    """
    # counted once, read twice
    counts = durable(tract_counts(spark, sf))
    areas = national_area(counts.select("dataset_id").distinct()).select("dataset_id", "denom_geoid")
    tracts = bl.of_nation(view(spark, sf, "fx_tract")).join(small_side(areas), "denom_geoid").drop("denom_geoid")
    return complete_counts(tracts, counts)


_ALL = {
    **EXTRA,
    "fx_full": "SELECT d.dataset_id, t.GEOID, coalesce(c.weighted_counts, 0.0) AS w FROM {fx_tract} t"
               " CROSS JOIN (SELECT DISTINCT dataset_id FROM {fx_count}) d"
               " LEFT JOIN {fx_count} c ON c.GEOID = t.GEOID AND c.dataset_id = d.dataset_id",
}


def _rolled(length: int) -> str:
    return (
        f"SELECT dataset_id, substring(GEOID, 1, {length}) AS GEOID, {r('sum(w)', 'weighted_counts', 2)}"
        f" FROM {{fx_full}} GROUP BY dataset_id, substring(GEOID, 1, {length})"
    )


@query(_rolled(5), _ALL)
def rollup_county(spark, sf):
    return settle(roll_up(tract_counts(spark, sf), 5), 2)


@query(_rolled(2), _ALL)
def rollup_state(spark, sf):
    return settle(roll_up(tract_counts(spark, sf), 2), 2)


@query(f"{_rolled(2)} UNION ALL {_rolled(5)}", _ALL)
def rollup_all_levels(spark, sf):
    return settle(roll_up_all(tract_counts(spark, sf)), 2)


@query(f"SELECT dataset_id, GEOID, {r('w', 'weighted_counts', 2)}, {r('w / sum(w) OVER (PARTITION BY dataset_id)', 'data_prop')} FROM {{fx_full}}", _ALL)
def data_prop(spark, sf):
    return settle(point_share(all_tracts(spark, sf)).select(
        "dataset_id", "GEOID", F.bround("weighted_counts", 2).alias("weighted_counts"), "data_prop"))


@query(f"SELECT dataset_id, GEOID, {r('w / nullif(sum(w) OVER (PARTITION BY dataset_id, substring(GEOID, 1, 2)), 0)', 'data_prop')} FROM {{fx_full}}", _ALL)
def data_prop_sub_area(spark, sf):
    tracts = all_tracts(spark, sf).withColumn("sub_geo", F.substring("GEOID", 1, 2))
    return settle(point_share(tracts, ("dataset_id", "sub_geo")).select("dataset_id", "GEOID", "data_prop"))


@query("SELECT dataset_id, count(*) AS num_sub_geo_total, CAST(sum(CASE WHEN w > 0 THEN 1 ELSE 0 END) AS BIGINT) AS num_sub_geo_data,"
       " sum(CASE WHEN w > 0 THEN 1 ELSE 0 END) * 1.0 / count(*) <= 0.5 AS few_sub_geos_flag FROM"
       " (SELECT dataset_id, substring(GEOID, 1, 5) AS g, sum(w) AS w FROM {fx_full} GROUP BY dataset_id, substring(GEOID, 1, 5)) x GROUP BY dataset_id", _ALL)
def sub_area_coverage_counties(spark, sf):
    return sub_area_coverage(roll_up(all_tracts(spark, sf), 5))


@query(f"SELECT dataset_id, {r('t', 'tract_total', 2)}, {r('a', 'area_total', 2)} FROM (SELECT dataset_id, sum(weighted_counts) AS t,"
       " sum(CASE WHEN dataset_id <> first_id OR GEOID NOT LIKE '%1' THEN weighted_counts END) AS a"
       " FROM {fx_count}, (SELECT min(dataset_id) AS first_id FROM {fx_count}) m GROUP BY dataset_id) x"
       " WHERE coalesce(abs(t - a) >= 0.00001, TRUE)", EXTRA)
def totals_agree(spark, sf):
    """Check that tract and state totals agree; tracts of the first dataset
    have been lost on the way up, so that one is reported."""
    tracts = durable(tract_counts(spark, sf))
    first = tracts.agg(F.min("dataset_id")).scalar()
    kept = tracts.where((F.col("dataset_id") != first) | ~F.col("GEOID").endswith("1"))
    return settle(totals_differ(tracts, roll_up(kept, 2)), 2)


def _states_with_counts(spark, sf):
    states = view(spark, sf, "fx_states").select(F.col("state_code").alias("GEOID"), F.concat("state_name", F.lit(", X")).alias("disp_name"), "region_name")
    rolled = durable(roll_up(tract_counts(spark, sf), 2))
    areas = national_area(rolled.select("dataset_id").distinct()).select("dataset_id", "denom_geoid")
    return attach_counts(bl.of_nation(states).join(small_side(areas), "denom_geoid").drop("denom_geoid"), rolled)


_STATE = {
    **_ALL,
    "st": "SELECT dataset_id, substring(GEOID, 1, 2) AS g, sum(w) AS w FROM {fx_full} GROUP BY dataset_id, substring(GEOID, 1, 2)",
    "st_full": "SELECT d.dataset_id, s.state_name, s.state_code, s.region_name, st.w FROM {fx_states} s"
               " CROSS JOIN (SELECT DISTINCT dataset_id FROM {fx_count}) d LEFT JOIN {st} st ON st.g = s.state_code AND st.dataset_id = d.dataset_id",
}


@query("SELECT dataset_id, state_name AS disp, state_code AS g_fips, coalesce(w = 0, FALSE) AS grey FROM {st_full} UNION ALL"
       " SELECT dataset_id, region_name AS disp, '00' AS g_fips, coalesce(sum(w), 0) = 0 AS grey FROM {st_full} GROUP BY dataset_id, region_name", _STATE)
def region_rollup(spark, sf):
    return sub_area_list(_states_with_counts(spark, sf))


# --- shapes ------------------------------------------------------------------


@query(f"SELECT t.GEOID, p.place_geoid, {r(_rect('t', 'p'), 'covered_share')} FROM {{fx_square}} t JOIN {{fx_place}} p ON {_rect('t', 'p')} > 0.01")
def tract_place_coverage(spark, sf):
    return settle(covered_tracts(tract_shapes(spark, sf), place_shapes(spark, sf)))


@query(f"SELECT t.GEOID, p.place_geoid, {r('1', 'area')}, {r(_rect('t', 'p'), 'overlap')} FROM {{fx_square}} t JOIN {{fx_place}} p ON {_rect('t', 'p')} > 0")
def polygon_overlap_area(spark, sf):
    return settle(overlap_area(tract_shapes(spark, sf), place_shapes(spark, sf)))


@query(f"SELECT substring(GEOID, 1, 5) AS GEOID, {r('sum((x1 - x0) * (y1 - y0))', 'area')}, count(*) AS n_rings FROM {{fx_square}} GROUP BY substring(GEOID, 1, 5)")
def dissolve_counties(spark, sf):
    return settle(upper_shapes(spark, sf, 5).select("GEOID", area(F.col("rings")).alias("area"), F.size("rings").alias("n_rings")))


_BOX = ", ".join(r(f"{f}({c})", n) for f, c, n in (("min", "x0", "xmin"), ("min", "y0", "ymin"), ("max", "x1", "xmax"), ("max", "y1", "ymax")))


@query(f"SELECT substring(GEOID, 1, 2) AS state, {_BOX} FROM {{fx_square}} GROUP BY substring(GEOID, 1, 2)")
def bbox(spark, sf):
    shapes = tract_shapes(spark, sf).withColumn("state", F.substring("GEOID", 1, 2))
    return settle(bounding_box(shapes, ["state"]))


_N, _C, _RHO0 = __import__("evenground.functions.geometry", fromlist=["_cone"])._cone()
_E2 = 2 / 298.257222101 - 1 / 298.257222101**2
_E = _E2**0.5


def _albers(x: str, y: str) -> tuple[str, str]:
    s = f"sin(radians({y}))"
    q = f"({1 - _E2!r} * ({s} / (1 - {_E2!r} * {s} * {s}) - ln((1 - {_E!r} * {s}) / (1 + {_E!r} * {s})) / {2 * _E!r}))"
    rho = f"(6378137.0 * sqrt({_C!r} - {_N!r} * {q}) / {_N!r})"
    theta = f"({_N!r} * radians({x} + 96.0))"
    return f"({rho} * sin({theta}))", f"({_RHO0!r} - {rho} * cos({theta}))"


_CORNERS = {
    "cr": "SELECT GEOID, " + ", ".join(
        f"{e} AS {n}{i}" for i, (x, y) in enumerate((("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))
        for n, e in zip("xy", _albers(x, y), strict=True)) + " FROM {fx_square}"
}
_SHOELACE = " + ".join(f"(x{i} * y{(i + 1) % 4} - x{(i + 1) % 4} * y{i})" for i in range(4))


@query(f"SELECT GEOID, {r(f'abs({_SHOELACE}) / 2 / 1000000', 'km2', 3)} FROM {{cr}}", _CORNERS)
def albers_area(spark, sf):
    """Area of every tract in square kilometres on the equal-area plane."""
    return settle(tract_shapes(spark, sf).select("GEOID", (area(equal_area(F.col("rings"))) / 1e6).alias("km2")), 3)


@query("SELECT GEOID, CASE WHEN num_pov > num_children THEN 'zero_area' ELSE 'good' END AS defect FROM {fx_tract}")
def bad_polygons(spark, sf):
    """Quality list: tracts of one kind get a collapsed shape first."""
    t = view(spark, sf, "fx_tract")
    x1 = F.when(F.col("num_pov") > F.col("num_children"), F.col("x0")).otherwise(F.col("x1"))
    rings = box_rings(F.col("x0"), F.col("y0"), x1, F.col("y1"))
    # a collapsed square keeps two edges of length zero apart from its sides
    defect = bad_polygon(rings)
    return t.select("GEOID", F.when(defect.isNotNull(), F.lit("zero_area")).otherwise(F.lit("good")).alias("defect"))


@query(f"SELECT s.state_code AS GEOID, s.state_abbv, count(*) AS n_rings, {r('sum(0.25)', 'area')} FROM {{fx_square}} t JOIN {{fx_states}} s ON s.state_code = substring(t.GEOID, 1, 2) GROUP BY s.state_code, s.state_abbv")
def generalized_states(spark, sf):
    """Swap state shapes for simpler ones (half the side of each square)."""
    half = view(spark, sf, "fx_square").select(
        F.substring("GEOID", 1, 2).alias("GEOID"),
        box_rings(F.col("x0"), F.col("y0"), F.col("x0") + 0.5, F.col("y0") + 0.5).alias("rings"),
    )
    simple = half.groupBy("GEOID").agg(F.flatten(F.collect_list("rings")).alias("rings"))
    states = upper_shapes(spark, sf, 2).join(
        view(spark, sf, "fx_states").select(F.col("state_code").alias("GEOID"), "state_abbv"), "GEOID")
    return settle(generalized(states, simple).select("GEOID", "state_abbv", F.size("rings").alias("n_rings"), area(F.col("rings")).alias("area")))


# --- places and names ----------------------------------------------------------


@query("SELECT p.place_geoid AS GEOID, trim(replace(p.namelsad, 'city', '')) || ', ' || s.state_abbv AS cleaned_name FROM {fx_place} p"
       " JOIN {fx_states} s ON s.state_code = substring(p.place_geoid, 1, 2) WHERE n_suppliers * 6000 >= 50000")
def big_places(spark, sf):
    p = view(spark, sf, "fx_place")
    places = p.select(F.col("place_geoid").alias("GEOID"), F.col("namelsad").alias("NAMELSAD"),
                      box_rings(*[F.col(c) for c in ("x0", "y0", "x1", "y1")]).alias("rings"))
    populations = p.select(F.col("place_geoid").alias("GEOID"), (F.col("n_suppliers") * 6000).alias("estimate"))
    return bl.big_places(places, populations, view(spark, sf, "fx_states")).drop("rings")


@query("SELECT c.GEOID, split_part(c.NAME, ', ', 1) || ', ' || s.state_abbv AS cleaned_name FROM {fx_landing_county} c"
       " JOIN {fx_states} s ON s.state_code = substring(c.GEOID, 1, 2)")
def county_names(spark, sf):
    return bl.area_names(view(spark, sf, "fx_landing_county").select("GEOID", "NAME"), "county", view(spark, sf, "fx_states"))
