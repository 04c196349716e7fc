"""Queries on statistics: reference build, scores, custom columns, outputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from evenground.catalogs import (
    BASELINES, CITY_PERCENTS, DERIVED_PERCENTS, PERCENTS, REPORTED_PERCENTS, SHORT_DEMO, SHORT_GEO, SUMS,
    SUMS_OF_SUMS,
)
from evenground.functions import margins as mg
from evenground.functions.names import baseline_population
from evenground.operators import baseline as bl
from evenground.operators import custom as cu
from evenground.operators.outputs import column_bounds, geo_output, short_demo, short_geo
from evenground.operators.rollup import point_share
from evenground.operators.scores import demo_scores, geo_scores, merge_partials, partials_long, weighted_partials
from workload import formulas as fm
from workload.areas import _ALL, all_tracts
from workload.points import place_shapes, tract_counts, tract_shapes
from workload.registry import query, r, settle
from workload.views import codes, view

EXTRA = fm.EXTRA


def survey(spark, sf, level):
    return bl.survey_level(view(spark, sf, f"fx_landing_{level}"), codes(), level, "2022")


# --- formulas ------------------------------------------------------------------


@query(f"SELECT GEOID, {r(fm.safe_divide('num_pov - num_pov', 'num_children - num_children'), 'zero_zero')},"
       f" {r(fm.safe_divide('num_pov', 'num_pop'), 'ratio')}, {r(fm.safe_divide('num_pop_margin', 'num_pop'), 'missing')},"
       f" {r(fm.safe_divide('num_pov', 'num_pop - num_pop'), 'over_zero')} FROM {{fx_tract}}")
def safe_divide(spark, sf):
    return settle(view(spark, sf, "fx_tract").selectExpr(
        "GEOID",
        f"{mg.safe_divide('(num_pov - num_pov)', '(num_children - num_children)')} AS zero_zero",
        f"{mg.safe_divide('num_pov', 'num_pop')} AS ratio",
        f"{mg.safe_divide('num_pop_margin', 'num_pop')} AS missing",
        f"{mg.safe_divide('num_pov', '(num_pop - num_pop)')} AS over_zero",
    ))


_NEW_SUMS = list(SUMS) + list(SUMS_OF_SUMS)
_WITH_M = [c for n in _NEW_SUMS for c in (n, f"{n}_margin")]


@query(f"SELECT GEOID, {', '.join(r(n, n) for n in _WITH_M)} FROM {{sv_tract_c}}", EXTRA)
def moe_sum_row(spark, sf):
    """The 18 derived sums with margins, over all tracts."""
    df = bl.add_sums(bl.fill_controlled(bl.rename_survey(view(spark, sf, "fx_landing_tract"), codes())))
    return settle(df.select("GEOID", *_WITH_M))


_GROUPED = ["num_pov", "num_under18_pov_pop", "num_seniors"]


@query("SELECT substring(GEOID, 1, 5) AS county, " + ", ".join(
    f"{r(f'sum({n})', n)}, " + r(f"sqrt(coalesce(sum(CASE WHEN {n} <> 0 THEN {n}_margin * {n}_margin END), 0) + pow(coalesce(max(CASE WHEN {n} = 0 THEN {n}_margin END), 0), 2))", f"{n}_margin")
    for n in _GROUPED) + " FROM {sv_tract_a} GROUP BY substring(GEOID, 1, 5)", EXTRA)
def moe_sum_grouped(spark, sf):
    df = bl.fill_controlled(bl.rename_survey(view(spark, sf, "fx_landing_tract"), codes()))
    return settle(df.groupBy(F.substring("GEOID", 1, 5).alias("county")).agg(
        *[c for n in _GROUPED for c in (F.sum(n).alias(n), F.expr(mg.moe_sum_agg(n, f"{n}_margin")).alias(f"{n}_margin"))]
    ))


_PCT = [c for n, _, _ in DERIVED_PERCENTS for c in (n, f"{n}_margin")]
_REP = [c for n, _, _ in REPORTED_PERCENTS for c in (n, f"{n}_margin")]


@query(f"SELECT GEOID, {', '.join(r(n, n) for n in _PCT)} FROM {{sv_tract}}", EXTRA)
def moe_prop_percent(spark, sf):
    """The 36 derived percents with margins, over all tracts."""
    return settle(survey(spark, sf, "tract").select("GEOID", *_PCT))


@query(f"SELECT GEOID, {', '.join(r(n, n) for n in _REP)} FROM {{sv_tract}}", EXTRA)
def reported_percent_fix(spark, sf):
    return settle(survey(spark, sf, "tract").select("GEOID", *_REP))


@query(" UNION ALL ".join(
    f"SELECT '{n}' AS var, CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS value FROM {{fx_landing_tract}}"
    for n, c in [("GEOID", "GEOID"), *[(f"{n}{s}", f'"{k}{e}"') for n, k in codes().items() if n.startswith("num_") for e, s in (("E", ""), ("M", "_margin"))]]))
def missing_margin_profile(spark, sf):
    return bl.missing_margin_profile(bl.rename_survey(view(spark, sf, "fx_landing_tract"), codes()))


_FIRST, _FIRST_CODE = next((n, k) for n, k in codes().items() if n.startswith("num_"))


@query(f"SELECT '{_FIRST}' AS var, CAST(count(*) AS BIGINT) AS value FROM {{fx_landing_tract}} WHERE GEOID LIKE '%7'", EXTRA)
def only_margins_missing(spark, sf):
    """Check that no estimate is missing; one that is, in some tracts, is reported."""
    landed = bl.rename_survey(view(spark, sf, "fx_landing_tract"), codes())
    lost = landed.withColumn(_FIRST, F.when(~F.col("GEOID").endswith("7"), F.col(_FIRST)))
    return bl.estimates_with_missing(bl.missing_margin_profile(lost))


@query("SELECT GEOID, var, " + r("value", "value") + " FROM (" + " UNION ALL ".join(
    f"SELECT GEOID, '{n}' AS var, {n} AS value FROM {{sv_tract}}" for n, _, _ in DERIVED_PERCENTS) + ") x WHERE value < 0 OR value > 100", EXTRA)
def percent_range_check(spark, sf):
    """Percents outside 0..100; the derived sums of the test survey have some."""
    return settle(bl.percents_out_of_range(survey(spark, sf, "tract"), [n for n, _, _ in DERIVED_PERCENTS]))


@query("SELECT GEOID, 'Tract' AS disp_name, '' AS disp_name_abbv, var, " + r("value", "value") + ", " + r("value_margin", "value_margin")
       + " FROM (" + fm.stats_rows("{sv_county}", "'x' AS disp_name") + ") x", EXTRA)
def precomputed_stats_unpivot(spark, sf):
    df = survey(spark, sf, "county").withColumns({"disp_name": F.lit("Tract"), "disp_name_abbv": F.lit("")})
    return settle(bl.precomputed_stats(df))


_PROPS = [c for b in BASELINES for c in (f"prop_{b}", f"prop_{b}_margin")]


def _prop_sql(pair: str) -> str:
    return f"SELECT GEOID, denom_geoid, {', '.join(r(c, c) for c in _PROPS)} FROM {{{pair}}}"


@query(_prop_sql("pair_us_state"), EXTRA)
def baseline_prop_us(spark, sf):
    us = survey(spark, sf, "us")
    return settle(bl.add_proportions(bl.of_nation(survey(spark, sf, "state")), us).select("GEOID", "denom_geoid", *_PROPS))


@query(_prop_sql("pair_county_tract"), EXTRA)
def baseline_prop_prefix(spark, sf):
    tracts = bl.by_prefix(survey(spark, sf, "tract"), 5)
    return settle(bl.add_proportions(tracts, survey(spark, sf, "county")).select("GEOID", "denom_geoid", *_PROPS))


@query("SELECT denom_geoid, var, value FROM (" + " UNION ALL ".join(
    f"SELECT denom_geoid, 'prop_{b}' AS var, sum(prop_{b}) AS value FROM {{pair_state_tract}} GROUP BY denom_geoid" for b in BASELINES)
    + ") x WHERE (value > 0 AND value < 1 - 1e-9) OR value > 1 + 1e-9", EXTRA)
def prop_sum_check(spark, sf):
    """Check that proportions sum to 1: no rows."""
    tracts = bl.by_prefix(survey(spark, sf, "tract"), 2)
    return bl.prop_sum_violations(bl.add_proportions(tracts, survey(spark, sf, "state")))


_CITY = [n for p, _, _ in CITY_PERCENTS for n in (p, f"{p}_margin")] + [c for b in BASELINES for c in (f"num_{b}", f"num_{b}_margin")]


def _cities(spark, sf):
    tracts = survey(spark, sf, "tract").withColumn("disp_name", F.col("tract_name"))
    places = place_shapes(spark, sf).join(view(spark, sf, "fx_place").select("place_geoid", F.col("namelsad").alias("cleaned_name")), "place_geoid")
    return bl.city_tables(tracts, tract_shapes(spark, sf), places)


@query("SELECT c.GEOID, p.namelsad AS disp_name, '' AS disp_name_abbv, var, " + r("value", "value") + ", " + r("value_margin", "value_margin")
       + " FROM (" + fm.stats_rows("{city_stats}", "0 AS z", [p for p, _, _ in CITY_PERCENTS]) + ") c JOIN {fx_place} p ON p.place_geoid = c.GEOID", EXTRA)
def city_stats(spark, sf):
    return settle(_cities(spark, sf)[1])


@query(_prop_sql("pair_city_tract"), EXTRA)
def city_tract_props(spark, sf):
    return settle(_cities(spark, sf)[0].select("GEOID", "denom_geoid", *_PROPS))


# --- scores --------------------------------------------------------------------


def scored_tracts(spark, sf):
    """Tracts of the nation with counts, shares and proportions."""
    keep = ["GEOID", *bl.with_margins(f"num_{b}" for b in BASELINES)]
    props = bl.add_proportions(bl.of_nation(view(spark, sf, "fx_tract").select(*keep)), view(spark, sf, "fx_us"))
    counts = all_tracts(spark, sf).select("dataset_id", "GEOID", "disp_name", "weighted_counts")
    return geo_scores(point_share(counts).join(props, "GEOID"))


def _geo_sql() -> str:
    cols = []
    for b in BASELINES:
        cols += [r(f"prop_{b}", f"prop_{b}"), r(f"round_even(dp, 3) - round_even(prop_{b}, 3)", f"diff_{b}"),
                 f"CASE WHEN dp <= prop_{b} - 1.96 * prop_{b}_margin OR dp >= prop_{b} + 1.96 * prop_{b}_margin THEN 'TRUE' ELSE 'FALSE' END AS sig_diff_{b}"]
    return f"SELECT dataset_id, GEOID, {r('dp', 'data_prop')}, {', '.join(cols)} FROM {{geo_base}}"


_GEO = {
    **_ALL,
    "geo_prop": "SELECT a.GEOID, a.disp_name, " + ", ".join(
        f"{fm.safe_divide(f'a.num_{b}', f'd.num_{b}')} AS prop_{b}, {fm.moe_prop(f'a.num_{b}', f'd.num_{b}', f'a.num_{b}_margin', f'd.num_{b}_margin')} AS prop_{b}_margin"
        for b in BASELINES) + " FROM {fx_tract} a CROSS JOIN {fx_us} d",
    "geo_base": "SELECT f.dataset_id, f.w, f.w / sum(f.w) OVER (PARTITION BY f.dataset_id) AS dp, g.* FROM {fx_full} f JOIN {geo_prop} g ON g.GEOID = f.GEOID",
    "geo_scored": _geo_sql(),
}


@query("SELECT * FROM {geo_scored}", _GEO)
def geo_disparity(spark, sf):
    """Flagship: share of points against shares of seven populations."""
    keep = [c for b in BASELINES for c in (f"prop_{b}", f"diff_{b}", f"sig_diff_{b}")]
    return settle(scored_tracts(spark, sf).select("dataset_id", "GEOID", "data_prop", *keep))


@query("SELECT dataset_id, GEOID AS num_geoid, 'x' AS m_disp, data_prop AS da_prop, " + ", ".join(
    f"{k} AS {v}" for k, v in SHORT_GEO.items() if k not in ("GEOID", "disp_name", "data_prop")) + " FROM {geo_scored}", _GEO)
def minify_columns(spark, sf):
    return settle(short_geo(geo_output(scored_tracts(spark, sf), BASELINES).drop("weighted_counts").withColumn("disp_name", F.lit("x"))))


_BOUND = [f"p_{v}" for k, v in SHORT_GEO.items() if False] + [v for k, v in SHORT_GEO.items() if v.startswith(("p_", "d_")) or v == "da_prop"]
_LONG_OF_SHORT = {v: k for k, v in SHORT_GEO.items()}


@query(" UNION ALL ".join(
    f"SELECT dataset_id, '{v}_{s}' AS bound, {r(f'{s}({_LONG_OF_SHORT[v]})', 'value', 5)} FROM {{geo_scored}} GROUP BY dataset_id"
    for v in _BOUND for s in ("min", "max")), _GEO)
def bounds_min_max(spark, sf):
    short = short_geo(geo_output(scored_tracts(spark, sf), BASELINES))
    return settle(column_bounds(short))


def _tract_values(spark, sf):
    # a tract without points adds nothing to a point-weighted mean
    counts = tract_counts(spark, sf).select("dataset_id", "GEOID", "weighted_counts")
    return counts.join(survey(spark, sf, "tract").select("GEOID", *bl.with_margins(PERCENTS)), "GEOID")


def _stats(df, key="GEOID"):
    return bl.unpivot_pairs(df, [key], PERCENTS).select(
        F.col(key).alias("geo_fips"), F.col("var").alias("census_var"), F.col("value").alias("summary_value"),
        F.col("value_margin").alias("summary_value_margin"))


_DEMO_COLS = ["dataset_id", "geo_fips", "census_var", "data_value", "summary_value", "diff_data_city", "data_value_sd",
              "summary_value_margin", "sig_diff", "baseline_pop"]


def _demo_sql(key: str, stats: str) -> tuple[str, dict[str, str]]:
    sums = ", ".join(
        f"sum(f.w * s.{p}) AS {p}, sum((f.w * s.{p}_margin) * (f.w * s.{p}_margin)) AS {p}_margin" for p in PERCENTS
    )
    extra = {
        **_ALL,
        "dm_sum": f"SELECT f.dataset_id, {key} AS geo_fips, sum(f.w) AS w, {sums} FROM {{fx_full}} f JOIN {{sv_tract}} s ON s.GEOID = f.GEOID GROUP BY f.dataset_id, {key}",
        "dm_val": " UNION ALL ".join(
            f"SELECT dataset_id, geo_fips, '{p}' AS census_var, coalesce({p}, 0) / w AS dv, sqrt(coalesce({p}_margin, 0)) / w / 1.645 AS sd FROM {{dm_sum}} WHERE w > 0"
            for p in PERCENTS),
        "dm_stat": fm.stats_rows(stats, "0 AS z"),
        "dm_join": "SELECT v.*, s.value AS sv, s.value_margin AS sm, v.dv - s.value AS diff, sqrt(v.sd * v.sd + s.value_margin * s.value_margin) AS den"
                   " FROM {dm_val} v JOIN {dm_stat} s ON s.GEOID = v.geo_fips AND s.var = v.census_var",
    }
    text = (
        f"SELECT dataset_id, geo_fips, census_var, {r('dv', 'data_value')}, {r('sv', 'summary_value')}, {r('diff', 'diff_data_city')},"
        f" {r('CASE WHEN sm IS NOT NULL THEN sd END', 'data_value_sd')}, {r('sm', 'summary_value_margin')},"
        " coalesce(sm IS NOT NULL AND CASE WHEN den = 0 THEN diff <> 0 ELSE abs(diff / nullif(den, 0)) > 1.96 END, FALSE) AS sig_diff,"
        " CASE WHEN contains(census_var, '_pov_') THEN 'pov_pop' WHEN contains(census_var, '_under18_') THEN 'under18_pop' ELSE 'total_pop' END AS baseline_pop"
        " FROM {dm_join}"
    )
    return text, extra


@query(*_demo_sql("'1'", "{sv_us}"))
def demo_disparity(spark, sf):
    partials = weighted_partials(_tract_values(spark, sf).withColumn("geo_fips", F.lit("1")), ["dataset_id", "geo_fips"])
    values = partials_long(partials, ["dataset_id", "geo_fips"])
    return settle(demo_scores(values, _stats(survey(spark, sf, "us")), ["geo_fips"]).select(*_DEMO_COLS))


@query(*_demo_sql("substring(f.GEOID, 1, 2)", "{sv_state}"))
def demo_disparity_sub_area(spark, sf):
    """Every state with points, through county partials that add up."""
    counties = weighted_partials(_tract_values(spark, sf).withColumn("county", F.substring("GEOID", 1, 5)), ["dataset_id", "county"])
    states = merge_partials(counties.withColumn("geo_fips", F.substring("county", 1, 2)), ["dataset_id", "geo_fips"])
    values = partials_long(states.where("w > 0"), ["dataset_id", "geo_fips"])
    return settle(demo_scores(values, _stats(survey(spark, sf, "state")), ["geo_fips"]).select(*_DEMO_COLS))


@query("SELECT census_var AS c_var, dataset_id, " + r("diff_data_city", "d_score") + ", sig_diff AS s_diff, 'national' AS g, geo_fips AS g_fips, 'US' AS g_disp, baseline_pop AS b_pop, 'US' AS g_mo FROM {dm_out}",
       {**_demo_sql("'1'", "{sv_us}")[1], "dm_out": _demo_sql("'1'", "{sv_us}")[0]})
def minify_demographic(spark, sf):
    scored = demo_disparity(spark, sf).withColumns({"geo": F.lit("national"), "geo_display": F.lit("US"), "geo_mo": F.lit("US")})
    return settle(short_demo(scored))


@query("SELECT baseline_pop, count(*) AS n FROM (SELECT CASE WHEN contains(var, '_pov_') THEN 'pov_pop' WHEN contains(var, '_under18_') THEN 'under18_pop'"
       " ELSE 'total_pop' END AS baseline_pop FROM (" + fm.stats_rows("{sv_county}", "0 AS z") + ") x) y GROUP BY baseline_pop", EXTRA)
def population_bucket(spark, sf):
    long = bl.unpivot_pairs(survey(spark, sf, "county"), ["GEOID"], PERCENTS)
    return long.groupBy(baseline_population(F.col("var")).alias("baseline_pop")).agg(F.count("*").alias("n"))


# --- custom columns --------------------------------------------------------------

_COLUMNS = {"dogs": "dogs_moe", "cats": "cats_moe", "birds": None, "fish": None, "bees": "bees_moe"}


def custom_long(spark, sf):
    custom = cu.select_custom(view(spark, sf, "fx_custom"), "GEOID", _COLUMNS, "demographic").drop("cast_error")
    keep = ["GEOID", "num_pop", "num_pop_margin"]
    tracts = view(spark, sf, "fx_tract").select(*keep)
    total = view(spark, sf, "fx_us").select(F.col("num_pop").alias("total"))
    areas = tracts.withColumns({"dataset_id": F.lit("all"), "prop_pop": F.col("num_pop") / total.scalar()})
    return cu.attach_custom(areas, custom, _COLUMNS, "demographic")


_CU = {
    "cl": " UNION ALL ".join(
        f"SELECT t.GEOID, '{n}_demographic' AS var, c.{n} AS est, {'c.' + m if m else 'CAST(NULL AS DOUBLE)'} AS moe, {m is not None} AS has_moe,"
        f" t.num_pop AS pop, t.num_pop_margin AS pop_moe FROM {{fx_tract}} t LEFT JOIN {{fx_custom}} c ON c.GEOID = t.GEOID"
        for n, m in _COLUMNS.items()),
    "cp": "SELECT var, bool_or(has_moe) AS has_moe, avg(CASE WHEN est IS NULL THEN 1.0 ELSE 0.0 END) AS em, avg(CASE WHEN moe IS NULL THEN 1.0 ELSE 0.0 END) AS mm,"
          " avg(CASE WHEN coalesce(est, 0) > pop THEN 1.0 ELSE 0.0 END) AS sa, avg(CASE WHEN coalesce(est, 0) < 0 THEN 1.0 ELSE 0.0 END) AS sb,"
          " coalesce(bool_or(moe < 0), FALSE) AS neg FROM {cl} GROUP BY var",
    "cd": "SELECT *, em <= 0.5 AND sa <= 0.5 AND sb <= 0.5 AS kept, has_moe AND mm <= 0.5 AND NOT neg AS moe_kept FROM {cp}",
    "cc": "SELECT GEOID, var, pop, pop_moe, moe_kept, greatest(CASE WHEN coalesce(est, 0) > pop AND sa > 0 THEN pop ELSE coalesce(est, 0) END,"
          " CASE WHEN sb > 0 THEN 0.0 ELSE -1e300 END) AS est, CASE WHEN moe_kept THEN moe END AS moe FROM {cl} JOIN {cd} USING (var) WHERE kept",
    "ct": "SELECT var, sum(est) AS tot, sqrt(sum((moe / 1.645) * (moe / 1.645))) AS tse FROM {cc} GROUP BY var",
    "cx": "SELECT c.*, est / nullif(tot, 0) AS prop, est / nullif(pop, 0) * 100 AS pct,"
          f" {fm.ratio_se('est', 'tot', '(moe / 1.645)', 'tse')} AS prop_margin, {fm.ratio_se('est', 'pop', '(moe / 1.645)', '(pop_moe / 1.645)')} * 100 AS pct_margin"
          " FROM {cc} c JOIN {ct} USING (var)",
}


@query(f"SELECT var, has_moe, {r('em', 'est_missing')}, {r('mm', 'moe_missing')}, {r('sa', 'share_above')}, {r('sb', 'share_below')}, kept, moe_kept FROM {{cd}}", _CU)
def custom_missing_profile(spark, sf):
    return settle(cu.profile(custom_long(spark, sf)).select(
        "var", "has_moe", "est_missing", "moe_missing", "share_above", "share_below", "kept", "moe_kept"))


@query(f"SELECT GEOID, var, {r('est', 'est')}, {r('moe', 'moe')} FROM {{cc}}", _CU)
def custom_validity_clamp(spark, sf):
    long = custom_long(spark, sf)
    return settle(cu.clean_custom(long, cu.profile(long)).select("GEOID", "var", "est", "moe"))


def _derived(spark, sf):
    long = custom_long(spark, sf)
    return cu.add_pct_prop(cu.clean_custom(long, cu.profile(long)))


@query(f"SELECT GEOID, var, {r('prop', 'prop')}, {r('pct', 'pct')}, {r('prop_margin', 'prop_margin')}, {r('pct_margin', 'pct_margin')} FROM {{cx}}", _CU)
def custom_pct_prop(spark, sf):
    return settle(_derived(spark, sf).select("GEOID", "var", "prop", "pct", "prop_margin", "pct_margin"))


@query("SELECT var, " + r("value", "value") + ", " + r("CASE WHEN mk THEN CASE WHEN rad >= 0 THEN sqrt(rad) END / tp * 1.645 * 100 END", "value_margin")
       + " FROM (SELECT var, bool_or(moe_kept) AS mk, sum(pop / (SELECT num_pop FROM {fx_us}) * pct) AS value, sum(pop) AS tp,"
         " coalesce(sum((moe / 1.645) * (moe / 1.645)), 0) - (sum(est) / sum(pop)) * (sum(est) / sum(pop)) * sum((pop_moe / 1.645) * (pop_moe / 1.645)) AS rad"
         " FROM {cx} GROUP BY var) x", _CU)
def custom_area_value(spark, sf):
    return settle(cu.area_value(_derived(spark, sf)).drop("dataset_id"))


@query("SELECT 'demographic_dropped_cols_over_half_missing_values' AS warning, var AS column FROM {cd} WHERE em > 0.5 UNION ALL"
       " SELECT 'demographic_cols_any_missing_values', var FROM {cd} WHERE em > 0 UNION ALL"
       " SELECT 'demographic_cols_any_missing_values', var || '_margin' FROM {cd} WHERE mm > 0 AND has_moe UNION ALL"
       " SELECT 'demographic_dropped_over_half_values_greater_than_total_pop', var FROM {cd} WHERE em <= 0.5 AND sa > 0.5 UNION ALL"
       " SELECT 'demographic_values_greater_than_total_pop', var FROM {cd} WHERE em <= 0.5 AND sa > 0 UNION ALL"
       " SELECT 'demographic_values_negative', var FROM {cd} WHERE em <= 0.5 AND sb > 0 UNION ALL"
       " SELECT 'demographic_dropped_any_values_negative_margin', var || '_margin' FROM {cd} WHERE em <= 0.5 AND neg UNION ALL"
       " SELECT 'demographic_missing_moe_columns', var FROM {cd} WHERE kept AND NOT moe_kept UNION ALL"
       " SELECT 'demographic_float_values', var FROM {cl} JOIN {cd} USING (var) WHERE em <= 0.5 AND coalesce(est, 0) <> floor(coalesce(est, 0)) AND coalesce(est, 0) <= pop GROUP BY var UNION ALL"
       " SELECT 'demographic_float_values', var || '_margin' FROM {cl} JOIN {cd} USING (var) WHERE em <= 0.5 AND cd.has_moe AND mm <= 0.5 AND moe <> floor(moe) GROUP BY var", _CU)
def custom_warnings(spark, sf):
    return cu.warnings(cu.profile(custom_long(spark, sf)), "demographic").drop("dataset_id")
