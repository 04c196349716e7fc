"""Reference build: survey columns, derived sums and percents, proportions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenground.catalogs import (
    BASELINES, BIG_PLACE_POPULATION, CITY_PERCENTS, DC_CITY, DC_CITY_NAME, DC_COUNTY, DC_NAMES, DC_STATE,
    DERIVED_PERCENTS, MERGED_PLACES, NATION_GEOID, PERCENTS, REPAIRED_COUNTY, REPAIRED_YEARS,
    REPORTED_PERCENTS, SUMS, SUMS_OF_SUMS, variable_codes,
)
from evenground.functions.margins import (
    moe_prop, moe_sum, moe_sum_agg, percent, percent_margin, plain_percent, repaired_margin,
    repaired_percent, rss_agg, safe_divide, unpivot,
)
from evenground.functions.names import (
    before_comma, clean_place_name, county_of, district_name, in_states, name_part, state_of,
)
from evenground.operators.overlay import covered_tracts, dissolve


def with_margins(names: Iterable[str]) -> list[str]:
    return [c for n in names for c in (n, f"{n}_margin")]


def unpivot_pairs(df: DataFrame, keys: Iterable[str], names: Iterable[str]) -> DataFrame:
    """Wide ``v, v_margin`` columns -> rows ``var, value, value_margin``."""
    rows = [(f"'{n}'", f"CAST({n} AS DOUBLE)", f"CAST({n}_margin AS DOUBLE)") for n in names]
    return df.selectExpr(*keys, unpivot(rows, ("var", "value", "value_margin")))


def derive(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """Add or replace columns given as expression text, in one projection."""
    kept = [f"`{c}`" for c in df.columns if c not in new]
    return df.selectExpr(*kept, *[f"{e} AS `{n}`" for n, e in new.items()])


# --- survey tables ---------------------------------------------------------


def rename_survey(landing: DataFrame, codes: Mapping[str, str], keep: Iterable[str] = ("GEOID", "NAME")) -> DataFrame:
    """Landing columns ``<code>E``/``<code>M`` -> clean names with margins."""
    return landing.selectExpr(
        *keep,
        *[
            f"CAST(`{code}{kind}` AS DOUBLE) AS {name}{suffix}"
            for name, code in codes.items()
            for kind, suffix in (("E", ""), ("M", "_margin"))
        ],
    )


def _survey_numbers(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith(("num_", "pct_"))]


def repair_county(df: DataFrame, year: str) -> DataFrame:
    """Two survey years lost values of one county: they become 0."""
    if str(year) not in REPAIRED_YEARS:
        return df
    repaired = f"GEOID LIKE '{REPAIRED_COUNTY}%'"
    return derive(df, {c: f"if({repaired}, coalesce({c}, 0D), {c})" for c in _survey_numbers(df)})


def tract_columns(df: DataFrame, year: str) -> DataFrame:
    name = F.col("NAME")
    return df.withColumns(
        {
            "state_fips": state_of(F.col("GEOID")),
            "county_fips": county_of(F.col("GEOID")),
            "tract_name": name_part(name, year, 1),
            "county_name": name_part(name, year, 2),
        }
    )


def missing_margin_profile(df: DataFrame) -> DataFrame:
    """Missing values per ``num_`` column, most first."""
    names = ["GEOID", *[c for c in df.columns if c.startswith("num_")]]
    counts = df.agg(*[F.expr(f"count_if({c} IS NULL) AS {c}") for c in names])
    return counts.selectExpr(unpivot([(f"'{c}'", c) for c in names], ("var", "value"))).orderBy(
        F.desc("value"), "var"
    )


def estimates_with_missing(profile: DataFrame) -> DataFrame:
    """Check: only margins may be missing.  Empty when the check holds."""
    return profile.where((F.col("value") > 0) & ~F.col("var").endswith("_margin"))


def fill_controlled(df: DataFrame) -> DataFrame:
    """A missing margin belongs to a controlled estimate: it is 0."""
    return df.na.fill(0.0, [c for c in df.columns if c.startswith("num_")])


def add_sums(df: DataFrame) -> DataFrame:
    """Derived sums with margins, in two phases: the second uses the first."""
    for phase in (SUMS, SUMS_OF_SUMS):
        new = {}
        for name, parts in phase.items():
            new[name] = " + ".join(parts)
            new[f"{name}_margin"] = moe_sum(parts, [f"{p}_margin" for p in parts])
        df = derive(df, new)
    return df


def _ratio_args(num: str, denom: str) -> tuple[str, str, str, str]:
    return num, denom, f"{num}_margin", f"{denom}_margin"


def add_percents(df: DataFrame, definitions=DERIVED_PERCENTS, reported=REPORTED_PERCENTS) -> DataFrame:
    """Derived percents, and repairs of percents the survey reports."""
    new = {}
    for name, num, denom in definitions:
        args = _ratio_args(num, denom)
        new[name] = percent(*args[:2])
        new[f"{name}_margin"] = percent_margin(*args)
    for name, num, denom in reported:
        args = _ratio_args(num, denom)
        new[name] = repaired_percent(name, *args[:2])
        new[f"{name}_margin"] = repaired_margin(f"{name}_margin", *args)
    return derive(df, new)


def percents_out_of_range(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Check: percents lie in 0..100.  Empty when the check holds."""
    return (
        unpivot_pairs(df, ["GEOID"], names)
        .where(~F.col("value").between(0, 100))
        .select("GEOID", "var", "value")
    )


def survey_level(landing: DataFrame, codes: Mapping[str, str], level: str, year: str,
                 keep: Iterable[str] = ("GEOID", "NAME")) -> DataFrame:
    """Clean survey table of one level; one projection, no shuffle."""
    df = rename_survey(landing, codes, keep)
    if level != "us":
        df = df.where(in_states(state_of(F.col("GEOID"))))
    if level == "tract":
        df = tract_columns(repair_county(df, year), year)
    # what a year's catalog doesn't name is missing, and so is what needs it
    lacking = [n for n in variable_codes() if n not in codes]
    df = fill_controlled(df).selectExpr("*", *[f"CAST(NULL AS DOUBLE) AS {n}{m}" for n in lacking for m in ("", "_margin")])
    return add_percents(add_sums(df))


# --- display names ---------------------------------------------------------


def display_names(df: DataFrame, level: str, states: DataFrame, year: str) -> DataFrame:
    """Add ``disp_name`` and ``disp_name_abbv``.

    ``states`` (state_code, state_abbv, state_name) has one row per state,
    below 57 of them, and is therefore broadcast.
    """
    if level == "us":
        return df.withColumns({"disp_name": F.lit("US"), "disp_name_abbv": F.lit("US")})
    if level == "tract":
        return df.withColumns({"disp_name": name_part(F.col("NAME"), year, 1), "disp_name_abbv": F.lit("")})
    known = states.select("state_code", "state_abbv")
    joined = df.withColumn("state_code", state_of(F.col("GEOID"))).join(known, "state_code", "left")
    if level == "state":
        return joined.withColumns({"disp_name": F.col("NAME"), "disp_name_abbv": F.col("state_abbv")}).drop(
            "state_abbv", "state_code"
        )
    county = before_comma(F.col("NAME"))
    return joined.withColumns(
        {"disp_name": F.concat_ws(", ", county, "state_abbv"), "disp_name_abbv": county}
    ).drop("state_abbv", "state_code")


# --- baseline proportions --------------------------------------------------


def add_proportions(numerators: DataFrame, denominators: DataFrame, baselines=BASELINES) -> DataFrame:
    """Share of each area in its denominator area, with margins.

    ``numerators`` carries ``denom_geoid``; ``denominators`` is keyed by GEOID.
    Spark broadcasts the denominators when their size allows it.
    """
    names = with_margins(f"num_{b}" for b in baselines)
    denom = denominators.selectExpr("GEOID AS denom_geoid", *[f"{n} AS d_{n}" for n in names])
    joined = numerators.join(denom, "denom_geoid", "left")
    new = {}
    for b in baselines:
        num, d = f"num_{b}", f"d_num_{b}"
        new[f"prop_{b}"] = safe_divide(num, d)
        new[f"prop_{b}_margin"] = moe_prop(num, d, f"{num}_margin", f"{d}_margin")
    return derive(joined, new).drop(*[f"d_{n}" for n in names])


def by_prefix(areas: DataFrame, length: int) -> DataFrame:
    return areas.withColumn("denom_geoid", F.substring("GEOID", 1, length))


def of_nation(areas: DataFrame) -> DataFrame:
    return areas.withColumn("denom_geoid", F.lit(NATION_GEOID))


def prop_sum_violations(props: DataFrame, keys: Iterable[str] = ("denom_geoid",), baselines=BASELINES) -> DataFrame:
    """Check: proportions of one denominator sum to 1 (or to 0).

    Empty when the check holds.
    """
    keys = list(keys)
    sums = props.groupBy(*keys).agg(*[F.sum(f"prop_{b}").alias(f"prop_{b}") for b in baselines])
    rows = [(f"'prop_{b}'", f"prop_{b}") for b in baselines]
    # summing in another order moves the last digits, hence 1e-9 on both sides
    return sums.selectExpr(*keys, unpivot(rows, ("var", "value"))).where(
        "(value > 0 AND value < 1 - 1e-9) OR value > 1 + 1e-9"
    )


def precomputed_stats(df: DataFrame, percents=PERCENTS) -> DataFrame:
    """Long area-wide values: GEOID, names, var, value, value_margin."""
    long = unpivot_pairs(df, ["GEOID", "disp_name", "disp_name_abbv"], percents)
    return long.withColumn("disp_name", district_name(F.col("disp_name")))


# --- areas and cities ------------------------------------------------------


def area_names(df: DataFrame, level: str, states: DataFrame) -> DataFrame:
    """(GEOID, cleaned_name) of counties or states."""
    if level == "state":
        return df.select("GEOID", district_name(F.col("NAME")).alias("cleaned_name"))
    known = states.select("state_code", "state_abbv")
    return (
        df.withColumn("state_code", state_of(F.col("GEOID")))
        .join(known, "state_code", "left")
        .select("GEOID", F.concat_ws(", ", district_name(before_comma(F.col("NAME"))), "state_abbv").alias("cleaned_name"))
    )


def merge_places(places: DataFrame, **measures: Callable[[Column], Column]) -> DataFrame:
    """Places that are recorded in parts get the shape of all their parts.

    ``measures`` are further columns, functions of the shape.  They are taken
    once of a merged shape, not of each part that gets it, and who reads only
    these does not carry the shape to every part.
    """
    groups = F.create_map(*[F.lit(x) for k, v in MERGED_PLACES.items() for x in (k, "+".join(v))])
    keyed = places.withColumn("shape_id", F.coalesce(groups[F.col("GEOID")], F.col("GEOID")))
    shapes = dissolve(keyed.where(F.col("GEOID").isin(*MERGED_PLACES)).select("shape_id", "rings"), "shape_id").select(
        "shape_id", F.col("rings").alias("all_rings"), F.lit(True).alias("merged_"), *[f(F.col("rings")).alias(f"all_{n}") for n, f in measures.items()])
    whole = keyed.join(shapes, "shape_id", "left")
    taken = {n: F.when(F.col("merged_"), F.col(f"all_{n}")).otherwise(f(F.col("rings"))) for n, f in measures.items()}
    return whole.withColumns({"rings": F.coalesce("all_rings", "rings"), **taken}).drop("all_rings", "shape_id", "merged_", *[f"all_{n}" for n in measures])


def big_places(places: DataFrame, populations: DataFrame, states: DataFrame,
               at_least: int = BIG_PLACE_POPULATION) -> DataFrame:
    """Places with enough people: (GEOID, cleaned_name, rings).

    ``places`` (GEOID, NAMELSAD, rings), ``populations`` (GEOID, estimate).
    """
    big = populations.where((F.col("estimate") >= at_least) & in_states(state_of(F.col("GEOID")))).select("GEOID")
    known = states.select("state_code", "state_abbv")
    return (
        merge_places(places).join(big, "GEOID", "left_semi")
        .withColumn("state_code", state_of(F.col("GEOID")))
        .join(known, "state_code", "left")
        .select("GEOID", F.concat_ws(", ", clean_place_name(F.col("NAMELSAD")), "state_abbv").alias("cleaned_name"), "rings")
    )


def city_stats(city_tracts: DataFrame, definitions=CITY_PERCENTS, baselines=BASELINES) -> DataFrame:
    """Sums, margins and percents per place: one grouped aggregate.

    ``city_tracts`` holds one row per tract and place with survey columns.
    """
    parts = sorted({n for _, num, denom in definitions for n in (num, denom)})
    aggregates = []
    for n in parts:
        aggregates += [f"sum({n}) AS {n}", f"{rss_agg(f'{n}_margin')} AS {n}_margin"]
    for b in baselines:
        margin = moe_sum_agg(f"num_{b}", f"num_{b}_margin")
        aggregates += [f"sum(num_{b}) AS total_{b}", f"{margin} AS total_{b}_margin"]
    sums = city_tracts.groupBy("place_geoid").agg(*map(F.expr, aggregates))
    new = []
    for name, num, denom in definitions:
        args = _ratio_args(num, denom)
        new += [f"{plain_percent(*args[:2])} AS {name}", f"{percent_margin(*args)} AS {name}_margin"]
    totals = [f"total_{b}{s} AS num_{b}{s}" for b in baselines for s in ("", "_margin")]
    return sums.selectExpr("place_geoid AS GEOID", *new, *totals)


def city_tables(tracts: DataFrame, tract_shapes: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """City build for all states at once: (tract rows per city, stats).

    ``tracts`` is a named survey table, ``tract_shapes`` (GEOID, rings) and
    ``places`` (place_geoid, cleaned_name, rings) are in an equal-area plane.
    Whole tract counts are used for every tract that passes the area rule.
    The district is left to its county.
    """
    not_dc = state_of(F.col("place_geoid")) != DC_STATE
    cover = covered_tracts(tract_shapes, places.where(not_dc)).where(
        state_of(F.col("GEOID")) == state_of(F.col("place_geoid"))
    )
    members = tracts.join(cover, "GEOID")
    stats_wide = city_stats(members)
    rows = add_proportions(members.withColumn("denom_geoid", F.col("place_geoid")), stats_wide)
    names = places.select(F.col("place_geoid").alias("GEOID"), F.col("cleaned_name").alias("disp_name"))
    stats = precomputed_stats(
        stats_wide.join(names, "GEOID", "left").withColumn("disp_name_abbv", F.lit("")),
        [name for name, _, _ in CITY_PERCENTS],
    )
    return rows.drop("place_geoid", "covered_share"), stats


def district_city(county_rows: DataFrame, county_stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The district's county stands in for its city, under the city's id."""
    rows = county_rows.where(F.col("denom_geoid") == DC_COUNTY).withColumn("denom_geoid", F.lit(DC_CITY))
    shown = DC_NAMES["District of Columbia, DC"]
    stats = county_stats.where(F.col("GEOID") == DC_COUNTY).withColumns(
        {
            "GEOID": F.lit(DC_CITY),
            "disp_name": F.when(F.col("disp_name") == shown, F.lit(DC_CITY_NAME)).otherwise(F.col("disp_name")),
        }
    )
    return rows, stats
