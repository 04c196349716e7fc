"""Identifiers and display names as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evenground.catalogs import DC_NAMES, FIRST_TERRITORY, PLACE_SUFFIXES


def padded_id(c: Column, width: int) -> Column:
    """Left-pad with zeros; longer ids stay whole (plain ``lpad`` would cut)."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def state_of(geoid: Column) -> Column:
    return F.substring(geoid, 1, 2)


def county_of(geoid: Column) -> Column:
    return F.substring(geoid, 3, 3)


def in_states(state_code: Column) -> Column:
    """Keep the states and the district, drop the territories."""
    return state_code.try_cast("int") < FIRST_TERRITORY


def name_part(name: Column, year: str | int, part: int) -> Column:
    """Part of a tract name; the separator changed in 2022."""
    separator = "; " if str(year) == "2022" else ", "
    return F.try_element_at(F.split(name, separator), F.lit(part))


def before_comma(name: Column) -> Column:
    return F.regexp_replace(name, ",.*$", "")


def clean_place_name(name: Column) -> Column:
    for word in PLACE_SUFFIXES:
        name = F.regexp_replace(name, f"{word}(?!.*{word})", "")
    return F.trim(name)


def district_name(name: Column) -> Column:
    for plain, shown in DC_NAMES.items():
        name = F.when(name == plain, F.lit(shown)).otherwise(name)
    return name


def baseline_population(variable: Column) -> Column:
    return (
        F.when(variable.contains("_pov_"), F.lit("pov_pop"))
        .when(variable.contains("_under18_"), F.lit("under18_pop"))
        .otherwise(F.lit("total_pop"))
    )
