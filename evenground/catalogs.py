"""Variable names, survey codes and formula catalogs.

Everything in this module is a value that results depend on, written as plain
text.  The repetitive under-18 race tables are built from a rule.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# Geographic levels.
# level -> (unit of the demographic score, unit of the geographic score,
#           number of id characters of the geographic unit)
# --------------------------------------------------------------------------
LEVELS = {
    "national": ("tract", "state", 2),
    "state": ("tract", "county", 5),
    "county": ("tract", "tract", 11),
    "city": ("tract", "tract", 11),
}
NATION_GEOID = "1"
NATION_NAME = "the United States"
NATION_BBOX = (-179.148909, 18.9103648, -66.94989, 71.365162)
YEARS = ("2022", "2021", "2019")
DEFAULT_YEAR = "2022"

# Confidence factors of the survey handbook.
Z_90 = 1.645
Z_95 = 1.96

# A tract belongs to a city when more than 1 % is covered.
COVERED_SHARE = 0.01

# Cell texts that count as missing when a delimited file is read.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --------------------------------------------------------------------------
# The seven baselines of the geographic score.
# --------------------------------------------------------------------------
BASELINES = (
    "pop", "cb_renter_hh", "seniors", "no_internet", "under_200_poverty_line",
    "children", "pov",
)

# --------------------------------------------------------------------------
# Percents of the demographic score.
# --------------------------------------------------------------------------
PERCENTS = (
    # total population
    "pct_black", "pct_white", "pct_asian", "pct_hisp", "pct_all_other_races",
    "pct_children", "pct_seniors", "pct_veterans", "pct_no_internet",
    "pct_unins", "pct_disability", "pct_renters", "pct_limited_eng_hh",
    "pct_bach", "pct_under_poverty_line", "pct_under_200_poverty_line",
    "pct_cb_renter_hh", "pct_unemp", "pct_less_hs_diploma",
    # under 18
    "pct_under18_unins", "pct_under18_disability", "pct_under18_pov",
    "pct_under18_limited_eng_hh", "pct_under18_white_alone",
    "pct_under18_black_alone", "pct_under18_asian_alone", "pct_under18_hisp",
    "pct_under18_all_other_races_alone",
    # in poverty
    "pct_pov_children", "pct_pov_seniors", "pct_pov_white_alone",
    "pct_pov_black_alone", "pct_pov_asian_alone", "pct_pov_hisp",
    "pct_pov_all_other_races_alone", "pct_pov_bach", "pct_pov_less_than_hs",
    "pct_pov_unemployed", "pct_pov_veterans", "pct_pov_disability",
    "pct_pov_unins",
)

# Rule for the under-18 tables: table letter -> (name in the source columns,
# name of the derived sum).  Each has eight age-by-sex cells.
_UNDER18_TABLES = {
    "A": ("white_alone", "white_alone"),
    "B": ("black_alone", "black_alone"),
    "C": ("anai_alone", "anai_alone"),
    "D": ("asian_alone", "asian_alone"),
    "E": ("nhpi_alone", "nhpi_alone"),
    "F": ("other_alone", "other_alone"),
    "G": ("two_or_more_alone", "two_or_more_alone"),
    "H": ("white", "white"),
    "I": ("hispanic", "hisp"),
}
_AGES = ("under5", "5_9", "10_14", "15_17")
_SEX_FIRST_CELL = {"male": 3, "female": 18}


def _under18_cells(group: str) -> list[str]:
    return [f"num_{age}_{group}_{sex}" for sex in _SEX_FIRST_CELL for age in _AGES]


# --------------------------------------------------------------------------
# Sums.  Names holding "all_other_race" use earlier sums and
# therefore belong to the second phase.
# --------------------------------------------------------------------------
SUMS = {
    "num_under18_disability": ["num_under18_one_disability", "num_under18_two_or_more_disability"],
    "num_under18_pov": ["num_under18_pov_under_6", "num_under18_pov_6_11", "num_under18_pov_12_17"],
    **{f"num_under18_{total}": _under18_cells(cells) for cells, total in _UNDER18_TABLES.values()},
    "num_less_than_hs": ["num_less_than_9th_grade", "num_9th_to_12th_grade"],
    "num_pov_disability": [
        "num_pov_disability_under_18", "num_pov_disability_18_64", "num_pov_disability_65_over",
    ],
    "num_pov_veterans": ["num_pov_veteran_18_64", "num_pov_veteran_65_over"],
    "num_pov_civ_18_older": [
        "num_pov_veteran_18_64", "num_pov_nonveteran_18_64",
        "num_pov_veteran_65_over", "num_pov_nonveteran_65_over",
    ],
}
SUMS_OF_SUMS = {
    "num_under18_all_other_races_alone": [
        "num_under18_other_alone", "num_under18_nhpi_alone",
        "num_under18_anai_alone", "num_under18_two_or_more_alone",
    ],
    "num_pov_all_other_races_alone": [
        "num_pov_other_alone", "num_pov_nhpi_alone", "num_pov_anai_alone", "num_pov_two_or_more",
    ],
    "num_all_other_races": ["num_other", "num_anai", "num_nhpi", "num_two_or_more"],
}

# --------------------------------------------------------------------------
# Derived percents as (percent, numerator, denominator).
# --------------------------------------------------------------------------
_DERIVED_ALL_LEVELS = (
    ("pct_no_internet", "num_no_internet", "num_hhs"),
    ("pct_under_200_poverty_line", "num_under_200_poverty_line", "num_pov_calc_pop"),
    ("pct_all_other_races", "num_all_other_races", "num_pop"),
    ("pct_less_hs_diploma", "num_less_than_hs", "num_25_older"),
    ("pct_under18_unins", "num_under19_unins", "num_under19_noninst"),
    ("pct_under18_pov", "num_under18_pov", "num_under18_pov_pop"),
    ("pct_under18_disability", "num_under18_disability", "num_under18_noninst"),
    ("pct_under18_white_alone", "num_under18_white_alone", "num_children"),
    ("pct_under18_black_alone", "num_under18_black_alone", "num_children"),
    ("pct_under18_asian_alone", "num_under18_asian_alone", "num_children"),
    ("pct_under18_hisp", "num_under18_hisp", "num_children"),
    ("pct_under18_all_other_races_alone", "num_under18_all_other_races_alone", "num_children"),
    ("pct_under18_limited_eng_hh", "num_5_17_limited_eng_hh", "num_5_17_in_hh"),
    ("pct_pov_children", "num_pov_children", "num_pov"),
    ("pct_pov_seniors", "num_pov_over65", "num_pov"),
    ("pct_pov_white_alone", "num_pov_white_alone", "num_pov"),
    ("pct_pov_black_alone", "num_pov_black_alone", "num_pov"),
    ("pct_pov_asian_alone", "num_pov_asian_alone", "num_pov"),
    ("pct_pov_hisp", "num_pov_hisp", "num_pov"),
    ("pct_pov_bach", "num_pov_bach", "num_pov_over_25"),
    ("pct_pov_less_than_hs", "num_pov_less_than_hs", "num_pov_over_25"),
    ("pct_pov_unemployed", "num_pov_unemployed", "num_pov_civ_labor_force"),
    ("pct_pov_veterans", "num_pov_veterans", "num_pov_civ_18_older"),
    ("pct_pov_disability", "num_pov_disability", "num_pov_noninst_pop"),
    ("pct_pov_unins", "num_pov_unins", "num_pov_noninst_pop"),
    ("pct_pov_all_other_races_alone", "num_pov_all_other_races_alone", "num_pov"),
)
_DERIVED_SURVEY_ONLY = (
    ("pct_under18_anai_alone", "num_under18_anai_alone", "num_children"),
    ("pct_under18_nhpi_alone", "num_under18_nhpi_alone", "num_children"),
    ("pct_under18_other_alone", "num_under18_other_alone", "num_children"),
    ("pct_under18_two_or_more_alone", "num_under18_two_or_more_alone", "num_children"),
    ("pct_under18_white", "num_under18_white", "num_children"),
    ("pct_pov_anai_alone", "num_pov_anai_alone", "num_pov"),
    ("pct_pov_nhpi_alone", "num_pov_nhpi_alone", "num_pov"),
    ("pct_pov_other_alone", "num_pov_other_alone", "num_pov"),
    ("pct_pov_two_or_more", "num_pov_two_or_more", "num_pov"),
    ("pct_pov_white", "num_pov_white", "num_pov"),
)
# reported by the survey itself; repaired in place at survey levels and
# recomputed at city level
REPORTED_PERCENTS = (
    ("pct_white", "num_white", "num_pop"),
    ("pct_black", "num_black", "num_pop"),
    ("pct_asian", "num_asian", "num_pop"),
    ("pct_hisp", "num_hisp", "num_pop"),
    ("pct_children", "num_children", "num_pop"),
    ("pct_veterans", "num_veterans", "num_civ_pop_18_older"),
    ("pct_seniors", "num_seniors", "num_pop"),
    ("pct_bach", "num_bach", "num_25_older"),
    ("pct_unemp", "num_unemp", "num_civ_pop_in_labor_force"),
    ("pct_unins", "num_unins", "num_noninst_pop"),
    ("pct_disability", "num_disability", "num_noninst_pop"),
    ("pct_renters", "num_renters", "num_hhs"),
    ("pct_under_poverty_line", "num_pov", "num_pov_calc_pop"),
    ("pct_cb_renter_hh", "num_cb_renter_hh", "num_renter_hh"),
    ("pct_limited_eng_hh", "num_limited_eng_hh", "num_hhs"),
)
DERIVED_PERCENTS = _DERIVED_ALL_LEVELS + _DERIVED_SURVEY_ONLY
CITY_PERCENTS = _DERIVED_ALL_LEVELS + REPORTED_PERCENTS

# --------------------------------------------------------------------------
# Survey codes for 2019, 2021 and 2022 (clean name, code).
# --------------------------------------------------------------------------
_TOTAL_CODES = """
num_no_internet B28002_013
num_hhs DP02_0001
num_25_older DP02_0059
num_bach DP02_0065
pct_bach DP02_0065P
num_civ_pop_18_older DP02_0069
num_veterans DP02_0070
pct_veterans DP02_0070P
num_disability DP02_0072
pct_disability DP02_0072P
num_16_older DP03_0001
num_civ_pop_in_labor_force DP03_0003
num_unemp DP03_0005
pct_unemp DP03_0009P
num_noninst_pop DP03_0095
num_unins DP03_0099
pct_unins DP03_0099P
num_occ_units DP04_0045
num_renters DP04_0047
pct_renters DP04_0047P
num_renter_hh DP04_0136
num_cb_renter_hh DP04_0142
pct_cb_renter_hh DP04_0142P
num_pop DP05_0001
num_under_5 DP05_0005
num_children DP05_0019
pct_children DP05_0019P
num_seniors DP05_0024
pct_seniors DP05_0024P
num_hisp DP05_0071
pct_hisp DP05_0071P
num_white DP05_0077
pct_white DP05_0077P
num_black DP05_0078
pct_black DP05_0078P
num_anai DP05_0079
num_asian DP05_0080
pct_asian DP05_0080P
num_nhpi DP05_0081
num_other DP05_0082
num_two_or_more DP05_0083
num_limited_eng_hh S1602_C03_001
pct_limited_eng_hh S1602_C04_001
num_pov_calc_pop S1701_C01_001
num_under_200_poverty_line S1701_C01_042
num_pov S1701_C02_001
pct_under_poverty_line S1701_C03_001
num_less_than_9th_grade DP02_0060
num_9th_to_12th_grade DP02_0061
"""
_UNDER18_CODES = """
num_children DP05_0019
num_under19_noninst B27010_002
num_under19_unins B27010_017
num_under18_noninst C18108_002
num_under18_one_disability C18108_003
num_under18_two_or_more_disability C18108_004
num_under18_pov_under_6 B17020_003
num_under18_pov_6_11 B17020_004
num_under18_pov_12_17 B17020_005
num_under18_pov_pop S1701_C01_002
num_5_17_limited_eng_hh B16003_002
num_5_17_in_hh B16004_002
"""
_POVERTY_CODES = """
num_pov S1701_C02_001
num_pov_children S1701_C02_002
num_pov_over65 S1701_C02_010
num_pov_white_alone S1701_C02_013
num_pov_black_alone S1701_C02_014
num_pov_asian_alone S1701_C02_016
num_pov_anai_alone S1701_C02_015
num_pov_nhpi_alone S1701_C02_017
num_pov_other_alone S1701_C02_018
num_pov_two_or_more S1701_C02_019
num_pov_hisp S1701_C02_020
num_pov_white S1701_C02_021
num_pov_male S1701_C02_011
num_pov_female S1701_C02_012
num_pov_over_25 S1701_C02_022
num_pov_bach S1701_C02_026
num_pov_less_than_hs S1701_C02_023
num_pov_civ_labor_force S1701_C02_027
num_pov_unemployed S1701_C02_031
num_pov_noninst_pop S2701_C01_061
num_pov_disability_under_18 C18130_004
num_pov_no_disability_under_18 C18130_007
num_pov_disability_18_64 C18130_011
num_pov_no_disability_18_64 C18130_014
num_pov_disability_65_over C18130_018
num_pov_no_disability_65_over C18130_021
num_pov_noninst_pop S2701_C01_061
num_pov_unins S2701_C04_061
num_pov_veteran_18_64 C21007_004
num_pov_nonveteran_18_64 C21007_011
num_pov_veteran_65_over C21007_019
num_pov_nonveteran_65_over C21007_026
"""


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(line.split()) for line in text.strip().splitlines()]


# --------------------------------------------------------------------------
# Codes of the 2018 survey where it differs, variables that only
# its catalog names, and later variables that it lacks.
# --------------------------------------------------------------------------
_CODES_2018 = """
num_25_older DP02_0058
num_bach DP02_0064
pct_bach DP02_0064P
num_hs_or_higher DP02_0066
pct_hs_or_higher DP02_0066P
num_civ_pop_18_older DP02_0068
num_veterans DP02_0069
pct_veterans DP02_0069P
num_disability DP02_0071
pct_disability DP02_0071P
num_under18_occ_units_owners B25012_003
num_under18_occ_units_renters B25012_011
num_pov_foreign_born B17025_006
"""
_NOT_IN_2018 = ("num_civ_pop_in_labor_force", "num_less_than_9th_grade", "num_9th_to_12th_grade")
CATALOG_YEARS = ("2022", "2021", "2019", "2018")


def variable_codes(year: str = DEFAULT_YEAR) -> dict[str, str]:
    """Clean name -> survey code of a year's catalog (distinct names)."""
    if str(year) not in CATALOG_YEARS:
        raise ValueError(f"no variable catalog for {year}")
    cells = [
        (f"num_{age}_{group}_{sex}", f"B01001{letter}_{first + i:03d}")
        for letter, (group, _) in _UNDER18_TABLES.items()
        for sex, first in _SEX_FIRST_CELL.items()
        for i, age in enumerate(_AGES)
    ]
    codes = dict(_pairs(_TOTAL_CODES) + _pairs(_UNDER18_CODES) + cells + _pairs(_POVERTY_CODES))
    if str(year) == "2018":
        codes = {n: c for n, c in codes.items() if n not in _NOT_IN_2018} | dict(_pairs(_CODES_2018))
    return codes


# --------------------------------------------------------------------------
# Short column names of the compact result document.
# --------------------------------------------------------------------------
SHORT_BASELINE = {
    "pop": "pop", "cb_renter_hh": "cbr", "seniors": "sen", "no_internet": "int",
    "under_200_poverty_line": "pov2", "children": "chi", "pov": "pov",
}
SHORT_GEO = {
    "disp_name": "m_disp",
    "data_prop": "da_prop",
    "GEOID": "num_geoid",
    **{f"diff_{k}": f"d_{v}" for k, v in SHORT_BASELINE.items()},
    **{f"prop_{k}": f"p_{v}" for k, v in SHORT_BASELINE.items()},
    **{f"sig_diff_{k}": f"s_{v}" for k, v in SHORT_BASELINE.items()},
}
SHORT_DEMO = {
    "census_var": "c_var", "diff_data_city": "d_score", "sig_diff": "s_diff",
    "geo": "g", "geo_fips": "g_fips", "geo_display": "g_disp",
    "baseline_pop": "b_pop", "geo_mo": "g_mo",
}

# Words removed from place names, in this order, last match only.
PLACE_SUFFIXES = (
    "city", "CDP", "town", "village", r"\(balance\)", "unified government",
    "consolidated government", "metropolitan government", "metro government",
    "urban county", "municipality",
)

# District shown with an article; its city file is its county.
DC_STATE = "11"
DC_COUNTY = "11001"
DC_CITY = "1150000"
DC_NAMES = {
    "District of Columbia": "the District of Columbia",
    "District of Columbia, DC": "the District of Columbia, DC",
}
DC_CITY_NAME = "Washington, DC"

# Two Louisville parts form one place.
MERGED_PLACES = {"2148000": ("2148000", "2148006"), "2148006": ("2148000", "2148006")}

# The county whose tracts lost values in two survey years.
REPAIRED_COUNTY = "35039"
REPAIRED_YEARS = ("2017", "2018")

# Fixed value: first territory code.
FIRST_TERRITORY = 57

# Fixed value: population a place needs to become a city area.
BIG_PLACE_POPULATION = 50000
