"""Input views derived from the given tables.

One SQL text per view serves both engines: table and view names stand in
braces.  Regions act as states, nations as counties and suppliers as tracts on
a grid of one-degree squares; every line item is a point near its tract.
"""

from __future__ import annotations

import re
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from evenground.catalogs import BASELINES, variable_codes

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

_MEASURES = {
    "pop": "1",
    "cb_renter_hh": "CASE WHEN l_tax >= 0.05 THEN 1 ELSE 0 END",
    "seniors": "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END",
    "no_internet": "CASE WHEN l_discount >= 0.05 THEN 1 ELSE 0 END",
    "under_200_poverty_line": "CASE WHEN l_quantity <= 20 THEN 1 ELSE 0 END",
    "children": "CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END",
    "pov": "CASE WHEN l_quantity <= 10 THEN 1 ELSE 0 END",
}
_SUMS = ",\n".join(f"CAST(sum({e}) AS DOUBLE) AS num_{n}" for n, e in _MEASURES.items())
_MARGINS = ",\n".join(
    f"sqrt(a.num_{n}) AS num_{n}_margin" if n != "pop"
    else "CASE WHEN s.k % 7 = 0 THEN NULL ELSE sqrt(a.num_pop) END AS num_pop_margin"
    for n in BASELINES
)
_ROLLED = ",\n".join(
    f"sum(num_{n}) AS num_{n}, sqrt(sum(pow(coalesce(num_{n}_margin, 0), 2))) AS num_{n}_margin" for n in BASELINES
)

VIEWS: dict[str, str] = {
    # areas with their squares
    "fx_square": """
SELECT lpad(CAST(n.n_regionkey + 1 AS STRING), 2, '0') || lpad(CAST(n.n_nationkey + 1 AS STRING), 3, '0')
         || lpad(CAST(s.s_suppkey + 1 AS STRING), 6, '0') AS GEOID,
       'Census Tract ' || CAST(s.s_suppkey + 1 AS STRING) AS disp_name,
       'Census Tract ' || CAST(s.s_suppkey + 1 AS STRING) || '; ' || n.n_name || '; ' || r.r_name AS NAME,
       s.s_suppkey AS k,
       CAST(-125 + s.s_suppkey % 40 AS DOUBLE) AS x0, CAST(-124 + s.s_suppkey % 40 AS DOUBLE) AS x1,
       CAST(25 + floor(s.s_suppkey / 40.0) AS DOUBLE) AS y0, CAST(26 + floor(s.s_suppkey / 40.0) AS DOUBLE) AS y1
FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    # areas with counts and margins
    "fx_tract": f"""
SELECT s.*, {", ".join(f"a.num_{n}" for n in BASELINES)}, {_MARGINS}
FROM {{fx_square}} s
JOIN (SELECT l_suppkey, {_SUMS} FROM {{lineitem}} GROUP BY l_suppkey) a ON a.l_suppkey = s.k""",
    # one point per line item
    "fx_point": """
SELECT l_orderkey, l_linenumber, l_returnflag AS dataset_id,
       (-12500 + 100 * (l_suppkey % 40) + (l_orderkey * 37 + l_linenumber * 11) % 121 - 10) / CAST(100 AS DOUBLE) AS lon,
       (2500 + 100 * floor(l_suppkey / 40.0) + (l_partkey * 53 + l_linenumber * 7) % 121 - 10) / CAST(100 AS DOUBLE) AS lat,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_orderkey % 89 = 0 THEN CAST(0 AS DOUBLE) ELSE l_extendedprice END AS weight,
       l_returnflag, l_linestatus, l_quantity, l_discount, l_shipdate
FROM {lineitem}""",
    # the same points with gaps, as text, the way an uploaded file arrives
    "fx_upload": """
SELECT dataset_id,
       CASE WHEN l_orderkey % 101 = 0 THEN 'NA' ELSE CAST(lon AS STRING) END AS lon,
       CASE WHEN l_orderkey % 103 = 0 THEN '' ELSE CAST(lat AS STRING) END AS lat,
       CASE WHEN weight IS NULL THEN 'n/a' ELSE CAST(weight AS STRING) END AS weight,
       CASE WHEN l_linenumber % 7 = 3 AND l_orderkey % 5 = 0 THEN 'NULL' ELSE CAST(l_quantity AS STRING) END AS quantity,
       CASE WHEN l_orderkey % 107 = 0 THEN '#N/A' ELSE l_linestatus END AS status,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS shipdate
FROM {fx_point}""",
    "fx_county": f"SELECT substring(GEOID, 1, 5) AS GEOID, {_ROLLED} FROM {{fx_tract}} GROUP BY substring(GEOID, 1, 5)",
    "fx_state": f"SELECT substring(GEOID, 1, 2) AS GEOID, {_ROLLED} FROM {{fx_tract}} GROUP BY substring(GEOID, 1, 2)",
    "fx_us": f"SELECT '1' AS GEOID, {_ROLLED} FROM {{fx_tract}}",
    # city rectangles across tracts, one per ten suppliers
    "fx_place": """
SELECT lpad(CAST(CAST(k AS INT) % 5 + 1 AS STRING), 2, '0') || lpad(CAST(CAST(k AS INT) AS STRING), 5, '0') AS place_geoid,
       'Place ' || CAST(CAST(k AS INT) AS STRING) || ' city' AS namelsad, n_suppliers,
       CAST(-125 + 10 * (k % 4) + 0.5 AS DOUBLE) AS x0, CAST(-125 + 10 * (k % 4) + 10.005 AS DOUBLE) AS x1,
       CAST(25 + floor(k / 4) + 0.25 AS DOUBLE) AS y0, CAST(25 + floor(k / 4) + 2.005 AS DOUBLE) AS y1
FROM (SELECT floor(s_suppkey / 10.0) AS k, count(*) AS n_suppliers FROM {supplier} GROUP BY floor(s_suppkey / 10.0)) g""",
    # user columns with missing, too large, negative and fractional values
    "fx_custom": """
SELECT GEOID, CASE WHEN k % 5 = 0 THEN NULL ELSE num_pov END AS dogs, sqrt(num_pov) AS dogs_moe,
       CASE WHEN k % 4 = 0 THEN num_pop + 10 WHEN k % 9 = 0 THEN CAST(-1 AS DOUBLE) ELSE num_children + 0.5 END AS cats,
       CASE WHEN k = 3 THEN CAST(-1 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS cats_moe,
       CASE WHEN k % 3 = 0 THEN num_pop ELSE NULL END AS birds,
       num_seniors AS fish,
       CASE WHEN k % 2 = 0 OR k % 5 = 1 THEN num_pop + 1 ELSE num_pov END AS bees, sqrt(num_pov) AS bees_moe
FROM {fx_tract}""",
    "fx_states": """
SELECT lpad(CAST(r_regionkey + 1 AS STRING), 2, '0') AS state_code, substring(r_name, 1, 2) AS state_abbv, r_name AS state_name,
       CASE WHEN r_regionkey % 2 = 0 THEN 'East' ELSE 'West' END AS region_name
FROM {region}""",
    "fx_regions": "SELECT state_name AS disp_name, region_name FROM {fx_states}",
}


def _survey_columns() -> list[tuple[str, str, int]]:
    return [(name, code, i) for i, (name, code) in enumerate(variable_codes().items())]


def _landing_tract() -> str:
    """Survey landing columns by a rule on the tract number and count."""
    out = []
    for name, code, i in _survey_columns():
        if name.startswith("pct_"):
            est = f"CASE WHEN (k + {i}) % 17 = 0 THEN NULL ELSE CAST((k * 7 + {i * 31}) % 1000 AS DOUBLE) / 10 END"
            moe = f"CASE WHEN (k + {i}) % 5 = 0 THEN NULL ELSE CAST((k * 3 + {i}) % 90 AS DOUBLE) / 10 END"
        elif name == "num_pop":
            est, moe = "num_pop", "num_pop_margin"
        else:
            share = (i * 37) % 55 + 5
            est = (
                f"CASE WHEN k % 29 = 0 OR (k + {i}) % 13 = 0 THEN CAST(0 AS DOUBLE)"
                f" ELSE CAST(floor(num_pop * {share} / 100.0) AS DOUBLE) END"
            )
            moe = f"CASE WHEN (k * 3 + {i}) % 11 = 0 THEN NULL ELSE CAST(floor(sqrt(num_pop)) + {i % 7} AS DOUBLE) END"
        out += [f'{est} AS "{code}E"', f'{moe} AS "{code}M"']
    return "SELECT GEOID, NAME, " + ",\n".join(out) + " FROM {fx_tract}"


def _landing_upper(length: int) -> str:
    key = f"substring(GEOID, 1, {length})" if length else "'1'"
    out = []
    for name, code, _ in _survey_columns():
        if name.startswith("pct_"):
            out += [f'max("{code}E") AS "{code}E"', f'max("{code}M") AS "{code}M"']
        else:
            out += [
                f'sum("{code}E") AS "{code}E"',
                f'CASE WHEN count("{code}M") * 2 < count(*) THEN NULL ELSE sqrt(sum(pow(coalesce("{code}M", 0), 2))) END AS "{code}M"',
            ]
    name = {
        5: "max(split_part(NAME, '; ', 2)) || ', ' || max(split_part(NAME, '; ', 3))",
        2: "max(split_part(NAME, '; ', 3))",
        0: "'United States'",
    }[length]
    group = f" GROUP BY {key}" if length else ""
    return f"SELECT {key} AS GEOID, {name} AS NAME, " + ",\n".join(out) + " FROM {fx_landing_tract}" + group


VIEWS["fx_landing_tract"] = _landing_tract()
VIEWS["fx_landing_county"] = _landing_upper(5)
VIEWS["fx_landing_state"] = _landing_upper(2)
VIEWS["fx_landing_us"] = _landing_upper(0)

_NAME = re.compile(r"\{(\w+)\}")


def names_in(text: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(text)))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or a view derived from given tables, as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name]
    inputs = {n: view(spark, sf_dir, n) for n in names_in(text)}
    # double quotes name columns in the shared text
    return spark.sql(text.replace('"', "`"), **inputs)


def sql(text: str, extra: dict[str, str] | None = None) -> str:
    """Shared text -> one statement with the views it needs in front."""
    known = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(t: str) -> None:
        for n in names_in(t):
            if n in known and n not in order:
                visit(known[n])
                order.append(n)

    visit(text)
    plain = lambda t: _NAME.sub(lambda m: m.group(1), t)
    # many statements read a view several times
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({plain(known[n])})" for n in order)
    return (f"WITH {ctes}\n" if ctes else "") + plain(text)


@cache
def codes() -> dict[str, str]:
    return variable_codes()
