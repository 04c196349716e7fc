"""The statistical formulas as SQL text, for the checks only."""

from __future__ import annotations

from evenground.catalogs import BASELINES, CITY_PERCENTS, DERIVED_PERCENTS, PERCENTS, REPORTED_PERCENTS, SUMS, SUMS_OF_SUMS
from workload.views import codes


def safe_divide(n: str, d: str) -> str:
    return f"(CASE WHEN {n} = 0 AND {d} = 0 THEN 0.0 ELSE {n} / nullif({d}, 0) END)"


def moe_prop(n: str, d: str, mn: str, md: str) -> str:
    first, second = f"({mn} * {mn})", f"({n} / nullif({d}, 0)) * ({n} / nullif({d}, 0)) * ({md} * {md})"
    return (
        f"(CASE WHEN {first} - {second} < 0 THEN sqrt({first} + {second})"
        f" WHEN {first} - {second} >= 0 THEN sqrt({first} - {second}) END / nullif({d}, 0))"
    )


def ratio_se(x: str, y: str, sx: str, sy: str) -> str:
    radicand = f"({sx} * {sx} - ({x} / nullif({y}, 0)) * ({x} / nullif({y}, 0)) * {sy} * {sy})"
    return f"(CASE WHEN {radicand} >= 0 THEN sqrt({radicand}) END / nullif({y}, 0))"


def percent(n: str, d: str) -> str:
    return f"round_even({safe_divide(n, d)} * 100, 3)"


def percent_margin(n: str, d: str, mn: str, md: str) -> str:
    return f"(CASE WHEN {n} = 0 AND {d} = 0 THEN 0.0 ELSE round_even({moe_prop(n, d, mn, md)} * 100, 3) END)"


def _m(*names: str) -> list[str]:
    return [f"{n}_margin" for n in names]


def _sums(phase: dict[str, list[str]]) -> str:
    out = []
    for name, parts in phase.items():
        nonzero = " + ".join(f"(CASE WHEN {p} = 0 THEN 0.0 ELSE {p}_margin * {p}_margin END)" for p in parts)
        zero = ", ".join(f"CASE WHEN {p} = 0 THEN {p}_margin ELSE 0.0 END" for p in parts)
        out += [f"{' + '.join(parts)} AS {name}", f"sqrt({nonzero} + pow(greatest({zero}), 2)) AS {name}_margin"]
    return ", ".join(out)


def _percents() -> str:
    out = []
    for name, n, d in DERIVED_PERCENTS:
        out += [f"{percent(n, d)} AS {name}", f"{percent_margin(n, d, *_m(n, d))} AS {name}_margin"]
    return ", ".join(out)


def _repairs() -> str:
    out = []
    for name, n, d in REPORTED_PERCENTS:
        zero = f"{n} = 0 AND {d} = 0"
        out.append(f"CASE WHEN {zero} THEN 0.0 ELSE {name} END AS {name}")
        out.append(
            f"CASE WHEN ({zero}) OR ({name}_margin IS NULL AND {n}_margin = 0 AND {d}_margin = 0"
            f" AND {n} <> 0 AND {d} <> 0) THEN 0.0 ELSE {name}_margin END AS {name}_margin"
        )
    return ", ".join(out)


def _level(level: str) -> dict[str, str]:
    renamed = []
    for name, code in codes().items():
        for kind, suffix in (("E", ""), ("M", "_margin")):
            c = f'"{code}{kind}"'
            renamed.append(f"{'coalesce(' + c + ', 0.0)' if name.startswith('num_') else c} AS {name}{suffix}")
    replaced = ", ".join(x for name, _, _ in REPORTED_PERCENTS for x in (name, f"{name}_margin"))
    return {
        f"sv_{level}_a": f"SELECT GEOID, NAME, {', '.join(renamed)} FROM {{fx_landing_{level}}}",
        f"sv_{level}_b": f"SELECT *, {_sums(SUMS)} FROM {{sv_{level}_a}}",
        f"sv_{level}_c": f"SELECT *, {_sums(SUMS_OF_SUMS)} FROM {{sv_{level}_b}}",
        f"sv_{level}": f"SELECT * EXCLUDE ({replaced}), {_percents()}, {_repairs()} FROM {{sv_{level}_c}}",
    }


def _pair(area: str, denom: str, key: str) -> str:
    """Baseline rows of one level pair."""
    cols = []
    for b in BASELINES:
        args = (f"a.num_{b}", f"d.num_{b}", f"a.num_{b}_margin", f"d.num_{b}_margin")
        cols += [
            f"{args[0]} AS num_{b}", f"{args[2]} AS num_{b}_margin",
            f"{safe_divide(*args[:2])} AS prop_{b}", f"{moe_prop(*args)} AS prop_{b}_margin",
        ]
    percents = ", ".join(f"a.{p}, a.{p}_margin" for p in PERCENTS)
    return (
        f"SELECT a.GEOID, a.NAME, {key} AS denom_geoid, {', '.join(cols)}, {percents}"
        f" FROM {area} a LEFT JOIN {denom} d ON {key} = d.GEOID"
    )


def _rect(a: str, b: str) -> str:
    width = f"greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0))"
    height = f"greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0))"
    return f"{width} * {height} / (({a}.x1 - {a}.x0) * ({a}.y1 - {a}.y0))"


def _city_stats() -> str:
    parts = sorted({x for _, n, d in CITY_PERCENTS for x in (n, d)})
    inner = ", ".join(f"sum({p}) AS {p}, sqrt(sum({p}_margin * {p}_margin)) AS {p}_margin" for p in parts)
    totals = ", ".join(
        f"sum(num_{b}) AS total_{b}, sqrt(coalesce(sum(CASE WHEN num_{b} <> 0 THEN num_{b}_margin * num_{b}_margin END), 0)"
        f" + pow(coalesce(max(CASE WHEN num_{b} = 0 THEN num_{b}_margin END), 0), 2)) AS total_{b}_margin"
        for b in BASELINES
    )
    out = []
    for name, n, d in CITY_PERCENTS:
        out += [
            f"round_even({n} / nullif({d}, 0) * 100, 3) AS {name}",
            f"{percent_margin(n, d, *_m(n, d))} AS {name}_margin",
        ]
    tot = ", ".join(f"total_{b} AS num_{b}, total_{b}_margin AS num_{b}_margin" for b in BASELINES)
    return (
        f"SELECT place_geoid AS GEOID, {', '.join(out)}, {tot} FROM"
        f" (SELECT place_geoid, {inner}, {totals} FROM {{city_member}} GROUP BY place_geoid) g"
    )


def _strict(p: str, t: str) -> str:
    return f"{p}.lon > {t}.x0 AND {p}.lon < {t}.x1 AND {p}.lat > {t}.y0 AND {p}.lat < {t}.y1"


EXTRA: dict[str, str] = {
    "fx_usable": "SELECT dataset_id, lon, lat, weight FROM {fx_point} WHERE weight IS NOT NULL AND weight <> 0",
    "fx_hit": f"SELECT p.*, t.GEOID FROM {{fx_usable}} p LEFT JOIN {{fx_square}} t ON {_strict('p', 't')}",
    "fx_count": "SELECT dataset_id, GEOID, sum(weight) AS weighted_counts, count(*) AS n FROM {fx_hit}"
                " WHERE GEOID IS NOT NULL GROUP BY dataset_id, GEOID",
    **_level("tract"), **_level("county"), **_level("state"), **_level("us"),
    "pair_us_state": _pair("{sv_state}", "{sv_us}", "'1'"),
    "pair_us_tract": _pair("{sv_tract}", "{sv_us}", "'1'"),
    "pair_state_county": _pair("{sv_county}", "{sv_state}", "substring(a.GEOID, 1, 2)"),
    "pair_state_tract": _pair("{sv_tract}", "{sv_state}", "substring(a.GEOID, 1, 2)"),
    "pair_county_tract": _pair("{sv_tract}", "{sv_county}", "substring(a.GEOID, 1, 5)"),
    "fx_cover": f"SELECT t.GEOID, p.place_geoid, {_rect('t', 'p')} AS covered_share"
                f" FROM {{fx_square}} t JOIN {{fx_place}} p ON {_rect('t', 'p')} > 0.01",
    "city_member": "SELECT s.*, c.place_geoid FROM {sv_tract} s JOIN {fx_cover} c ON s.GEOID = c.GEOID"
                   " WHERE substring(c.GEOID, 1, 2) = substring(c.place_geoid, 1, 2)"
                   " AND substring(c.place_geoid, 1, 2) <> '11'",
    "city_stats": _city_stats(),
    "pair_city_tract": _pair("{city_member}", "{city_stats}", "a.place_geoid"),
    "base_all": " UNION ALL ".join(
        f"SELECT '{g}' AS denom_geo, '{u}' AS num_geo, p.* FROM {{{v}}} p"
        for g, u, v in (
            ("national", "state", "pair_us_state"), ("national", "tract", "pair_us_tract"),
            ("state", "county", "pair_state_county"), ("state", "tract", "pair_state_tract"),
            ("county", "tract", "pair_county_tract"), ("city", "tract", "pair_city_tract"),
        )
    ),
}


def stats_rows(source: str, names: str, percents=PERCENTS) -> str:
    """Long area-wide values of one table."""
    return " UNION ALL ".join(
        f"SELECT GEOID, {names}, '{p}' AS var, {p} AS value, {p}_margin AS value_margin FROM {source}"
        for p in percents
    )
