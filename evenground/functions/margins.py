"""Margins of error and guarded arithmetic as SQL expression text.

The reference build derives hundreds of columns from the same few formulas.
As text, each is parsed by Spark in one call; built operator by operator from
Python it would take thousands of calls.  Arguments are column names or
expressions, results go into ``expr``/``selectExpr``.

Missing values are NULL throughout.  Nothing here can yield NaN or raise under
ANSI mode: divisions go through ``try_divide``, and ``root`` answers NULL for
a negative radicand.
"""

from __future__ import annotations

from collections.abc import Sequence

from evenground.catalogs import Z_90


def square(x: str) -> str:
    return f"(({x}) * ({x}))"


def root(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN sqrt({x}) END)"


def divide(num: str, denom: str) -> str:
    return f"try_divide({num}, {denom})"


def safe_divide(num: str, denom: str) -> str:
    """Missing stays missing, 0/0 is 0, x/0 is missing, else the ratio."""
    return f"(CASE WHEN {num} = 0 AND {denom} = 0 THEN 0D ELSE {divide(num, denom)} END)"


def moe_sum(estimates: Sequence[str], margins: Sequence[str]) -> str:
    """Margin of a sum over columns of one row.

    Root of the squared margins, where all zero estimates together count only
    with the largest of their margins.
    """
    pairs = list(zip(estimates, margins, strict=True))
    nonzero = " + ".join(f"if({e} = 0, 0D, {square(m)})" for e, m in pairs)
    zero = ", ".join(f"if({e} = 0, {m}, 0D)" for e, m in pairs)
    return f"sqrt({nonzero} + power(greatest({zero}, 0D), 2))"


def moe_sum_agg(estimate: str, margin: str) -> str:
    """The same margin for a sum over the rows of a group."""
    nonzero = f"coalesce(sum(CASE WHEN {estimate} != 0 THEN {square(margin)} END), 0D)"
    zero = f"coalesce(max(CASE WHEN {estimate} = 0 THEN {margin} END), 0D)"
    return f"sqrt({nonzero} + power({zero}, 2))"


def rss_agg(margin: str) -> str:
    """Plain root of summed squares over the rows of a group."""
    return f"sqrt(sum({square(margin)}))"


def moe_prop(num: str, denom: str, moe_num: str, moe_denom: str) -> str:
    """Margin of a proportion; falls back to the ratio form below zero."""
    scaled = f"{square(divide(num, denom))} * {square(moe_denom)}"
    radicand = (
        f"if({square(moe_num)} - {scaled} < 0, {square(moe_num)} + {scaled}, {square(moe_num)} - {scaled})"
    )
    return divide(f"sqrt({radicand})", denom)


def percent(num: str, denom: str) -> str:
    return f"bround({safe_divide(num, denom)} * 100, 3)"


def plain_percent(num: str, denom: str) -> str:
    """City percents are an unguarded ratio: 0/0 is missing."""
    return f"bround({divide(num, denom)} * 100, 3)"


def percent_margin(num: str, denom: str, moe_num: str, moe_denom: str) -> str:
    margin = f"bround({moe_prop(num, denom, moe_num, moe_denom)} * 100, 3)"
    return f"(CASE WHEN {num} = 0 AND {denom} = 0 THEN 0D ELSE {margin} END)"


def repaired_percent(value: str, num: str, denom: str) -> str:
    return f"(CASE WHEN {num} = 0 AND {denom} = 0 THEN 0D ELSE {value} END)"


def repaired_margin(margin: str, num: str, denom: str, moe_num: str, moe_denom: str) -> str:
    both_zero = f"{num} = 0 AND {denom} = 0"
    both_controlled = (
        f"{margin} IS NULL AND {moe_num} = 0 AND {moe_denom} = 0 AND {denom} != 0 AND {num} != 0"
    )
    return f"(CASE WHEN ({both_zero}) OR ({both_controlled}) THEN 0D ELSE {margin} END)"


def standard_error(margin: str) -> str:
    return f"({margin} / {Z_90}D)"


def ratio_se(x: str, y: str, se_x: str, se_y: str) -> str:
    """Standard error of x/y without fallback: negative radicand is missing."""
    return divide(root(f"({square(se_x)} - {square(divide(x, y))} * {square(se_y)})"), y)


def unpivot(rows: Sequence[Sequence[str]], names: Sequence[str]) -> str:
    """``stack`` of the given rows of expressions."""
    cells = ", ".join(cell for row in rows for cell in row)
    return f"stack({len(rows)}, {cells}) AS ({', '.join(names)})"
