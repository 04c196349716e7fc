"""Planar geometry on array columns.

A polygon is ``rings: array<array<struct<x,y>>>`` with parts and holes
flattened (even-odd rule).  Work happens on ``edges``, an array of
``struct<x1,y1,x2,y2>``: the even-odd test needs the edges only, in any order,
which is what lets the spatial index keep just the edges one cell needs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RING_TYPE = "array<array<struct<x:double,y:double>>>"


def box_rings(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Rectangle as one counter-clockwise ring."""
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    ring = F.array(*[F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")) for x, y in corners])
    return F.array(ring)


def _ring_edges(ring: Column) -> Column:
    following = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.filter(
        F.zip_with(
            ring,
            following,
            lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")),
        ),
        lambda e: (e.x1 != e.x2) | (e.y1 != e.y2),
    )


def edges(rings: Column) -> Column:
    """All edges of all rings; closed and open rings give the same edges."""
    return F.flatten(F.transform(rings, _ring_edges))


def bounds(edge_array: Column) -> list[Column]:
    """xmin, ymin, xmax, ymax of an edge array."""

    def pick(best, first: str, second: str) -> Column:
        each = F.transform(edge_array, lambda e: best[0](e[first], e[second]))
        return best[1](each)

    low, high = (F.least, F.array_min), (F.greatest, F.array_max)
    return [
        pick(low, "x1", "x2").alias("xmin"),
        pick(low, "y1", "y2").alias("ymin"),
        pick(high, "x1", "x2").alias("xmax"),
        pick(high, "y1", "y2").alias("ymax"),
    ]


def with_bounds(rings: Column) -> Column:
    """Array of one struct ``edges, xmin, ymin, xmax, ymax``, for ``inline``.

    The lambda binds the edges once; plain columns would be expanded into
    every place that uses them.
    """
    return F.transform(F.array(edges(rings)), lambda e: F.struct(e.alias("edges"), *bounds(e)))


_ON_EDGE = 1 << 20


def edge_turn(x1: Column, y1: Column, x2: Column, y2: Column, x: Column, y: Column) -> Column:
    """Positive left of the edge, negative right of it, zero on its line."""
    return (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)


def strictly_inside(edge_array: Column, x: Column, y: Column) -> Column:
    """Even-odd test; a point on an edge or vertex is not inside.

    One pass: each edge adds one per crossing of the ray to the right, and a
    large even number when the point lies on it.
    """

    def step(total: Column, e: Column) -> Column:
        above = (e.y1 > y) & (e.y2 > y)
        below = (e.y1 < y) & (e.y2 < y)
        left = (e.x1 < x) & (e.x2 < x)
        turn = edge_turn(e.x1, e.y1, e.x2, e.y2, x, y)
        # with the edge neither above, below nor left of the point, zero turn
        # means that it lies on the edge, unless the edge is all to the right
        touches = (turn == 0) & ((e.x1 <= x) | (e.x2 <= x))
        crosses = ((e.y1 > y) != (e.y2 > y)) & ((turn > 0) == (e.y2 > e.y1))
        return total + F.when(above | below | left, F.lit(0)).when(touches, F.lit(_ON_EDGE)).when(
            crosses, F.lit(1)
        ).otherwise(F.lit(0))

    return F.aggregate(edge_array, F.lit(0), step, lambda t: (t < _ON_EDGE) & (t % 2 == 1))


def separates(e: Column, x: Column, y: Column, to_x: Column, to_y: Column) -> Column:
    """1 when the edge separates a point from another place, 0 when not, and a
    large negative number when the point lies on the edge.

    The line between the two crosses the edge when both ends of each lie on
    different sides of the other; a zero counts as the right side, for an end
    that two edges share as for the place.
    """
    turn = edge_turn(e.x1, e.y1, e.x2, e.y2, x, y)
    within = x.between(F.least(e.x1, e.x2), F.greatest(e.x1, e.x2)) & y.between(F.least(e.y1, e.y2), F.greatest(e.y1, e.y2))
    apart = (turn > 0) != (edge_turn(e.x1, e.y1, e.x2, e.y2, to_x, to_y) > 0)
    split = (edge_turn(x, y, to_x, to_y, e.x1, e.y1) > 0) != (edge_turn(x, y, to_x, to_y, e.x2, e.y2) > 0)
    return F.when((turn == 0) & within, F.lit(-_ON_EDGE)).when(apart & split, F.lit(1)).otherwise(F.lit(0))


def signed_ring_area(ring: Column) -> Column:
    return F.aggregate(
        _ring_edges(ring), F.lit(0.0), lambda s, e: s + (e.x1 * e.y2 - e.x2 * e.y1) / 2
    )


def area(rings: Column) -> Column:
    """Area of normalised rings: outer and hole rings turn opposite ways."""
    return F.abs(F.aggregate(rings, F.lit(0.0), lambda s, r: s + signed_ring_area(r)))


def normalised(parts: Column) -> Column:
    """``array<array<ring>>`` of parts -> flat rings, outer rings turning
    counter-clockwise and holes clockwise."""

    def turned(ring: Column, i: Column) -> Column:
        wanted = F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.when(signed_ring_area(ring) * wanted < 0, F.reverse(ring)).otherwise(ring)

    return F.flatten(F.transform(parts, lambda part: F.transform(part, turned)))


# North America equal-area conic on the GRS80 ellipsoid.
_A = 6378137.0
_INV_F = 298.257222101
_LAT1, _LAT2, _LAT0, _LON0 = 20.0, 60.0, 40.0, -96.0
_E2 = 2 / _INV_F - 1 / _INV_F**2
_E = math.sqrt(_E2)


def _q(sin_phi, log):
    return (1 - _E2) * (
        sin_phi / (1 - _E2 * sin_phi * sin_phi)
        - log((1 - _E * sin_phi) / (1 + _E * sin_phi)) / (2 * _E)
    )


def _cone() -> tuple[float, float, float]:
    def m2(lat: float) -> float:
        s = math.sin(math.radians(lat))
        return math.cos(math.radians(lat)) ** 2 / (1 - _E2 * s * s)

    q = {lat: _q(math.sin(math.radians(lat)), math.log) for lat in (_LAT1, _LAT2, _LAT0)}
    n = (m2(_LAT1) - m2(_LAT2)) / (q[_LAT2] - q[_LAT1])
    c = m2(_LAT1) + n * q[_LAT1]
    return n, c, _A * math.sqrt(c - n * q[_LAT0]) / n


def equal_area(rings: Column) -> Column:
    """Longitude/latitude rings -> metres on the equal-area conic."""
    n, c, rho0 = _cone()

    def project(p: Column) -> Column:
        rho = _A * F.sqrt(c - n * _q(F.sin(F.radians(p.y)), F.log)) / n
        theta = n * F.radians(p.x - _LON0)
        return F.struct((rho * F.sin(theta)).alias("x"), (rho0 - rho * F.cos(theta)).alias("y"))

    return F.transform(rings, lambda ring: F.transform(ring, project))


def bad_polygon(rings: Column) -> Column:
    """Name of the first defect of a polygon, NULL when there is none."""
    return (
        F.when(rings.isNull() | (F.size(rings) == 0), F.lit("empty"))
        .when(F.exists(rings, lambda r: F.size(_ring_edges(r)) < 3), F.lit("too_few_points"))
        .when(area(rings) == 0, F.lit("zero_area"))
    )
