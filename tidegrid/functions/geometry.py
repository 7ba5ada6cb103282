"""Points and rings as plain columns, in fragments of Spark SQL text.

A point is two doubles (``lon``, ``lat``). An area is a closed ring,
``array<struct<x: double, y: double>>``, first vertex repeated at the end. An area with holes or of several parts
has its rings one after the other in the same array, with a break between two: a null element before a hole of
the part at hand, an element without coordinates before the outer ring of the next part.
Work on areas goes through their edges, ``array<struct<x1, y1, x2, y2>>``; a break has none, and what is inside
is told by even-odd over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from tidegrid.functions import geodesy

CRS = "EPSG:4326"
RING_TYPE = "array<struct<x:double,y:double>>"


def make_point(x: str, y: str) -> str:
    return f"struct(CAST({x} AS DOUBLE) AS x, CAST({y} AS DOUBLE) AS y)"


def point_x(point: str) -> str:
    return f"({point}).x"


def point_y(point: str) -> str:
    return f"({point}).y"


def ring_of(vertices: Sequence[tuple[str | float, str | float]]) -> str:
    """A ring from vertex pairs; SQL fragments or plain numbers."""
    return "array(" + ", ".join(make_point(str(x), str(y)) for x, y in vertices) + ")"


def edges_of(ring: str) -> str:
    count = f"greatest(size({ring}) - 1, 0)"
    return f"""filter(zip_with(slice({ring}, 1, {count}), slice({ring}, 2, {count}),
        (a, b) -> struct(a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2)),
        e -> NOT (e.x1 IS NULL AND e.y1 IS NULL OR e.x2 IS NULL AND e.y2 IS NULL))"""


HOLE_BREAK = "CAST(NULL AS struct<x:double,y:double>)"
PART_BREAK = "CAST(struct(NULL AS x, NULL AS y) AS struct<x:double,y:double>)"


def rings_of(ring: str) -> str:
    """The rings of an area in order: ``array<struct<part, shell, ring>>``, parts from 0."""
    breaks = f"""filter(sequence(0, greatest(size({ring}) - 1, 0)), i -> {ring}[i] IS NULL
        OR {ring}[i].x IS NULL AND {ring}[i].y IS NULL)"""
    spans = f"zip_with(concat(array(-1), at), concat(at, array(size({ring}))), (a, b) -> struct(a, b))"
    parts = f"CAST(size(filter(at, i -> i <= s.a AND {ring}[i] IS NOT NULL)) AS INT)"
    return geodesy.let("at", breaks, f"""transform({spans}, s -> struct({parts} AS part,
        s.a < 0 OR {ring}[s.a] IS NOT NULL AS shell, slice({ring}, s.a + 2, s.b - s.a - 1) AS ring))""")


def has_breaks(ring: str) -> str:
    return f"exists({ring}, v -> v IS NULL OR v.x IS NULL AND v.y IS NULL)"


def first_vertices(ring: str) -> str:
    """The first vertex of every ring of an area."""
    return f"""filter(transform({ring}, (v, i) -> CASE WHEN i = 0 OR {ring}[greatest(i - 1, 0)].x IS NULL THEN v END),
        v -> v.x IS NOT NULL)"""


def ring_bounds(ring: str) -> str:
    xs, ys = f"transform({ring}, v -> v.x)", f"transform({ring}, v -> v.y)"
    return (
        f"struct(array_min({xs}) AS xmin, array_min({ys}) AS ymin, "
        f"array_max({xs}) AS xmax, array_max({ys}) AS ymax)"
    )


def turn(a: tuple[str, str], b: tuple[str, str], p: tuple[str, str]) -> str:
    """Positive when p lies left of a→b, negative when right, 0 on the line."""
    (ax, ay), (bx, by), (px, py) = a, b, p
    return f"(({bx} - {ax}) * ({py} - {ay}) - ({px} - {ax}) * ({by} - {ay}))"


def edges_contain(edges: str, x: str, y: str) -> str:
    """True for a point strictly inside: even-odd over the edges, on-edge excluded."""
    side = turn(("g.x1", "g.y1"), ("g.x2", "g.y2"), (x, y))
    return f"""(aggregate({edges}, 0, (s, g) -> CASE
        WHEN s < 0 OR (g.y1 > {y} AND g.y2 > {y}) OR (g.y1 < {y} AND g.y2 < {y}) THEN s
        WHEN ((g.x1 <= {x} AND {x} <= g.x2) OR (g.x2 <= {x} AND {x} <= g.x1)) AND {side} = 0 THEN -1
        WHEN (g.y1 > {y}) <> (g.y2 > {y}) AND (g.y2 > g.y1) = ({side} > 0) THEN 1 - s
        ELSE s END) = 1)"""


def ring_contains(ring: str, x: str, y: str) -> str:
    return edges_contain(edges_of(ring), x, y)


def edges_distance(edges: str, x: str, y: str) -> str:
    """Metres from a point to an area; 0 inside and on the boundary."""
    metres = geodesy.let(
        "q", geodesy.nearest_on_edges(edges, x, y), geodesy.point_metres(x, y, "q.qx", "q.qy")
    )
    return f"(CASE WHEN {edges_contain(edges, x, y)} THEN 0D ELSE {metres} END)"


def ring_distance(ring: str, x: str, y: str) -> str:
    return geodesy.let("ring_edges", edges_of(ring), edges_distance("ring_edges", x, y))


def ring_moments(ring: str, origin: str | None = None) -> str:
    """Shoelace sums of one ring about ``origin`` (its first vertex): ``struct(a2, mx, my)``."""
    o = origin or f"{ring}[0]"
    near = f"""transform({edges_of(ring)}, e -> struct(
        e.x1 - {o}.x AS x1, e.y1 - {o}.y AS y1,
        e.x2 - {o}.x AS x2, e.y2 - {o}.y AS y2))"""
    weighted = f"transform({near}, e -> struct(e.x1 + e.x2 AS sx, e.y1 + e.y2 AS sy, e.x1 * e.y2 - e.x2 * e.y1 AS w))"
    return f"""aggregate({weighted}, struct(0D AS a2, 0D AS mx, 0D AS my),
        (m, e) -> struct(m.a2 + e.w AS a2, m.mx + e.sx * e.w AS mx, m.my + e.sy * e.w AS my))"""


def area_moments(ring: str) -> str:
    """Shoelace sums of an area about its first vertex: outer rings count, holes count against, whichever way they turn."""
    each = f"""transform({rings_of(ring)}, r -> transform(array({ring_moments('r.ring', f'{ring}[0]')}),
        m -> struct(m, signum(m.a2) * CASE WHEN r.shell THEN 1 ELSE -1 END AS s))[0])"""
    summed = f"""aggregate({each}, struct(0D AS a2, 0D AS mx, 0D AS my), (t, q) -> struct(
        t.a2 + q.s * q.m.a2 AS a2, t.mx + q.s * q.m.mx AS mx, t.my + q.s * q.m.my AS my))"""
    return f"(CASE WHEN {has_breaks(ring)} THEN {summed} ELSE {ring_moments(ring)} END)"


def ring_area(ring: str) -> str:
    """Planar area in square degrees, unsigned."""
    return f"(abs({area_moments(ring)}.a2) / 2D)"


def ring_centroid(ring: str) -> str:
    """Area-weighted centroid, ``struct(x, y)``; null coordinates for an area of nothing."""
    return geodesy.let(
        "moments",
        area_moments(ring),
        f"struct({ring}[0].x + moments.mx / nullif(moments.a2 * 3D, 0D) AS x, "
        f"{ring}[0].y + moments.my / nullif(moments.a2 * 3D, 0D) AS y)",
    )


def point_problem(lon: str, lat: str) -> str:
    """Why a point cannot be used, or null."""
    return f"""(CASE WHEN {lon} IS NULL OR {lat} IS NULL OR isnan({lon}) OR isnan({lat}) THEN 'missing'
        WHEN abs({lon}) > 180 OR abs({lat}) > 90 THEN 'out_of_range' END)"""


def point_is_valid(lon: str, lat: str) -> str:
    return f"({point_problem(lon, lat)} IS NULL)"


def ring_problem(ring: str) -> str:
    """What the rings of an area show one by one: any flaw but intersections and misplaced rings, or null."""
    rings = geodesy.let("rings", rings_of(ring), f"""CASE
        WHEN exists(rings, r -> size(r.ring) < 4) THEN 'too_few_vertices'
        WHEN exists(rings, r -> r.ring[0].x <> element_at(r.ring, -1).x OR r.ring[0].y <> element_at(r.ring, -1).y) THEN 'not_closed'
        WHEN exists(rings, r -> {ring_moments('r.ring')}.a2 = 0) THEN 'zero_area' END""")
    return f"""(CASE
        WHEN {ring} IS NULL OR size({ring}) = 0 THEN 'missing'
        WHEN exists({ring}, v -> (v.x IS NULL) <> (v.y IS NULL) OR isnan(v.x) OR isnan(v.y)) THEN 'missing'
        WHEN exists({ring}, v -> abs(v.x) > 180 OR abs(v.y) > 90) THEN 'out_of_range'
        ELSE {rings} END)"""


def segments_touch(a: str, b: str) -> str:
    """True when two segments (structs x1, y1, x2, y2) share at least one point."""
    a1, a2 = (f"{a}.x1", f"{a}.y1"), (f"{a}.x2", f"{a}.y2")
    b1, b2 = (f"{b}.x1", f"{b}.y1"), (f"{b}.x2", f"{b}.y2")
    boxes_meet = " AND ".join(
        f"least({p}.{c}1, {p}.{c}2) <= greatest({q}.{c}1, {q}.{c}2)"
        for c in "xy" for p, q in ((a, b), (b, a))
    )
    return (
        f"({boxes_meet} AND signum({turn(a1, a2, b1)}) * signum({turn(a1, a2, b2)}) <= 0 "
        f"AND signum({turn(b1, b2, a1)}) * signum({turn(b1, b2, a2)}) <= 0)"
    )


def segments_cross(a: str, b: str) -> str:
    """True when two segments cross, or run along each other, rather than touch in one point."""
    a1, a2 = (f"{a}.x1", f"{a}.y1"), (f"{a}.x2", f"{a}.y2")
    b1, b2 = (f"{b}.x1", f"{b}.y1"), (f"{b}.x2", f"{b}.y2")
    along = " OR ".join(
        f"greatest(least({a}.{c}1, {a}.{c}2), least({b}.{c}1, {b}.{c}2)) < "
        f"least(greatest({a}.{c}1, {a}.{c}2), greatest({b}.{c}1, {b}.{c}2))"
        for c in "xy"
    )
    return (
        f"({segments_touch(a, b)} AND "
        f"(signum({turn(a1, a2, b1)}) * signum({turn(a1, a2, b2)}) < 0 AND signum({turn(b1, b2, a1)}) * signum({turn(b1, b2, a2)}) < 0 "
        f"OR {turn(a1, a2, b1)} = 0 AND {turn(a1, a2, b2)} = 0 AND ({along})))"
    )


def folds_back(a: str, b: str) -> str:
    """True when b, starting where a ends, runs back over a."""
    straight = turn((f"{a}.x1", f"{a}.y1"), (f"{a}.x2", f"{a}.y2"), (f"{b}.x2", f"{b}.y2"))
    dot = f"(({a}.x2 - {a}.x1) * ({b}.x2 - {b}.x1) + ({a}.y2 - {a}.y1) * ({b}.y2 - {b}.y1))"
    return f"({straight} = 0 AND {dot} < 0)"
