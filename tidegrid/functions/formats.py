"""Text and binary exchange forms: WKT, GeoJSON, WKB.

As in the rest of the package, SQL text in and out; only the two WKB encoders are Arrow
UDFs over whole batches, as Spark has no built-in that turns a double into its bytes.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidegrid.functions.geodesy import let
from tidegrid.functions.geometry import HOLE_BREAK, PART_BREAK, RING_TYPE, has_breaks, rings_of

_NUMBER = r"[-+]?(?:\\d+\\.?\\d*|\\.\\d+)(?:[eE][-+]?\\d+)?"


# --- WKT ---------------------------------------------------------------------


def number_text(value: str) -> str:
    """Plain decimal text without trailing zeros, e.g. ``-51.3`` or ``-30``."""
    return f"regexp_replace(CAST(CAST({value} AS DECIMAL(38, 15)) AS STRING), '\\\\.?0+$', '')"


def point_wkt(lon: str, lat: str) -> str:
    return f"('POINT(' || {number_text(lon)} || ' ' || {number_text(lat)} || ')')"


def _joined(ring: str, text: str, opening: str, hole: str, part: str, closing: str) -> str:
    """The rings of an area as text: each ring ``r.ring`` by ``text``, with what stands before a hole or a part."""
    each = f"""transform(rings, (r, i) -> CASE WHEN i = 0 THEN '' WHEN r.shell THEN '{part}' ELSE '{hole}' END || {text})"""
    return let("rings", rings_of(ring), f"'{opening}' || array_join({each}, '') || '{closing}'")


def ring_wkt(ring: str) -> str:
    """``POLYGON``, or ``MULTIPOLYGON`` for an area of several parts."""
    def pairs(of: str) -> str:
        return f"array_join(transform({of}, v -> {number_text('v.x')} || ' ' || {number_text('v.y')}), ',')"

    parts = f"exists({ring}, v -> v IS NOT NULL AND v.x IS NULL AND v.y IS NULL)"
    many = _joined(ring, pairs("r.ring"), "((", "),(", ")),((", "))")
    return (
        f"(CASE WHEN {ring} IS NULL THEN NULL WHEN NOT {has_breaks(ring)} THEN 'POLYGON((' || {pairs(ring)} || '))' "
        f"WHEN {parts} THEN 'MULTIPOLYGON(' || {many} || ')' ELSE 'POLYGON' || {many} END)"
    )


def box_wkt(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    corners = [(xmin, ymin), (xmin, ymax), (xmax, ymax), (xmax, ymin), (xmin, ymin)]
    pairs = " || ',' || ".join(f"{number_text(x)} || ' ' || {number_text(y)}" for x, y in corners)
    return f"('POLYGON((' || {pairs} || '))')"


def wkt_point(text: str) -> str:
    """``struct(x, y)`` from ``POINT(x y)``; null for any other text."""
    pattern = rf"(?i)^\\s*POINT\\s*\\(\\s*({_NUMBER})\\s+({_NUMBER})\\s*\\)\\s*$"
    x, y = (f"CAST(regexp_extract({text}, '{pattern}', {i}) AS DOUBLE)" for i in (1, 2))
    return f"(CASE WHEN {text} RLIKE '{pattern}' THEN struct({x} AS x, {y} AS y) END)"


def wkt_ring(text: str) -> str:
    """The rings of ``POLYGON((x y, …), …)`` or ``MULTIPOLYGON(((…)))``; null for any other text."""
    ring = r"\\(\\s*[^()]+\\)"
    rings = rf"\\(\\s*{ring}(?:\\s*,\\s*{ring})*\\s*\\)"
    polygon = rf"(?i)^\\s*POLYGON\\s*{rings}\\s*$"
    several = rf"(?i)^\\s*MULTIPOLYGON\\s*\\(\\s*{rings}(?:\\s*,\\s*{rings})*\\s*\\)\\s*$"

    def vertices(of: str) -> str:
        pairs = f"transform(split({of}, ','), p -> split(trim(p), '\\\\s+'))"
        return (
            f"transform({pairs}, p -> struct(try_cast(try_element_at(p, 1) AS DOUBLE) AS x, "
            "try_cast(try_element_at(p, 2) AS DOUBLE) AS y))"
        )

    # each ring with the brackets before it: two or more open a part
    found = f"regexp_extract_all({text}, '((?:\\\\(\\\\s*)+[^()]+)', 1)"
    path = f"""flatten(transform({found}, (t, i) -> concat(CASE WHEN i = 0 THEN CAST(array() AS {RING_TYPE})
        WHEN regexp_count(t, '\\\\(') > 1 THEN array({PART_BREAK}) ELSE array({HOLE_BREAK}) END,
        {vertices("regexp_replace(t, '[(]', '')")})))"""
    return f"(CASE WHEN {text} RLIKE '{polygon}' OR {text} RLIKE '{several}' THEN {path} END)"


# --- GeoJSON -----------------------------------------------------------------


def point_geojson(lon: str, lat: str) -> str:
    text = f"to_json(named_struct('type', 'Point', 'coordinates', array({lon}, {lat})))"
    return f"(CASE WHEN {lon} IS NOT NULL AND {lat} IS NOT NULL THEN {text} END)"


def ring_geojson(ring: str) -> str:
    """Polygon, or MultiPolygon for an area of several parts."""
    shape = f"array(transform({ring}, v -> array(v.x, v.y)))"
    text = f"to_json(named_struct('type', 'Polygon', 'coordinates', {shape}))"
    parts = f"exists({ring}, v -> v IS NOT NULL AND v.x IS NULL AND v.y IS NULL)"
    many = _joined(ring, "to_json(transform(r.ring, v -> array(v.x, v.y)))", "[", ",", "],[", "]")
    return f"""(CASE WHEN {ring} IS NULL THEN NULL WHEN NOT {has_breaks(ring)} THEN {text}
        WHEN {parts} THEN '{{"type":"MultiPolygon","coordinates":[' || {many} || ']}}'
        ELSE '{{"type":"Polygon","coordinates":' || {many} || '}}' END)"""


def parse_geometry(text: str) -> str:
    """``struct(type, coordinates)`` from GeoJSON geometry text; ``coordinates`` stays text."""
    return f"from_json({text}, 'type string, coordinates string')"


def geojson_point(geometry: str) -> str:
    """``struct(x, y)`` when a parsed geometry is a Point, else null."""
    point = let(
        "xy", f"from_json({geometry}.coordinates, 'array<double>')",
        "struct(try_element_at(xy, 1) AS x, try_element_at(xy, 2) AS y)",
    )
    return f"(CASE WHEN {geometry}.type = 'Point' THEN {point} END)"


def geojson_ring(geometry: str) -> str:
    """The rings when a parsed geometry is a Polygon or MultiPolygon, else null."""
    def path(rings: str) -> str:
        vertices = "transform(r, v -> struct(try_element_at(v, 1) AS x, try_element_at(v, 2) AS y))"
        return f"""flatten(transform({rings}, (r, i) -> concat(
            CASE WHEN i = 0 THEN CAST(array() AS {RING_TYPE}) ELSE array({HOLE_BREAK}) END, {vertices})))"""

    one = let(
        "rings", f"from_json({geometry}.coordinates, 'array<array<array<double>>>')",
        f"CASE WHEN size(rings) > 0 THEN {path('rings')} END",
    )
    several = let(
        "parts", f"from_json({geometry}.coordinates, 'array<array<array<array<double>>>>')",
        f"""CASE WHEN size(parts) > 0 THEN flatten(transform(parts, (p, j) -> concat(
            CASE WHEN j = 0 THEN CAST(array() AS {RING_TYPE}) ELSE array({PART_BREAK}) END, {path('p')}))) END""",
    )
    return f"(CASE {geometry}.type WHEN 'Polygon' THEN {one} WHEN 'MultiPolygon' THEN {several} END)"


def feature(properties: str, geometry: str) -> str:
    """One GeoJSON Feature as text, from a struct and GeoJSON geometry text.

    Null properties are kept as JSON nulls.
    """
    props = f"to_json({properties}, map('ignoreNullFields', 'false'))"
    return (
        f"('{{\"type\":\"Feature\",\"properties\":' || {props} || "
        f"',\"geometry\":' || coalesce({geometry}, 'null') || '}}')"
    )


# --- WKB ---------------------------------------------------------------------


def _field(hex_text: str, at: str, width: int) -> str:
    """Hex of the field starting at a hex position, most significant byte first."""
    swapped = " || ".join(f"substr({hex_text}, {at} + {2 * i}, 2)" for i in reversed(range(width)))
    return f"(CASE WHEN substr({hex_text}, 1, 2) = '01' THEN {swapped} ELSE substr({hex_text}, {at}, {2 * width}) END)"


def _uint(hex_digits: str) -> str:
    return f"CAST(conv({hex_digits}, 16, 10) AS BIGINT)"


def _double(hex_digits: str) -> str:
    """IEEE-754 double from 16 hex digits, exact; null for NaN and infinity."""
    parts = (
        f"struct({_uint('substr(h, 1, 3)')} AS head, CAST({_uint('substr(h, 4, 13)')} AS DOUBLE) AS fraction)"
    )
    value = """(CASE WHEN p.head >= 2048 THEN -1D ELSE 1D END) * (CASE
        WHEN p.head % 2048 = 0 THEN p.fraction * pow(2D, -1074D)
        WHEN p.head % 2048 < 2047 THEN (p.fraction + 4503599627370496D) * pow(2D, p.head % 2048 - 1075D) END)"""
    return let("h", hex_digits, let("p", parts, value))


def wkb_point(wkb: str) -> str:
    """``struct(x, y)`` from a two-dimensional WKB Point; null for other geometries."""
    point = f"struct({_double(_field('w', '11', 8))} AS x, {_double(_field('w', '27', 8))} AS y)"
    kind = f"{_uint(_field('w', '3', 4))} % 1000 = 1"
    return let("w", f"hex({wkb})", f"CASE WHEN length(w) = 42 AND {kind} THEN {point} END")


def wkb_ring(wkb: str) -> str:
    """The rings of a two-dimensional WKB Polygon or MultiPolygon of one byte order; null otherwise."""
    def vertices(at: str, n: str) -> str:
        return f"""transform(sequence(0, CAST({n} AS INT) - 1), i -> struct(
            {_double(_field('k.w', f'{at} + i * 32', 8))} AS x, {_double(_field('k.w', f'{at} + 16 + i * 32', 8))} AS y))"""

    def count(at: str) -> str:
        return _uint(_field("k.w", at, 4))

    empty = f"CAST(array() AS {RING_TYPE})"
    # hex positions; a ring is its number of vertices, then 16 bytes for each of them; -1 is no place
    def rings(first: str, start: str, between: str) -> str:
        ring = f"""CASE WHEN s.at < 0 OR n = 0 OR n IS NULL OR s.at + 7 + 32 * n > length(k.w) THEN struct(-1L AS at, s.path AS path)
            ELSE struct(s.at + 8 + 32 * n AS at, concat(s.path, CASE WHEN j = 1 THEN {between} ELSE array({HOLE_BREAK}) END,
                {vertices('s.at + 8', 'n')}) AS path) END"""
        return f"""aggregate(sequence(1, CAST(least(greatest({count(first)}, 1), length(k.w)) AS INT)), {start},
            (s, j) -> {let('n', f"CASE WHEN s.at >= 0 THEN {count('s.at')} END", ring)})"""

    one = rings("11", f"struct(19L AS at, {empty} AS path)", empty)
    part = rings("m.at + 10", "struct(m.at + 18 AS at, m.path AS path)", f"CASE WHEN p = 1 THEN {empty} ELSE array({PART_BREAK}) END")
    several = f"""aggregate(sequence(1, CAST(least(greatest({count('11')}, 1), length(k.w)) AS INT)), struct(19L AS at, {empty} AS path),
        (m, p) -> CASE WHEN m.at < 0 THEN m WHEN {count('m.at + 2')} % 1000 = 3 AND {count('m.at + 10')} > 0 THEN {part}
            ELSE struct(-1L AS at, m.path AS path) END)"""
    heads = f"struct(w AS w, {_uint(_field('w', '3', 4))} AS kind, {_uint(_field('w', '11', 4))} AS n)"
    whole = f"CASE WHEN k.n > 0 AND k.kind = 3 THEN {one} WHEN k.n > 0 AND k.kind = 6 THEN {several} END"
    # everything must be used up
    return let("w", f"hex({wkb})", let("k", heads, let("q", whole, "CASE WHEN q.at = length(k.w) + 1 THEN q.path END")))


def _binary(data: np.ndarray, lengths: np.ndarray, present: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``; absent ones have length 0."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("<i4")
    valid = np.packbits(present, bitorder="little")
    return pa.Array.from_buffers(
        pa.binary(), len(lengths), [pa.py_buffer(valid.tobytes()), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())]
    )


@F.arrow_udf(BinaryType())
def point_wkb(lon: pa.Array, lat: pa.Array) -> pa.Array:
    """WKB Point, as a column of its own: ``select(point_wkb("lon", "lat"))``."""
    present = ~np.asarray(pc.or_(lon.is_null(), lat.is_null()))
    rows = np.empty(len(lon), dtype=[("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])
    rows["order"], rows["kind"] = 1, 1
    rows["x"] = lon.cast("double").to_numpy(zero_copy_only=False)
    rows["y"] = lat.cast("double").to_numpy(zero_copy_only=False)
    return _binary(rows[present], np.where(present, rows.itemsize, 0), present)


def _polygons(xs: pa.Array, ys: pa.Array) -> pa.Array:
    """WKB Polygons of one ring, given the x and y arrays of equal length."""
    present = ~np.asarray(pc.or_(xs.is_null(), ys.is_null()))
    counts = np.where(present, pc.fill_null(xs.value_lengths(), 0).to_numpy(), 0)
    some = pa.array(present)
    vertices = np.empty((counts.sum(), 2), "<f8")
    vertices[:, 0] = xs.filter(some).flatten().to_numpy(zero_copy_only=False)
    vertices[:, 1] = ys.filter(some).flatten().to_numpy(zero_copy_only=False)
    heads = np.empty(present.sum(), dtype=[("order", "u1"), ("kind", "<u4"), ("rings", "<u4"), ("n", "<u4")])
    heads["order"], heads["kind"], heads["rings"], heads["n"] = 1, 3, 1, counts[present]
    lengths = np.where(present, heads.itemsize + vertices.itemsize * 2 * counts, 0)
    starts = (np.cumsum(lengths) - lengths)[present]
    data = np.empty(lengths.sum(), np.uint8)
    data[starts[:, None] + np.arange(heads.itemsize)] = heads.view(np.uint8).reshape(-1, heads.itemsize)
    kept = counts[present]
    nth = np.arange(len(vertices)) - np.repeat(np.cumsum(kept) - kept, kept)
    places = np.repeat(starts + heads.itemsize, kept) + 16 * nth
    data[places[:, None] + np.arange(16)] = vertices.view(np.uint8).reshape(-1, 16)
    return _binary(data, lengths, present)


def _several(xs: list[float | None], ys: list[float | None], holes: list[bool]) -> bytes:
    """WKB Polygon or MultiPolygon of rings with breaks between them."""
    parts: list[list[list[tuple]]] = [[[]]]
    for x, y, hole in zip(xs, ys, holes):
        if hole:
            parts[-1].append([])
        elif x is None and y is None:
            parts.append([[]])
        else:
            parts[-1][-1].append((x, y))
    polygons = [
        struct.pack("<BII", 1, 3, len(part))
        + b"".join(struct.pack("<I", len(ring)) + np.array(ring, "<f8").tobytes() for ring in part)
        for part in parts
    ]
    return polygons[0] if len(polygons) == 1 else struct.pack("<BII", 1, 6, len(polygons)) + b"".join(polygons)


@F.arrow_udf(BinaryType())
def area_wkb(xs: pa.Array, ys: pa.Array, holes: pa.Array) -> pa.Array:
    """WKB of areas given by the x and y of their vertices and which of them are breaks before holes."""
    if xs.flatten().null_count == 0:
        return _polygons(xs, ys)
    out = []
    for i in range(len(xs)):
        one = xs[i : i + 1]
        if one.flatten().null_count:
            out.append(_several(one[0].as_py(), ys[i].as_py(), holes[i].as_py()))
        else:
            out.append(_polygons(one, ys[i : i + 1])[0].as_py())
    return pa.array(out, pa.binary())


def ring_wkb(ring: str):
    """WKB Polygon or MultiPolygon of a ring column, as a column of its own."""
    return area_wkb(*[F.expr(f"transform({ring}, v -> {part})") for part in ("v.x", "v.y", "v IS NULL")])
