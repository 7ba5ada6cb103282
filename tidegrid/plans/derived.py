"""Points and areas derived from the supplied tables.

The tables hold no coordinates, so these are worked out from keys with integer arithmetic
that any SQL engine evaluates alike. Every derived set grows with its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidegrid.functions.geometry import HOLE_BREAK, PART_BREAK, RING_TYPE, ring_of
from tidegrid.functions.text import days_from, zero_padded

# The three reference flood areas (id, name, date, severity, population, bounds).
REFERENCE_AREAS = [
    (1, "Partenon", "2024-06-10", "high", 2500, (-51.30, -30.05, -51.20, -29.95)),
    (2, "Centro/Menino Deus", "2024-06-10", "very_high", 5000, (-51.22, -30.03, -51.18, -29.98)),
    (3, "Zona Norte", "2024-06-10", "medium", 1500, (-51.25, -29.92, -51.15, -29.88)),
]
AREA_FIELDS = ["area_id", "area_name", "flood_date", "severity", "affected_population"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def citizens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS citizen_id",
        "c_name AS name",
        "'Rua ' || CAST(c_custkey % 997 AS STRING) || ', Porto Alegre' AS address",
        f"CASE WHEN c_custkey % 11 <> 0 THEN '51 99999-' || {zero_padded('c_custkey', 4)} END AS phone",
        f"{days_from('2024-01-01', 'c_custkey % 366')} AS registration_date",
        "CAST(-51350 + (c_custkey * 7919) % 251 AS DOUBLE) / 1e3D AS lon",
        "CAST(-30080 + (c_custkey * c_custkey * 31 + c_custkey * 17) % 233 AS DOUBLE) / 1e3D AS lat",
    )


def reference_areas(spark: SparkSession) -> DataFrame:
    """The three flood areas, ids 1 to 3; 1 and 2 overlap."""
    rows = []
    for i, name, date, severity, people, (x0, y0, x1, y1) in REFERENCE_AREAS:
        box = ring_of([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])
        rows.append(f"({i}L, '{name}', '{date}', '{severity}', {people}L, {box})")
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(AREA_FIELDS)}, ring)")


def _at(dx: int | str, dy: int | str) -> tuple[str, str]:
    """A vertex in thousandths of a degree from the supplier's corner (x, y)."""
    return f"CAST(x + {dx} AS DOUBLE) / 1e3D", f"CAST(y + {dy} AS DOUBLE) / 1e3D"


def _placed_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS k",
        "-51360 + (s_suppkey * 7919) % 240 AS x",
        "-30090 + (s_suppkey * s_suppkey * 13 + s_suppkey * 29) % 220 AS y",
        "8 + s_suppkey % 20 AS w",
        "8 + (s_suppkey * 7) % 20 AS h",
    )


_BASIN_RING = f"""CASE k % 4
    WHEN 0 THEN {ring_of([_at(0, 0), _at('w', 0), _at('w', 'h'), _at(0, 'h'), _at(0, 0)])}
    WHEN 1 THEN {ring_of([_at(0, 0), _at('w', 0), _at(3, 'h'), _at(0, 0)])}
    WHEN 2 THEN {ring_of([_at(0, 0), _at('w', 0), _at('w', 3), _at(3, 3), _at(3, 'h'), _at(0, 'h'), _at(0, 0)])}
    ELSE {ring_of([_at(0, 0), _at('w', 2), _at('2 * w', 0), _at('w', 'h'), _at(0, 0)])} END"""

_RAW_RING = f"""CASE k % 11
    WHEN 1 THEN {ring_of([_at(0, 0), _at(9, 0), _at(9, 9), _at(0, 9)])}
    WHEN 2 THEN {ring_of([_at(0, 0), _at(9, 0), _at(0, 0)])}
    WHEN 3 THEN {ring_of([_at(0, 0), _at(9, 0), _at(4, 0), _at(0, 0)])}
    WHEN 4 THEN {ring_of([_at(0, 0), _at(9, 9), _at(9, 0), _at(0, 12), _at(0, 0)])}
    WHEN 5 THEN {ring_of([_at(0, 0), _at(8, 0), _at(8, 8), _at(4, 0), _at(0, 8), _at(0, 0)])}
    WHEN 6 THEN CAST(NULL AS {RING_TYPE})
    WHEN 7 THEN {ring_of([_at(0, 0), _at(9, 0), _at(9, 0), _at(9, 9), _at(0, 0)])}
    WHEN 8 THEN {ring_of([_at(0, 0), _at(9, 0), _at(9, 9), _at(9, 14), _at(9, 9), _at(0, 9), _at(0, 0)])}
    ELSE {_BASIN_RING} END"""


def basins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area per supplier, ids from 1000: boxes, triangles, L and dart shapes, many overlapping."""
    return _placed_suppliers(spark, sf_dir).selectExpr(
        "k + 1000 AS area_id",
        "'Basin ' || CAST(k % 40 AS STRING) AS area_name",
        f"date_format({days_from('2024-05-01', 'k % 60')}, 'yyyy-MM-dd') AS flood_date",
        "CASE k % 3 WHEN 0 THEN 'medium' WHEN 1 THEN 'high' ELSE 'very_high' END AS severity",
        "100 + k * 37 % 5000 AS affected_population",
        f"{_BASIN_RING} AS ring",
    )


def all_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference areas and the basins together."""
    return reference_areas(spark).unionByName(basins(spark, sf_dir))


def raw_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basins as they might arrive: some rings broken, some ids twice, severity missing here and there.

    ``arrival`` is the order of arrival. Rings by ``s_suppkey % 11``: 1 not closed, 2 too few
    vertices, 3 no area, 4 crossing itself, 5 touching itself, 6 missing, 7 a repeated vertex
    (valid), 8 a spike; the others as in :func:`basins`.
    """
    first = _placed_suppliers(spark, sf_dir).selectExpr(
        "k + 1000 AS area_id",
        "'Basin ' || CAST(k % 40 AS STRING) AS area_name",
        f"date_format({days_from('2024-05-01', 'k % 60')}, 'yyyy-MM-dd') AS flood_date",
        "CASE WHEN k % 5 <> 0 THEN 'high' END AS severity",
        "CASE WHEN k % 7 <> 0 THEN 100 + k * 37 % 5000 END AS affected_population",
        "inline(CASE WHEN k % 6 = 0 THEN array(struct(k AS arrival, '' AS note), "
        "struct(k + 1000000000 AS arrival, ' again' AS note)) "
        "ELSE array(struct(k AS arrival, '' AS note)) END)",
        f"{_RAW_RING} AS ring",
    )
    return first.selectExpr(
        "area_id", "area_name || note AS area_name", "flood_date", "severity",
        "affected_population", "arrival", "ring",
    )


def raw_citizens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per order: citizens registering again and again, as text, with flaws.

    A tenth of all records have no usable coordinates, and a third of them come from one
    citizen (id 7), so that the key is as uneven as keys get.
    """
    who = "(CASE WHEN o_orderkey % 3 = 0 THEN 7L ELSE o_custkey END)"
    return table(spark, sf_dir, "orders").selectExpr(
        f"CAST({who} AS STRING) AS citizen_id",
        f"'  Citizen_' || {zero_padded(who, 3)} || ' ' AS name",
        "' Rua ' || CAST(o_orderkey % 997 AS STRING) || '  ' AS address",
        f"CASE WHEN o_orderkey % 7 <> 0 THEN '51 99999-' || {zero_padded('o_orderkey % 10000', 4)} END AS phone",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS registration_date",
        "CASE WHEN o_orderkey % 20 = 3 THEN NULL WHEN o_orderkey % 20 = 5 THEN 999D "
        "ELSE CAST(-51350 + (o_orderkey * 7919) % 251 AS DOUBLE) / 1e3D END AS lon",
        "CAST(-30080 + (o_orderkey * o_orderkey * 31 + o_orderkey * 17) % 233 AS DOUBLE) / 1e3D AS lat",
        "o_orderkey AS arrival",
    )


def _box(x0: int | str, y0: int | str, x1: int | str, y1: int | str) -> str:
    return ring_of([_at(x0, y0), _at(x1, y0), _at(x1, y1), _at(x0, y1), _at(x0, y0)])


def _with(ring: str, mark: str, condition: str) -> str:
    """SQL text that adds a ring behind a break where ``condition`` holds."""
    return f"CASE WHEN {condition} THEN concat(array({mark}), {ring}) ELSE CAST(array() AS {RING_TYPE}) END"


_LAKES = ", ".join([
    _box(0, 0, "w + 12", "h + 12"),
    _with(_box(3, 3, 9, 9), HOLE_BREAK, "true"),
    _with(_box(11, 11, 15, 15), HOLE_BREAK, "k % 3 = 0"),
    _with(_box("w + 20", 0, "w + 30", 6), PART_BREAK, "k % 2 = 0"),
    _with(_box(5, 5, 7, 7), PART_BREAK, "k % 4 = 0"),
])

_RAW_LAKES = ", ".join([
    _LAKES,
    _with(_box(-9, -9, -5, -5), HOLE_BREAK, "k % 9 = 1"),
    _with(_box(1, 1, 2, 2), PART_BREAK, "k % 9 = 2"),
    _with(_box(-2, 4, 2, 8), HOLE_BREAK, "k % 9 = 3"),
    # in the first hole of the part it belongs to
    _with(ring_of([_at(4, 4), _at(5, 4), _at(4, 5), _at(4, 4)]), HOLE_BREAK, "k % 9 = 4 AND k % 2 = 1"),
    _with(ring_of([_at(1, 1), _at(2, 1), _at(1, 1)]), HOLE_BREAK, "k % 9 = 5"),
    # touches the outer ring in one point
    _with(ring_of([_at(0, 1), _at(2, 1), _at(2, 2), _at(0, 1)]), HOLE_BREAK, "k % 9 = 6 AND k % 2 = 1"),
])


def lakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One area per supplier, ids from 1000: a box with one or two holes, half of them with a second part, some with an island in a hole."""
    return _placed_suppliers(spark, sf_dir).selectExpr("k + 1000 AS area_id", f"concat({_LAKES}) AS ring")


def raw_lakes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`lakes` with flaws by ``s_suppkey % 9``: 1 a hole outside, 2 a part within another, 3 a hole across the outer ring,
    4 a hole in a hole, 5 a hole of two vertices; 6 has a hole that touches the outer ring, which is valid."""
    return _placed_suppliers(spark, sf_dir).selectExpr("k + 1000 AS area_id", f"concat({_RAW_LAKES}) AS ring")
