"""Areas cut into grid cells, so that "point in area" becomes an equi-join.

Each area is listed once under every cell it may reach. A cell wholly inside the area
needs no further test; a cell the boundary passes through keeps just the edges that
can matter for points in it; cells outside are left out. The cell side is a power of
two of a degree, so cell numbers and cell bounds are exact in doubles.

Areas far larger than the rest are listed at a coarser level, so no area is spread over
more than ``SPAN + 1`` cells a side and none is cut short.

A cell on a boundary is divided once more, into ``PARTS`` by ``PARTS`` parts, of which two masks of 64 bits
tell which lie wholly inside and which an edge comes near. Only points in parts of the second kind are compared
with edges; a cell with more than ``MASK_EDGES`` edges has no such masks and compares all its points.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidegrid.functions.geodesy import metres_per_degree_lon
from tidegrid.functions.geometry import edges_contain, edges_of, ring_bounds
from tidegrid.operators.edgewise import PARTS, part_masks
from tidegrid.session import materialise

SPAN = 16
LEVEL_RATIO = 16
BROADCAST_BYTES = 64 * 1024 * 1024
# a cell with more edges has no masks
MASK_EDGES = 64

CELL = ["_level", "_cx", "_cy"]


@dataclass(frozen=True)
class AreaIndex:
    """Cells of a set of areas, with what was measured about them."""

    cells: DataFrame
    area_columns: tuple[str, ...]
    side: float
    levels: tuple[int, ...]
    rows: int
    size_bytes: int
    broadcast_bytes: int
    margin_m: float

    @property
    def small(self) -> bool:
        """True when the measured cell table may be sent to every executor."""
        return self.size_bytes <= self.broadcast_bytes

    def level_side(self, level: int) -> float:
        return self.side * LEVEL_RATIO**level


def cell_no(value: str, side: float) -> str:
    """The cell number along one axis, as SQL text; null for null, NaN and infinity."""
    return f"(CASE WHEN abs({value}) < double('Infinity') THEN floor({value} / {side!r}D) END)"


def part_no(lon: str, lat: str, side: float) -> str:
    """Which part of its cell a point lies in, column by column, as SQL text; null where the cell is."""
    along = [
        f"least(greatest({cell_no(v, side / PARTS)} - {PARTS}L * {cell_no(v, side)}, 0L), {PARTS - 1}L)" for v in (lon, lat)
    ]
    return f"CAST({PARTS}L * {along[0]} + {along[1]} AS INT)"


def power_of_two(value: float) -> float:
    """The largest power of two not above ``value``, kept within sane cell sides."""
    return 2.0 ** max(-20, min(6, math.floor(math.log2(value)))) if value > 0 else 2.0**-20


def with_bounds(areas: DataFrame, margin_m: float = 0.0) -> DataFrame:
    """Areas with a usable ring, plus bounds and the margin in degrees on each axis."""
    bounds = areas.filter("size(ring) >= 4").selectExpr("*", f"{ring_bounds('ring')} AS _b")
    # NaN counts as greater than infinity, so this leaves out both
    bounds = bounds.filter(
        "greatest(abs(_b.xmin), abs(_b.ymin), abs(_b.xmax), abs(_b.ymax)) < double('Infinity')"
    )
    if margin_m > 0:
        # the smallest metres per degree within reach give a margin that is surely enough
        my = f"{1.001 * margin_m / 110500.0!r}D"
        far = f"least(greatest(abs(_b.ymin), abs(_b.ymax)) + {my}, 89.9D)"
        mx = f"least({1.001 * margin_m!r}D / {metres_per_degree_lon(far)}, 360D)"
    else:
        mx = my = "0D"
    return bounds.selectExpr(
        *areas.columns,
        "_b.xmin AS _xmin", "_b.ymin AS _ymin", "_b.xmax AS _xmax", "_b.ymax AS _ymax",
        f"{mx} AS _mx", f"{my} AS _my",
    )


EXTENT = "greatest(_xmax - _xmin + 2 * _mx, _ymax - _ymin + 2 * _my)"


def index_areas(
    areas: DataFrame,
    area_columns: list[str],
    margin_m: float = 0.0,
    broadcast_bytes: int = BROADCAST_BYTES,
    side: float | None = None,
) -> AreaIndex:
    """Cut ``areas`` (a ``ring`` column and ``area_columns``) into cells.

    The typical extent of the areas sets the cell side. The cell table is written once to the
    shared folder, and its measured size decides how it may be joined.
    """
    boxes = with_bounds(areas.select("ring", *area_columns), margin_m)
    if side is None:
        median = boxes.selectExpr(f"percentile_approx({EXTENT}, 0.5) AS m").first()["m"]
        side = power_of_two((median or 0.0) / 2.0)

    level = (
        f"greatest(0, CAST(ceil(ln(greatest({EXTENT}, 1e-12D) / {side * SPAN!r}D) "
        f"/ {math.log(LEVEL_RATIO)!r}D) AS INT))"
    )
    placed = boxes.selectExpr("*", f"{level} AS _level").selectExpr(
        "*", f"{side!r}D * pow({LEVEL_RATIO}D, _level) AS _side"
    )
    cells = materialise(_cut(placed, area_columns), "area-cells")
    columns = ", ".join(f"`{c}`" for c in cells.columns)
    stats = cells.selectExpr(
        "count(*) AS rows",
        f"sum(length(to_json(struct({columns})))) AS bytes",
        "sort_array(collect_set(_level)) AS levels",
    ).first()
    return AreaIndex(
        cells=cells,
        area_columns=tuple(area_columns),
        side=side,
        levels=tuple(stats["levels"]) or (0,),
        rows=stats["rows"],
        size_bytes=stats["bytes"] or 0,
        broadcast_bytes=broadcast_bytes,
        margin_m=margin_m,
    )


def _cut(placed: DataFrame, area_columns: list[str]) -> DataFrame:
    names = [f"`{c}`" for c in area_columns]
    keep = ["_level", "_side", "_mx", "_my", *names]
    # a ray towards +x from any point of a column of cells meets only edges not left of it
    columns = placed.selectExpr(
        *keep, "_ymin", "_ymax", f"{edges_of('ring')} AS _edges",
        "explode(sequence(floor((_xmin - _mx) / _side), floor((_xmax + _mx) / _side))) AS _cx",
    ).selectExpr(
        *keep, "_ymin", "_ymax", "_cx",
        "filter(_edges, e -> greatest(e.x1, e.x2) + _mx >= _cx * _side) AS _edges",
    )
    rows = columns.selectExpr(
        *keep, "_cx", "_edges",
        "explode(sequence(floor((_ymin - _my) / _side), floor((_ymax + _my) / _side))) AS _cy",
    ).selectExpr(
        *keep, "_cx", "_cy",
        """filter(_edges, e -> greatest(e.y1, e.y2) + _my >= _cy * _side
            AND least(e.y1, e.y2) - _my <= (_cy + 1) * _side) AS _edges""",
    )
    centre_in = edges_contain("_edges", "((_cx + 0.5D) * _side)", "((_cy + 0.5D) * _side)")
    return (
        rows.selectExpr(
            "*", "NOT exists(_edges, e -> least(e.x1, e.x2) - _mx <= (_cx + 1) * _side) AS _inside"
        )
        .filter(f"NOT _inside OR {centre_in}")
        .selectExpr(
            *CELL, "_inside", "CASE WHEN NOT _inside THEN _edges END AS _edges", *names, "_side", "_mx", "_my",
            f"CASE WHEN NOT _inside AND size(_edges) <= {MASK_EDGES} THEN _edges END AS _few",
        )
        .withColumn("_parts", part_masks("_few", "_cx", "_cy", "_side", "_mx", "_my"))
        .selectExpr(
            *CELL, "_inside", "_edges", "CASE WHEN _inside THEN -1L ELSE _parts.full END AS _full",
            "CASE WHEN _inside THEN 0L ELSE _parts.near END AS _near", *names,
        )
    )
