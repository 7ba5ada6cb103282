"""Lists of edges looked at a batch of rows at a time: distances to points, masks of the parts of cells, outlines that meet.

The formulas are those of :mod:`tidegrid.functions.geometry`; as SQL text they are worked out by the interpreter of
lambda functions, one edge at a time.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, LongType, StructType

from tidegrid.functions.geodesy import WGS84_A, WGS84_E2

# parts of a cell a side; the square of it is the bits of a long
PARTS = 8
# so many edges are looked at in one go
EDGES = 4096
# so many pairs of areas, and of their edges, are looked at in one go
PAIRS, PAIRS_OF_EDGES = 4096, 1 << 17

_EQUATOR = np.pi / 180.0 * WGS84_A
_MERIDIAN = np.pi / 180.0 * WGS84_A * (1.0 - WGS84_E2)


def _metres_per_degree(lat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sine = np.sin(np.radians(lat))
    curvature = 1.0 - WGS84_E2 * sine * sine
    return _EQUATOR * np.cos(np.radians(lat)) / np.sqrt(curvature), _MERIDIAN / np.power(curvature, 1.5)


def nearest_metres(px: np.ndarray, py: np.ndarray, n: np.ndarray, lines: Sequence[np.ndarray]) -> np.ndarray:
    """Metres from each point to the area of its ``n`` edges, which stand one after the other; 0 inside, NaN if unknown."""
    x1, y1, x2, y2 = lines
    starts = np.cumsum(n) - n
    x, y = np.repeat(px, n), np.repeat(py, n)
    within = _inside((x, y), (x1, y1, x2, y2), starts)
    across, along = _metres_per_degree(py)
    ratio = np.repeat(np.maximum(across / along, 1e-9), n)
    ex, ey, ox, oy = (x2 - x1) * ratio, y2 - y1, (x - x1) * ratio, y - y1
    dot, length = ox * ex + oy * ey, ex * ex + ey * ey
    share = np.where(dot <= 0, 0.0, np.where(dot >= length, 1.0, dot / length))
    dx, dy = share * ex - ox, share * ey - oy
    d2, qx, qy = dx * dx + dy * dy, x + dx / ratio, y + dy
    # of several equally near the first by place; an edge without a coordinate leaves the distance open
    best = np.minimum.reduceat(d2, starts)
    tied = d2 == np.repeat(best, n)
    near_x = np.minimum.reduceat(np.where(tied, qx, np.inf), starts)
    tied &= qx == np.repeat(near_x, n)
    near_y = np.minimum.reduceat(np.where(tied, qy, np.inf), starts)
    across, along = _metres_per_degree((py + near_y) / 2.0)
    away_x, away_y = (near_x - px) * across, (near_y - py) * along
    metres = np.where(np.isnan(best), np.nan, np.sqrt(away_x * away_x + away_y * away_y))
    return np.where(within, 0.0, metres)


@F.arrow_udf(DoubleType())
def metres_to_edges(lon: pa.Array, lat: pa.Array, edges: pa.Array) -> pa.Array:
    """Metres from each point to the area of its edges, 0 inside, on the boundary and without a list of edges."""
    counts = np.asarray(edges.value_lengths().fill_null(0))
    some = np.flatnonzero(counts)
    out = np.zeros(len(counts))
    if not len(some):
        return pa.array(out)
    flat = edges.flatten()
    x1, y1, x2, y2 = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("x1", "y1", "x2", "y2"))
    px, py = (np.asarray(v.to_numpy(zero_copy_only=False), dtype=float)[some] for v in (lon, lat))
    with np.errstate(all="ignore"):
        out[some] = nearest_metres(px, py, counts[some], (x1, y1, x2, y2))
    return pa.array(out, from_pandas=True)


@F.arrow_udf(StructType().add("full", LongType()).add("near", LongType()))
def part_masks(edges: pa.Array, cx: pa.Array, cy: pa.Array, side: pa.Array, mx: pa.Array, my: pa.Array) -> pa.Array:
    """For each cell a bit for each of its parts, column by column: wholly inside, and within the margin of an edge.

    Without a list of edges every part counts as near.
    """
    counts = np.asarray(edges.value_lengths().fill_null(0))
    full, near = np.zeros(len(counts), "<i8"), np.full(len(counts), -1, "<i8")
    some = np.flatnonzero(counts)
    if len(some):
        flat = edges.flatten()
        lines = [flat.field(n).to_numpy(zero_copy_only=False) for n in ("x1", "y1", "x2", "y2")]
        cells = [np.asarray(v.to_numpy(zero_copy_only=False), dtype=float)[some] for v in (cx, cy, side, mx, my)]
        ends = np.cumsum(counts[some])
        first = 0
        while first < len(some):
            before = ends[first - 1] if first else 0
            last = max(int(np.searchsorted(ends, before + EDGES)), first + 1)
            full[some[first:last]], near[some[first:last]] = _masks(
                [v[before : ends[last - 1]] for v in lines], counts[some[first:last]], [v[first:last] for v in cells])
            first = last
    return pa.StructArray.from_arrays([pa.array(full), pa.array(near)], ["full", "near"])


def _masks(lines: list[np.ndarray], counts: np.ndarray, cells: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x1, y1, x2, y2 = (v[:, None] for v in lines)
    cx, cy, side, mx, my = (np.repeat(v, counts)[:, None] for v in cells)
    starts = np.cumsum(counts) - counts
    middle = (np.arange(PARTS) + 0.5) / PARTS
    x, y = (cx + middle) * side, (cy + middle) * side
    # half a part, and a thousandth of it for rounding
    reach_x, reach_y = side / PARTS * 0.5005 + mx, side / PARTS * 0.5005 + my
    across = (np.minimum(x1, x2) <= x + reach_x) & (np.maximum(x1, x2) >= x - reach_x)
    along = (np.minimum(y1, y2) <= y + reach_y) & (np.maximum(y1, y2) >= y - reach_y)
    turn = ((x2 - x1) * (y - y1))[:, None, :] - ((x - x1) * (y2 - y1))[:, :, None]
    # a part wholly on one side of the edge's line does not meet it
    meets = np.abs(turn) <= (np.abs(x2 - x1) * reach_y + np.abs(y2 - y1) * reach_x)[:, :, None]
    unknown = np.isnan(x1 + y1 + x2 + y2)[:, :, None]
    near = np.logical_or.reduceat(across[:, :, None] & along[:, None, :] & meets | unknown, starts, axis=0)
    crossed = ((y1 > y) != (y2 > y))[:, None, :] & ((y2 > y1)[:, :, None] == (turn > 0))
    inside = np.add.reduceat(crossed.astype(np.int64), starts, axis=0) % 2 == 1
    return _bits(inside & ~near), _bits(near)


def _bits(parts: np.ndarray) -> np.ndarray:
    return np.packbits(parts.reshape(len(parts), -1), axis=1, bitorder="little").view("<i8")[:, 0]


@F.arrow_udf(BinaryType())
def packed(records: pa.Array) -> pa.Array:
    """The doubles of each list of structs of doubles, one after the other; NaN for null."""
    counts = np.asarray(records.value_lengths().fill_null(0))
    flat = records.flatten()
    values = np.stack([f.to_numpy(zero_copy_only=False).astype("<f8") for f in flat.flatten()], axis=1).tobytes()
    width = 8 * flat.type.num_fields
    ends = np.cumsum(counts) * width
    return pa.array([values[a:b] for a, b in zip((ends - counts * width).tolist(), ends.tolist(), strict=True)], pa.binary())


def touching_pairs(pairs: DataFrame) -> DataFrame:
    """``_lid`` and ``_rid`` of pairs of areas that share a point.

    ``pairs`` has these, the common box ``x0, y0, x1, y1``, and for each area its edges and the first vertices of its rings
    (``le, re, lv, rv``), as :func:`packed` gives them.
    """
    ids = ["_lid", "_rid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [_touch(batch.slice(at, PAIRS)) for at in range(0, batch.num_rows, PAIRS)]
            if hits:
                kept = pa.array(np.concatenate(hits))
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in ids], names=ids)

    schema = StructType([f for f in pairs.schema.fields if f.name in ids])
    columns = [*ids, "x0", "y0", "x1", "y1", "le", "re", "lv", "rv"]
    return pairs.select(*columns).mapInArrow(run, schema)


def _unpacked(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The records of all rows, a column for each field, and the row each belongs to."""
    column = column.cast(pa.binary())
    ends = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(column.buffers()[2] or b"", "u1")[ends[0] : ends[-1]].view("<f8").reshape(-1, width)
    return values, np.repeat(np.arange(len(column)), np.diff(ends) // (8 * width))


def _crossed(rows: np.ndarray, left: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every record on the left (of the row ``rows``) with every record on the right of its row, in portions; numbers on both sides."""
    starts, n = np.cumsum(counts) - counts, counts[rows]
    ends = np.cumsum(n)
    first = 0
    while first < len(left):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + PAIRS_OF_EDGES)), first + 1)
        some = n[first:last]
        which = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        yield np.repeat(left[first:last], some), which + np.repeat(starts[rows[first:last]], some)
        first = last


def _turn(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (px - ax) * (by - ay)


def _touch(batch: pa.RecordBatch) -> np.ndarray:
    """Which rows of :func:`touching_pairs` share a point."""
    hit = np.zeros(batch.num_rows, bool)
    box = [batch.column(c).to_numpy() for c in ("x0", "y0", "x1", "y1")]
    (le, lrow), (re, rrow) = (_unpacked(batch.column(c), 4) for c in ("le", "re"))
    with np.errstate(all="ignore"):
        def near(e: np.ndarray, row: np.ndarray) -> np.ndarray:
            x0, y0, x1, y1 = (b[row] for b in box)
            return (
                (np.fmin(e[:, 0], e[:, 2]) <= x1) & (np.fmax(e[:, 0], e[:, 2]) >= x0)
                & (np.fmin(e[:, 1], e[:, 3]) <= y1) & (np.fmax(e[:, 1], e[:, 3]) >= y0)
            )

        # only edges that reach into the common box can meet
        lkeep, rkeep = np.flatnonzero(near(le, lrow)), np.flatnonzero(near(re, rrow))
        counts = np.bincount(rrow[rkeep], minlength=len(hit))
        for a, b in _crossed(lrow[lkeep], lkeep, counts):
            row, b = lrow[a], rkeep[b]
            ax1, ay1, ax2, ay2 = le[a].T
            bx1, by1, bx2, by2 = re[b].T
            touch = (
                (np.fmin(ax1, ax2) <= np.fmax(bx1, bx2)) & (np.fmin(bx1, bx2) <= np.fmax(ax1, ax2))
                & (np.fmin(ay1, ay2) <= np.fmax(by1, by2)) & (np.fmin(by1, by2) <= np.fmax(ay1, ay2))
            )
            touch &= np.sign(_turn(ax1, ay1, ax2, ay2, bx1, by1)) * np.sign(_turn(ax1, ay1, ax2, ay2, bx2, by2)) <= 0
            touch &= np.sign(_turn(bx1, by1, bx2, by2, ax1, ay1)) * np.sign(_turn(bx1, by1, bx2, by2, ax2, ay2)) <= 0
            hit[row[touch]] = True
        # else one ring of an area may lie inside the other
        for vertices, edges, erow in (("lv", re, rrow), ("rv", le, lrow)):
            v, vrow = _unpacked(batch.column(vertices), 2)
            left = np.flatnonzero(~hit[vrow])
            counts = np.bincount(erow, minlength=len(hit))
            for a, b in _crossed(vrow[left], left, counts):
                starts = np.flatnonzero(np.diff(a, prepend=-1))
                if len(starts):
                    within = _inside(v[a].T, edges[b].T, starts)
                    hit[vrow[a[starts]][within]] = True
    return hit


def _inside(points: np.ndarray, edges: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Even-odd over the edges from each of ``starts`` to the next, on the boundary excluded; the point stands beside each edge."""
    (x, y), (x1, y1, x2, y2) = points, edges
    known = ~np.isnan(x1 + y1 + x2 + y2)
    side = _turn(x1, y1, x2, y2, x, y)
    level = known & ~((y1 > y) & (y2 > y)) & ~((y1 < y) & (y2 < y))
    on_edge = level & (side == 0) & ((x1 <= x) & (x <= x2) | (x2 <= x) & (x <= x1))
    crossed = level & ((y1 > y) != (y2 > y)) & ((y2 > y1) == (side > 0))
    return ~np.logical_or.reduceat(on_edge, starts) & (np.add.reduceat(crossed.astype(np.int64), starts) % 2 == 1)


def held_by_bucket(points: DataFrame, cells: DataFrame, area_columns: list[str]) -> DataFrame:
    """``area_columns`` of every cell with ``n``, how many of the points of the cell its area holds; cells without any are left out.

    Both sides have ``_bucket``, which places whole cells in tasks, and a cell number ``_cell``. ``points`` has ``lon``, ``lat``,
    the number ``times`` it stands for and its ``_part``; ``cells`` has the masks and ``_lines``, its edges as :func:`packed` gives
    them. Points of parts wholly inside are only counted, those of parts near an edge are compared with the edges.
    """
    names = [f"a{i}" for i in range(len(area_columns))]
    named = cells.selectExpr("_bucket", "_cell", "_full", "_near", "_lines", *[f"`{c}` AS {n}" for c, n in zip(area_columns, names)])

    def run(places: pa.Table, areas: pa.Table) -> pa.Table:
        counts = _held(places.combine_chunks(), areas.combine_chunks())
        some = pa.array(counts > 0)
        return pa.table([*[areas.column(n) for n in names], pa.array(counts)], [*names, "n"]).filter(some)

    schema = StructType([f for f in named.schema.fields if f.name in names]).add("n", LongType())
    met = points.groupBy("_bucket").cogroup(named.groupBy("_bucket")).applyInArrow(run, schema)
    return met.selectExpr(*[f"{n} AS `{c}`" for c, n in zip(area_columns, names)], "n")


def _held(places: pa.Table, areas: pa.Table) -> np.ndarray:
    held = np.zeros(areas.num_rows, np.int64)
    if not places.num_rows or not areas.num_rows:
        return held
    parts = PARTS * PARTS
    cell, at = np.unique(places.column("_cell").to_numpy(), return_inverse=True)
    code = at * parts + places.column("_part").to_numpy()
    order = np.argsort(code, kind="stable")
    lon, lat, times = (places.column(c).to_numpy()[order] for c in ("lon", "lat", "times"))
    stops = np.searchsorted(code[order], np.arange(len(cell) * parts + 1))
    sums = np.concatenate([[0], np.cumsum(times)])
    rows_in = np.diff(stops).reshape(-1, parts)
    times_in = np.diff(sums[stops]).reshape(-1, parts)

    own = areas.column("_cell").to_numpy()
    mine = np.minimum(np.searchsorted(cell, own), len(cell) - 1)
    met = np.flatnonzero(cell[mine] == own)
    full, near = (areas.column(c).to_numpy() for c in ("_full", "_near"))
    lines = areas.column("_lines").combine_chunks()
    for first in range(0, len(met), PAIRS):
        some = met[first : first + PAIRS]
        held[some] = (_unpacked_bits(full[some]) * times_in[mine[some]]).sum(axis=1)
        which, part = np.nonzero(_unpacked_bits(near[some]) & (rows_in[mine[some]] > 0))
        # each part near an edge with its points, then each of these with the edges
        begin = stops[mine[some[which]] * parts + part]
        n = rows_in[mine[some[which]], part]
        edges, erow = _unpacked(lines.take(pa.array(some)), 4)
        edge_counts = np.bincount(erow, minlength=len(some))
        ends = np.cumsum(n)
        low = 0
        while low < len(which):
            before = ends[low - 1] if low else 0
            high = max(int(np.searchsorted(ends, before + PAIRS_OF_EDGES)), low + 1)
            m = n[low:high]
            point = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(begin[low:high], m)
            row = np.repeat(which[low:high], m)
            for a, b in _crossed(row, np.arange(len(row)), edge_counts):
                starts = np.flatnonzero(np.diff(a, prepend=-1))
                if len(starts):
                    within = a[starts][_inside((lon[point[a]], lat[point[a]]), edges[b].T, starts)]
                    held[some] += np.bincount(row[within], times[point[within]], len(some)).astype(np.int64)
            low = high
    return held


def _unpacked_bits(masks: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(masks, "<i8").view("u1").reshape(-1, 8), axis=1, bitorder="little").astype(bool)
