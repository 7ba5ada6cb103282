"""Joins of many rows with many on equal keys, a block of pairs at a time.

Rows of one key are put together in chunks, chunks of both sides meet by an ordinary equi-join, and the pairs of two
chunks are looked at in numpy (``mapInArrow``). What is shuffled grows with the rows of both sides, not with their pairs,
and a task holds no more than two chunks and a portion of their pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from tidegrid.operators.edgewise import PAIRS_OF_EDGES, _inside, _metres_per_degree, _turn, _unpacked, _unpacked_bits, nearest_metres
from tidegrid.operators.skew import HOT_SHARE
from tidegrid.session import materialise

# joins of fewer pairs, or of fewer pairs a key, gain nothing from blocks
WORTH_PAIRS, WORTH_PAIRS_A_KEY = 1 << 20, 256
# so many rows (by weight) are in a chunk of the left and the right side
LEFT_ROWS, RIGHT_ROWS = 8192, 1024
# a task takes about so many pairs of equal keys
BLOCK_TASK_PAIRS = 1 << 24
# matrices of points and areas have so many elements, and so many pairs are handed on in one go
ELEMENTS, BATCH = 1 << 15, 1 << 17
# areas with more edges in a cell are looked at one by one
FEW_EDGES = 64

Found = tuple[np.ndarray, np.ndarray, "np.ndarray | None"]


@dataclass(frozen=True)
class BlockPlan:
    """Which keys need several chunks, and how many tasks the join gets."""

    keys: list[str]
    hot: DataFrame
    tasks: int


def plan_blocks(left: DataFrame, right: DataFrame, keys: list[str], left_weight: str = "1", right_weight: str = "1") -> BlockPlan | None:
    """How to cut both sides; none if there are too few pairs of equal keys to be worth it."""
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    mine, yours = (
        df.filter(known).groupBy(*keys).agg(F.count("*").alias(f"_{n}_rows"), F.expr(f"sum({w})").alias(f"_{n}_weight"))
        for df, n, w in ((left, "l", left_weight), (right, "r", right_weight))
    )
    # as doubles: the product of two counts may not fit
    met = materialise(mine.join(yours, keys).withColumn("_pairs", F.expr("double(_l_rows) * _r_rows")), "met-keys")
    stats = met.selectExpr("count(*) AS n", "coalesce(sum(_pairs), 0D) AS pairs").first()
    if stats["pairs"] < max(WORTH_PAIRS, WORTH_PAIRS_A_KEY * stats["n"]):
        return None
    cores = left.sparkSession.sparkContext.defaultParallelism
    tasks = int(max(min(stats["pairs"] // BLOCK_TASK_PAIRS + 1, HOT_SHARE), 4 * cores))
    limit = stats["pairs"] / tasks
    # the right side is divided among the tasks of a key first, and the rows on the left repeated for it
    hot = met.selectExpr(
        *keys, f"CAST(ceil(_l_weight / {LEFT_ROWS}) AS INT) AS _lp", f"CAST(ceil(_r_weight / {RIGHT_ROWS}) AS INT) AS _rp",
        f"CAST(ceil(_pairs / {limit!r}D) AS INT) AS _n",
    ).filter("_lp > 1 OR _rp > 1").selectExpr("*", "least(_rp, _n) AS _rg").selectExpr(
        *[f"{k} AS _hot{k}" for k in keys], "_lp", "_rp", "_rg", "least(_lp, CAST(ceil(_n / _rg) AS INT)) AS _lg")
    return BlockPlan(keys, hot, tasks)


def meet_blocks(
    left: DataFrame, right: DataFrame, plan: BlockPlan, row_ids: tuple[list[str], list[str]],
    pairs: Callable[[pa.StructArray, pa.StructArray], Iterator[Found]], out: tuple[list[str], list[str]], measure: str | None = None,
) -> DataFrame:
    """The columns ``out`` of both sides of the pairs of rows with equal keys that ``pairs`` finds.

    It gets the rows of two chunks and gives portions of the found ones by their places, with a number a pair that becomes
    the column ``measure``. ``row_ids`` name columns that tell the rows of each side apart.
    """
    keys = plan.keys
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    same = " AND ".join(f"{k} = _hot{k}" for k in keys)

    def chunks(df: DataFrame, name: str, row_id: list[str], mine: str, yours: str) -> DataFrame:
        # columns by their places, as both sides may share names
        record = ", ".join(f"`{c}` AS c{i}" for i, c in enumerate(df.columns))
        cut = df.filter(known).join(plan.hot, F.expr(same), "left").withColumn(
            "_piece", F.pmod(F.xxhash64(*row_id), F.coalesce(f"_{mine}p", F.lit(1)))
        ).selectExpr(*keys, "_piece", f"coalesce(_{mine}g, 1) AS _mine", f"coalesce(_{yours}g, 1) AS _yours", f"struct({record}) AS r")
        together = cut.groupBy(*keys, "_piece", "_mine", "_yours").agg(F.collect_list("r").alias(name))
        return together.selectExpr(
            *keys, name, f"_piece % _mine AS _{mine}s", f"explode(sequence(0, _yours - 1)) AS _{yours}s"
        ).withColumns({f"_{side}s": F.col(f"_{side}s").cast("int") for side in "lr"})

    on = [*keys, "_ls", "_rs"]
    a, b = (
        df.repartition(plan.tasks, *on)
        for df in (chunks(left, "l", row_ids[0], "l", "r"), chunks(right, "r", row_ids[1], "r", "l"))
    )
    places = [[df.columns.index(c) for c in some] for df, some in ((left, out[0]), (right, out[1]))]
    names = [*out[0], *out[1], *([measure] if measure else [])]
    fields = [df.schema[c] for df, some in ((left, out[0]), (right, out[1])) for c in some]
    schema = StructType(fields)
    if measure:
        schema = schema.add(measure, DoubleType())

    def handed(l_rows: pa.StructArray, r_rows: pa.StructArray, found: list[Found]) -> pa.RecordBatch:
        i, j = (pa.array(np.concatenate([f[n] for f in found])) for n in (0, 1))
        columns = [l_rows.field(c).take(i) for c in places[0]] + [r_rows.field(c).take(j) for c in places[1]]
        if measure:
            columns.append(pa.array(np.concatenate([f[2] for f in found])))
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [batch.column(0), batch.column(1)]
            for row in range(batch.num_rows):
                l_rows, r_rows = (_elements(side, row) for side in sides)
                waiting, held = [], 0
                for found in pairs(l_rows, r_rows):
                    waiting.append(found)
                    held += len(found[0])
                    if held >= BATCH:
                        yield handed(l_rows, r_rows, waiting)
                        waiting, held = [], 0
                if held:
                    yield handed(l_rows, r_rows, waiting)

    return a.join(b, on).select("l", "r").mapInArrow(run, schema)


def _elements(lists: pa.ListArray, row: int) -> pa.StructArray:
    first, last = lists.offsets[row].as_py(), lists.offsets[row + 1].as_py()
    return lists.values.slice(first, last - first)


def _numbers(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False))


def points_with_areas(points: pa.StructArray, areas: pa.StructArray, metres: float | None = None) -> Iterator[Found]:
    """Places of points and areas of one cell that hold them, or with ``metres`` are so near, then with their distance.

    ``points`` starts with the coordinates and the part of the cell; ``areas`` with both masks of the parts and the edges as
    :func:`packed` gives them. Points of parts wholly inside an area are settled by its mask.
    """
    x, y, part = (_numbers(points.field(i)) for i in range(3))
    full, near = (_unpacked_bits(_numbers(areas.field(i))) for i in range(2))
    edges, owner = _unpacked(areas.field(2), 4)
    # an edge without a coordinate crosses nothing and leaves the distance open
    edges = np.where(np.isnan(edges).any(axis=1)[:, None], np.inf, edges)
    counts = np.bincount(owner, minlength=len(areas))
    starts = np.cumsum(counts) - counts
    near &= ~full
    few = counts <= FEW_EDGES
    # areas by falling number of edges, so that those with a k-th edge come first
    rank = np.argsort(-np.where(few, counts, -1), kind="stable")
    most = int(counts[few].max(initial=0))
    lines = np.zeros((most, 4, len(rank)))
    for k in range(most):
        some = rank[: np.count_nonzero(few & (counts > k))]
        lines[k, :, : len(some)] = edges[starts[some] + k].T
    ranked, near, full = counts[rank], near[rank], full[rank]

    if len(x) * len(rank) <= ELEMENTS:
        # a small block in one go: what is wholly inside is known, the rest is compared whatever the part
        covered = full.all(axis=1)
        groups = [(np.arange(len(x)), np.flatnonzero(covered), np.flatnonzero(~covered))]
    else:
        order = np.argsort(part, kind="stable")
        stops = np.searchsorted(part[order], np.arange(full.shape[1] + 1))
        full, near = np.asfortranarray(full), np.asfortranarray(near)
        groups = (
            (order[stops[p] : stops[p + 1]], np.flatnonzero(full[:, p]), np.flatnonzero(near[:, p]))
            for p in np.flatnonzero(np.diff(stops))
        )
    for which, covering, meeting in groups:
        step = max(1, BATCH // len(which))
        for at in range(0, len(covering), step):
            some = rank[covering[at : at + step]]
            zeros = None if metres is None else np.zeros(len(some) * len(which))
            yield np.tile(which, len(some)), np.repeat(some, len(which)), zeros
        px, py = x[which], y[which]
        step = max(1, ELEMENTS // len(which))
        compared = meeting[few[rank[meeting]]]
        for at in range(0, len(compared), step):
            some = compared[at : at + step]
            i, j, away = _compared(px, py, lines[:, :, some], ranked[some], metres)
            yield which[j], rank[some[i]], away
        for area in rank[meeting[~few[rank[meeting]]]]:
            own = edges[starts[area] : starts[area] + counts[area]]
            for at in range(0, len(which), max(1, PAIRS_OF_EDGES // len(own))):
                portion = which[at : at + max(1, PAIRS_OF_EDGES // len(own))]
                hit, away = _of_one(x[portion], y[portion], own, metres)
                yield portion[hit], np.full(np.count_nonzero(hit), area), away


def _of_one(x: np.ndarray, y: np.ndarray, edges: np.ndarray, metres: float | None) -> tuple[np.ndarray, np.ndarray | None]:
    """Which points an area of many edges holds or is near to, and the distances of these."""
    lines = np.tile(edges, (len(x), 1)).T
    lines = np.where(np.isinf(lines).any(axis=0), np.nan, lines)
    counts = np.full(len(x), len(edges))
    with np.errstate(all="ignore"):
        if metres is None:
            starts = np.cumsum(counts) - counts
            return _inside((np.repeat(x, counts), np.repeat(y, counts)), lines, starts), None
        away = nearest_metres(x, y, counts, lines)
        hit = away <= metres
    return hit, away[hit]


def _compared(x: np.ndarray, y: np.ndarray, lines: np.ndarray, counts: np.ndarray, metres: float | None) -> Found:
    """Numbers of areas and points of the pairs that hit, of all areas (by falling number of edges) with all points."""
    shape = (len(counts), len(x))
    odd, on_edge = np.zeros(shape, bool), np.zeros(shape, bool)
    measured = metres is not None
    with np.errstate(all="ignore"):
        if measured:
            across, along = _metres_per_degree(y)
            ratio = np.maximum(across / along, 1e-9)
            best, best_x, best_y = np.full(shape, np.inf), np.zeros(shape), np.zeros(shape)
        for k in range(int(counts[0]) if len(counts) else 0):
            m = int(np.searchsorted(-counts, -k))
            x1, y1, x2, y2 = lines[k, :, :m, None]
            ex, ey, ox, oy = x2 - x1, y2 - y1, x - x1, y - y1
            above1, above2 = y1 > y, y2 > y
            side = ex * oy
            side -= ox * ey
            odd[:m] ^= (above1 != above2) & ((ey > 0) == (side > 0))
            straight = side == 0
            if straight.any():
                level = ~(above1 & above2) & ~((y1 < y) & (y2 < y))
                on_edge[:m] |= straight & level & ((x1 <= x) & (x <= x2) | (x2 <= x) & (x <= x1))
            if measured:
                ex = ex * ratio
                ox *= ratio
                length = ex * ex
                length += ey * ey
                dot = ox * ex
                dot += oy * ey
                # the same as 0 up to the start and 1 from the end on; an edge without length counts as its start
                share = np.where(dot <= 0, 0.0, np.where(dot >= length, 1.0, dot / length))
                dx = np.subtract(share * ex, ox, out=ex)
                dy = np.subtract(np.multiply(share, ey, out=share), oy, out=share)
                d2 = dx * dx
                d2 += dy * dy
                # of several equally near the first by place
                dx /= ratio
                dx += x
                dy += y
                nearer = d2 < best[:m]
                tied = np.flatnonzero(d2 == best[:m])
                if len(tied):
                    bx, by, qx, qy = best_x[:m].reshape(-1)[tied], best_y[:m].reshape(-1)[tied], dx.reshape(-1)[tied], dy.reshape(-1)[tied]
                    nearer.reshape(-1)[tied] = (qx < bx) | ((qx == bx) & (qy < by))
                nearer |= np.isnan(d2)
                np.copyto(best[:m], d2, where=nearer)
                np.copyto(best_x[:m], dx, where=nearer)
                np.copyto(best_y[:m], dy, where=nearer)
        odd &= ~on_edge
        if not measured:
            i, j = np.nonzero(odd)
            return i, j, None
        # a bound that surely holds, so that metres are worked out for few others
        plane = np.inf if metres > 10_000 or np.abs(y).max() > 80 else (1.05 * metres / 110_500.0) ** 2
        i, j = np.nonzero(odd | (best <= plane))
        px, py, qx, qy = x[j], y[j], best_x[i, j], best_y[i, j]
        across, along = _metres_per_degree((py + qy) / 2.0)
        away_x, away_y = (qx - px) * across, (qy - py) * along
        away = np.where(odd[i, j], 0.0, np.sqrt(away_x * away_x + away_y * away_y))
        hit = away <= metres
    return i[hit], j[hit], away[hit]


@dataclass(frozen=True)
class _Outlines:
    """Areas of one cell with their edges and first vertices, by number; what an area has none of is NaN."""

    box: list[np.ndarray]
    edges: np.ndarray
    bounds: np.ndarray
    vertices: np.ndarray

    @classmethod
    def of(cls, rows: pa.StructArray) -> _Outlines:
        edges = _padded(*_unpacked(rows.field(4), 4), len(rows))
        bounds = np.stack([
            np.fmin(edges[:, 0], edges[:, 2]), np.fmin(edges[:, 1], edges[:, 3]),
            np.fmax(edges[:, 0], edges[:, 2]), np.fmax(edges[:, 1], edges[:, 3])], axis=1)
        return cls([_numbers(rows.field(c)) for c in range(4)], edges, bounds, _padded(*_unpacked(rows.field(5), 2), len(rows)))


def _padded(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    counts = np.bincount(owner, minlength=n)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = np.full((int(counts.max(initial=0)), values.shape[1], n), np.nan)
    out[number, :, owner] = values
    return out


def touching_areas(left: pa.StructArray, right: pa.StructArray) -> Iterator[Found]:
    """Places of the areas of one cell that share a point, of pairs whose common box has its lower left corner in the cell.

    Both sides start with the bounds, the edges and the first vertices of the rings as :func:`packed` gives them, the side of
    the cell and its numbers.
    """
    a, b = _Outlines.of(left), _Outlines.of(right)
    side, cx, cy = (left.field(c)[0].as_py() for c in range(6, 9))
    # a common box is little work, and few pairs are left of many
    step = max(1, 16 * ELEMENTS // len(right))
    with np.errstate(all="ignore"):
        for at in range(0, len(left), step):
            lx0, ly0, lx1, ly1 = (v[at : at + step, None] for v in a.box)
            rx0, ry0, rx1, ry1 = b.box
            x0, y0, x1, y1 = np.maximum(lx0, rx0), np.maximum(ly0, ry0), np.minimum(lx1, rx1), np.minimum(ly1, ry1)
            here = (x0 <= x1) & (y0 <= y1)
            # cells of a power of two have exact bounds
            here &= (x0 >= cx * side) & (x0 < (cx + 1) * side) & (y0 >= cy * side) & (y0 < (cy + 1) * side)
            i, j = np.nonzero(here)
            hit = _touching(a, b, i + at, j, [v[i, j] for v in (x0, y0, x1, y1)])
            yield i[hit] + at, j[hit], None


def _touching(a: _Outlines, b: _Outlines, i: np.ndarray, j: np.ndarray, box: list[np.ndarray]) -> np.ndarray:
    """Which pairs share a point: edges meet, or a ring of one lies inside the other."""
    hit = np.zeros(len(i), bool)
    for p in range(len(a.edges)):
        open_ = np.flatnonzero(~hit)
        if not len(open_):
            return hit
        x0, y0, x1, y1 = (v[open_] for v in box)
        e0, f0, e1, f1 = (v[i[open_]] for v in a.bounds[p])
        # only edges that reach into the common box can meet
        reach = (e0 <= x1) & (e1 >= x0) & (f0 <= y1) & (f1 >= y0)
        open_, e0, f0, e1, f1 = (v[reach] for v in (open_, e0, f0, e1, f1))
        for q in range(len(b.edges)):
            if not len(open_):
                break
            g0, h0, g1, h1 = (v[j[open_]] for v in b.bounds[q])
            some = np.flatnonzero((e0 <= g1) & (g0 <= e1) & (f0 <= h1) & (h0 <= f1))
            if not len(some):
                continue
            ax1, ay1, ax2, ay2 = (v[i[open_[some]]] for v in a.edges[p])
            bx1, by1, bx2, by2 = (v[j[open_[some]]] for v in b.edges[q])
            touch = np.sign(_turn(ax1, ay1, ax2, ay2, bx1, by1)) * np.sign(_turn(ax1, ay1, ax2, ay2, bx2, by2)) <= 0
            touch &= np.sign(_turn(bx1, by1, bx2, by2, ax1, ay1)) * np.sign(_turn(bx1, by1, bx2, by2, ax2, ay2)) <= 0
            if touch.any():
                hit[open_[some[touch]]] = True
                rest = np.ones(len(open_), bool)
                rest[some[touch]] = False
                open_, e0, f0, e1, f1 = (v[rest] for v in (open_, e0, f0, e1, f1))
    for mine, own, yours, other in ((a, i, b, j), (b, j, a, i)):
        for p in range(len(mine.vertices)):
            open_ = np.flatnonzero(~hit)
            x, y = (v[own[open_]] for v in mine.vertices[p])
            known = ~np.isnan(x)
            hit[open_[known][_within(x[known], y[known], yours.edges, other[open_[known]])]] = True
    return hit


def _within(x: np.ndarray, y: np.ndarray, edges: np.ndarray, area: np.ndarray) -> np.ndarray:
    """Whether each point lies strictly inside its area, by even-odd over the edges."""
    odd, on_edge = np.zeros(len(x), bool), np.zeros(len(x), bool)
    for lines in edges:
        x1, y1, x2, y2 = (v[area] for v in lines)
        known = ~np.isnan(x1 + y1 + x2 + y2)
        side = _turn(x1, y1, x2, y2, x, y)
        level = known & ~((y1 > y) & (y2 > y)) & ~((y1 < y) & (y2 < y))
        on_edge |= level & (side == 0) & ((x1 <= x) & (x <= x2) | (x2 <= x) & (x <= x1))
        odd ^= level & ((y1 > y) != (y2 > y)) & ((y2 > y1) == (side > 0))
    return odd & ~on_edge
