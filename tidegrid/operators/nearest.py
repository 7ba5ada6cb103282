"""The nearest area of every point, exactly, without pairing all points with all areas.

An area a point lies in is found by the spatial join. For the others the nearest edge decides,
so the search runs over single edges; an area with very many vertices is no burden.

Points are summed up by grid cell, and edges are listed under the cells they run through, at
several cell sizes. A cell looks around itself at every size; the best edge seen bounds the
distance of all its points. Cells far from every edge are put together in larger ones, as from
afar they all see the same edges. Edges that can beat the bound lie in the eight neighbours of
the cell size just wider than it, or in the cell itself. All of these are equi-joins on cell
numbers. What is left is joined to the points, and only those distances are computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geodesy import metres_per_degree_lat, metres_per_degree_lon
from tidegrid.functions.geometry import edges_of
from tidegrid.operators.edgewise import PARTS
from tidegrid.operators.grid import BROADCAST_BYTES, AreaIndex, cell_no, index_areas, power_of_two, with_bounds
from tidegrid.operators.skew import meet
from tidegrid.operators.spatial import flag_index, within_join
from tidegrid.session import materialise

WORLD_SIDE = 512.0
FINEST_SIDE = 2.0**-20
LOOK_STEP = 2
# a cell this many times smaller than its distance is merged into a larger one
FAR = 8
# fewer points than this in the average cell, and cells are made wider, at most this often
POINTS_PER_CELL = 16
WIDEN = 2
CELLS_PER_TASK = 50_000
PART_BITS = PARTS.bit_length() - 1

_EDGE = ["x1", "y1", "x2", "y2"]


_SCALES = ["_low", "_high", "_kx0", "_kx1", "_ky0", "_ky1", "_stretch"]


def _with_scales(cells: DataFrame, reach_deg: str) -> DataFrame:
    """Adds the least and greatest metres per degree within ``reach_deg`` of latitude of a cell.

    The cell is ``_cx``, ``_cy`` with side ``_s``.
    """
    wide = cells.selectExpr(
        "*",
        f"greatest(_cy * _s - {reach_deg}, -90D) AS _low",
        f"least((_cy + 1) * _s + {reach_deg}, 90D) AS _high",
    ).selectExpr(
        "*",
        "least(greatest(abs(_low), abs(_high)), 90D) AS _far",
        "CASE WHEN _low <= 0 AND _high >= 0 THEN 0D ELSE least(abs(_low), abs(_high), 90D) END AS _near",
    )
    # a degree of longitude is shortest at the far latitude, one of latitude at the near one
    return wide.selectExpr(
        *cells.columns, "_low", "_high",
        f"{metres_per_degree_lon('_far')} AS _kx0", f"{metres_per_degree_lon('_near')} AS _kx1",
        f"{metres_per_degree_lat('_near')} AS _ky0", f"{metres_per_degree_lat('_far')} AS _ky1",
    ).selectExpr(
        "*",
        "greatest(coalesce(_kx1 / nullif(_kx0, 0D), double('Infinity')), _ky1 / _ky0) AS _stretch",
    )


# No point of the cell is farther than this from the edge. The start of the edge is a point of the
# area: measured from the farthest corner, allowing for the change of scale between the latitudes
# the scales were taken for. Never null, which spares the optimizer a second evaluation.
_FX = "(greatest(abs(x1 - _cx * _s), abs(x1 - (_cx + 1) * _s)) * _kx1)"
_FY = "(greatest(abs(y1 - _cy * _s), abs(y1 - (_cy + 1) * _s)) * _ky1)"
_MOST = (
    f"coalesce(CASE WHEN y1 BETWEEN _low AND _high THEN sqrt({_FX} * {_FX} + {_FY} * {_FY}) * _stretch END, "
    "double('Infinity'))"
)
# No point of the edge within the latitudes of the scales is nearer than this to the cell.
_GX = "(greatest(least(x1, x2) - (_cx + 1) * _s, _cx * _s - greatest(x1, x2), 0D) * _kx0)"
_GY = "(greatest(least(y1, y2) - (_cy + 1) * _s, _cy * _s - greatest(y1, y2), 0D) * _ky0)"
_LEAST = f"(sqrt({_GX} * {_GX} + {_GY} * {_GY}) * (1D - 1e-9D))"


def _flat_edges(areas: DataFrame, area_id: str) -> DataFrame:
    """The edges of areas, a row each with the area id; edges in this form stay as they are."""
    if "ring" not in areas.columns:
        return areas.select(area_id, *_EDGE)
    return areas.selectExpr(f"`{area_id}`", f"inline({edges_of('ring')}) AS (x1, y1, x2, y2)")


def _finest_cells(areas: DataFrame, area_id: str, side: float) -> DataFrame:
    """Edges under every cell of one size they may run through: ``_ux, _uy``, the area id, the edge, and where it runs in its column."""
    edges = _flat_edges(areas, area_id)
    slack = "1e-6D"
    in_columns = edges.selectExpr(
        "*", f"(y2 - y1) / nullif(x2 - x1, 0D) AS slope",
        f"explode(sequence(floor(least(x1, x2) / {side!r}D), floor(greatest(x1, x2) / {side!r}D))) AS c",
    ).selectExpr(
        "*", f"floor(least(x1, x2) / {side!r}D) AS first_ux",
        f"greatest(least(x1, x2), (c - {slack}) * {side!r}D) AS xa",
        f"least(greatest(x1, x2), (c + 1 + {slack}) * {side!r}D) AS xb",
        # the column before
        f"greatest(least(x1, x2), (c - 1 - {slack}) * {side!r}D) AS xp",
        f"least(greatest(x1, x2), (c + {slack}) * {side!r}D) AS xq",
    ).selectExpr(
        f"`{area_id}`", *_EDGE, "c", "first_ux",
        "coalesce(y1 + slope * (xa - x1), y1) AS ya", "coalesce(y1 + slope * (xb - x1), y2) AS yb",
        "y1 + slope * (xp - x1) AS yp", "y1 + slope * (xq - x1) AS yq",
    ).selectExpr(
        f"`{area_id}`", *_EDGE, "c AS _ux", "first_ux",
        f"floor(least(ya, yb) / {side!r}D - {slack}) AS first_uy", f"floor(greatest(ya, yb) / {side!r}D + {slack}) AS last_uy",
        f"floor(least(yp, yq) / {side!r}D - {slack}) AS before_uy", f"floor(greatest(yp, yq) / {side!r}D + {slack}) AS until_uy",
    )
    return in_columns.selectExpr("*", "explode(sequence(first_uy, last_uy)) AS _uy")


def _listed_edges(areas: DataFrame, area_id: str, side: float, bits: list[int]) -> DataFrame:
    """Edges under every cell they may run through: ``_bits, _ux, _uy``, the area id, the edge."""
    finest = _finest_cells(areas, area_id, side)
    # a wider cell comes from the first finest cell of the edge in it; what several columns give is told by the distinct
    top = bits[-1]
    return finest.selectExpr(
        f"`{area_id}`", *_EDGE, "_ux AS ux", "_uy AS uy",
        f"""explode(sequence(0, least(
            CASE WHEN _uy = first_uy THEN {top} ELSE {_halvings('_uy', top)} END,
            CASE WHEN _ux = first_ux OR NOT coalesce(_uy BETWEEN before_uy AND until_uy, false) THEN {top}
                ELSE {_halvings('_ux', top)} END))) AS _bits""",
    ).selectExpr(
        f"`{area_id}`", *_EDGE, "_bits", "shiftright(ux, _bits) AS _ux", "shiftright(uy, _bits) AS _uy"
    ).distinct()


def _open_edges(areas: DataFrame, index: AreaIndex, area_id: str) -> DataFrame:
    """Edges of indexed areas that may be nearest to a point in none of them, a row each.

    The way from such a point into an area leads over the outline of this area, which is nearer than what lies inside. So edges are
    left out that run through parts of cells only that are wholly inside some area: with areas upon areas, nearly all.
    """
    edges = _flat_edges(with_bounds(areas.select(area_id, "ring")), area_id)
    known = " AND ".join(f"{c} IS NOT NULL" for c in _EDGE)
    cores = areas.sparkSession.sparkContext.defaultParallelism
    for level in index.levels:
        covered = materialise(
            index.cells.filter(f"_level = {level}").groupBy("_cx", "_cy").agg(F.expr("bit_or(_full) AS _covered"))
            .filter("_covered <> 0"), "covered-parts")
        cells = covered.count()
        if not cells:
            continue
        # each edge is about to become many rows, whatever the size of the files it came from
        whole = edges.filter(known).repartition(cores, *_EDGE)
        listed = _finest_cells(whole, area_id, index.level_side(level) / PARTS).selectExpr(
            f"`{area_id}`", *_EDGE, f"shiftright(_ux, {PART_BITS}) AS _cx", f"shiftright(_uy, {PART_BITS}) AS _cy",
            f"CAST({PARTS} * (_ux & {PARTS - 1}) + (_uy & {PARTS - 1}) AS INT) AS _part")
        seen = meet(listed, covered, ["_cx", "_cy"], _EDGE, 32 * cells <= index.broadcast_bytes, "left")
        still = seen.filter("_covered IS NULL OR getbit(_covered, _part) = 0").select(area_id, *_EDGE).distinct()
        edges = materialise(still.unionByName(edges.filter(f"NOT ({known})")), "open-edges")
    return edges


def _halvings(number: str, most: int) -> str:
    """How often a cell number can be halved, as SQL text."""
    return f"(CASE WHEN {number} = 0 THEN {most} ELSE least(CAST(round(log2({number} & -{number})) AS INT), {most}) END)"


def _around(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Each row once for its cell (_ux, _uy) and for each of the eight cells around."""
    return cells.selectExpr(
        *columns, "_uy", "explode(array(_ux - 1, _ux, _ux + 1)) AS _ux"
    ).selectExpr(*columns, "_ux", "explode(array(_uy - 1, _uy, _uy + 1)) AS _uy")


def _cell_side(edges: DataFrame) -> float:
    """About one edge per cell where edges are spread out, about eight along a fine outline."""
    middles = edges.selectExpr(
        "count(*) AS n",
        "percentile_approx((x1 + x2) / 2D, array(0.05D, 0.95D)) AS px",
        "percentile_approx((y1 + y2) / 2D, array(0.05D, 0.95D)) AS py",
        "percentile_approx(greatest(abs(x2 - x1), abs(y2 - y1)), 0.5) AS len",
    ).first()
    if not middles["n"]:
        return 1.0
    (x0, x1), (y0, y1) = middles["px"], middles["py"]
    spaced = ((x1 - x0) * (y1 - y0) / (0.81 * middles["n"])) ** 0.5
    sizes = [v for v in (spaced, 8 * middles["len"]) if v > 0]
    return max(power_of_two(min(sizes, default=1.0)), FINEST_SIDE)


def candidate_edges(
    points: DataFrame, areas: DataFrame, area_id: str, broadcast_bytes: int = BROADCAST_BYTES
) -> tuple[DataFrame, DataFrame, float]:
    """Which edges may be nearest where, of areas or of edges in rows (``_flat_edges``).

    Returns ``(leaves, cells, side)``: ``leaves`` has ``_bits, _cx, _cy``, the area id and the edge
    for cells of side ``side * 2**_bits``; ``cells`` gives for each finest cell holding points the
    ``_bits`` of the leaf that covers it.
    """
    edges = _flat_edges(with_bounds(areas.select(area_id, "ring")) if "ring" in areas.columns else areas, area_id)
    side = _cell_side(edges)
    cells = materialise(
        points.selectExpr(f"{cell_no('lon', side)} AS _cx", f"{cell_no('lat', side)} AS _cy")
        .filter("_cx IS NOT NULL AND _cy IS NOT NULL")
        .groupBy("_cx", "_cy")
        .agg(F.expr("count(*) AS _points")),
        "point-cells",
    )
    levels = range(WIDEN + 1)
    seen = cells.selectExpr(
        "sum(_points) AS points", "count(*) AS n",
        *[f"approx_count_distinct(struct(shiftright(_cx, {b}), shiftright(_cy, {b}))) AS n{b}" for b in levels],
    ).first()
    widen = next((b for b in levels if (seen["points"] or 0) >= POINTS_PER_CELL * seen[f"n{b}"]), WIDEN)
    side *= 2**widen
    bits = [0]
    while side * 2 ** bits[-1] < WORLD_SIDE:
        bits.append(bits[-1] + 1)

    # each cell is about to become some hundred rows: cut them finer than their size suggests, by the
    # key the steps below group by, so that they need no shuffle of their own
    cores = points.sparkSession.sparkContext.defaultParallelism
    parts = max(min(cores, -(-seen["n"] // 8)), -(-seen["n"] // CELLS_PER_TASK), 1)
    cells = (
        cells.selectExpr(f"shiftright(_cx, {widen}) AS _cx", f"shiftright(_cy, {widen}) AS _cy")
        .repartition(parts, "_cx", "_cy")
        .distinct()
    )
    listed = materialise(_listed_edges(edges, area_id, side, bits), "listed-edges")
    small = listed.count() * 80 <= broadcast_bytes
    at = ["_bits", "_ux", "_uy"]

    # 1. a bound for every cell, from one edge of each cell seen around it at several sizes
    look_bits = sorted({*bits[::LOOK_STEP], bits[-1]})
    one_each = listed.filter(F.col("_bits").isin(look_bits)).groupBy(*at).agg(F.expr("min(struct(y1, x1)) AS v"))
    places = ", ".join(
        f"struct({b} AS _bits, shiftright(_cx, {b}) AS _ux, shiftright(_cy, {b}) AS _uy)" for b in look_bits
    )
    looks = _around(
        cells.selectExpr("_cx", "_cy", f"inline(array({places})) AS (_bits, _ux, _uy)"),
        ["_cx", "_cy", "_bits"],
    )
    found = meet(looks, one_each, at, ["_cx", "_cy"], small).selectExpr(
        "_cx", "_cy", f"{side!r}D AS _s", "v.x1 AS x1", "v.y1 AS y1"
    )
    bound = (
        _with_scales(found, "greatest(abs(y1 - _cy * _s), _s)")
        .selectExpr("_cx", "_cy", f"{_MOST} AS _most")
        .groupBy("_cx", "_cy")
        .agg(F.expr("min(_most) AS _best"))
    )
    own = f"CAST(floor(log2(greatest(_best / 111320D / {FAR * side!r}D, 1D))) AS INT)"
    bound = materialise(bound.selectExpr("*", f"least({own}, {bits[-1]}) AS _bits"), "cell-bounds")

    # 2. the edges within that bound, looked up at the cell size just wider than it
    merged = (
        bound.selectExpr("_bits", "shiftright(_cx, _bits) AS _cx", "shiftright(_cy, _bits) AS _cy", "_best")
        .groupBy("_bits", "_cx", "_cy")
        .agg(F.expr("max(_best) AS _best"))
        .selectExpr("*", f"{side!r}D * pow(2D, _bits) AS _s")
    )
    reach_y = f"(_best / {110500.0!r}D)"
    wide_enough = "CASE " + " ".join(
        f"WHEN 1.001D * greatest({reach_y}, coalesce(_best / nullif(_kx0, 0D), 1000D)) <= {side * 2**b!r}D THEN {b}"
        for b in bits
    ) + f" ELSE {bits[-1]} END"
    cell = ["_own", "_cx", "_cy", "_s", "_best", *_SCALES]
    windows = _around(
        _with_scales(merged, reach_y)
        .selectExpr("_bits AS _own", *cell[1:], f"greatest({wide_enough}, _bits) AS _bits")
        .selectExpr(
            "*", "shiftright(_cx, _bits - _own) AS _ux", "shiftright(_cy, _bits - _own) AS _uy"
        ),
        [*cell, "_bits"],
    )
    near = materialise(
        meet(windows, listed, at, ["_own", "_cx", "_cy"], small)
        .filter(f"{_LEAST} <= _best")
        .selectExpr(*[c for c in cell if c != "_best"], f"`{area_id}`", *_EDGE, f"{_MOST} AS _most"),
        "near-edges",
    )

    # 3. a tighter bound from all of these
    best = near.groupBy("_own", "_cx", "_cy").agg(F.expr("min(_most) AS _best"))
    kept = near.join(best, ["_own", "_cx", "_cy"]).filter(f"{_LEAST} <= _best")
    leaves = kept.selectExpr("_own AS _bits", "_cx", "_cy", f"`{area_id}`", *_EDGE).distinct()
    return leaves, bound.select("_cx", "_cy", "_bits"), side


def _edge_metres(pairs: DataFrame, columns: list[str]) -> DataFrame:
    """``distance_m`` from (lon, lat) to the edge (x1, y1, x2, y2), for each row."""
    relative = pairs.selectExpr(
        "*",
        f"greatest({metres_per_degree_lon('lat')} / {metres_per_degree_lat('lat')}, 1e-9D) AS _ratio",
    ).selectExpr(
        "*",
        "(x2 - x1) * _ratio AS _ex", "y2 - y1 AS _ey", "(lon - x1) * _ratio AS _px", "lat - y1 AS _py",
    ).selectExpr(
        "*",
        """least(greatest(coalesce((_px * _ex + _py * _ey) / nullif(_ex * _ex + _ey * _ey, 0D), 0D),
            0D), 1D) AS _t""",
    ).selectExpr(
        "*",
        "(_t * _ex - _px) / _ratio AS _dx", "_t * _ey - _py AS _dy",
    ).selectExpr("*", "lat + _dy / 2D AS _mid")
    return relative.selectExpr(
        *columns,
        f"sqrt(pow(_dx * {metres_per_degree_lon('_mid')}, 2D) + "
        f"pow(_dy * {metres_per_degree_lat('_mid')}, 2D)) AS distance_m",
    )


def nearest_pairs(
    points: DataFrame,
    areas: DataFrame,
    area_id: str = "area_id",
    row_id: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Points (with ``lon``, ``lat``) with areas that may be nearest, and ``distance_m``.

    A point may have several rows for one area; the row with the least distance of all is
    its true distance, 0 inside an area.
    """
    inside = within_join(points, areas.select(area_id, "ring"), "inner", [area_id], row_id, broadcast_bytes)
    inside = inside.selectExpr(*points.columns, f"`{area_id}`", "0D AS distance_m")
    return _edge_pairs(points, areas, area_id, row_id, broadcast_bytes).unionByName(inside)


def _edge_pairs(
    points: DataFrame, areas: DataFrame, area_id: str, row_id: list[str] | None, broadcast_bytes: int
) -> DataFrame:
    """Points with the edges that may be nearest, and ``distance_m`` to each, whether or not an area contains them."""
    found, cells, side = candidate_edges(points, areas, area_id, broadcast_bytes)
    leaves = materialise(found, "nearest-edges")
    stats = leaves.selectExpr("count(*) * 64 AS bytes", "sort_array(collect_set(_bits)) AS bits").first()
    lon, lat = cell_no("lon", side), cell_no("lat", side)
    if stats["bytes"] <= broadcast_bytes:
        # a point looks itself up at every size of leaf in use; one found at a size that is not its
        # own brings edges that do not matter, but none is missed
        places = ", ".join(
            f"struct({b} AS _bits, shiftright({lon}, {b}) AS _cx, shiftright({lat}, {b}) AS _cy)"
            for b in stats["bits"] or [0]
        )
        placed = points.selectExpr("*", f"inline(array({places})) AS (_bits, _cx, _cy)")
        joined = placed.join(F.broadcast(leaves), ["_bits", "_cx", "_cy"])
    else:
        # too much to broadcast: give each finest cell its leaf's edges, then shuffle by those
        by_leaf = leaves.withColumnsRenamed({"_cx": "_ux", "_cy": "_uy"})
        fine = cells.selectExpr(
            "_cx", "_cy", "_bits", "shiftright(_cx, _bits) AS _ux", "shiftright(_cy, _bits) AS _uy"
        )
        fine = meet(fine, by_leaf, ["_bits", "_ux", "_uy"], ["_cx", "_cy"], False)
        fine = fine.select("_cx", "_cy", area_id, *_EDGE)
        placed = points.selectExpr("*", f"{lon} AS _cx", f"{lat} AS _cy")
        joined = meet(placed, fine, ["_cx", "_cy"], row_id or points.columns, False)
    return _edge_metres(joined, [*points.columns, f"`{area_id}`"])


def min_distance(
    points: DataFrame,
    areas: DataFrame,
    keys: list[str],
    area_id: str = "area_id",
    row_id: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The least distance per ``keys``, in metres, as ``min_distance_m``.

    Points in some area are told by a flag, however many areas that are; only the others look for edges, and only for those
    that do not run inside other areas.
    """
    index = index_areas(areas, [area_id], broadcast_bytes=broadcast_bytes)
    flagged = materialise(
        flag_index(points.select(*keys, "lon", "lat"), index, "_within", row_id=row_id), "flagged-points")
    inside = flagged.filter("_within").select(*keys).withColumn("distance_m", F.lit(0.0))
    outside = flagged.filter("NOT _within").drop("_within")
    pairs = _edge_pairs(outside, _open_edges(areas, index, area_id), area_id, row_id, broadcast_bytes).select(*keys, "distance_m").unionByName(inside)
    return pairs.groupBy(*keys).agg(F.expr("min(distance_m) AS min_distance_m"))


def nearest_area(
    points: DataFrame, areas: DataFrame, keys: list[str], area_id: str = "area_id", **options
) -> DataFrame:
    """The nearest area per ``keys``; of several equally near, the one with the lowest id."""
    pairs = nearest_pairs(points.select(*keys, "lon", "lat"), areas, area_id, **options)
    best = pairs.groupBy(*keys).agg(F.expr(f"min(struct(distance_m, `{area_id}` AS id)) AS _best"))
    return best.selectExpr(*keys, f"_best.id AS `{area_id}`", "_best.distance_m AS min_distance_m")
