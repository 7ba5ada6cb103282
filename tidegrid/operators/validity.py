"""Which geometries can be used, and why the others cannot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import (
    edges_of,
    folds_back,
    has_breaks,
    point_problem,
    ring_bounds,
    ring_problem,
    rings_of,
    segments_cross,
    segments_touch,
    turn,
)
from tidegrid.operators.grid import BROADCAST_BYTES
from tidegrid.operators.skew import meet
from tidegrid.session import materialise


def check_points(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds ``invalid_reason`` (null if none) and ``geometry_valid``."""
    return points.selectExpr("*", f"{point_problem(lon, lat)} AS invalid_reason").selectExpr(
        "*", "invalid_reason IS NULL AS geometry_valid"
    )


def _ring_edges(rings: DataFrame) -> DataFrame:
    """Every edge of areas (``_ring_id``, ``ring``): ring ``k`` of part ``part``, edge ``i`` of the ``n`` of its ring.

    Directly repeated vertices are left out. ``bins`` by ``bins`` cells of ``w`` by ``h`` from (``x0``, ``y0``) cover the area,
    about one for each of its edges; ``several`` tells areas of more than one ring.
    """
    return (
        rings.selectExpr("_ring_id", f"{ring_bounds('ring')} AS b", "size(ring) AS total", f"{rings_of('ring')} AS rings")
        .selectExpr("_ring_id", "b", "CAST(ceil(sqrt(total)) AS BIGINT) AS bins", "size(rings) > 1 AS several",
                    "posexplode(rings) AS (k, r)")
        .selectExpr(
            "*", "filter(r.ring, (v, i) -> i = 0 OR v.x <> r.ring[greatest(i - 1, 0)].x OR v.y <> r.ring[greatest(i - 1, 0)].y) AS ring")
        .selectExpr(
            "_ring_id", "several", "k", "r.part AS part", "r.shell AS shell", "size(ring) - 1 AS n", "bins", "b.xmin AS x0", "b.ymin AS y0",
            "(b.xmax - b.xmin) / bins AS w", "(b.ymax - b.ymin) / bins AS h",
            f"posexplode({edges_of('ring')}) AS (i, e)",
        )
    )


def _bin_of(value: str) -> str:
    return f"greatest(least(floor({value}), bins - 1), 0L)"


_SLACK = "1e-6D"


#: More edges than this in a cell, and the cell gets a grid of its own.
CROWDED = 64
#: Grids within grids; each divides a crowded side by the root of the cell's edges. What still crowds a cell then shares a point.
DEEPEST = 6


def _under_cells(edges: DataFrame) -> DataFrame:
    """Edges under each cell they run through of the grid of their ``cell`` (``bins``, ``x0``, ``y0``, ``w``, ``h``).

    ``cell`` is then the finer one, with its corner in ``x0``, ``y0``.
    """
    first = _bin_of(f"(least(e.x1, e.x2) - x0) / w - {_SLACK}")
    last = _bin_of(f"(greatest(e.x1, e.x2) - x0) / w + {_SLACK}")
    # the part of an edge within one column of cells, with a little slack on either side
    parts = (
        edges.selectExpr("*", f"explode(sequence({first}, {last})) AS c")
        .selectExpr(
            "*",
            f"greatest(least(e.x1, e.x2), x0 + (c - {_SLACK}) * w) AS xa",
            f"least(greatest(e.x1, e.x2), x0 + (c + 1 + {_SLACK}) * w) AS xb",
            "(e.y2 - e.y1) / nullif(e.x2 - e.x1, 0D) AS slope",
        )
        .selectExpr(
            "*",
            "coalesce(e.y1 + slope * (xa - e.x1), e.y1) AS ya",
            "coalesce(e.y1 + slope * (xb - e.x1), e.y2) AS yb",
        )
    )
    bottom = _bin_of(f"(least(ya, yb) - y0) / h - {_SLACK}")
    top = _bin_of(f"(greatest(ya, yb) - y0) / h + {_SLACK}")
    # within a finer grid an edge may be above or below it in some column
    reaching = parts.filter(f"greatest(ya, yb) >= y0 - {_SLACK} * h AND least(ya, yb) <= y0 + (bins + {_SLACK}) * h")
    # cells of equal hash are compared together, which finds nothing that is not there
    return reaching.selectExpr("*", f"explode(sequence({bottom}, {top})) AS r").selectExpr(
        "_ring_id", "k", "n", "i", "e", "w", "h", "x0 + c * w AS x0", "y0 + r * h AS y0", "xxhash64(cell, c, r) AS cell")


def self_intersecting(rings: DataFrame, longest: int | None = None) -> DataFrame:
    """The ``_ring_id`` of areas with a ring that crosses, touches or retraces itself, or rings that cross each other.

    ``rings``: ``_ring_id``, ``ring``, closed rings with an area; ``longest`` the most vertices of any, if known. Edges are compared
    only where they share a cell of a grid laid over that area, about one cell per edge; a cell that many edges share
    gets a finer grid, so however unevenly an outline is drawn, it is neither held in one task nor compared edge by edge. Directly
    repeated vertices are allowed, and so are different rings that touch in single points.
    """
    start = _ring_edges(rings).selectExpr("_ring_id", "k", "n", "i", "e", "bins", "x0", "y0", "w", "h", "0L AS cell")
    binned = _under_cells(start)
    settled = None
    if longest is None:
        longest = rings.selectExpr("max(size(ring)) AS n").first()["n"] or 0
    for _ in range(DEEPEST if longest > CROWDED else 0):
        binned = materialise(binned, "edges-by-cell")
        counts = materialise(
            binned.groupBy("_ring_id", "cell").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") > CROWDED), "crowded-cells")
        crowded = counts.count()
        if not crowded:
            break
        told = meet(binned, counts, ["_ring_id", "cell"], ["_ring_id", "k", "i"], crowded * 128 <= BROADCAST_BYTES, "left")
        calm = told.filter("held IS NULL").drop("held")
        settled = calm if settled is None else settled.unionByName(calm)
        finer = told.filter("held IS NOT NULL").selectExpr(
            "_ring_id", "k", "n", "i", "e", "x0", "y0", "cell", "CAST(ceil(sqrt(held)) AS BIGINT) AS bins",
            "w / ceil(sqrt(held)) AS w", "h / ceil(sqrt(held)) AS h")
        binned = _under_cells(finer)
    binned = (binned if settled is None else settled.unionByName(binned)).select("_ring_id", "k", "n", "i", "e", "cell")
    other = binned.selectExpr("_ring_id AS id2", "k AS k2", "cell AS cell2", "i AS j", "e AS f")
    meets = f"""_ring_id = id2 AND cell = cell2 AND CASE
        WHEN k <> k2 THEN {segments_cross('e', 'f')}
        WHEN i = j THEN false
        WHEN j = (i + 1) % n THEN {folds_back('e', 'f')}
        WHEN i = (j + 1) % n THEN false
        ELSE {segments_touch('e', 'f')} END"""
    return binned.join(other, F.expr(meets), "left_semi").select("_ring_id").distinct()


def misplaced_rings(rings: DataFrame) -> DataFrame:
    """``_ring_id`` and ``_misplaced`` of areas of several rings with a hole outside its part or parts that overlap.

    The middle of every edge is a witness for its ring. Which other rings of the area hold it is told by even-odd over the
    edges in its strip of latitude, by an equi-join on area and strip. A hole lies in the outer ring of its part and in
    no other hole of it; an outer ring lies in an even number of rings of each other part. Rings must not cross.
    """
    edges = _ring_edges(rings).filter("several")
    strips = edges.selectExpr(
        "_ring_id", "k AS k2", "part AS part2", "shell AS shell2", "e AS f",
        f"explode(sequence({_bin_of(f'(least(e.y1, e.y2) - y0) / h - {_SLACK}')}, "
        f"{_bin_of(f'(greatest(e.y1, e.y2) - y0) / h + {_SLACK}')})) AS strip",
    )
    middle = "struct((e.x1 + e.x2) / 2D AS x, (e.y1 + e.y2) / 2D AS y)"
    witnesses = edges.selectExpr("_ring_id", "k", "i", "part", "shell", "y0", "h", "bins", f"{middle} AS m").selectExpr(
        "_ring_id", "k", "i", "part", "shell", "m", f"{_bin_of('(m.y - y0) / h')} AS strip")
    side = turn(("f.x1", "f.y1"), ("f.x2", "f.y2"), ("m.x", "m.y"))
    crossed = f"(f.y1 > m.y) <> (f.y2 > m.y) AND (f.y2 > f.y1) = ({side} > 0)"
    holding = (
        witnesses.join(strips, ["_ring_id", "strip"])
        .groupBy("_ring_id", "k", "i", "part", "shell", "k2", "part2", "shell2")
        .agg(F.expr(f"count_if({crossed}) % 2 = 1 AND k <> k2").alias("held"))
        .groupBy("_ring_id", "k", "i", "part", "shell", "part2")
        .agg(
            F.expr("count_if(held) % 2 = 1").alias("odd"),
            F.expr("count_if(held AND shell2) > 0").alias("in_shell"),
            F.expr("count_if(held AND NOT shell2) > 0").alias("in_hole"),
        )
    )
    # a witness without an edge of its own outer ring in its strip is outside of it
    judged = holding.groupBy("_ring_id", "k", "i", "shell").agg(
        F.expr("NOT shell AND NOT (bool_or(part = part2 AND in_shell) AND NOT bool_or(part = part2 AND in_hole))").alias("outside"),
        F.expr("shell AND bool_or(part <> part2 AND odd)").alias("overlaps"),
    )
    return judged.filter("outside OR overlaps").groupBy("_ring_id").agg(
        F.expr("CASE WHEN bool_or(outside) THEN 'hole_outside' ELSE 'parts_overlap' END").alias("_misplaced"))


def check_rings(areas: DataFrame) -> DataFrame:
    """Adds ``invalid_reason`` (null if none) and ``geometry_valid`` for a ``ring`` column, holes and parts included."""
    first_look = areas.selectExpr("*", f"{ring_problem('ring')} AS _problem").selectExpr(
        "*", "CASE WHEN _problem IS NULL THEN sha2(to_json(struct(ring)), 256) END AS _ring_id"
    )
    to_check = (
        first_look.filter("_ring_id IS NOT NULL")
        .groupBy("_ring_id")
        .agg(F.expr("any_value(ring) AS ring"))
    )
    to_check = materialise(to_check.withColumn("_several", F.expr(has_breaks("ring"))), "rings-to-check")
    seen = to_check.selectExpr("coalesce(bool_or(_several), false) AS several", "coalesce(max(size(ring)), 0) AS longest").first()
    crossed = self_intersecting(to_check, seen["longest"]).withColumn("_flaw", F.lit("self_intersection"))
    if seen["several"]:
        misplaced = misplaced_rings(to_check.filter("_several"))
        crossed = crossed.unionByName(misplaced.withColumnRenamed("_misplaced", "_flaw")).groupBy("_ring_id").agg(
            # rings that cross may seem misplaced as well
            F.max("_flaw").alias("_flaw"))
    crossed = materialise(crossed, "crossed-rings")
    small = crossed.count() * 128 <= BROADCAST_BYTES
    return (
        meet(first_look, crossed, ["_ring_id"], areas.columns, small, "left")
        .selectExpr(*areas.columns, "coalesce(_problem, _flaw) AS invalid_reason")
        .selectExpr("*", "invalid_reason IS NULL AS geometry_valid")
    )


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(usable, quarantined)``; the quarantined rows keep ``invalid_reason``."""
    return checked.filter("geometry_valid").drop("invalid_reason"), checked.filter("NOT geometry_valid")
