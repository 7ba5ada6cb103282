"""Joins between points and areas, and between areas."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.geometry import (
    edges_contain,
    edges_distance,
    edges_of,
    first_vertices,
    ring_contains,
    segments_touch,
)
from tidegrid.operators.blocks import meet_blocks, plan_blocks, points_with_areas, touching_areas
from tidegrid.operators.edgewise import held_by_bucket, metres_to_edges, packed, touching_pairs
from tidegrid.operators.grid import (
    BROADCAST_BYTES,
    LEVEL_RATIO,
    MASK_EDGES,
    AreaIndex,
    cell_no,
    index_areas,
    part_no,
    power_of_two,
    with_bounds,
)
from tidegrid.operators.skew import meet, pair_tasks, spread_hot_keys, spread_pairs
from tidegrid.session import materialise


class _Probe:
    """Points looking themselves up in an index, with the exact test for a candidate pair."""

    def __init__(self, index: AreaIndex, hit: str, lon: str, lat: str, row_id: list[str]):
        self.index, self.hit, self.lon, self.lat, self.row_id = index, hit, lon, lat, row_id

    def cell(self, level: int) -> tuple[str, str]:
        side = self.index.level_side(level)
        return cell_no(self.lon, side), cell_no(self.lat, side)

    def part(self, level: int) -> str:
        return part_no(self.lon, self.lat, self.index.level_side(level))

    def _meet(self, points: DataFrame, cells: DataFrame, keys: list[str], how: str) -> DataFrame:
        if self.index.small:
            cells = F.broadcast(cells)
        else:
            points, cells = spread_pairs(points, cells, keys, self.row_id)
            keys = [*keys, "_salt"]
        renamed = cells.withColumnsRenamed({k: f"{k}_c" for k in keys})
        condition = " AND ".join([f"{k} = {k}_c" for k in keys] + [f"({self.hit})"])
        return points.join(renamed, F.expr(condition), how)

    def at_level(self, points: DataFrame, level: int, how: str) -> DataFrame:
        cx, cy = self.cell(level)
        placed = points.selectExpr("*", f"{cx} AS _cx", f"{cy} AS _cy", f"{self.part(level)} AS _part")
        cells = self.index.cells.filter(f"_level = {level}").drop("_level")
        joined = self._meet(placed, cells, ["_cx", "_cy"], how)
        return joined.select(*points.columns) if how in ("left_semi", "left_anti") else joined

    def inner(self, points: DataFrame, how: str = "inner") -> DataFrame:
        if len(self.index.levels) == 1:
            return self.at_level(points, self.index.levels[0], how)
        places = ", ".join(
            "struct({} AS _level, {} AS _cx, {} AS _cy, {} AS _part)".format(level, *self.cell(level), self.part(level))
            for level in self.index.levels
        )
        placed = points.selectExpr("*", f"inline(array({places})) AS (_level, _cx, _cy, _part)")
        return self._meet(placed, self.index.cells, ["_level", "_cx", "_cy"], how)

    def blocks(self, points: DataFrame, metres: float | None = None) -> DataFrame | None:
        """What :meth:`inner` finds, within ``metres`` if given, with ``distance_m``, by blocks of pairs; none where these do not pay."""
        if points.isStreaming or self.index.small and metres is None:
            return None
        keys = ["_level", "_cx", "_cy"]
        places = ", ".join(
            "struct({} AS _level, {} AS _cx, {} AS _cy, {} AS _part)".format(level, *self.cell(level), self.part(level))
            for level in self.index.levels
        )
        placed = points.selectExpr(
            f"CAST(`{self.lon}` AS DOUBLE) AS _x", f"CAST(`{self.lat}` AS DOUBLE) AS _y",
            f"inline(array({places})) AS (_level, _cx, _cy, _part)", *[f"`{c}`" for c in points.columns])
        placed = placed.select("_x", "_y", "_part", *keys, *points.columns)
        weight = "greatest(1D, size(_edges) / 16D)"
        plan = plan_blocks(placed, self.index.cells, keys, right_weight=weight)
        if plan is None:
            return None
        columns = list(self.index.area_columns)
        cells = self.index.cells.withColumn("_lines", packed("_edges")).select("_full", "_near", "_lines", *keys, *columns)
        return meet_blocks(
            placed, cells, plan, (self.row_id, [*keys, *columns]), partial(points_with_areas, metres=metres),
            (points.columns, columns), None if metres is None else "distance_m")

    def without(self, points: DataFrame) -> DataFrame:
        for level in self.index.levels:
            points = self.at_level(points, level, "left_anti")
        return points

    def gathered(self, points: DataFrame) -> tuple[DataFrame, list[tuple[str, str]]]:
        """Points once each, with an array of the areas of their cell at each level and their part of it; the names of these columns.

        For small indexes: a broadcast look-up a level, so points run once, without a shuffle.
        """
        area = ", ".join(["_inside", "_edges", "_full", "_near", *[f"`{c}`" for c in self.index.area_columns]])
        columns, names = list(points.columns), []
        for level in self.index.levels:
            cx, cy = self.cell(level)
            name, part = f"_at{level}", f"_part{level}"
            cells = self.index.cells.filter(f"_level = {level}").groupBy("_cx", "_cy").agg(
                F.expr(f"collect_list(struct({area}))").alias(name)
            )
            before = [n for pair in names for n in pair]
            points = points.selectExpr(
                *[f"`{c}`" for c in [*columns, *before]], f"{cx} AS _cx", f"{cy} AS _cy", f"{self.part(level)} AS {part}")
            points = points.join(F.broadcast(cells), ["_cx", "_cy"], "left")
            names.append((name, part))
        return points.select(*columns, *[n for pair in names for n in pair]), names

    def hit_places(self, points: DataFrame) -> DataFrame:
        """Distinct coordinates inside some area, by one join over all levels, written once.

        Coordinates alone decide, so a place with a third of all points is looked up as one.
        """
        by_place = _Probe(self.index, self.hit, self.lon, self.lat, [self.lon, self.lat])
        places = by_place.inner(points.select(self.lon, self.lat).distinct(), "left_semi")
        return materialise(places.select(self.lon, self.lat).distinct(), "hit-places")


def join_index(
    points: DataFrame,
    index: AreaIndex,
    how: str = "left",
    lon: str = "lon",
    lat: str = "lat",
    row_id: list[str] | None = None,
) -> DataFrame:
    """Points joined to indexed areas that strictly contain them.

    ``how``: ``inner`` and ``left`` give one row per (point, area), ``left`` also keeps points
    in no area; ``semi`` gives points in at least one area, once each; ``anti`` the others.
    ``row_id`` names columns that tell points apart, for spreading hot cells; all columns
    if not given.
    """
    clash = set(points.columns) & set(index.area_columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    probe = _Probe(index, _holds("", "_part", lon, lat), lon, lat, row_id or points.columns)
    levels = index.levels
    out = [*points.columns, *index.area_columns]
    # a stream cannot be looked up beforehand
    by_place = len(levels) > 1 and not index.small and not points.isStreaming
    if how == "inner":
        met = probe.blocks(points)
        return (probe.inner(points) if met is None else met).select(*out)
    if how in ("semi", "anti"):
        if len(levels) == 1:
            return probe.at_level(points, levels[0], f"left_{how}")
        if how == "anti" and not index.small and not by_place:
            return probe.without(points)
        flagged = flag_index(points, index, "_hit", lon, lat, row_id)
        return flagged.filter("_hit" if how == "semi" else "NOT _hit").select(*points.columns)
    if how == "left":
        if len(levels) == 1:
            return probe.at_level(points, levels[0], "left").select(*out)
        if index.small:
            met, names = probe.gathered(points)
            area = ", ".join(f"_area.`{c}` AS `{c}`" for c in index.area_columns)
            holding = ", ".join(
                f"transform(filter(coalesce({n}, array()), _area -> {_holds('_area.', part, lon, lat)}), _area -> struct({area}))"
                for n, part in names
            )
            columns = ", ".join(f"`{c}`" for c in index.area_columns)
            return met.selectExpr(
                *[f"`{c}`" for c in points.columns], f"inline_outer(concat({holding})) AS ({columns})"
            )
        alone = join_index(points, index, "anti", lon, lat, row_id)
        met = probe.blocks(points)
        return (probe.inner(points) if met is None else met).select(*out).unionByName(alone, allowMissingColumns=True)
    raise ValueError(f"how must be inner, left, semi or anti, not {how!r}")


def _holds(area: str, part: str, lon: str, lat: str) -> str:
    """Whether the candidate of a cell (its columns behind the prefix ``area``) contains the point; edges are looked at last."""
    return (
        f"(CASE WHEN {area}_inside OR getbit({area}_full, {part}) = 1 THEN true WHEN getbit({area}_near, {part}) = 0 THEN false "
        f"ELSE {edges_contain(f'{area}_edges', lon, lat)} END)"
    )


def flag_index(
    points: DataFrame,
    index: AreaIndex,
    flag: str,
    lon: str = "lon",
    lat: str = "lat",
    row_id: list[str] | None = None,
) -> DataFrame:
    """Points once each, with a boolean ``flag``: whether at least one indexed area strictly contains them.

    Points run once: through broadcast look-ups of a small index, else through one join with the places
    that were hit. ``row_id`` as in :func:`join_index`.
    """
    if flag in points.columns:
        raise ValueError(f"there is a column {flag} already")
    probe = _Probe(index, _holds("", "_part", lon, lat), lon, lat, row_id or points.columns)
    columns = [f"`{c}`" for c in points.columns]
    if index.small:
        met, names = probe.gathered(points)
        hit = " OR ".join(f"coalesce(exists({n}, _area -> {_holds('_area.', part, lon, lat)}), false)" for n, part in names)
        return met.selectExpr(*columns, f"({hit}) AS `{flag}`")
    if points.isStreaming:
        # a level at a time: points that are hit leave the rest
        parts, rest = [], points
        for level in index.levels:
            parts.append(probe.at_level(rest, level, "left_semi").withColumn(flag, F.lit(True)))
            rest = probe.at_level(rest, level, "left_anti")
        return _union([*parts, rest.withColumn(flag, F.lit(False))])
    places = probe.hit_places(points)
    small = 64 * places.count() <= index.broadcast_bytes
    marked = meet(points, places.withColumn("_hit_place", F.lit(True)), [lon, lat], probe.row_id, small, "left")
    return marked.selectExpr(*columns, f"_hit_place IS NOT NULL AS `{flag}`")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def within_join(
    points: DataFrame,
    areas: DataFrame,
    how: str = "left",
    area_columns: list[str] | None = None,
    row_id: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    side: float | None = None,
) -> DataFrame:
    """:func:`join_index` on areas indexed for this one join."""
    columns = area_columns or [c for c in areas.columns if c != "ring"]
    index = index_areas(areas, columns, broadcast_bytes=broadcast_bytes, side=side)
    return join_index(points, index, how, row_id=row_id)


def points_per_area(points: DataFrame, index: AreaIndex, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``index.area_columns`` and ``n``, the points strictly inside, of areas that hold any; no pair of a point and an area is listed.

    Points are summed up by coordinates, then by the parts of their cells. An area takes the sums of the parts inside it, and
    only points in parts near its edges are compared with them, a batch of cells at a time. Cells with more than 1/1024 of the
    points, or of the areas, are split; cells are told apart by a hash of 64 bits.
    """
    probe = _Probe(index, "true", lon, lat, [lon, lat])
    keys, area_columns = ["_level", "_cx", "_cy"], list(index.area_columns)
    looks = ", ".join(
        "struct({} AS _level, {} AS _cx, {} AS _cy, {} AS _part)".format(level, *probe.cell(level), probe.part(level))
        for level in index.levels
    )
    once = points.groupBy(lon, lat).agg(F.count("*").alias("times"))
    placed = materialise(
        once.selectExpr(f"`{lon}` AS lon", f"`{lat}` AS lat", "times", f"inline(array({looks})) AS (_level, _cx, _cy, _part)")
        .filter("_cx IS NOT NULL AND _cy IS NOT NULL"), "points-by-part")
    cells = index.cells.withColumn("_lines", packed("_edges")).select(*keys, "_full", "_near", "_lines", *area_columns)
    tasks = pair_tasks(placed, cells, keys)
    placed, cells = spread_hot_keys(placed, cells, keys, ["lon", "lat"])
    placed, cells = placed.withColumnRenamed("_salt", "_piece"), cells.withColumnRenamed("_salt", "_piece")
    cells, placed = spread_hot_keys(cells, placed, [*keys, "_piece"], area_columns)
    cell = F.xxhash64(*keys, "_piece", "_salt")
    placed, cells = (
        df.withColumn("_cell", cell).withColumn("_bucket", F.pmod("_cell", F.lit(tasks))) for df in (placed, cells)
    )
    held = held_by_bucket(placed.select("_bucket", "_cell", "lon", "lat", "times", "_part"), cells, area_columns)
    return held.groupBy(*area_columns).agg(F.sum("n").alias("n"))


def contains_join(
    areas: DataFrame,
    points: DataFrame,
    how: str = "left",
    area_columns: list[str] | None = None,
    area_id: str = "area_id",
    row_id: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The same pairs seen from the areas; ``left`` also keeps areas holding no point, told without listing the pairs again."""
    columns = area_columns or [c for c in areas.columns if c != "ring"]
    index = index_areas(areas, columns, broadcast_bytes=broadcast_bytes)
    pairs = join_index(points, index, "inner", row_id=row_id)
    pairs = pairs.select(*columns, *points.columns)
    if how == "inner":
        return pairs
    if how != "left":
        raise ValueError(f"how must be inner or left, not {how!r}")
    hit_ids = points_per_area(points, index).select(area_id).distinct()
    empty = areas.select(*columns).join(hit_ids, area_id, "left_anti")
    return pairs.unionByName(empty, allowMissingColumns=True)


def within_distance_join(
    points: DataFrame,
    areas: DataFrame,
    metres: float,
    area_columns: list[str] | None = None,
    row_id: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Pairs of points and areas at most ``metres`` apart, with ``distance_m`` (0 inside)."""
    columns = area_columns or [c for c in areas.columns if c != "ring"]
    index = index_areas(areas, columns, margin_m=metres, broadcast_bytes=broadcast_bytes)
    within = "_inside OR getbit(_full, _part) = 1"
    # no part that is neither inside nor near an edge is within reach
    probe = _Probe(index, f"{within} OR getbit(_near, _part) = 1", "lon", "lat", row_id or points.columns)
    by_blocks = probe.blocks(points, float(metres))
    if by_blocks is not None:
        return by_blocks.select(*points.columns, *columns, "distance_m")
    few = f"size(_edges) <= {MASK_EDGES}"
    # lists of many edges stay single rows, the others go by batches; within an area neither is looked at
    met = probe.inner(points).selectExpr(
        *points.columns, *columns, f"CASE WHEN NOT ({within}) AND {few} THEN _edges END AS _few",
        f"CASE WHEN NOT ({within}) AND NOT {few} THEN _edges END AS _many",
    ).withColumn("_metres", metres_to_edges(F.col("lon").cast("double"), F.col("lat").cast("double"), "_few"))
    distance = f"CASE WHEN _many IS NULL THEN _metres ELSE {edges_distance('_many', 'lon', 'lat')} END"
    # written as a generator so that the distance is worked out once, not again for the filter
    near = f"filter(array(struct({distance} AS distance_m)), d -> d.distance_m <= {float(metres)!r}D)"
    return met.selectExpr(*points.columns, *columns, f"inline({near})")


#: Areas with more edges are not carried to every cell they are listed under.
CARRIED_EDGES = 64

#: Pairs of areas with more pairs of edges than this in their common box have them meet by cells of that box.
EDGE_PAIRS = 4096


def areas_intersect_join(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Pairs ``(left_id, right_id)`` of areas that share at least one point.

    Areas are listed under the cells of their bounds at their own level, and those of the other side
    at that level or a coarser one, by two joins: a pair meets at the coarser of its two levels. A pair
    that shares several cells is kept in the one holding the lower left corner of the common box. Areas of up to
    ``CARRIED_EDGES`` edges carry their outlines to these cells, so that a pair is looked at where it meets, by blocks of pairs
    where there are many, and nothing but the result is written. Pairs with a larger area, or one whose id comes twice, are written once with their common box,
    then get the edges that reach into it. Few edges are compared within the row; many are listed
    under the cells of a grid over the common box and meet there, as rows.
    """
    if left_id == right_id:
        raise ValueError("the two id columns need different names")
    boxes = {
        tag: materialise(with_bounds(df.selectExpr(f"`{i}` AS id", "ring")).filter("id IS NOT NULL"), "boxes")
        for tag, df, i in (("l", left, left_id), ("r", right, right_id))
    }
    edges = edges_of("ring")
    special = {
        tag: materialise(
            df.selectExpr("id", f"size({edges}) AS n").groupBy("id").agg(F.count("*").alias("areas"), F.max("n").alias("n"))
            .filter(f"areas > 1 OR n > {CARRIED_EDGES}").select("id"), "areas-apart")
        for tag, df in boxes.items()
    }
    apart = {tag: df.count() > 0 for tag, df in special.items()}
    plain = {tag: df.join(special[tag], "id", "left_anti") if apart[tag] else df for tag, df in boxes.items()}
    carried = {
        tag: materialise(
            df.withColumn("_edges", packed(F.expr(edges))).withColumn("_vertices", packed(F.expr(first_vertices("ring"))))
            .drop("ring"), "outlines")
        for tag, df in plain.items()
    }
    extent = "greatest(_xmax - _xmin, _ymax - _ymin)"
    stats = (
        boxes["l"].selectExpr(f"{extent} AS e", "size(ring) AS n", "'l' AS tag")
        .unionByName(boxes["r"].selectExpr(f"{extent} AS e", "size(ring) AS n", "'r' AS tag"))
        .selectExpr(
            "percentile_approx(e, 0.5) AS m", "max(e) AS top", "count_if(tag = 'l') AS l", "count_if(tag = 'r') AS r",
            "coalesce(sum(n) FILTER (WHERE tag = 'l'), 0) AS l_vertices", "coalesce(sum(n) FILTER (WHERE tag = 'r'), 0) AS r_vertices")
        .first()
    )
    # level n takes areas up to four of its cells wide
    sides = [power_of_two(stats["m"] or 0.0)]
    while 4 * sides[-1] < (stats["top"] or 0.0):
        sides.append(sides[-1] * LEVEL_RATIO)
    side_list = "array(" + ", ".join(f"{s!r}D" for s in sides) + ")"

    def listed(tag: str, df: DataFrame, levels: str) -> DataFrame:
        outline = [c for c in ("_edges", "_vertices") if c in df.columns]
        own = f"size(filter({side_list}, s -> 4 * s < {extent}))"
        return (
            df.selectExpr("id", "_xmin", "_ymin", "_xmax", "_ymax", *outline, f"{own} AS own")
            .selectExpr("*", f"explode({levels}) AS _level")
            .selectExpr("*", f"{side_list}[_level] AS _side")
            .selectExpr("*", "explode(sequence(floor(_xmin / _side), floor(_xmax / _side))) AS _cx")
            .selectExpr("*", "explode(sequence(floor(_ymin / _side), floor(_ymax / _side))) AS _cy")
            .selectExpr(
                "_level", "_cx", "_cy",
                f"struct({', '.join(['id', '_side AS side', '_xmin AS x0', '_ymin AS y0', '_xmax AS x1', '_ymax AS y1', *outline])}) AS {tag}",
            )
        )

    own_level, top = "array(own)", len(sides) - 1
    own_or_coarser = f"sequence(own, {top})"
    coarser = f"CASE WHEN own < {top} THEN sequence(own + 1, {top}) ELSE CAST(array() AS array<int>) END"
    keys = ["_level", "_cx", "_cy"]
    x0, y0 = "greatest(l.x0, r.x0)", "greatest(l.y0, r.y0)"
    x1, y1 = "least(l.x1, r.x1)", "least(l.y1, r.y1)"
    # an area has at most five cells a side at each level, of some 120 bytes and what it carries
    listed_bytes = {tag: 25 * len(sides) * (stats[tag] * 120 + 32 * stats[f"{tag}_vertices"]) for tag in "lr"}

    def meeting(l_areas: DataFrame, r_areas: DataFrame, l_levels: str, r_levels: str, *more: str) -> DataFrame:
        a, b, on = listed("l", l_areas, l_levels), listed("r", r_areas, r_levels), keys
        if min(listed_bytes.values()) > broadcast_bytes:
            a, b = spread_pairs(a, b, keys, ["l.id"])
            on = [*keys, "_salt"]
        elif listed_bytes["r"] <= listed_bytes["l"]:
            b = F.broadcast(b)
        else:
            a = F.broadcast(a)
        return a.join(b, on).filter(
            f"{x0} <= {x1} AND {y0} <= {y1} AND _cx = floor({x0} / l.side) AND _cy = floor({y0} / l.side)"
        ).selectExpr("l.id AS _lid", "r.id AS _rid", f"{x0} AS x0", f"{y0} AS y0", f"{x1} AS x1", f"{y1} AS y1", *more)

    def met_by(l_areas: DataFrame, r_areas: DataFrame, *more: str) -> DataFrame:
        # one side only at its own level, so that small areas do not meet each other in coarse cells
        met = meeting(l_areas, r_areas, own_level, own_or_coarser, *more)
        return met.unionByName(meeting(l_areas, r_areas, coarser, own_level, *more)) if top else met

    def met_outlines(l_levels: str, r_levels: str) -> DataFrame:
        l_areas, r_areas = (
            listed(tag, carried[tag], levels).selectExpr(f"{tag}.*", *keys).selectExpr(
                "x0", "y0", "x1", "y1", "_edges", "_vertices", "side", "_cx", "_cy", "_level", f"id AS _{tag}id")
            for tag, levels in (("l", l_levels), ("r", r_levels))
        )
        plan = plan_blocks(l_areas, r_areas, keys)
        if plan is not None:
            return meet_blocks(l_areas, r_areas, plan, ([*keys, "_lid"], [*keys, "_rid"]), touching_areas, (["_lid"], ["_rid"]))
        return touching_pairs(meeting(
            carried["l"], carried["r"], l_levels, r_levels,
            "l._edges AS le", "r._edges AS re", "l._vertices AS lv", "r._vertices AS rv"))

    touching = met_outlines(own_level, own_or_coarser)
    if top:
        touching = touching.unionByName(met_outlines(coarser, own_level))
    others = []
    if apart["l"]:
        others.append(met_by(boxes["l"].join(special["l"], "id", "left_semi"), boxes["r"]))
    if apart["r"]:
        others.append(met_by(plain["l"], boxes["r"].join(special["r"], "id", "left_semi")))
    if others:
        touching = touching.unionByName(_touching_rings(materialise(_union(others), "boxes-that-meet"), boxes, stats, broadcast_bytes))
    return touching.selectExpr(f"_lid AS `{left_id}`", f"_rid AS `{right_id}`")


def _touching_rings(met: DataFrame, boxes: dict[str, DataFrame], stats, broadcast_bytes: int) -> DataFrame:
    """``_lid`` and ``_rid`` of those pairs whose rings share a point."""

    def edges_in_common_box(ring: str) -> str:
        return f"""filter({edges_of(ring)}, c -> least(c.x1, c.x2) <= x1
            AND greatest(c.x1, c.x2) >= x0 AND least(c.y1, c.y2) <= y1 AND greatest(c.y1, c.y2) >= y0)"""

    pairs = met
    # rings join the pairs whose boxes meet; an area that meets very many is repeated in pieces
    for tag, other in (("l", "r"), ("r", "l")):
        rings = boxes[tag].selectExpr(f"id AS _{tag}id", f"ring AS _{tag}ring")
        small = 16 * stats[f"{tag}_vertices"] + 64 * stats[tag] <= broadcast_bytes
        pairs = meet(pairs, rings, [f"_{tag}id"], [f"_{other}id"], small)
    # one ring of each inside the other, boundaries apart
    inside = f"""exists({first_vertices('_lring')}, v -> {ring_contains('_rring', 'v.x', 'v.y')})
        OR exists({first_vertices('_rring')}, v -> {ring_contains('_lring', 'v.x', 'v.y')})"""
    ids = ["_lid", "_rid"]
    tested = pairs.selectExpr(
        *ids, "x0", "y0", "x1", "y1", f"{edges_in_common_box('_lring')} AS le", f"{edges_in_common_box('_rring')} AS re",
        f"{inside} AS inside",
    )
    tested = materialise(tested, "pairs-of-areas")
    many = f"NOT inside AND CAST(size(le) AS BIGINT) * size(re) > {EDGE_PAIRS}"
    boundaries_meet = "exists(le, e -> exists(re, f -> " + segments_touch("e", "f") + "))"
    touching = tested.filter(f"NOT ({many})").filter(f"inside OR {boundaries_meet}").select(*ids)
    if tested.filter(many).limit(1).count():
        touching = touching.unionByName(_crossing_outlines(tested.filter(many), ids))
    return touching


def _crossing_outlines(pairs: DataFrame, ids: list[str]) -> DataFrame:
    """``ids`` of pairs with an edge of ``le`` that touches one of ``re``, by cells of the common box, about one for each edge."""
    bins = "CAST(ceil(sqrt(greatest(size(le), size(re)))) AS BIGINT)"
    grid = pairs.selectExpr("*", f"{bins} AS bins").selectExpr("*", "(x1 - x0) / bins AS w", "(y1 - y0) / bins AS h")

    def bin_of(value: str, origin: str, size: str) -> str:
        # a box without width or height has one row of cells
        return f"greatest(least(floor(coalesce(({value} - {origin}) / nullif({size}, 0D), 0D)), bins - 1), 0L)"

    def listed(side: str, name: str) -> DataFrame:
        slack = "1e-6D"
        columns = grid.selectExpr(*ids, "bins", "x0", "y0", "w", "h", f"explode({side}) AS e").selectExpr(
            "*", f"explode(sequence({bin_of(f'least(e.x1, e.x2) - {slack} * w', 'x0', 'w')}, "
            f"{bin_of(f'greatest(e.x1, e.x2) + {slack} * w', 'x0', 'w')})) AS c",
        ).selectExpr(
            "*", "(e.y2 - e.y1) / nullif(e.x2 - e.x1, 0D) AS slope",
            # the outer columns take what reaches beyond the box
            f"CASE WHEN c = 0 THEN least(e.x1, e.x2) ELSE greatest(least(e.x1, e.x2), x0 + (c - {slack}) * w) END AS xa",
            f"CASE WHEN c = bins - 1 THEN greatest(e.x1, e.x2) ELSE least(greatest(e.x1, e.x2), x0 + (c + 1 + {slack}) * w) END AS xb",
        ).selectExpr(
            "*", "coalesce(e.y1 + slope * (xa - e.x1), e.y1) AS ya", "coalesce(e.y1 + slope * (xb - e.x1), e.y2) AS yb",
        )
        return columns.selectExpr(
            *ids, "c", f"e AS {name}",
            f"explode(sequence({bin_of(f'least(ya, yb) - {slack} * h', 'y0', 'h')}, "
            f"{bin_of(f'greatest(ya, yb) + {slack} * h', 'y0', 'h')})) AS row",
        )

    keys = [*ids, "c", "row"]
    left, right = spread_hot_keys(listed("le", "e"), listed("re", "f"), keys, ["e"])
    return left.join(right, [*keys, "_salt"]).filter(segments_touch("e", "f")).select(*ids).distinct()
