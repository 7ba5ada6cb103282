"""Areas with holes and of several parts: forms, flaws, joins; and outlines of very many edges."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shapes import random_points
from tidegrid.functions import formats, geometry
from tidegrid.functions.geometry import RING_TYPE, edges_of, first_vertices, ring_contains, segments_touch
from tidegrid.operators import nearest, spatial, validity
from tidegrid.sources import geojson


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def path(*parts):
    """Parts are lists of rings, the first the outer one."""
    out = []
    for part in parts:
        for i, ring in enumerate(part):
            if out:
                out.append(None if i else {"x": None, "y": None})
            out += [{"x": float(x), "y": float(y)} for x, y in ring]
    return out


def areas_of(spark, rings):
    return spark.createDataFrame(list(rings.items()), f"area_id long, ring {RING_TYPE}")


def circle(cx, cy, r, n, wobble=0.0, seed=0):
    rnd = random.Random(seed)
    ring = [(cx + r * (1 + wobble * rnd.random()) * math.cos(2 * math.pi * i / n),
             cy + r * (1 + wobble * rnd.random()) * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*ring, ring[0]]


SHELL = box(0, 0, 10, 10)


@pytest.mark.parametrize("name, area, reason", [
    ("hole", path([SHELL, box(2, 2, 4, 4)]), None),
    ("two holes", path([SHELL, box(2, 2, 4, 4), box(5, 5, 6, 6)]), None),
    ("either turn", path([SHELL[::-1], box(2, 2, 4, 4)]), None),
    ("two parts", path([SHELL], [box(20, 0, 21, 1)]), None),
    ("island", path([SHELL, box(2, 2, 8, 8)], [box(4, 4, 5, 5)]), None),
    ("parts touch in a point", path([SHELL], [box(10, 10, 11, 11)]), None),
    ("hole touches in a point", path([SHELL, [(0, 5), (2, 4), (2, 6), (0, 5)]]), None),
    ("hole outside", path([SHELL, box(20, 2, 24, 4)]), "hole_outside"),
    ("hole in hole", path([SHELL, box(2, 2, 8, 8), box(3, 3, 4, 4)]), "hole_outside"),
    ("hole beyond a vertex", path([SHELL, [(10, 10), (12, 14), (14, 12), (10, 10)]]), "hole_outside"),
    ("hole of another part", path([SHELL], [box(20, 0, 30, 10), box(2, 2, 3, 3)]), "hole_outside"),
    ("part in part", path([SHELL], [box(2, 2, 3, 3)]), "parts_overlap"),
    ("parts cross", path([SHELL], [box(5, 5, 15, 15)]), "self_intersection"),
    ("parts share a side", path([SHELL], [box(10, 2, 15, 8)]), "self_intersection"),
    ("hole crosses", path([SHELL, box(8, 2, 12, 4)]), "self_intersection"),
    ("hole crosses itself", path([SHELL, [(2, 2), (4, 4), (4, 2), (2, 5), (2, 2)]]), "self_intersection"),
    ("hole not closed", path([SHELL, box(2, 2, 4, 4)[:-1]]), "not_closed"),
    ("hole of nothing", path([SHELL, [(2, 2), (3, 2), (4, 2), (2, 2)]]), "zero_area"),
    ("empty part", path([SHELL], [[]]), "too_few_vertices"),
    ("half a vertex", path([SHELL, [(2, 2), (4, 2), (4, 4), (2, 2)]])[:-1] + [{"x": 1.0, "y": None}], "missing"),
])
def test_flaws_of_areas(spark, name, area, reason):
    # beside others, so that areas must not mix
    frame = areas_of(spark, {1: area, 2: path([SHELL]), 3: path([SHELL, box(1, 1, 2, 2)])})
    got = {r["area_id"]: r["invalid_reason"] for r in validity.check_rings(frame).collect()}
    assert got == {1: reason, 2: None, 3: None}


def test_measures_do_not_depend_on_turns(spark):
    one = path([SHELL, box(2, 2, 4, 4)], [box(20, 0, 22, 2)])
    two = path([SHELL[::-1], box(2, 2, 4, 4)], [box(20, 0, 22, 2)[::-1]])
    rows = areas_of(spark, {1: one, 2: two}).selectExpr(
        f"{geometry.ring_area('ring')} AS a", f"{geometry.ring_centroid('ring')} AS c").collect()
    for r in rows:
        assert r["a"] == pytest.approx(100)
        assert r["c"]["x"] == pytest.approx((100 * 5 - 4 * 3 + 4 * 21) / 100)
        assert r["c"]["y"] == pytest.approx((100 * 5 - 4 * 3 + 4 * 1) / 100)


def test_forms_and_back(spark, tmp_path):
    frame = areas_of(spark, {
        1: path([SHELL]), 2: path([SHELL, box(2, 2, 4, 4), box(5, 5, 6, 6)]),
        3: path([SHELL, box(2, 2, 4, 4)], [box(20, 0, 22, 2), box(20.5, 0.5, 21, 1)], [box(30, 0, 31, 1)]), 4: None})
    geojson.write_geojson(frame, str(tmp_path / "g"))
    back = geojson.read_geojson(spark, str(tmp_path / "g")).selectExpr("area_id", "ring", "geometry_type")
    want = {r["area_id"]: r["ring"] for r in frame.collect()}
    assert {r["area_id"]: r["ring"] for r in back.collect()} == want
    assert {r["area_id"]: r["geometry_type"] for r in back.collect()} == {1: "Polygon", 2: "Polygon", 3: "MultiPolygon", 4: None}
    frame.withColumn("w", formats.ring_wkb("ring")).write.parquet(str(tmp_path / "w"))
    both = spark.read.parquet(str(tmp_path / "w")).selectExpr(
        "area_id", f"{formats.wkb_ring('w')} AS a", f"{formats.wkt_ring(formats.ring_wkt('ring'))} AS b")
    assert {r["area_id"]: r["a"] for r in both.collect()} == want
    assert {r["area_id"]: r["b"] for r in both.collect()} == want


@pytest.mark.parametrize("text", ["POLYGON EMPTY", "POLYGON(())", "POLYGON((0 0,1 0,1 1,0 0)", "MULTIPOLYGON((0 0,1 0,1 1,0 0))",
                                  "POLYGON((0 0,1 0,1 1,0 0)),((2 2,3 3,3 2,2 2))", "POINT(1 2)"])
def test_other_text_is_no_area(spark, text):
    assert spark.createDataFrame([(text,)], "t string").selectExpr(f"{formats.wkt_ring('t')} AS r").first()["r"] is None


@pytest.mark.parametrize("cut", [1, 9, 17])
def test_damaged_wkb_is_no_area(spark, tmp_path, cut):
    areas_of(spark, {1: path([SHELL, box(2, 2, 4, 4)], [box(20, 0, 22, 2)])}).withColumn("w", formats.ring_wkb("ring")).write.parquet(
        str(tmp_path / "w"))
    read = spark.read.parquet(str(tmp_path / "w"))
    assert read.selectExpr(f"substring(w, 1, length(w) - {cut}) AS w").selectExpr(f"{formats.wkb_ring('w')} AS r").first()["r"] is None


def random_lakes(spark, seed, n):
    rnd = random.Random(seed)
    rings = {}
    for i in range(n):
        x, y, r = rnd.uniform(-51.5, -50.9), rnd.uniform(-30.2, -29.6), rnd.choice([0.01, 0.05, 0.3])
        parts = [[circle(x, y, r, rnd.choice([4, 9, 40])), circle(x, y, r * 0.4, rnd.choice([4, 7]))]]
        if rnd.random() < 0.5:
            parts.append([circle(x, y, r * 0.1, 5)])
        if rnd.random() < 0.5:
            parts.append([circle(x + 3 * r, y, r, 6)])
        rings[i] = path(*parts)
    return areas_of(spark, rings)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_joins_equal_brute_force(spark, options):
    areas = random_lakes(spark, 1, 25).cache()
    points = random_points(spark, 2, 600, (-51.6, -30.3, -50.8, -29.5)).cache()
    want = {(r["id"], r["area_id"]) for r in points.crossJoin(areas).filter(ring_contains("ring", "lon", "lat")).collect()}
    got = [(r["id"], r["area_id"]) for r in spatial.within_join(points, areas, "inner", ["area_id"], **options).collect()]
    assert sorted(got) == sorted(want)
    few = points.filter("id < 150")
    every = few.crossJoin(areas).selectExpr("id", f"{geometry.ring_distance('ring', 'lon', 'lat')} AS d")
    least = {r["id"]: r["d"] for r in every.groupBy("id").agg(F.min("d").alias("d")).collect()}
    near = {r["id"]: r["min_distance_m"] for r in nearest.min_distance(few, areas, ["id"], **options).collect()}
    assert near.keys() == least.keys() and all(near[k] == pytest.approx(least[k], abs=1e-5) for k in near)


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
@pytest.mark.parametrize("few", [1, 4096])
def test_intersections_equal_brute_force(spark, monkeypatch, options, few):
    monkeypatch.setattr(spatial, "EDGE_PAIRS", few)
    a = random_lakes(spark, 3, 20).cache()
    b = random_lakes(spark, 4, 20).withColumnRenamed("area_id", "other_id").cache()
    both = a.crossJoin(b.withColumnRenamed("ring", "other")).selectExpr("*", f"{edges_of('ring')} AS e", f"{edges_of('other')} AS f")
    meet = f"exists(e, p -> exists(f, q -> {segments_touch('p', 'q')}))"
    one_in = f"exists({first_vertices('ring')}, v -> {ring_contains('other', 'v.x', 'v.y')})"
    other_in = f"exists({first_vertices('other')}, v -> {ring_contains('ring', 'v.x', 'v.y')})"
    want = {(r["area_id"], r["other_id"]) for r in both.filter(f"{meet} OR {one_in} OR {other_in}").collect()}
    got = [(r["area_id"], r["other_id"]) for r in spatial.areas_intersect_join(a, b, "area_id", "other_id", **options).collect()]
    assert sorted(got) == sorted(want) and 0 < len(want) < 400


def test_outlines_of_very_many_edges(spark):
    a = areas_of(spark, {1: path([circle(0, 0, 1, 40_000)])})
    b = areas_of(spark, {1: path([circle(0, 0, 1.1, 40_000)]), 2: path([circle(1.5, 0, 1, 40_000)]),
                         3: path([circle(0, 0, 1.1, 40_000), circle(0, 0, 1.05, 40_000)])}).withColumnRenamed("area_id", "other_id")
    got = [r["other_id"] for r in spatial.areas_intersect_join(a, b, "area_id", "other_id").collect()]
    assert sorted(got) == [1, 2]


def test_one_large_area_among_many(spark):
    small = {i: path([box(i % 60 * 0.01, i // 60 * 0.01, i % 60 * 0.01 + 0.005, i // 60 * 0.01 + 0.005)]) for i in range(3600)}
    a = areas_of(spark, {**small, 9999: path([box(-1, -1, 2, 2)])})
    got = spatial.areas_intersect_join(a, a.withColumnRenamed("area_id", "other_id"), "area_id", "other_id")
    assert got.count() == 3600 + 1 + 2 * 3600


def figure(cx, cy, r, n, crossing):
    """A fine outline; crossing swaps two vertices far apart along it."""
    ring = circle(cx, cy, r, n)[:-1]
    if crossing:
        ring[n // 4], ring[n // 4 + 2] = ring[n // 4 + 2], ring[n // 4]
    return ring


@pytest.mark.parametrize("crowded", [1, 8, 64])
def test_crowded_outlines_are_checked_exactly(spark, monkeypatch, crowded):
    monkeypatch.setattr(validity, "CROWDED", crowded)
    rings = {}
    for i in range(12):
        fine = figure(0, 0, 1e-4, 300, i % 3 == 1)
        # a far vertex makes all the others share a cell at first
        ring = [*fine, (5.0, 0.001 * i)] if i % 3 != 2 else [*fine, (5.0, 0.0), (5.0, 1.0), (-5.0, 1e-5), (5.0, -1.0)]
        rings[i] = path([[*ring, ring[0]]])
    got = {r["area_id"]: r["geometry_valid"] for r in validity.check_rings(areas_of(spark, rings)).collect()}
    assert got == {i: i % 3 == 0 for i in range(12)}


def test_one_stray_vertex_does_not_bring_all_pairs(spark):
    fine = circle(0, 0, 1e-3, 8000)[:-1]
    frame = areas_of(spark, {1: path([[*fine, (50.0, 50.0), fine[0]]])}).selectExpr("'a' AS _ring_id", "ring")
    start = validity._ring_edges(frame)
    assert start.count() == 8001
    assert validity.self_intersecting(frame).count() == 0
    # the most edges that any cell keeps
    once = validity._under_cells(start.selectExpr("_ring_id", "k", "n", "i", "e", "bins", "x0", "y0", "w", "h", "0L AS cell"))
    assert once.groupBy("cell").count().agg(F.max("count")).first()[0] > 4000


def test_sql_names_take_areas_with_holes(spark):
    from tidegrid.functions import registry

    registry.register(spark)
    lake = "st_geomfromtext('POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,4 2,4 4,2 4,2 2))')"
    row = spark.sql(f"""SELECT st_distance({lake}, 1D, 1D) AS inside, st_distance({lake}, 3D, 3D) AS in_hole, st_area({lake}) AS area,
        st_contains({lake}, 3D, 3D) AS held, st_astext({lake}) AS text, st_geomfromtext('POINT(1 2)') AS none""").first()
    assert row["inside"] == 0 and 100_000 < row["in_hole"] < 112_000 and row["area"] == 96
    assert row["held"] is False and row["none"] is None
    assert row["text"] == "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,4 2,4 4,2 4,2 2))"
