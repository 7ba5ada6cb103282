import math

import pytest
from pyspark.sql import functions as F

from shapes import random_areas, random_points
from tidegrid.functions.geometry import edges_of, ring_contains, ring_distance, ring_of, segments_touch
from tidegrid.operators import nearest, skew, spatial
from tidegrid.operators.grid import index_areas

BOX = (-51.5, -30.2, -50.9, -29.6)
# broadcast and shuffled, cells fine and coarse, one level and several
OPTIONS = [{}, {"broadcast_bytes": 0}, {"side": 2.0**-3}, {"side": 2.0**-9}]


@pytest.fixture(scope="module")
def fixture(spark):
    areas = random_areas(spark, 5, 40, [0.02, 0.05, 0.01, 0.02], BOX).unionByName(
        random_areas(spark, 6, 1, [1.5], (-51.9, -30.9, -51.8, -30.8)).withColumn("area_id", F.col("area_id") + 1000)
    ).cache()
    points = random_points(spark, 7, 1500, BOX).cache()
    pairs = points.crossJoin(areas).filter(ring_contains("ring", "lon", "lat"))
    hits = {(r["id"], r["area_id"]) for r in pairs.collect()}
    return points, areas, hits


@pytest.mark.parametrize("options", OPTIONS)
def test_joins_equal_brute_force(fixture, options):
    points, areas, hits = fixture
    index = index_areas(areas, ["area_id"], **options)
    everyone = {r["id"] for r in points.collect()}
    affected = {i for i, _ in hits}

    inner = [(r["id"], r["area_id"]) for r in spatial.join_index(points, index, "inner").collect()]
    assert sorted(inner) == sorted(hits)
    left = [(r["id"], r["area_id"]) for r in spatial.join_index(points, index, "left").collect()]
    assert sorted(left, key=str) == sorted([*hits, *((i, None) for i in everyone - affected)], key=str)
    semi = [r["id"] for r in spatial.join_index(points, index, "semi").collect()]
    assert sorted(semi) == sorted(affected)
    anti = [r["id"] for r in spatial.join_index(points, index, "anti").collect()]
    assert sorted(anti) == sorted(everyone - affected)
    flagged = [(r["id"], r["hit"]) for r in spatial.flag_index(points, index, "hit").collect()]
    assert sorted(flagged) == sorted((i, i in affected) for i in everyone)


@pytest.mark.parametrize("options", OPTIONS)
def test_flags_keep_repeated_and_lost_points(spark, fixture, options):
    points, areas, hits = fixture
    index = index_areas(areas, ["area_id"], **options)
    one = next(iter(hits))[0]
    copies = points.filter(f"id = {one}").crossJoin(spark.range(300).select()).unionByName(
        spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 0.0), (-3, None, None)], "id long, lon double, lat double")
    ).unionByName(points.filter(f"id <> {one}"))
    got = spatial.flag_index(copies, index, "hit").groupBy("id").agg(
        F.count("*").alias("n"), F.count_if("hit").alias("yes")).collect()
    found = {r["id"]: (r["n"], r["yes"]) for r in got}
    assert found[one] == (300, 300) and all(found[i] == (1, 0) for i in (-1, -2, -3))
    assert len(found) == points.count() + 3
    with pytest.raises(ValueError):
        spatial.flag_index(points, index, "lon")


def test_points_run_once_whatever_the_levels(fixture):
    points, areas, _ = fixture
    small = index_areas(areas, ["area_id"], side=2.0**-9)
    assert small.small and len(small.levels) > 1
    for how in ("left", "semi", "anti"):
        plan = spatial.join_index(points, small, how)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("InMemoryRelation [id") == 1, how
    large = index_areas(areas, ["area_id"], side=2.0**-9, broadcast_bytes=0)
    joins = [
        spatial.join_index(points, index, "anti")._jdf.queryExecution().optimizedPlan().toString().count("Join ")
        for index in (large, index_areas(areas, ["area_id"], side=2.0**-12, broadcast_bytes=0))
    ]
    assert joins[0] == joins[1]


def test_several_levels_are_in_play(fixture):
    _, areas, _ = fixture
    assert len(index_areas(areas, ["area_id"]).levels) > 1


def test_edges_vertices_and_lost_points(spark):
    square = ring_of([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])
    broken = ring_of([(0, 0), (1, 0), ("double('NaN')", 1), (0, 0)])
    endless = ring_of([(0, 0), ("double('Infinity')", 0), (1, 1), (0, 0)])
    areas = spark.sql(f"SELECT * FROM VALUES (1L, {square}), (2L, {broken}), (3L, {endless}) AS t(area_id, ring)")
    points = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, 0.0, 0.5), (3, 1.0, 1.0), (4, None, 0.5), (5, float("nan"), 0.5), (6, 500.0, 0.5), (7, 0.999, 0.001),
         (8, float("inf"), 0.5)],
        "id long, lon double, lat double",
    )
    for options in OPTIONS:
        got = spatial.within_join(points, areas, "left", ["area_id"], **options).collect()
        assert {r["id"]: r["area_id"] for r in got} == {1: 1, 2: None, 3: None, 4: None, 5: None, 6: None, 7: 1, 8: None}


def test_nearest_skips_lost_points(spark):
    square = ring_of([(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)])
    areas = spark.sql(f"SELECT 1L AS area_id, {square} AS ring")
    points = spark.createDataFrame(
        [(1, 0.5, 0.5), (2, None, 0.5), (3, float("inf"), 0.5), (4, float("nan"), 0.5), (5, 1.0, 2.0)],
        "id long, lon double, lat double",
    )
    got = {r["id"]: r["min_distance_m"] for r in nearest.min_distance(points, areas, ["id"]).collect()}
    assert sorted(got) == [1, 5] and got[1] == 0.0 and got[5] == pytest.approx(110_600, rel=1e-3)
    assert nearest.min_distance(points, areas.filter("false"), ["id"]).count() == 0


def test_no_areas_and_no_points(spark, fixture):
    points, areas, _ = fixture
    nothing = areas.filter("false")
    assert spatial.within_join(points, nothing, "left", ["area_id"]).filter("area_id IS NULL").count() == points.count()
    assert spatial.within_join(points, nothing, "inner", ["area_id"]).count() == 0
    assert spatial.within_join(points.filter("false"), areas, "left", ["area_id"], broadcast_bytes=0).count() == 0


def test_column_clash_is_refused(fixture):
    points, areas, _ = fixture
    with pytest.raises(ValueError):
        spatial.within_join(points.withColumn("area_id", F.lit(1)), areas, "left", ["area_id"])


def test_hot_cell_is_spread(spark):
    big = spark.range(6000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 1L WHEN id % 3 = 1 THEN NULL ELSE id END AS k")
    small = spark.range(6000).selectExpr("id AS k", "id * 10 AS v")
    spread_big, spread_small = skew.spread_hot_keys(big, small, ["k"], ["id"])
    assert spread_big.count() == 6000
    assert spread_big.filter("k = 1").select("_salt").distinct().count() > 100
    assert spread_big.filter("k IS NULL").select("_salt").distinct().count() > 100
    joined = spread_big.join(spread_small, ["k", "_salt"])
    assert joined.count() == big.join(small, "k").count() == 4000
    assert joined.select("id").distinct().count() == 4000


def test_all_points_in_one_place(spark, fixture):
    _, areas, _ = fixture
    crowd = spark.range(3000).selectExpr("id", "-51.2D AS lon", "-29.9D AS lat")
    one = crowd.limit(1).crossJoin(areas).filter(ring_contains("ring", "lon", "lat")).count()
    assert spatial.within_join(crowd, areas, "inner", ["area_id"], broadcast_bytes=0).count() == 3000 * one


def test_contains_join_keeps_empty_areas(fixture):
    points, areas, hits = fixture
    got = spatial.contains_join(areas, points, "left", ["area_id"]).collect()
    ids = {r["area_id"] for r in areas.collect()}
    assert {(r["id"], r["area_id"]) for r in got} == hits | {(None, a) for a in ids - {a for _, a in hits}}


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}])
def test_distances_equal_brute_force(fixture, options):
    points, areas, _ = fixture
    few = points.filter("id < 400")
    every = few.crossJoin(areas).selectExpr(
        "id", "area_id", f"{ring_distance('ring', 'lon', 'lat')} AS d"
    ).collect()
    within = {(r["id"], r["area_id"]): r["d"] for r in every if r["d"] <= 2500}
    got = {(r["id"], r["area_id"]): r["distance_m"] for r in
           spatial.within_distance_join(few, areas, 2500.0, ["area_id"], **options).collect()}
    assert got.keys() == within.keys()
    assert all(got[k] == pytest.approx(within[k], abs=1e-6) for k in got)

    least: dict = {}
    for r in every:
        least[r["id"]] = min(least.get(r["id"], (float("inf"), 0)), (r["d"], r["area_id"]))
    near = {r["id"]: (r["min_distance_m"], r["area_id"]) for r in
            nearest.nearest_area(few, areas, ["id"], **options).collect()}
    assert near.keys() == least.keys()
    for k, (d, a) in near.items():
        assert d == pytest.approx(least[k][0], abs=1e-5)
        assert a == least[k][1]


def test_nearest_over_the_globe(spark):
    """Far from any area, and areas of very different sizes."""
    areas = random_areas(spark, 11, 30, [0.01, 3.0, 0.2], (-120, -60, 120, 60)).cache()
    points = random_points(spark, 12, 150, (-150, -75, 150, 75)).cache()
    best: dict = {}
    # the library's measure: each edge by itself
    edges = areas.selectExpr("area_id", "ring", f"explode({edges_of('ring')}) AS e")
    pairs = points.crossJoin(edges)
    measured = nearest._edge_metres(
        pairs.select("id", "lon", "lat", "area_id", "ring", "e.*"), ["id", "area_id", "ring", "lon", "lat"]
    ).selectExpr("id", "area_id", f"CASE WHEN {ring_contains('ring', 'lon', 'lat')} THEN 0D ELSE distance_m END AS d")
    for r in measured.groupBy("id").agg(F.min("d").alias("d")).collect():
        best[r["id"]] = r["d"]
    got = {r["id"]: r["min_distance_m"] for r in nearest.min_distance(points, areas, ["id"]).collect()}
    assert got.keys() == best.keys()
    assert all(got[k] == pytest.approx(best[k], rel=1e-9, abs=1e-6) for k in got)


def test_areas_intersect_equals_brute_force(spark):
    a = random_areas(spark, 21, 25, [0.02, 0.3, 0.05], BOX).cache()
    b = random_areas(spark, 22, 25, [0.04, 0.01, 2.0], BOX).withColumnRenamed("area_id", "other_id").cache()
    both = a.crossJoin(b.withColumnRenamed("ring", "other")).selectExpr(
        "area_id", "other_id", "ring", "other", f"{edges_of('ring')} AS e", f"{edges_of('other')} AS f"
    )
    meet = f"exists(e, p -> exists(f, q -> {segments_touch('p', 'q')}))"
    first_in = ring_contains("other", "ring[0].x", "ring[0].y")
    other_in = ring_contains("ring", "other[0].x", "other[0].y")
    want = {(r["area_id"], r["other_id"]) for r in both.filter(f"{meet} OR {first_in} OR {other_in}").collect()}
    got = [(r["area_id"], r["other_id"]) for r in spatial.areas_intersect_join(a, b, "area_id", "other_id").collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("margin", [0.0, 700.0])
def test_parts_of_cells_settle_most_pairs(spark, margin):
    """Parts told to be inside or out of reach are so for every point in them, and few points are left to compare with edges."""
    areas = random_areas(spark, 11, 30, [0.02, 0.05, 0.01, 0.02], BOX)
    points = random_points(spark, 12, 4000, BOX)
    index = index_areas(areas, ["area_id"], margin_m=margin)
    probe = spatial._Probe(index, "true", "lon", "lat", ["id"])
    met = probe.inner(points).join(areas, "area_id").selectExpr(
        "getbit(_full, _part) = 1 AS full", "getbit(_near, _part) = 1 AS near", "_inside",
        f"{ring_contains('ring', 'lon', 'lat')} AS within", f"{ring_distance('ring', 'lon', 'lat')} <= {margin}D AS reached",
    ).cache()
    assert met.filter("full AND (near AND NOT _inside OR NOT within)").count() == 0
    assert met.filter("NOT full AND NOT near AND (within OR reached)").count() == 0
    if not margin:
        assert met.filter("near").count() < met.count() / 2


def test_distance_to_outlines_of_many_edges(spark):
    """Lists of few and of many edges give the distances of the formula."""
    rings = [
        (k, ring_of([(0.02 * math.cos(2 * math.pi * i / n), 0.02 * math.sin(2 * math.pi * i / n)) for i in range(n)] + [(0.02, 0.0)]))
        for k, n in ((1, 5), (2, 40), (3, 400))]
    areas = spark.sql("SELECT * FROM VALUES " + ", ".join(f"({k}L, {r})" for k, r in rings) + " AS t(area_id, ring)")
    points = random_points(spark, 13, 300, (-0.05, -0.05, 0.05, 0.05))
    want = {(r["id"], r["area_id"]): r["d"] for r in points.crossJoin(areas).selectExpr(
        "id", "area_id", f"{ring_distance('ring', 'lon', 'lat')} AS d").collect() if r["d"] <= 1500}
    near = spatial.within_distance_join(points, areas, 1500.0, ["area_id"])
    assert "ArrowEvalPython" in near._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["id"], r["area_id"]): r["distance_m"] for r in near.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-6) for k in got)


def test_points_in_areas_look_for_no_edges(spark, fixture, monkeypatch):
    """However many areas hold a point, it is flagged once; only points in none look for the nearest edge."""
    points, areas, hits = fixture
    looked, real = [], nearest._edge_pairs
    monkeypatch.setattr(nearest, "_edge_pairs", lambda outside, *rest: looked.append(outside.count()) or real(outside, *rest))
    got = {r["id"]: r["min_distance_m"] for r in nearest.min_distance(points, areas, ["id"]).collect()}
    assert looked == [len(got) - len({i for i, _ in hits})]
    assert {i for i, d in got.items() if d == 0} == {i for i, _ in hits}


def test_edges_are_listed_once_a_cell(spark):
    """Every cell an edge runs through at every size, from about two rows for each finest one."""
    areas = random_areas(spark, 14, 10, [0.3], BOX)
    bits = list(range(12))
    got = {tuple(r) for r in nearest._listed_edges(areas, "area_id", 2.0**-8, bits).collect()}
    finest = [r for r in got if r[5] == 0]
    assert got == {(*r[:5], b, r[6] >> b, r[7] >> b) for r in finest for b in bits} and finest


def test_plain_areas_meet_without_pairs_being_written(spark, monkeypatch):
    """Areas of few edges are compared where they meet; only those of many edges, or of an id that comes twice, have their pairs written."""
    def box(x0, y0, x1, y1):
        return [{"x": x, "y": y} for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]

    # a box with a hole and a second part
    lake = [*box(0.0, 0.0, 4.0, 4.0), None, *box(1.0, 1.0, 3.0, 3.0), {"x": None, "y": None}, *box(6.0, 0.0, 7.0, 1.0)]
    others = {
        1: box(1.5, 1.5, 2.5, 2.5), 2: box(1.0, 1.5, 2.0, 2.5), 3: box(0.2, 0.2, 0.8, 0.8), 4: box(4.5, 0.0, 5.5, 4.0),
        5: box(-1.0, -1.0, 8.0, 8.0), 6: box(6.2, 0.2, 6.4, 0.4), 7: box(4.0, 4.0, 5.0, 5.0), None: box(0.0, 0.0, 1.0, 1.0),
    }
    schema = "area_id long, ring array<struct<x: double, y: double>>"
    lakes = spark.createDataFrame([(10, lake)], schema)
    areas = spark.createDataFrame(list(others.items()), schema).withColumnRenamed("area_id", "other_id")
    written = []
    plain = spatial.materialise
    monkeypatch.setattr(spatial, "materialise", lambda df, label: written.append(label) or plain(df, label))
    for size in ({}, {"broadcast_bytes": 0}):
        got = spatial.areas_intersect_join(lakes, areas, "area_id", "other_id", **size).collect()
        assert sorted((r["area_id"], r["other_id"]) for r in got) == [(10, i) for i in (2, 3, 5, 6, 7)]
    assert "pairs-of-areas" not in written and "boxes-that-meet" not in written
    many = [{"x": 2 + math.cos(2 * math.pi * i / 90), "y": 2 + math.sin(2 * math.pi * i / 90)} for i in range(90)]
    more = areas.unionByName(spark.createDataFrame([(8, [*many, many[0]])], areas.schema))
    got = spatial.areas_intersect_join(lakes, more, "area_id", "other_id").collect()
    assert sorted(r["other_id"] for r in got) == [2, 3, 5, 6, 7, 8]
    assert "pairs-of-areas" in written


def test_joins_of_many_pairs_get_tasks_by_their_pairs(spark, monkeypatch):
    """Inputs of few bytes with many pairs are not put together to a few tasks."""
    monkeypatch.setattr(skew, "TASK_PAIRS", 1000)
    areas = random_areas(spark, 11, 40, [0.2], BOX)
    points = random_points(spark, 12, 2000, BOX)
    joined = spatial.within_join(points, areas, "inner", ["area_id"], ["id"], broadcast_bytes=0).cache()
    pairs = joined.count()
    assert pairs > 1000 and joined.rdd.getNumPartitions() > 2 * spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < pairs / 4


def test_points_are_counted_without_pairs(spark, fixture, monkeypatch):
    """Counts by area are those of the pairs, at one level or several, with repeated and lost points; no join lists the pairs."""
    points, areas, hits = fixture
    one = next(iter(hits))[0]
    lost = spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 0.0), (-3, None, None)], "id long, lon double, lat double")
    more = points.unionByName(points.filter(f"id = {one}").crossJoin(spark.range(300).select())).unionByName(lost)
    want = {}
    for i, area in hits:
        want[area] = want.get(area, 0) + (301 if i == one else 1)

    def no_pairs(*_):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(spatial._Probe, "_meet", no_pairs)
    for options in OPTIONS:
        index = index_areas(areas, ["area_id"], **options)
        got = spatial.points_per_area(more, index).collect()
        assert {r["area_id"]: r["n"] for r in got} == want and len(got) == len(want)
