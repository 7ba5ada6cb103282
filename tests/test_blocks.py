import pytest
from pyspark.sql import functions as F

from shapes import random_areas, random_points
from tidegrid.functions.geodesy import rounded_metres
from tidegrid.functions.geometry import edges_of, ring_contains, ring_distance, segments_touch
from tidegrid.operators import blocks, nearest, spatial
from tidegrid.operators.grid import index_areas

BOX = (-51.5, -30.2, -51.3, -30.0)


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def crowd(spark):
    """Many areas over one place, one of them of many edges, and points of which some are lost or come twice."""
    areas = random_areas(spark, 5, 120, [0.02, 0.05, 0.1], BOX).unionByName(
        spark.range(1).selectExpr("1000L AS area_id", "transform(sequence(0, 500), i -> struct("
        "-51.4D + 0.08D * cos(i % 500 * pi() / 250) AS x, -30.1D + 0.08D * sin(i % 500 * pi() / 250) AS y)) AS ring"))
    areas = areas.unionByName(areas.filter("area_id = 7")).withColumn("area_id", F.expr("CASE WHEN area_id <> 3 THEN area_id END"))
    points = random_points(spark, 7, 600, BOX).unionByName(
        spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 0.0), (-3, None, None)], "id long, lon double, lat double"))
    points = points.unionByName(points.filter("id < 5")).withColumn("id", F.expr("CASE WHEN id <> 9 THEN id END"))
    return points.cache(), areas.cache()


@pytest.fixture(params=[(8192, 1024, 1 << 15), (64, 16, 256)])
def always(request, monkeypatch):
    """Blocks whatever the number of pairs, of usual size and so small that all is cut."""
    monkeypatch.setattr(blocks, "WORTH_PAIRS", 0)
    monkeypatch.setattr(blocks, "WORTH_PAIRS_A_KEY", 0)
    for name, value in zip(("LEFT_ROWS", "RIGHT_ROWS", "ELEMENTS"), request.param, strict=True):
        monkeypatch.setattr(blocks, name, value)


@pytest.mark.parametrize("side", [None, 2.0**-3, 2.0**-7])
def test_points_meet_areas_by_blocks(crowd, always, side):
    points, areas = crowd
    expected = sorted(
        ((r[0], r[1]) for r in points.crossJoin(areas).filter(ring_contains("ring", "lon", "lat")).select("id", "area_id").collect()), key=str)
    met = spatial.join_index(points, index_areas(areas, ["area_id"], broadcast_bytes=0, side=side), "inner")
    assert "MapInArrow" in _plan(met)
    assert met.columns == ["id", "lon", "lat", "area_id"]
    assert sorted(((r[0], r[3]) for r in met.collect()), key=str) == expected


@pytest.mark.parametrize("metres", [300.0, 20_000.0])
def test_distances_by_blocks(crowd, always, metres):
    points, areas = crowd
    expected = sorted(
        ((r[0], r[1], round(r[2], 4)) for r in points.filter("id < 60 OR id IS NULL").crossJoin(areas)
         .selectExpr("id", "area_id", f"{ring_distance('ring', 'lon', 'lat')} AS d").filter(f"d <= {metres}D").collect()), key=str)
    met = spatial.within_distance_join(points.filter("id < 60 OR id IS NULL"), areas, metres, broadcast_bytes=0)
    assert "MapInArrow" in _plan(met)
    assert sorted(((r["id"], r["area_id"], round(r["distance_m"], 4)) for r in met.collect()), key=str) == expected


def test_lengths_are_rounded_as_by_spark(spark):
    odd = spark.createDataFrame([(v,) for v in (0.0, 0.005, 1.005, 2.675, 499.995, 1e6, 1e9 + 0.125, float("nan"), None)], "d double")
    drawn = spark.range(20_000).selectExpr("rand(3) * 1000 AS d").unionByName(spark.range(2000).selectExpr("id / 1000D AS d"))
    both = odd.unionByName(drawn).selectExpr("round(d, 2) AS a", f"{rounded_metres('d')} AS b")
    assert both.filter("NOT (a <=> b)").count() == 0


def test_areas_meet_by_blocks(crowd, always):
    areas = crowd[1].filter("area_id < 60").unionByName(
        crowd[1].filter("area_id = 50").selectExpr("2000L AS area_id", "transform(ring, v -> struct(v.x * 0.01D - 50.87D AS x, v.y * 0.01D - 29.8D AS y)) AS ring"))
    areas = areas.dropDuplicates(["area_id"])
    others = areas.withColumnRenamed("area_id", "other_id")
    got = spatial.areas_intersect_join(areas, others, "area_id", "other_id", broadcast_bytes=0)
    assert "_vertices" in _plan(got) and "collect_list" in _plan(got)
    pairs = areas.crossJoin(others.withColumnRenamed("ring", "other"))
    ring, other = edges_of("ring"), edges_of("other")
    brute = pairs.filter(
        f"exists({ring}, e -> exists({other}, f -> {segments_touch('e', 'f')})) OR {ring_contains('ring', 'other[0].x', 'other[0].y')} "
        f"OR {ring_contains('other', 'ring[0].x', 'ring[0].y')}").select("area_id", "other_id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, brute.collect()))


def test_edges_inside_other_areas_are_not_looked_at(spark, monkeypatch):
    """With areas upon areas few edges may be nearest to a point in none, and the distances stay as they are."""
    areas = random_areas(spark, 15, 400, [0.05, 0.08], BOX)
    points = random_points(spark, 16, 400, (-51.7, -30.4, -51.1, -29.8))
    listed, real = [], nearest._listed_edges
    monkeypatch.setattr(nearest, "_listed_edges", lambda edges, *rest: listed.append(edges.count()) or real(edges, *rest))
    got = {r["id"]: r["min_distance_m"] for r in nearest.min_distance(points, areas, ["id"]).collect()}
    assert 0 < listed[0] < areas.selectExpr(f"sum(size({edges_of('ring')})) AS n").first()["n"] / 4
    brute = points.crossJoin(areas).groupBy("id").agg(F.expr(f"min({ring_distance('ring', 'lon', 'lat')}) AS d"))
    expected = {r["id"]: r["d"] for r in brute.collect()}
    assert len(got) == len(expected) and all(got[i] == pytest.approx(d, abs=1e-3) for i, d in expected.items())
