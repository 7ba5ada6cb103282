import math

import pytest

from tidegrid.functions import formats, geometry, text

SQUARE = geometry.ring_of([(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)])
DART = geometry.ring_of([(0, 0), (4, 1), (8, 0), (4, 6), (0, 0)])


def value(spark, expression):
    return spark.sql(f"SELECT {expression} AS v").first()["v"]


@pytest.mark.parametrize(
    "x, y, inside",
    [(2, 2, True), (0, 2, False), (4, 4, False), (2, 0, False), (5, 2, False), (-1, 0, False), (3.999, 0.001, True)],
)
def test_square_excludes_its_boundary(spark, x, y, inside):
    assert value(spark, geometry.ring_contains(SQUARE, f"{x}D", f"{y}D")) is inside


@pytest.mark.parametrize("x, y, inside", [(4, 3, True), (4, 0.5, False), (4, 1, False), (2, 2, True), (2, 3, False)])
def test_concave_ring(spark, x, y, inside):
    assert value(spark, geometry.ring_contains(DART, f"{x}D", f"{y}D")) is inside


def test_null_point_is_not_inside(spark):
    assert not value(spark, geometry.ring_contains(SQUARE, "CAST(NULL AS DOUBLE)", "1D"))


def test_moments(spark):
    assert value(spark, geometry.ring_area(SQUARE)) == 16.0
    c = value(spark, geometry.ring_centroid(SQUARE))
    assert (c["x"], c["y"]) == (2.0, 2.0)
    flat = geometry.ring_of([(0, 0), (1, 0), (2, 0), (0, 0)])
    assert value(spark, geometry.ring_centroid(flat))["x"] is None


def test_bounds_and_point_parts(spark):
    assert tuple(value(spark, geometry.ring_bounds(DART))) == (0.0, 0.0, 8.0, 6.0)
    p = geometry.make_point("1", "2.5")
    assert value(spark, geometry.point_x(p)) == 1.0 and value(spark, geometry.point_y(p)) == 2.5


@pytest.mark.parametrize(
    "lon, lat, why",
    [("1D", "2D", None), ("NULL", "2D", "missing"), ("double('NaN')", "2D", "missing"),
     ("181D", "2D", "out_of_range"), ("1D", "-90.5D", "out_of_range")],
)
def test_point_problem(spark, lon, lat, why):
    assert value(spark, geometry.point_problem(f"CAST({lon} AS DOUBLE)", f"CAST({lat} AS DOUBLE)")) == why


def vincenty(lon1, lat1, lon2, lat2):
    """Geodesic length on WGS84, the published iteration."""
    a, f = 6378137.0, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(v))) for v in (lat1, lat2))
    big_l = lam = math.radians(lon2 - lon1)
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam),
                       math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        cos2 = 1 - sin_a**2
        mid = c - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0.0
        big_c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = big_l + (1 - big_c) * f * sin_a * (sigma + big_c * s * (mid + big_c * c * (2 * mid**2 - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    u = cos2 * (a * a - b * b) / (b * b)
    big_a = 1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u)))
    big_b = u / 1024 * (256 + u * (-128 + u * (74 - 47 * u)))
    delta = big_b * s * (mid + big_b / 4 * (c * (2 * mid**2 - 1)
                         - big_b / 6 * mid * (4 * s * s - 3) * (4 * mid**2 - 3)))
    return b * big_a * (sigma - delta)


@pytest.mark.parametrize("lat", [0.0, -30.03, 52.0, 68.0])
@pytest.mark.parametrize("dx, dy", [(0.01, 0.0), (0.0, 0.01), (0.2, 0.3), (-0.7, 0.4)])
def test_distance_to_a_vertex_is_geodesic(spark, lat, dx, dy):
    # a tiny triangle pointing at the query point, so that its vertex is nearest
    sx, sy = math.copysign(1e-6, dx or 1), math.copysign(1e-6, dy or 1)
    ring = geometry.ring_of([(dx, lat + dy), (dx + sx, lat + dy), (dx, lat + dy + sy), (dx, lat + dy)])
    got = value(spark, geometry.ring_distance(ring, "0D", f"{lat}D"))
    assert got == pytest.approx(vincenty(0.0, lat, dx, lat + dy), rel=2e-5)


def test_distance_zero_inside_and_on_edge(spark):
    assert value(spark, geometry.ring_distance(SQUARE, "1D", "1D")) == 0.0
    assert value(spark, geometry.ring_distance(SQUARE, "4D", "1D")) == 0.0
    to_edge = value(spark, geometry.ring_distance(SQUARE, "2D", "-0.1D"))
    assert to_edge == pytest.approx(vincenty(2, -0.1, 2, 0), rel=1e-5)


def test_wkt_and_back(spark):
    assert value(spark, formats.ring_wkt(SQUARE)) == "POLYGON((0 0,4 0,4 4,0 4,0 0))"
    assert value(spark, formats.point_wkt("-51.3D", "0.0001D")) == "POINT(-51.3 0.0001)"
    assert value(spark, formats.point_wkt("100D", "-30D")) == "POINT(100 -30)"
    same = f"{formats.wkt_ring(formats.ring_wkt(DART))} = {DART}"
    assert value(spark, same) is True
    assert len(value(spark, formats.wkt_ring("'POLYGON((0 0,1 0,1 1,0 0),(0 0,1 0,1 1,0 0))'"))) == 9
    assert value(spark, formats.wkt_ring("'LINESTRING(0 0,1 0,1 1,0 0)'")) is None
    assert tuple(value(spark, formats.wkt_point("' point ( -1.5e1   2 )'"))) == (-15.0, 2.0)
    assert value(spark, formats.wkt_point("'LINESTRING(0 0,1 1)'")) is None


def test_geojson_and_back(spark):
    g = formats.parse_geometry(formats.ring_geojson(DART))
    assert value(spark, f"{formats.geojson_ring(f'({g})')} = {DART}") is True
    holes = "'{\"type\":\"Polygon\",\"coordinates\":[[[0,0],[1,0],[1,1],[0,0]],[[0,0],[1,0],[1,1],[0,0]]]}'"
    assert len(value(spark, formats.geojson_ring(f"({formats.parse_geometry(holes)})"))) == 9


def test_wkb_is_exact(spark):
    numbers = [0.0, -0.5, 1e-300, 5e-324, 1.7976931348623157e308, -51.2093, 1 / 3]
    df = spark.createDataFrame([(x, y) for x in numbers for y in numbers], "lon double, lat double")
    df = df.withColumn("g", formats.point_wkb("lon", "lat")).selectExpr("lon", "lat", f"{formats.wkb_point('g')} AS p")
    assert df.filter("p IS NULL OR p.x <> lon OR p.y <> lat").count() == 0


def test_wkb_big_endian_and_other_kinds(spark):
    import struct

    rows = [(struct.pack(">BIdd", 0, 1, 1.5, -2.25),), (struct.pack("<BII", 1, 2, 0),), (None,)]
    got = spark.createDataFrame(rows, "g binary").selectExpr(f"{formats.wkb_point('g')} AS p").collect()
    assert [tuple(r["p"]) if r["p"] else None for r in got] == [(1.5, -2.25), None, None]


@pytest.mark.parametrize(
    "given, date",
    [("2024-01-05", "2024-01-05"), (" 2024-01-05T10:11:12 ", "2024-01-05"), ("01/31/2024", "2024-01-31"),
     ("2024", None), ("12345678901", None), ("2024-13-01", None), ("Centro", None)],
)
def test_lenient_dates(spark, given, date):
    assert value(spark, text.iso_date(text.try_parse_date(f"'{given}'"))) == date


def test_strict_date_raises(spark):
    with pytest.raises(Exception):
        value(spark, text.parse_date("'Centro'"))


def test_text_rules(spark):
    assert value(spark, text.zero_padded("7", 3)) == "007"
    assert value(spark, text.zero_padded("12345", 3)) == "12345"
    assert value(spark, text.tidy("'\\t a b \\n'")) == "a b"


def test_normal_draws_have_the_asked_spread(spark):
    draw = text.normal_draw("id", "x", "10D", 0.5)
    row = spark.range(20000).selectExpr(f"avg({draw}) AS m", f"stddev({draw}) AS s").first()
    assert row["m"] == pytest.approx(10, abs=0.02) and row["s"] == pytest.approx(0.5, abs=0.02)
