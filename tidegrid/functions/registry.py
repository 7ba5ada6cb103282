"""The geometry functions under their usual SQL names, for use in ``spark.sql``.

    register(spark)
    spark.sql("SELECT citizen_id, st_astext_point(lon, lat) FROM citizens")

They are SQL functions: the optimizer puts their text in place of the call. To join points with
areas use the operators instead, as a join on ``st_contains`` alone compares all pairs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidegrid.functions import formats, geometry

_RING = "ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
_POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"

FUNCTIONS = {
    "st_contains": (f"{_RING}, lon DOUBLE, lat DOUBLE", "BOOLEAN", geometry.ring_contains("ring", "lon", "lat")),
    "st_distance_m": (f"{_RING}, lon DOUBLE, lat DOUBLE", "DOUBLE", geometry.ring_distance("ring", "lon", "lat")),
    "st_distance": (f"{_RING}, lon DOUBLE, lat DOUBLE", "DOUBLE", geometry.ring_distance("ring", "lon", "lat")),
    "st_centroid": (_RING, _POINT, geometry.ring_centroid("ring")),
    "st_area": (_RING, "DOUBLE", geometry.ring_area("ring")),
    "st_isvalid_point": ("lon DOUBLE, lat DOUBLE", "BOOLEAN", geometry.point_is_valid("lon", "lat")),
    "st_point": ("lon DOUBLE, lat DOUBLE", _POINT, geometry.make_point("lon", "lat")),
    "st_x": (f"point {_POINT}", "DOUBLE", geometry.point_x("point")),
    "st_y": (f"point {_POINT}", "DOUBLE", geometry.point_y("point")),
    "st_bounds": (
        _RING, "STRUCT<xmin: DOUBLE, ymin: DOUBLE, xmax: DOUBLE, ymax: DOUBLE>", geometry.ring_bounds("ring")
    ),
    "st_astext": (_RING, "STRING", formats.ring_wkt("ring")),
    "st_astext_point": ("lon DOUBLE, lat DOUBLE", "STRING", formats.point_wkt("lon", "lat")),
    "st_asgeojson": (_RING, "STRING", formats.ring_geojson("ring")),
    "st_asgeojson_point": ("lon DOUBLE, lat DOUBLE", "STRING", formats.point_geojson("lon", "lat")),
    "st_polygonfromtext": ("wkt STRING", "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>", formats.wkt_ring("wkt")),
    "st_geomfromtext": ("wkt STRING", "ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>", formats.wkt_ring("wkt")),
    "st_pointfromtext": ("wkt STRING", _POINT, formats.wkt_point("wkt")),
}


def register(spark: SparkSession) -> None:
    """Create the functions for this session."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
