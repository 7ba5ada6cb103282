"""Bronze, silver and gold layers as Parquet under a base URI; the scheme picks the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.formats import point_wkb, ring_wkb, wkb_point, wkb_ring
from tidegrid.functions.geometry import RING_TYPE, ring_bounds

# Names of the published files, by layer.
FLOODING_AREAS = "flooding_areas_porto_alegre"
CITIZENS = "citizens_data"
AFFECTED = "affected_citizens"
UNAFFECTED = "unaffected_citizens"
ALL_EVALUATED = "all_citizens_evaluated"

CITIZENS_SCHEMA = (
    "citizen_id bigint, name string, address string, phone string, registration_date timestamp, "
    "lon double, lat double"
)
AREAS_SCHEMA = (
    "area_id bigint, area_name string, flood_date string, severity string, "
    f"affected_population bigint, ring {RING_TYPE}"
)


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}.parquet"


def read_layer(
    spark: SparkSession, base: str, layer: str, name: str, schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(layer_path(base, layer, name))


def write_layer(df: DataFrame, base: str, layer: str, name: str) -> str:
    path = layer_path(base, layer, name)
    df.write.mode("overwrite").parquet(path)
    return path


def copy_table(spark: SparkSession, source: str, target: str) -> str:
    """A table copied to another store; any URI Spark has a file system for (``s3a://…``)."""
    spark.read.parquet(source).write.mode("overwrite").parquet(target)
    return target


def read_wkb_points(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """GeoParquet with points: the WKB column becomes ``lon`` and ``lat``."""
    df = spark.read.parquet(path)
    rest = [f"`{c}`" for c in df.columns if c != geometry]
    return df.selectExpr(*rest, f"{wkb_point(f'`{geometry}`')} AS _p").selectExpr(
        *rest, "_p.x AS lon", "_p.y AS lat"
    )


def read_wkb_areas(spark: SparkSession, path: str, geometry: str = "geometry") -> DataFrame:
    """GeoParquet with polygons: the WKB column becomes ``ring``."""
    df = spark.read.parquet(path)
    rest = [f"`{c}`" for c in df.columns if c != geometry]
    return df.selectExpr(*rest, f"{wkb_ring(f'`{geometry}`')} AS ring")


def with_wkb(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """Points or rings turned into one WKB column, for tools that expect it."""
    if "ring" in df.columns:
        return df.withColumn(geometry, ring_wkb("ring")).drop("ring")
    return df.withColumn(geometry, point_wkb(F.col("lon"), F.col("lat"))).drop("lon", "lat")


#: Columns of the bounds that :func:`write_clustered` adds to areas.
BOX = ("_xmin", "_ymin", "_xmax", "_ymax")


def _spread_bits(value: str) -> str:
    """The low 31 bits of a number at the even places of a long."""
    for shift, mask in (
        (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)
    ):
        value = f"transform(array({value}), v -> (v | shiftleft(v, {shift})) & {mask}L)[0]"
    return value


def curve_key(lon: str, lat: str) -> str:
    """Place on a Z-shaped curve over the globe, as SQL text: near places mostly have near keys."""
    x = f"CAST(greatest(least(({lon} + 180D) / 360D, 1D), 0D) * 2147483647D AS BIGINT)"
    y = f"CAST(greatest(least(({lat} + 90D) / 180D, 1D), 0D) * 2147483647D AS BIGINT)"
    return f"({_spread_bits(x)} | shiftleft({_spread_bits(y)}, 1))"


def write_clustered(df: DataFrame, path: str, rows_per_file: int = 1_000_000) -> str:
    """Points or areas as Parquet whose files and row groups hold places near each other.

    Rows are ranged by a space-filling curve, and by a hash of the row within one place, so a place with very
    many rows fills several files. Areas get their bounds in ``_xmin``, ``_ymin``, ``_xmax`` and ``_ymax``. Rows without
    a place are kept.
    """
    files = df.count() // rows_per_file + 1
    if "ring" in df.columns:
        taken = set(BOX) & set(df.columns)
        if taken:
            raise ValueError(f"columns of the bounds are there already: {sorted(taken)}")
        placed = df.selectExpr("*", f"{ring_bounds('ring')} AS _b").selectExpr(
            *[f"`{c}`" for c in df.columns], *[f"_b.{c[1:]} AS {c}" for c in BOX])
        key = curve_key("(_xmin + _xmax) / 2D", "(_ymin + _ymax) / 2D")
    else:
        placed, key = df, curve_key("lon", "lat")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed.repartitionByRange(files, F.expr(key), row).sortWithinPartitions(F.expr(key)).write.mode("overwrite").parquet(path)
    return path


def read_box(
    spark: SparkSession, path: str, box: tuple[float, float, float, float], schema: T.StructType | str | None = None
) -> DataFrame:
    """Rows of a clustered table whose place or bounds touch the box (xmin, ymin, xmax, ymax).

    The filter is on plain columns, so Parquet's statistics skip the files and row groups elsewhere. ``schema``, if
    given, is that of the written table, bounds included.
    """
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    x0, y0, x1, y1 = (f"{float(v)!r}D" for v in box)
    if "ring" in df.columns:
        return df.filter(f"_xmin <= {x1} AND _xmax >= {x0} AND _ymin <= {y1} AND _ymax >= {y0}").drop(*BOX)
    return df.filter(f"lon BETWEEN {x0} AND {x1} AND lat BETWEEN {y0} AND {y1}")
