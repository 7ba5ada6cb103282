"""CSV with latitude and longitude columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidegrid.functions.geometry import CRS


def read_csv_points(
    spark: SparkSession,
    path: str | list[str],
    lat_col: str = "latitude",
    lon_col: str = "longitude",
    crs: str = CRS,
    schema: T.StructType | str | None = None,
    damaged: str | None = None,
) -> DataFrame:
    """Records with ``lon`` and ``lat`` in place of the two coordinate columns.

    Without a schema the types are inferred, which reads the data once more; give one for
    large input. Coordinates that are no numbers become null. ``damaged`` names a column for the text of
    records with too few or too many fields, or with a value that its column cannot hold; it is null for all others.
    """
    if crs != CRS:
        raise ValueError(f"only {CRS} is supported, not {crs}")
    reader = spark.read.option("header", True)
    if damaged:
        fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        fields = fields or reader.option("inferSchema", True).csv(path).schema
        if damaged in fields.names:
            raise ValueError(f"there is a column {damaged} already")
        schema = T.StructType([*fields, T.StructField(damaged, T.StringType())])
        reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", damaged)
    df = (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)
    missing = [c for c in (lat_col, lon_col) if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found in the CSV: {missing}")
    rest = [f"`{c}`" for c in df.columns if c not in (lat_col, lon_col, damaged)]
    if damaged:
        # Spark tells damage by the columns it reads; a condition that always holds makes it read all of them
        fields = ", ".join(f"`{c}`" for c in df.columns if c != damaged)
        rest.append(f"CASE WHEN xxhash64({fields}) >= bigint('-9223372036854775808') THEN `{damaged}` END AS `{damaged}`")
    return df.selectExpr(
        *rest, f"try_cast(`{lon_col}` AS DOUBLE) AS lon", f"try_cast(`{lat_col}` AS DOUBLE) AS lat"
    )


def write_csv_points(points: DataFrame, path: str) -> None:
    """All columns, with the coordinates last as ``longitude`` and ``latitude``."""
    rest = [f"`{c}`" for c in points.columns if c not in ("lon", "lat")]
    out = points.selectExpr(*rest, "lon AS longitude", "lat AS latitude")
    out.write.mode("overwrite").option("header", True).csv(path)
