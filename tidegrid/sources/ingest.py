"""All CSV and GeoJSON sources of some folders, converted and reported on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.cleaning import auto_types, source_columns
from tidegrid.operators.validity import check_points, check_rings
from tidegrid.sources.csv_points import read_csv_points
from tidegrid.sources.geojson import read_geojson

#: Text of CSV records that do not fit their header, in converted tables.
DAMAGED = "_damaged"

REPORT_SCHEMA = "source string, source_type string, status string, records bigint, output string, error string"


def discover(spark: SparkSession, folders: list[str], pattern: str) -> list[str]:
    """Paths of the files matching ``pattern`` directly in the folders; contents are not read."""
    found: list[str] = []
    for folder in folders:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{pattern}")
        fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        found += [str(status.getPath()) for status in (fs.globStatus(hadoop) or [])]
    return sorted(found)


def convert(spark: SparkSession, path: str, source_type: str, run_ts: str) -> DataFrame:
    """One source read, checked, with dates and lower case settled and its origin noted."""
    if source_type == "csv":
        records = check_points(read_csv_points(spark, path, damaged=DAMAGED)).selectExpr(
            "* EXCEPT (invalid_reason, geometry_valid)",
            f"CASE WHEN {DAMAGED} IS NOT NULL THEN 'malformed' ELSE invalid_reason END AS invalid_reason",
        ).selectExpr("*", "invalid_reason IS NULL AS geometry_valid")
    else:
        read = read_geojson(spark, path)
        records = check_rings(read).selectExpr(
            "* EXCEPT (invalid_reason, geometry_valid)",
            """CASE WHEN malformed THEN 'malformed'
                WHEN geometry_type = 'Point' THEN CASE WHEN lon IS NULL OR lat IS NULL THEN 'missing' END
                ELSE invalid_reason END AS invalid_reason""",
        ).selectExpr("*", "invalid_reason IS NULL AS geometry_valid")
    typed = auto_types(records, skip=("invalid_reason", "geometry_type", DAMAGED))
    return source_columns(typed, source_type, run_ts)


def ingest_all(spark: SparkSession, folders: list[str], out: str, run_ts: str) -> DataFrame:
    """Convert every source to ``out``; an unreadable one is reported and does not stop the rest.

    A source is a file, or a folder of part files with the extension in its name. Names of
    outputs carry the source type, so that a CSV and a GeoJSON of one name both stay.
    """
    report = []
    for source_type, pattern in (("csv", "*.csv"), ("geojson", "*.geojson")):
        for path in discover(spark, folders, pattern):
            name = path.rstrip("/").rsplit("/", 1)[-1]
            target = f"{out.rstrip('/')}/{name.rsplit('.', 1)[0]}_{source_type}.parquet"
            try:
                convert(spark, path, source_type, run_ts).write.mode("overwrite").parquet(target)
                records = spark.read.parquet(target).count()
                report.append((name, source_type, "success", records, target, None))
            except Exception as error:  # one bad source must not stop the others
                report.append((name, source_type, "error", None, None, str(error).split("\n")[0]))
    return spark.createDataFrame(report, REPORT_SCHEMA)


def report_summary(report: DataFrame) -> DataFrame:
    """Files, successes, failures and records of a run: one row."""
    return report.selectExpr(
        "count(*) AS total_files",
        "count_if(status = 'success') AS successful",
        "count_if(status = 'error') AS failed",
        "coalesce(sum(records) FILTER (WHERE status = 'success'), 0L) AS total_records",
    )


def records_by_source(converted: DataFrame) -> DataFrame:
    """Records and rejected records of converted tables read from files, by source type."""
    return converted.groupBy("_source_type").agg(
        F.count(F.lit(1)).alias("records"), F.expr("count_if(NOT geometry_valid)").alias("rejected")
    )
