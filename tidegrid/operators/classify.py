"""Affected or not: from spatial join pairs to the three published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.operators.cleaning import keep_columns
from tidegrid.operators.spatial import within_join

# Columns of the published tables, in order.
AFFECTED_COLUMNS = [
    "citizen_id", "name", "address", "phone", "registration_date", "lon", "lat",
    "affected_by_flooding", "affected_area_id", "area_name", "flood_date", "severity",
    "normalized_date", "data_quality_score",
]
UNAFFECTED_COLUMNS = [
    "citizen_id", "name", "address", "phone", "registration_date", "lon", "lat",
    "affected_by_flooding", "normalized_date", "data_quality_score",
]
ALL_COLUMNS = [
    "citizen_id", "name", "address", "phone", "registration_date", "lon", "lat",
    "affected_by_flooding", "affected_area_id", "normalized_date", "data_quality_score",
]
# What a map shows for a citizen, by status.
MARKERS = {True: ("red", "exclamation-triangle", "AFETADO"), False: ("blue", "info-sign", "SEGURO")}


def classify(citizens: DataFrame, areas: DataFrame, **join_options) -> DataFrame:
    """One row per (citizen, area holding it), one row for a citizen in no area.

    Adds ``affected_by_flooding`` and ``affected_area_id``. Control columns are the citizen's.
    """
    wanted = [c for c in ("area_id", "area_name", "flood_date", "severity", "affected_population")
              if c in areas.columns]
    pairs = within_join(citizens, areas, "left", wanted, row_id=["citizen_id"], **join_options)
    return flag_pairs(pairs)


def flag_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("affected_by_flooding", F.col("area_id").isNotNull()).withColumnRenamed(
        "area_id", "affected_area_id"
    )


def affected_table(classified: DataFrame, run_ts: str) -> DataFrame:
    return _published(classified.filter("affected_by_flooding"), AFFECTED_COLUMNS, run_ts)


def unaffected_table(classified: DataFrame, run_ts: str) -> DataFrame:
    return _published(classified.filter("NOT affected_by_flooding"), UNAFFECTED_COLUMNS, run_ts)


def all_table(classified: DataFrame, run_ts: str) -> DataFrame:
    return _published(classified, ALL_COLUMNS, run_ts)


def _published(df: DataFrame, columns: list[str], run_ts: str) -> DataFrame:
    return keep_columns(df, columns).withColumn("processing_date", F.expr(f"TIMESTAMP '{run_ts}'"))


def with_markers(df: DataFrame) -> DataFrame:
    """Map colour, icon and label by status."""
    (c1, i1, l1), (c0, i0, l0) = MARKERS[True], MARKERS[False]
    flag = "affected_by_flooding"
    return df.selectExpr(
        "*",
        f"CASE WHEN {flag} THEN '{c1}' ELSE '{c0}' END AS marker_colour",
        f"CASE WHEN {flag} THEN '{i1}' ELSE '{i0}' END AS marker_icon",
        f"CASE WHEN {flag} THEN '{l1}' ELSE '{l0}' END AS marker_label",
    )
