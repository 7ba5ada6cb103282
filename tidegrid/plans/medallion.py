"""The whole job: bronze to silver to gold, table load, run log, summary."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidegrid.operators.classify import affected_table, all_table, classify, unaffected_table
from tidegrid.operators.cleaning import clean_areas, clean_citizens, keep_columns, keep_first
from tidegrid.operators.contracts import CITIZENS, FLOODING_AREAS, conform
from tidegrid.operators.merge import refresh
from tidegrid.operators.reports import status_share
from tidegrid.session import replace_table
from tidegrid.sources import layers
from tidegrid.sources.runlog import append_run


@dataclass(frozen=True)
class Published:
    affected: DataFrame
    unaffected: DataFrame
    evaluated: DataFrame
    citizens: DataFrame
    areas: DataFrame


def run(
    spark: SparkSession,
    base: str,
    raw_citizens: DataFrame,
    raw_areas: DataFrame,
    order: list[str],
    run_ts: str,
    current: DataFrame | None = None,
) -> Published:
    """Run all layers under ``base``; ``current`` is the citizens table of the run before.

    The classified pairs are written once, split by status, and the three published tables
    are made from them, so that the join runs once.
    """
    started = time.monotonic()
    silver_citizens, bad_citizens = clean_citizens(raw_citizens, order, run_ts)
    silver_areas, bad_areas = clean_areas(raw_areas, order, run_ts)
    layers.write_layer(silver_citizens, base, "silver", f"silver_{layers.CITIZENS}")
    layers.write_layer(silver_areas, base, "silver", f"silver_{layers.FLOODING_AREAS}")
    layers.write_layer(bad_citizens, base, "quarantine", layers.CITIZENS)
    layers.write_layer(bad_areas, base, "quarantine", layers.FLOODING_AREAS)
    citizens = layers.read_layer(spark, base, "silver", f"silver_{layers.CITIZENS}")
    areas = layers.read_layer(spark, base, "silver", f"silver_{layers.FLOODING_AREAS}")

    pairs_path = layers.layer_path(base, "gold", "classified_pairs")
    classified = classify(citizens, areas)
    classified.write.mode("overwrite").partitionBy("affected_by_flooding").parquet(pairs_path)
    pairs = spark.read.schema(classified.schema).parquet(pairs_path)
    layers.write_layer(affected_table(pairs, run_ts), base, "gold", layers.AFFECTED)
    layers.write_layer(unaffected_table(pairs, run_ts), base, "gold", layers.UNAFFECTED)
    layers.write_layer(all_table(pairs, run_ts), base, "gold", layers.ALL_EVALUATED)
    affected, unaffected, evaluated = (
        layers.read_layer(spark, base, "gold", name)
        for name in (layers.AFFECTED, layers.UNAFFECTED, layers.ALL_EVALUATED)
    )

    loaded = load_citizens(affected, unaffected, current)
    # the current table may be the one that is replaced
    table = replace_table(loaded, layers.layer_path(base, "tables", "citizens"))
    replace_table(conform(areas, FLOODING_AREAS), layers.layer_path(base, "tables", "flooding_areas"))
    append_run(table, f"{base}/tables/pipeline_runs.parquet", run_ts, seconds=round(time.monotonic() - started, 3))
    return Published(
        affected, unaffected, evaluated, table, layers.read_layer(spark, base, "tables", "flooding_areas")
    )


def load_citizens(affected: DataFrame, unaffected: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """The citizens table after a load: one row per citizen, a full refresh of those with a status."""
    once = conform(keep_first(affected, ["citizen_id"], ["affected_area_id"]), CITIZENS)
    others = conform(unaffected, CITIZENS)
    if current is None:
        return once.unionByName(others)
    return refresh(keep_columns(current, list(CITIZENS.columns)), once, others, ["citizen_id"])


def summary(published: Published) -> DataFrame:
    """Totals over evaluated rows, one row per (citizen, area) pair as published."""
    return status_share(published.evaluated)
