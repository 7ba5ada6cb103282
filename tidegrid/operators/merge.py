"""Loading results into a table by key, and deleting by condition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.operators.cleaning import keep_last
from tidegrid.session import replace_table


def upsert(current: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Every key of either side; rows of ``incoming`` replace those of ``current``.

    Written as union and aggregate, which needs one shuffle and is not slowed by an uneven key.
    """
    both = current.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return keep_last(both, key, ["_new"]).drop("_new")


def upsert_column(current: DataFrame, incoming: DataFrame, key: list[str], column: str) -> DataFrame:
    """As :func:`upsert`, but for a key that exists only ``column`` is taken over.

    Of several rows of one side with a key, the one whose text sorts first or last counts.
    """
    columns = current.columns
    rest = ", ".join(f"`{c}`" for c in columns if c not in key and c != column)
    both = current.withColumn("_new", F.lit(0)).unionByName(incoming.select(*columns).withColumn("_new", F.lit(1)))
    merged = both.groupBy(*key).agg(
        F.expr(f"min_by(struct({rest}), struct(_new, to_json(struct({rest})))) AS _old"),
        F.expr(f"max_by(`{column}`, struct(_new, to_json(struct(`{column}`, {rest})))) AS `{column}`"),
    )
    return merged.select(*key, "_old.*", column).select(*columns)


def refresh(current: DataFrame, affected: DataFrame, unaffected: DataFrame, key: list[str]) -> DataFrame:
    """The table after a full reload: all rows with a status go, both inputs come in.

    Rows without a status stay unless a new row has their key. A key in both inputs is
    unaffected, as that load comes last.
    """
    flag = "affected_by_flooding"
    kept = delete_rows(current, f"{flag} IS NOT NULL")
    ranked = (
        kept.withColumn("_load", F.lit(0))
        .unionByName(affected.select(*current.columns).withColumn("_load", F.lit(1)))
        .unionByName(unaffected.select(*current.columns).withColumn("_load", F.lit(2)))
    )
    return keep_last(ranked, key, ["_load"]).drop("_load")


def delete_rows(df: DataFrame, condition: str) -> DataFrame:
    """What a DELETE leaves: rows for which the condition is false or unknown."""
    return df.filter(f"NOT coalesce({condition}, false)")


def rewrite_without(spark: SparkSession, path: str, condition: str) -> DataFrame:
    """DELETE on a Parquet table: the survivors are written beside it and then take its place."""
    return replace_table(delete_rows(spark.read.parquet(path), condition), path)
