"""Hot join keys spread over several tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.session import materialise

HOT_SHARE = 1024
# a join that lists pairs gets a task for so many of them, and no more than ``HOT_SHARE`` tasks
TASK_PAIRS = 1 << 21
STREAM_SALTS = 16


def spread_hot_keys(
    big: DataFrame, small: DataFrame, keys: list[str], row_id: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Add ``_salt`` to both sides of an equi-join on ``keys``.

    A key with more than 1/1024 of the big side's rows is split into pieces of about that
    size, and the small side's rows for it are repeated once per piece. At most 1024 keys can
    be that hot, so the list of them is safe to broadcast. The salt is a hash of ``row_id``,
    so a recomputed task puts its rows in the same pieces.

    A stream cannot be counted beforehand; there every key gets a fixed number of pieces.
    """
    piece = F.xxhash64(*row_id)
    if big.isStreaming:
        salts = F.lit(STREAM_SALTS)
        return (
            big.withColumn("_salt", F.pmod(piece, salts).cast("int")),
            small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1)))),
        )
    # the big side is run once for this, whatever it is made from
    counts = materialise(big.groupBy(*keys).agg(F.count("*").alias("_rows")), "key-counts")
    limit = (counts.agg(F.sum("_rows")).first()[0] or 0) / HOT_SHARE
    hot = counts.filter(F.col("_rows") > limit).select(
        *[F.col(k).alias(f"_hot{k}") for k in keys],
        F.ceil(F.col("_rows") / F.lit(max(limit, 1.0))).cast("int").alias("_pieces"),
    )
    # null-safe: rows without a cell match nothing but must not all land in one task
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"_hot{k}"))
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    salted_big = (
        big.join(F.broadcast(hot), same_key, "left")
        .withColumn("_salt", F.pmod(piece, pieces).cast("int"))
        .select(*big.columns, "_salt")
    )
    salted_small = (
        small.join(F.broadcast(hot), same_key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .select(*small.columns, "_salt")
    )
    return salted_big, salted_small


def pair_tasks(left: DataFrame, right: DataFrame, keys: list[str]) -> int:
    """How many tasks the pairs of equal keys are worth."""
    mine, yours = (
        df.groupBy(*keys).agg(F.count("*").alias(n)) for df, n in ((left, "_mine"), (right, "_yours"))
    )
    # as doubles: the product of two counts may not fit
    total = mine.join(yours, keys).agg(F.sum(F.expr("double(_mine) * _yours"))).first()[0] or 0.0
    cores = left.sparkSession.sparkContext.defaultParallelism
    return int(min(max(total // TASK_PAIRS + 1, cores), max(HOT_SHARE, cores)))


def spread_pairs(
    big: DataFrame, small: DataFrame, keys: list[str], row_id: list[str]
) -> tuple[DataFrame, DataFrame]:
    """:func:`spread_hot_keys` for a join of many rows with many, both sides shuffled for it.

    The tasks follow from the number of pairs of equal keys, which small inputs can have many of: partitions put
    together by their bytes would leave them to a few tasks.
    """
    salted_big, salted_small = spread_hot_keys(big, small, keys, row_id)
    if big.isStreaming:
        return salted_big, salted_small
    tasks = pair_tasks(big, small, keys)
    return tuple(df.repartition(tasks, *keys, "_salt") for df in (salted_big, salted_small))


def meet(
    left: DataFrame, right: DataFrame, keys: list[str], row_id: list[str], small: bool, how: str = "inner"
) -> DataFrame:
    """An equi-join: the right side broadcast if it was measured small, else hot keys spread."""
    if small:
        return left.join(F.broadcast(right), keys, how)
    left, right = spread_hot_keys(left, right, keys, row_id)
    return left.join(right, [*keys, "_salt"], how).drop("_salt")
