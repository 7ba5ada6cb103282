"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.session import materialise

#: A table up to this many bytes may be broadcast; it is measured before.
BROADCAST_BYTES = 16 << 20

#: Rows of an Arrow batch between Spark and Python.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """At most ``BATCH_ROWS`` rows in an Arrow batch of this session: texts can be long, and a worker holds a few batches."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column in ``taken`` has it (Spark ignores case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def text_digest(text: Column) -> Column:
    """SHA-256 of the whole text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def is_small(measured: DataFrame, row_bytes: Column) -> bool:
    """Whether a written table is small enough to be broadcast, from its measured size in memory."""
    size = measured.select(F.sum(row_bytes + F.lit(64))).first()[0]
    return (size or 0) <= BROADCAST_BYTES


def lookup(big: DataFrame, small: DataFrame, key: str, weight: Column, how: str = "left") -> DataFrame:
    """``big`` joined to the written table ``small``, which has each ``key`` once.

    ``weight`` is how many rows of ``big`` a row of ``small`` stands for. A small table is
    broadcast. Otherwise keys with over 1/1000 of all rows that match are fewer than 1000: these are
    broadcast, and only the rest is shuffled, so no task gets a hot key of ``small``; one that ``small``
    lacks is left to Spark, which splits it, as it is on the larger side of an ordinary join.
    """
    if is_small(small, F.lit(64 * len(small.columns))):
        return big.join(F.broadcast(small), key, how)
    total = small.select(F.sum(weight)).first()[0] or 0
    hot = small.filter(weight > F.lit(total / 1000))
    hit = fresh([*big.columns, *small.columns], "_hit")
    near = big.join(F.broadcast(hot.withColumn(hit, F.lit(True))), key, "left")
    found = near.filter(F.col(hit)).drop(hit)
    rest = near.filter(F.col(hit).isNull()).select(*big.columns)
    cold = small.filter(~(weight > F.lit(total / 1000)))
    if how != "left":
        return found.unionByName(rest.join(cold, key, how))
    # rows without a key match nothing and need not meet in one task
    keyed = rest.filter(F.col(key).isNotNull()).join(cold, key, how)
    return found.unionByName(keyed).unionByName(rest.filter(F.col(key).isNull()), allowMissingColumns=True)


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``links`` (``a``, ``b``): each node with the smallest node it reaches.

    Rounds of smallest-label joins with pointer jumping, each written to the shared folder.
    Stars and short chains settle in a few rounds; the loop ends when no label changes. Minima are
    taken before rows are shuffled, and joins are plain equi-joins whose large keys Spark can split.
    """
    both = materialise(
        links.select("a", "b").union(links.select("b", "a")).filter("a <> b").distinct(), label
    )
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
        .select("node", F.least("node", "m").alias("label")), label
    )
    while True:
        offered = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("best"))
        )
        stepped = labels.join(offered, "node").select(
            "node", F.least("label", "best").alias("label"), F.col("label").alias("old")
        )
        onward = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        after = materialise(
            stepped.join(onward, "label", "left").select(
                "node", F.least("label", F.coalesce("further", "label")).alias("label"), "old"
            ), label
        )
        changed = after.filter("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
