"""Files dropped into a folder, taken up as a stream.

The checkpoint keeps which files were seen, so a drop must be a new file; one overwritten in
place is not read again. Tables are kept as one folder per micro-batch, ``run=…/epoch=N``, written with
overwrite: a batch that is run again after a failure replaces its own folder and nothing else. A run is a
checkpoint's life; a new checkpoint counts its batches from 0 again, in a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidegrid.operators.classify import flag_pairs
from tidegrid.operators.cleaning import keep_first, keep_last
from tidegrid.operators.grid import AreaIndex
from tidegrid.operators.spatial import join_index

#: Groups of the keys of :func:`first_settled`; fixed for the life of a checkpoint.
BUCKETS = 512


def watch_csv(
    spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    """New CSV files of a folder, oldest first, as a stream."""
    reader = spark.readStream.schema(schema).option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder)


def watch_parquet(
    spark: SparkSession, folder: str, schema: T.StructType | str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take up all that is there, appending to a Parquet table, and stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def _batch_folder(batch: DataFrame, path: str, epoch: int) -> str:
    """Where a micro-batch belongs: the run of its checkpoint, numbered in order of first batches."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not query:
        raise RuntimeError("not within a micro-batch")
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    pattern = place(f"{path}/run=*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    runs = [status.getPath().getName() for status in (fs.globStatus(pattern) or [])]
    mine = [run for run in runs if run.endswith(query)]
    last = max((int(run.removeprefix("run=").split("-")[0]) for run in runs), default=0)
    return f"{path}/{mine[0] if mine else f'run={last + 1:08d}-{query}'}/epoch={epoch}"


def classify_drops(points: DataFrame, index: AreaIndex, path: str, checkpoint: str) -> StreamingQuery:
    """Classified micro-batches under ``path/run=…/epoch=N``, for any set of areas."""

    def store(batch: DataFrame, epoch: int) -> None:
        classified = flag_pairs(join_index(batch, index, "left", row_id=["citizen_id"]))
        classified.write.mode("overwrite").parquet(_batch_folder(batch, path, epoch))

    return points.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()


def merge_drops(stream: DataFrame, path: str, checkpoint: str, key: list[str], order: list[str]) -> StreamingQuery:
    """Record each drop as a set of changes under ``path/run=…/epoch=N``.

    Only the changes are written, reduced to the last per key; :func:`merged` resolves them when
    read and :func:`compact` folds them into one set now and then.
    """

    def store(batch: DataFrame, epoch: int) -> None:
        keep_last(batch, key, order).write.mode("overwrite").parquet(_batch_folder(batch, path, epoch))

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(
        availableNow=True
    ).start()


def merged(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The table after all drops: for each key the row of the latest."""
    return keep_last(spark.read.parquet(path), key, ["run", "epoch"]).drop("run", "epoch")


def compact(spark: SparkSession, path: str, new_path: str, key: list[str]) -> DataFrame:
    """All changes so far folded into one set, written next to the old one."""
    changes = spark.read.parquet(path)
    folded = keep_last(changes, key, ["run", "epoch"])
    folded.withColumns({"run": F.lit("00000000-folded"), "epoch": F.lit(-1)}).write.mode("overwrite").partitionBy(
        "run", "epoch"
    ).parquet(new_path)
    return merged(spark, new_path, key)


def first_seen(stream: DataFrame, key: list[str], event_time: str | None = None, keep_for: str | None = None) -> DataFrame:
    """Only the first record of each key, across drops.

    State grows with the keys unless the source has a time column: with ``event_time`` and
    ``keep_for`` keys older than that are forgotten.
    """
    if event_time and keep_for:
        return stream.withWatermark(event_time, keep_for).dropDuplicatesWithinWatermark(key)
    return stream.dropDuplicates(key)


def first_settled(
    stream: DataFrame, key: list[str], order: list[str], event_time: str | None = None, keep_for: str | None = None
) -> DataFrame:
    """As :func:`first_seen`, and of several records of a key in one micro-batch the first by ``order`` wins, whatever the partitions.

    Equal ones are told apart by their other columns. Keys are kept in ``BUCKETS`` buckets by hash, each one group with the
    keys seen so far as its state, so that Python is called once a bucket rather than once a key. With ``event_time`` and
    ``keep_for`` a key is forgotten once the watermark is that far behind its last record. A bucket's records of a
    micro-batch are looked through in chunks; its keys and the first record of each have to fit in memory.
    """
    columns = stream.columns
    by = [*order, *[c for c in columns if c not in order]]
    if event_time and keep_for:
        stream = stream.withWatermark(event_time, keep_for)
    millis = int(pd.Timedelta(keep_for).total_seconds() * 1000) if keep_for else 0
    identity = F.to_json(F.struct(*[_same_text(F.col(f"`{c}`"), stream.schema[c].dataType).alias(c) for c in key]))
    # pandas has whole numbers beside nulls as doubles, which do not hold all of 64 bits
    wide = [f.name for f in stream.schema.fields if isinstance(f.dataType, T.LongType)]
    exact = stream.select("*", identity.alias("_key")).withColumns(
        {c: F.col(f"`{c}`").cast("decimal(20,0)") for c in wide}
    ).withColumn("_bucket", F.pmod(F.xxhash64("_key"), F.lit(BUCKETS)))

    def pick(_, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs() if millis else 0
        known = _unpacked(state.get[0]) if state.exists else pd.Series([], dtype="int64")
        best, latest = None, pd.Series([], dtype="int64")
        for chunk in () if state.hasTimedOut else chunks:
            seen = pd.Series(now, index=chunk["_key"], dtype="int64")
            if millis:
                times = pd.to_datetime(chunk[event_time]).astype("datetime64[ns]")
                at = (times.astype("int64") // 1_000_000).where(times.notna(), now)
                seen = pd.Series(at.clip(lower=now).to_numpy(), index=chunk["_key"], dtype="int64")
            latest = pd.concat([latest, seen]).groupby(level=0).max()
            best = chunk if best is None else pd.concat([best, chunk])
            best = best.sort_values(by, kind="stable", na_position="first").drop_duplicates("_key")
        new = None if best is None else best[~best["_key"].isin(known.index)]
        rest = known[~known.index.isin(latest.index) & ((known >= now) | (millis == 0))]
        known = pd.concat([rest, latest + millis])
        if not len(known):
            state.remove()
            return
        state.update((_packed(known),))
        if millis:
            state.setTimeoutTimestamp(int(known.min()))
        if new is not None and len(new):
            yield new[columns]

    timeout = GroupStateTimeout.EventTimeTimeout if millis else GroupStateTimeout.NoTimeout
    found = exact.groupBy("_bucket").applyInPandasWithState(
        pick, exact.select(*[f"`{c}`" for c in columns]).schema, "known binary", "append", timeout)
    return found.withColumns({c: F.col(f"`{c}`").cast("bigint") for c in wide})


def _same_text(column: Column, kind: T.DataType) -> Column:
    """A column whose JSON text is equal for equal keys only."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return column + F.lit(0.0)  # one zero
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    return column.cast("string") if isinstance(kind, T.TimestampNTZType) else column


def _packed(known: pd.Series) -> bytes:
    sink = pa.BufferOutputStream()
    table = pa.table({"key": pa.array(known.index, pa.string()), "until": pa.array(known.to_numpy(), pa.int64())})
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(packed: bytes) -> pd.Series:
    table = pa.ipc.open_stream(bytes(packed)).read_all()
    return pd.Series(table["until"].to_numpy(), index=table["key"].to_pandas(), dtype="int64")


def first_of_drops(spark: SparkSession, path: str, key: list[str], order: list[str]) -> DataFrame:
    """As :func:`first_seen`, from stored drops, with the order within a drop settled too."""
    drops = spark.read.parquet(path)
    return keep_first(drops, key, ["epoch", *order]).drop("epoch")

