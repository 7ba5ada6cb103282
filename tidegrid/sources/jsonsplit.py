"""Features of GeoJSON files in any layout of lines, found by string state and bracket depth.

Text is read in pieces that end at closing braces, which Spark's text reader can split wherever a file's
splits lie, so a document on one line or of many gigabytes is read by many tasks. Whether a piece starts within a string,
at what depth of brackets, and within a list of features depends on all text before it:

1. Each split is scanned for both states a string can be in at its start: quotes, change of depth, and where lists
   of features open and close, by depth relative to the start.
2. Prefix sums over the splits of a file (a row each) give each split its start state.
3. Each split is scanned again from there and cut into units: features of a collection, parts of a collection around them, and
   other documents. Units that cross splits come out in fragments, joined by file in order; all others never leave their task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidegrid.session import materialise

ESCAPED = re.compile(r"\\.", re.S)
LIST = re.compile(r'"features"\s*:\s*\[')

#: Up to so many splits, their start states (about 100 bytes each) are broadcast.
BROADCAST_SPLITS = 100_000

SUMMARY = (
    "file string, block long, file_size long, bytes long, quotes long, steps array<long>, "
    "opened array<map<long, long>>, closed array<map<long, long>>"
)
FRAGMENT = "file string, block long, n long, complete boolean, kind string, value string"


def _depth(text: str, inside: int) -> tuple[int, int]:
    """Change of depth by brackets outside strings, and whether the text ends inside one."""
    parts = (ESCAPED.sub("", text) if "\\" in text else text).split('"')
    told = "".join(parts[inside::2])
    change = told.count("{") + told.count("[") - told.count("}") - told.count("]")
    return change, (inside + len(parts) - 1) % 2


def _opening(text: str, depth: int, inside: int, wanted: int | None = None) -> list[tuple[int, int]]:
    """Depth and end of each place where a list of features opens (at depth ``wanted`` only, if given)."""
    found = []
    if '"features"' in text:
        for match in LIST.finditer(text):
            change, within = _depth(text[: match.start()], inside)
            if not within and (wanted is None or depth + change == wanted):
                found.append((depth + change, match.end()))
    return found


def _splits(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, Iterator[str]]]:
    """The pieces of each split, with the values of ``columns`` that all of them share."""
    rows = (
        (tuple(row[:-1]), row[-1])
        for batch in batches for row in zip(*[batch.column(c).to_pylist() for c in [*columns, "value"]])
    )
    following = next(rows, None)

    def pieces(head: tuple) -> Iterator[str]:
        nonlocal following
        while following is not None and following[0] == head:
            value = following[1]
            following = next(rows, None)
            yield value

    while following is not None:
        head = following[0]
        yield head, pieces(head)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block, file_size), pieces in _splits(batches, ["file", "block", "file_size"]):
        size = quotes = 0
        steps = [0, 0]
        opened: list[dict[int, int]] = [{}, {}]
        closed: list[dict[int, int]] = [{}, {}]
        for n, value in enumerate(pieces):
            size += len(value.encode("utf-8")) + 1
            text = value + "}"
            for start in (0, 1):
                inside = (start + quotes) % 2
                change, _ = _depth(text, inside)
                depth = steps[start]
                for at, _ in _opening(value, depth, inside):
                    if depth + change > at:
                        opened[start][at] = n
                if not inside and value.lstrip().startswith("]"):
                    closed[start][depth] = n
                steps[start] += change
            quotes += _depth(text, 0)[1]
        yield pa.RecordBatch.from_pydict({
            "file": [file], "block": [block], "file_size": [file_size], "bytes": [size], "quotes": [quotes % 2], "steps": [steps],
            "opened": pa.array([[list(m.items()) for m in opened]], pa.list_(pa.map_(pa.int64(), pa.int64()))),
            "closed": pa.array([[list(m.items()) for m in closed]], pa.list_(pa.map_(pa.int64(), pa.int64()))),
        })


def _starts(summaries: DataFrame) -> DataFrame:
    """For each split whether it starts in a string, at what depth, in a list of features; ``cut`` if no brace ends its file."""
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (
        summaries
        .withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
        .withColumn("step", F.expr("steps[CAST(inside AS INT)]"))
        .withColumn("depth", F.coalesce(F.sum("step").over(before), F.lit(0)))
        .withColumn("opens", F.expr("try_element_at(opened[CAST(inside AS INT)], 1 - depth)"))
        .withColumn("closes", F.expr("try_element_at(closed[CAST(inside AS INT)], 2 - depth)"))
        .withColumn("event", F.expr(
            "CASE WHEN opens IS NOT NULL OR closes IS NOT NULL THEN coalesce(opens, -1L) > coalesce(closes, -1L) END"))
        .withColumn("listed", F.coalesce(F.last("event", ignorenulls=True).over(before), F.lit(False)))
        # text behind the last brace counts a byte too many; a byte order mark is not read
        .withColumn("cut", (F.col("block") == F.max("block").over(file))
                    & (F.col("file_size") - F.sum("bytes").over(file)).isin(-1, 2))
        .select("file", "block", "inside", "depth", "listed", "cut")
    )


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, block, inside, depth, listed, cut), pieces in _splits(
            batches, ["file", "block", "inside", "depth", "listed", "cut"]):
        unit: list[str] = []
        out: list[tuple] = []
        n = held = 0

        def end(kind: str | None) -> None:
            nonlocal n, held
            text = "".join(unit)
            unit.clear()
            if kind or text.strip(" \t\r\n"):
                out.append((file, block, n, kind is not None and (n > 0 or block == 0), kind, text))
                n += 1
                held += len(text)

        value = next(pieces)
        while value is not None:
            following = next(pieces, None)
            text = value if cut and following is None else value + "}"
            if listed and depth == 2 and not inside and value.lstrip().startswith("]"):
                listed = False
            change, after = _depth(text, inside)
            if not listed and depth <= 1 and not inside and depth + change >= 2:
                places = _opening(value, depth, inside, 1)
                if places:
                    unit.append(text[: places[0][1]])
                    end("frame")
                    text, listed = text[places[0][1]:], True
            unit.append(text)
            depth, inside = depth + change, after
            if text.endswith("}") and not inside and (depth <= 0 or listed and depth == 2):
                end("feature" if listed and depth == 2 else "document")
                listed = listed and depth > 0
            if len(out) >= 500 or held > 8 << 20:
                yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in out], _ARROW)
                out.clear()
                held = 0
            value = following
        end(None)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in out], _ARROW)


_ARROW = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("complete", pa.bool_()), ("kind", pa.string()),
    ("value", pa.string()),
])


def units(spark: SparkSession, files: list[str]) -> DataFrame:
    """``source_file``, ``kind`` and ``value`` of every unit: feature, frame (around features), document, or rest.

    Commas and white space before a value are no part of it. A rest is text that the end of its file cuts off.
    """
    pieces = spark.read.option("lineSep", "}").text(files).selectExpr(
        "_metadata.file_path AS file", "_metadata.file_block_start AS block", "_metadata.file_size AS file_size",
        "monotonically_increasing_id() AS at", "value")
    summaries = pieces.select("file", "block", "file_size", "value").mapInArrow(_summaries, SUMMARY)
    starts = materialise(_starts(summaries), "json-starts")
    if starts.count() <= BROADCAST_SPLITS:
        told = pieces.join(F.broadcast(starts), ["file", "block"])
    else:
        told = pieces.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "at")
    cut = materialise(
        told.select("file", "block", "inside", "depth", "listed", "cut", "value").mapInArrow(_fragments, FRAGMENT), "json-units")
    order = Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, -1)
    joined = (
        # at most two fragments a split
        cut.filter("NOT complete").withColumn("unit", F.count("kind").over(order))
        .groupBy("file", "unit").agg(
            F.max("kind").alias("kind"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "n", "value"))), lambda f: f["value"]), "")
            .alias("value"))
    )
    return (
        cut.filter("complete").select("file", "kind", "value").unionByName(joined.select("file", "kind", "value"))
        .select(F.col("file").alias("source_file"), "kind", F.regexp_replace("value", r"^[\s,]+", "").alias("value"))
        .selectExpr(
            "source_file", "value",
            # what follows a list of features starts with its bracket
            "CASE WHEN kind = 'document' AND startswith(value, ']') THEN 'frame' ELSE coalesce(kind, 'rest') END AS kind")
        .filter("value <> ''")
    )
