"""Repair of conversation structure: the cheapest edits that leave an optional system turn and pairs of user and assistant.

Turns of a conversation are taken by turn (nulls first), then role and text. A turn is blank (no visible
character), a duplicate (role and text seen earlier in the conversation) or truncated (it does not end in
``.``, ``!`` or ``?``); the first of these counts. Edits are Keep (0), Rerole to user or assistant (2), Delete
(3; blank turns and duplicates must go) and Insert of an empty user or assistant turn (2); a truncated turn that
stays costs 1. The role initials of the result read ``(s?(ua)+)?``. Of the cheapest ways the one whose
initials of edits (the audit) come first in ASCII order is taken.

The states of that pattern are 0 nothing yet, 1 after the system turn, 2 after user, 3 after assistant. Dynamic
programming carries the best edit prefix of each state from turn to turn. Prefixes are linked nodes that share
what they have in common; a node knows its ancestors at distances that are powers of two and a rolling hash of
its whole prefix. Ties are settled where two prefixes first differ, found by searching for their longest common
prefix over the ancestors; hashes that agree are verified letter by letter, once for each pair of nodes.
Prefixes of equal cost that have used the same turns are never the beginning of one another (the rest would be
Inserts, which cost), so the lesser prefix stays the lesser whatever follows.

A conversation of up to ``SEGMENT_ROWS`` turns and ``SEGMENT_BYTES`` bytes is repaired by one call. A longer one is
sorted by ranges over many tasks and cut into segments; each gives the best edits between any two states,
which are folded along the conversation as 16 costs and ranks a segment; then each segment applies
its own. Duplicates are then found by the least turn of each role and text, joined back with hot keys split.

Defined results: a null in any column counts as one space (a null ``conv_id`` is a conversation of its own); a conversation
without turns left costs nothing and has an empty audit; repeated rows are duplicates; rows equal in turn are
ordered by role and text; roles are told by their first character; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.llm.common import lookup, table
from tidegrid.session import materialise

#: Turns and bytes of role and text that one call takes; longer conversations are cut into segments.
SEGMENT_ROWS = 10_000
SEGMENT_BYTES = 16 << 20
#: Audits kept in each Python worker by the classes of the turns, and the most turns of those kept.
KNOWN_SIZE, KNOWN_TURNS = 100_000, 64

SPACE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
#: Where the next user or assistant turn leads from each state.
STEP = (2, 2, 3, 2)
INITIAL = {"s": 1, "u": 2, "a": 3}
KEEP, CUT, GONE = 0, 1, 2
BASE, PRIME = 911_382_323, (1 << 61) - 1


class Prefixes:
    """Edit prefixes as linked nodes; node 0 is the empty one."""

    def __init__(self):
        self.letter, self.size, self.digest = [""], [0], [0]
        #: ancestors[v][k] lies 2**k letters before v
        self.ancestors: list[list[int]] = [[]]
        self.verified: set[tuple[int, int]] = set()

    def add(self, node: int, letter: str) -> int:
        ancestors, up = self.ancestors, [node]
        while node and len(ancestors[node]) >= len(up):
            node = ancestors[node][len(up) - 1]
            up.append(node)
        self.letter.append(letter)
        self.size.append(self.size[up[0]] + 1)
        self.digest.append((self.digest[up[0]] * BASE + ord(letter)) % PRIME)
        ancestors.append(up)
        return len(ancestors) - 1

    def equal(self, a: int, b: int) -> bool:
        """Whether two prefixes of one size hold the same letters; equal hashes are verified."""
        if a == b:
            return True
        if self.digest[a] != self.digest[b]:
            return False
        path = []
        while a != b and (a, b) not in self.verified:
            if self.letter[a] != self.letter[b]:
                return False
            path.append((a, b))
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        self.verified.update(path)
        return True

    def cut(self, node: int, size: int) -> int:
        """The first ``size`` letters of a prefix."""
        excess = self.size[node] - size
        while excess:
            k = excess.bit_length() - 1
            node = self.ancestors[node][k]
            excess -= 1 << k
        return node

    def less(self, a: int, b: int) -> bool:
        size = min(self.size[a], self.size[b])
        x, y = self.cut(a, size), self.cut(b, size)
        if self.equal(x, y):
            return self.size[a] < self.size[b]
        # to the shortest ancestors that still differ: all before them is the longest common prefix
        for k in range(len(self.ancestors[x]) - 1, -1, -1):
            if k < len(self.ancestors[x]):
                up, vp = self.ancestors[x][k], self.ancestors[y][k]
                if not self.equal(up, vp):
                    x, y = up, vp
        return self.letter[x] < self.letter[y]

    def text(self, node: int) -> str:
        letters = []
        while node:
            letters.append(self.letter[node])
            node = self.ancestors[node][0]
        return "".join(reversed(letters))

    def best(self, a: tuple[int, int] | None, b: tuple[int, int] | None) -> tuple[int, int] | None:
        """The better of two (cost, prefix), either of which may be missing."""
        if a is None or b is None:
            return a or b
        if a[0] != b[0]:
            return a if a[0] < b[0] else b
        return b if self.less(b[1], a[1]) else a

    def longer(self, way: tuple[int, int] | None, cost: int, letter: str) -> tuple[int, int] | None:
        return way and (way[0] + cost, self.add(way[1], letter))


def inserted(tree: Prefixes, ways: list) -> list:
    """The best ways after any Inserts that may follow."""
    second = ways[2]
    for q in (0, 1, 3):
        second = tree.best(second, tree.longer(ways[q], 2, "I"))
    return [ways[0], ways[1], second, tree.best(ways[3], tree.longer(second, 2, "I"))]


def advance(tree: Prefixes, ways: list, classes: bytes) -> list:
    """The best ways by state after the turns of ``classes``, each of which ends with the edit of the last turn."""
    for c in classes:
        initial, fault = divmod(c, 3)
        held = inserted(tree, ways)
        ways = [tree.longer(way, 3, "D") for way in held]
        if fault == GONE:
            continue
        for q in range(4):
            if held[q]:
                to = STEP[q]
                if initial == to:
                    ways[to] = tree.best(ways[to], tree.longer(held[q], fault, "K"))
                else:
                    ways[to] = tree.best(ways[to], tree.longer(held[q], 2 + fault, "R"))
        if initial == 1:
            ways[1] = tree.best(ways[1], tree.longer(held[0], fault, "K"))
    return ways


def whole(classes: bytes) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    tree = Prefixes()
    ways = inserted(tree, advance(tree, [(0, 0), None, None, None], classes))
    cost, node = tree.best(ways[0], ways[3])
    return cost, tree.text(node)


def between(classes: bytes) -> tuple[list[int], list[int], list[str]]:
    """Costs (-1 if there is no way), ranks among those of one first state, and audits, by first and last state."""
    costs, ranks, audits = [], [], []
    for first in range(4):
        tree = Prefixes()
        ways = advance(tree, [(0, 0) if q == first else None for q in range(4)], classes)
        costs += [-1 if way is None else way[0] for way in ways]
        ranks += [sum(tree.less(w[1], way[1]) for w in ways if w) if way else -1 for way in ways]
        audits += ["" if way is None else tree.text(way[1]) for way in ways]
    return costs, ranks, audits


def fold(segments: list[tuple[list[int], list[int]]]) -> list[tuple[int, int, int, str]]:
    """First state, last state, cost and Inserts at the end for each segment, from their costs and ranks."""
    # by state: cost, rank of the prefix among all states, and the states so far
    ways: list[tuple[int, tuple, list[int]] | None] = [(0, (), [0]), None, None, None]
    trail: list[list[int | None]] = []
    for costs, ranks in segments:
        after, came = [], []
        for last in range(4):
            options = [
                (ways[q][0] + costs[4 * q + last], ways[q][1], ranks[4 * q + last], q)
                for q in range(4) if ways[q] and costs[4 * q + last] >= 0
            ]
            # prefixes that end with a turn's edit and come from two states differ before this segment
            best = min(options, default=None)
            after.append(best)
            came.append(best and best[3])
        order = sorted({(w[1], w[2]) for w in after if w})
        ways = [w and (w[0], order.index((w[1], w[2])), None) for w in after]
        trail.append(came)
    ends = {0: "", 1: "II", 2: "I", 3: ""}
    finish = [(ways[q][0] + 2 * len(end), q, end) for q, end in ends.items() if ways[q]]
    cheapest = min(f[0] for f in finish)
    # of equal cost: by what follows the common part; a prefix that differs earlier is told by its rank
    _, last, end = min((f for f in finish if f[0] == cheapest), key=lambda f: ways[f[1]][1])
    states = [last]
    for came in reversed(trail):
        states.append(came[states[-1]])
    states.reverse()
    return [
        (q, r, costs[4 * q + r] + (2 * len(end) if i == len(segments) - 1 else 0), end if i == len(segments) - 1 else "")
        for i, ((costs, _), q, r) in enumerate(zip(segments, states, states[1:]))
    ]


def edited(audit: str, state: int, rows: list[tuple[str, str]]) -> list[dict]:
    """The turns with their edits; inserted ones have no text, deleted ones stand as they were."""
    turns, at = [], iter(rows)
    for edit in audit:
        role, text = next(at) if edit != "I" else ("", "")
        if edit in "IR":
            role = "assistant" if state == 2 else "user"
        if edit != "D":
            state = 1 if edit == "K" and role[:1] == "s" else STEP[state]
        turns.append({"edit": edit, "role": role, "text": text})
    return turns


class Stretch:
    """Consecutive turns of one conversation, as they come in order."""

    def __init__(self, conv):
        self.conv = conv
        self.rows: list[tuple[str, str]] = []
        self.turns: list[int | None] = []
        self.classes = bytearray()
        self.counts = [0, 0, 0]  # blank, duplicate, truncated
        self.bytes = 0

    def add(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        visible = text.strip(SPACE)
        fault = GONE
        if not visible:
            self.counts[0] += 1
        elif seen:
            self.counts[1] += 1
        elif visible[-1] not in ".!?":
            self.counts[2] += 1
            fault = CUT
        else:
            fault = KEEP
        self.rows.append((role, text))
        self.turns.append(turn)
        self.classes.append(3 * INITIAL.get(role[:1], 0) + fault)
        self.bytes += len(role) + len(text)

    def summary(self) -> dict:
        told = [t for t in self.turns if t is not None]
        firsts = [role[:1] for role, _ in self.rows]
        return {
            "n_rows": len(self.rows),
            "blank": self.counts[0], "duplicate": self.counts[1], "truncated": self.counts[2],
            "illegal": sum(a + b not in LEGAL for a, b in zip(firsts, firsts[1:])),
            "min_turn": min(told, default=None), "max_turn": max(told, default=None), "n_turns": len(set(told)),
        }


COUNTS = "n_rows long, blank long, duplicate long, truncated long, illegal long, min_turn long, max_turn long, n_turns long"
TURNS = "turns array<struct<edit: string, role: string, text: string>>"


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _stretches(batches: Iterator[pa.RecordBatch], rows: int | None, size: int | None) -> Iterator[Stretch]:
    """Stretches of sorted rows; of whole conversations if no limits are given.

    Limits cut after so many rows or bytes; then a row is a duplicate if ``later`` says so or the row before
    it is the same, else if its conversation had the same role and text before.
    """
    current, before, seen = None, None, set()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "later")]
        for conv, turn, role, text, present, later in zip(*columns):
            if current is None or conv != current.conv:
                if current is not None:
                    yield current
                current, before, seen = Stretch(conv), None, set()
            elif rows and (len(current.rows) >= rows or current.bytes >= size):
                yield current
                current = Stretch(conv)
            if not present:
                continue
            said = (role, text)
            if rows:
                known = later or before == (turn, role, text)
                before = (turn, role, text)
            else:
                known = said in seen
                seen.add(said)
            current.add(turn, role, text, known)
    if current is not None:
        yield current


def _batched(records: Iterator[dict], schema: pa.Schema, most: int = 200, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, weight = [], 0
    for record in records:
        held.append(record)
        weight += sum(len(t["text"]) for t in record.get("turns") or [])
        if len(held) >= most or weight >= size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _short(rows: DataFrame) -> DataFrame:
    """Conversations that one call takes, each with its edits."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    schema = T._parse_datatype_string(f"conv_id {conv}, segment long, n_segments long, {COUNTS}, cost long, audit string, {TURNS}")
    arrow = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[int, str]] = {}

        def records() -> Iterator[dict]:
            for stretch in _stretches(batches, None, None):
                classes = bytes(stretch.classes)
                found = known.get(classes)
                if found is None:
                    found = whole(classes)
                    if len(classes) <= KNOWN_TURNS and len(known) < KNOWN_SIZE:
                        known[classes] = found
                yield {
                    "conv_id": stretch.conv, "segment": 0, "n_segments": 1, **stretch.summary(),
                    "cost": found[0], "audit": found[1], "turns": edited(found[1], 0, stretch.rows),
                }

        yield from _batched(records(), arrow)

    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    return ordered.mapInArrow(run, schema)


def _long(rows: DataFrame, segment_rows: int, segment_bytes: int) -> DataFrame:
    """The segments of conversations that are too long for one call, each with its edits."""
    conv = rows.schema["conv_id"].dataType.simpleString()
    said = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit("\n"),
        F.length("role").cast("string"), F.lit("\n"), F.col("role"), F.col("text"),
    )
    keyed = materialise(
        rows.filter("present").drop("later").withColumn("said", F.unhex(F.sha2(said, 256))), "dialogue-rows")
    firsts = materialise(
        keyed.groupBy("said").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("n")), "dialogue-firsts")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    marked = lookup(keyed, firsts, "said", F.col("n"), "inner").select(
        "conv_id", "turn", "role", "text", "present", F.expr("NOT (turn <=> first.turn)").alias("later"))
    heavy_schema = T._parse_datatype_string(
        f"conv_id {conv}, part long, block long, piece string, {COUNTS}, first_turn long, last_turn long, first_initial string, "
        "last_initial string, costs array<long>, ranks array<long>, audits array<string>, "
        "turns array<struct<edit: string, role: string, text: string>>")
    heavy_arrow = _arrow(heavy_schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def records() -> Iterator[dict]:
            for block, stretch in enumerate(_stretches(batches, segment_rows, segment_bytes)):
                costs, ranks, audits = between(bytes(stretch.classes))
                yield {
                    "conv_id": stretch.conv, "part": part, "block": block, "piece": f"{part}:{block}", **stretch.summary(),
                    "first_turn": stretch.turns[0], "last_turn": stretch.turns[-1],
                    "first_initial": stretch.rows[0][0][:1], "last_initial": stretch.rows[-1][0][:1],
                    "costs": costs, "ranks": ranks, "audits": audits,
                    "turns": [{"edit": "", "role": r, "text": t} for r, t in stretch.rows],
                }

        yield from _batched(records(), heavy_arrow)

    heavy = materialise(
        marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, heavy_schema), "dialogue-segments")
    light_schema = "piece string, segment long, n_segments long, q long, way long, tail string, cost long, more_illegal long, same_turn long"
    light_arrow = _arrow(T._parse_datatype_string(light_schema))

    def chain(group: pa.Table) -> pa.Table:
        # a row for each segment: a ten-thousandth of the conversation's turns, some 300 bytes each
        pieces = group.sort_by([("part", "ascending"), ("block", "ascending")]).to_pylist()
        chosen, out, before = fold([(p["costs"], p["ranks"]) for p in pieces]), [], None
        for i, (p, (q, r, cost, end)) in enumerate(zip(pieces, chosen)):
            out.append({
                "piece": p["piece"], "segment": i, "n_segments": len(pieces), "q": q, "way": 4 * q + r, "tail": end, "cost": cost,
                "more_illegal": int(before is not None and before["last_initial"] + p["first_initial"] not in LEGAL),
                "same_turn": int(before is not None and p["first_turn"] is not None and before["last_turn"] == p["first_turn"]),
            })
            before = p
        return pa.Table.from_pylist(out, light_arrow)

    light = materialise(
        heavy.select("conv_id", "part", "block", "piece", "costs", "ranks", "first_turn", "last_turn", "first_initial", "last_initial")
        .groupBy("conv_id").applyInArrow(chain, light_schema), "dialogue-ways")
    both = lookup(heavy.drop("part", "block", "costs", "ranks"), light, "piece", F.lit(1), "inner").select(
        "conv_id", "segment", "n_segments", "n_rows", "blank", "duplicate", "truncated",
        (F.col("illegal") + F.col("more_illegal")).alias("illegal"), "min_turn", "max_turn",
        (F.col("n_turns") - F.col("same_turn")).alias("n_turns"), "cost",
        F.expr("concat(audits[way], tail)").alias("audit"), "turns", "q",
    )
    schema = T._parse_datatype_string(f"conv_id {conv}, segment long, n_segments long, {COUNTS}, cost long, audit string, {TURNS}")
    arrow = _arrow(schema)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[dict]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    q = row.pop("q")
                    row["turns"] = edited(row["audit"], q, [(t["role"], t["text"]) for t in row["turns"]])
                    yield row

        yield from _batched(records(), arrow)

    return both.mapInArrow(apply, schema)


def repair(rows: DataFrame, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Conversations (``conv_id``, ``turn``, ``role``, ``text``) repaired: one row for each segment.

    Gives ``conv_id``, ``segment`` (from 0) of ``n_segments``, counts of rows and faults, ``min_turn``, ``max_turn`` and
    ``n_turns`` (distinct ones, not counted again if the segment before ends with it), ``cost``, ``audit`` and ``turns``: the edits in order with
    role and text after them. Of a boolean column ``present``, rows with false only name their conversation.
    """
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    rows = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"), present.alias("present"), F.lit(False).alias("later"),
    )
    # compared as text, where a null is a value like others
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("_key")
    sizes = rows.filter("present").groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("_bytes"))
    large = materialise(
        sizes.filter((F.col("_n") > segment_rows) | (F.col("_bytes") > segment_bytes)).drop("_bytes"), "dialogue-long")
    if large.limit(1).count() == 0:
        return _short(rows)
    told = lookup(rows.withColumn("_key", key), large, "_key", F.col("_n"), "left")
    short = _short(told.filter("_n IS NULL").drop("_key", "_n"))
    return short.unionByName(_long(told.filter("_n IS NOT NULL").drop("_key", "_n"), segment_rows, segment_bytes))


#: The edits of a conversation's rows by their checksum, before repair.
DAMAGED = """
SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
  CASE h WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  h <> 0 AS present, explode(array_repeat(0, CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy
FROM (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    crc32(concat(coalesce(CAST(conv_id AS STRING), ' '), ':', coalesce(CAST(turn AS STRING), ' '))) % 20 AS h
  FROM {rows})
"""


def digests(repaired: DataFrame) -> DataFrame:
    """One row for each conversation: counts, cost, audit and the digest of the repaired text.

    Conversations of one segment are done by SQL functions. The others are summed up by segment, and their
    text streams through one task each in order, as a digest cannot be taken in parts.
    """
    lines = F.expr(
        "array_join(transform(filter(turns, t -> t.edit <> 'D'), t -> concat(t.role, ':', t.text)), '\\n')")
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0)).alias("gaps")
    counts = ["blank", "duplicate", "truncated", "illegal", "cost"]
    single = repaired.filter("n_segments = 1").select(
        "conv_id", gaps, *counts, "audit", F.sha2(lines, 256).alias("repaired_sha256"))
    large = materialise(repaired.filter("n_segments > 1").withColumn("lines", lines), "dialogue-repaired")
    if large.limit(1).count() == 0:
        return single
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")).alias("_key")
    summed = large.groupBy(key, "conv_id").agg(
        F.min("min_turn").alias("min_turn"), F.max("max_turn").alias("max_turn"), F.sum("n_turns").alias("n_turns"),
        *[F.sum(c).alias(c) for c in counts],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", "audit"))), lambda s: s["audit"]), "")
        .alias("audit"),
    ).select("_key", "conv_id", gaps, *counts, "audit")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, empty = None, None, True
        for batch in batches:
            for name, kept, text in zip(*[batch.column(c) for c in ("_key", "kept", "lines")]):
                name = name.as_py()
                if name != at:
                    if at is not None:
                        yield pa.RecordBatch.from_pydict({"_key": [at], "repaired_sha256": [digest.hexdigest()]})
                    at, digest, empty = name, hashlib.sha256(), True
                if kept.as_py():
                    digest.update(("" if empty else "\n").encode() + text.as_py().encode("utf-8"))
                    empty = False
        if at is not None:
            yield pa.RecordBatch.from_pydict({"_key": [at], "repaired_sha256": [digest.hexdigest()]})

    hashed = (
        large.select(key, "segment", F.expr("exists(turns, t -> t.edit <> 'D')").alias("kept"), "lines")
        .repartition("_key").sortWithinPartitions("_key", "segment").select("_key", "kept", "lines")
        .mapInArrow(stream, "_key string, repaired_sha256 string")
    )
    return single.unionByName(summed.join(hashed, "_key").drop("_key"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by its rows' checksums, with its faults, the cheapest repair and its digest."""
    rows = table(spark, sf_dir, "conversations")
    return digests(repair(spark.sql(DAMAGED, rows=rows).drop("copy")))
