"""Shards of equal row counts that keep linked documents together, by balanced label propagation.

Documents of a group (here: with equal texts) are linked. Each linked document starts in a shard that
its hash gives. In a round, each group counts its members by shard; the shards with most of them, and
with room for the others, are those it settles in, as few as its size allows. Members elsewhere ask to move there. How many of
those that ask to go from one shard to another may move follows from the quotas: what a shard has,
less what leaves, plus what comes, stays within its share of all rows. The rounds are joins and
aggregates over the linked documents, each written to the shared folder, and end when nothing moves.

Afterwards a shard keeps at most its quota of linked documents; those over it, and the documents
without links, which are at home anywhere, fill the slots left. So row counts differ by one at most,
whatever the rounds have done, and edges are cut only where a group is too large or space was short.

Everything is DataFrame and SQL functions. The driver sees counts by pairs of shards only. A group is
counted before it is shuffled, has a row per shard afterwards, and frequent groups are broadcast, so
one with a third of all rows is no hot key.

Defined results: a null text is empty, and such documents are a group like any other; repeated rows
are separate documents; null ids are kept; an empty table gives an empty result; ``shard_rows`` keeps columns of any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import fresh, lookup, table, text_digest
from tidegrid.session import materialise

SHARDS = 40
#: Names of columns that are made on the way.
WORKING = {"key", "n", "group", "shard", "slot", "at", "wish"}
#: Rounds at most; groups that fit settle in one or two.
ROUNDS = 8
#: Rows that one task puts in order when slots are numbered.
PIECE = 20_000
#: Bytes that a document takes beside its text (fixed by the contract).
OVERHEAD = 16


def numbered(rows: DataFrame, within: list[str], order: list[str], name: str) -> DataFrame:
    """``rows`` with ``name``: 0, 1, 2 … within equal ``within``, written to the shared folder.

    Rows are dealt to pieces by a hash of ``order``, numbered in each, and shifted by the sizes of
    the pieces before, so no task orders more than about ``PIECE`` rows.
    """
    pieces = max(1, -(-rows.count() // PIECE))
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(F.lit("piece"), *order), F.lit(pieces)))
    keys = [*within, "_piece"]
    ranked = dealt.selectExpr(
        "*", f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}) - 1 AS _at"
    )
    ranked = materialise(ranked, "ranked")
    sizes = ranked.groupBy(*keys).agg((F.max("_at") + 1).alias("_size"))
    part = f"PARTITION BY {', '.join(within)} " if within else ""
    before = materialise(
        sizes.selectExpr(*keys, f"sum(_size) OVER ({part}ORDER BY _piece) - _size AS _before"), "piece-sizes"
    )
    return materialise(
        ranked.join(before, keys).withColumn(name, F.col("_at") + F.col("_before")).drop("_piece", "_at", "_before"),
        "numbered",
    )


def admitted(asked: dict[tuple[int, int], int], load: list[int], quota: list[int]) -> dict[tuple[int, int], float]:
    """Which share of those that ask to go from one shard to another may go.

    Starts from all and takes back as much as a shard would be over its quota, which holds back
    what would leave other shards, until every shard is within its quota. Shares only fall.
    """
    share = dict.fromkeys(asked, 1.0)
    shards = range(len(load))
    for _ in range(1000):
        coming, going = [0.0] * len(load), [0.0] * len(load)
        for (a, b), n in asked.items():
            coming[b] += n * share[a, b]
            going[a] += n * share[a, b]
        over = {b for b in shards if coming[b] > 1e-9 and load[b] + coming[b] - going[b] > max(quota[b], load[b] - going[b]) + 0.5}
        if not over:
            break
        for (a, b) in asked:
            if b in over:
                room = max(0.0, quota[b] - load[b] + going[b])
                share[a, b] *= min(1.0, room / coming[b])
    return share


def propagate(linked: DataFrame, quota: list[int]) -> DataFrame:
    """``linked`` (``key``, ``group``, ``n`` members) with ``shard`` after the rounds of moving."""
    shards = len(quota)
    least = max(1, min(quota))
    state = materialise(
        linked.withColumn("shard", F.pmod(F.xxhash64(F.lit("start"), "key"), F.lit(shards)).cast("int")), "shards-0"
    )
    for turn in range(1, ROUNDS + 1):
        votes = materialise(state.groupBy("group", "shard").agg(F.count("*").alias("c"), F.max("n").alias("n")), "votes")
        load = [0] * shards
        for row in votes.groupBy("shard").agg(F.sum("c").alias("c")).collect():
            load[row["shard"]] = row["c"]
        room = f"array({', '.join(str(q - x) for q, x in zip(quota, load, strict=True))})"
        # Shards with room for the rest of the group come first, then those with most of it. Equal counts
        # are told apart by a hash, so that groups do not all prefer the same shards.
        homes = votes.groupBy("group").agg(
            F.sort_array(F.collect_list(F.struct(
                F.expr(f"get({room}, shard) >= n - c").alias("fits"), "c", F.xxhash64("group", "shard").alias("h"), "shard"
            )), False).alias("order"),
            F.max("n").alias("n"),
        ).selectExpr(
            "group", "n AS members", "order",
            # where none of its shards has room for a group that a shard can hold, one that has
            f"CASE WHEN n <= {least} AND NOT order[0].fits THEN"
            f" filter(sequence(0, {shards - 1}), s -> get({room}, s) >= n) ELSE array() END AS roomy",
        ).selectExpr(
            "group", "members",
            f"CASE WHEN size(roomy) > 0 THEN array(get(roomy, CAST(pmod(xxhash64('roomy', {turn}, group), size(roomy)) AS INT)))"
            f" ELSE transform(slice(order, 1, CAST(ceil(members / {least}) AS INT)), x -> x.shard) END AS homes",
        )
        homes = materialise(homes, "homes")
        wish = materialise(
            lookup(state, homes, "group", F.col("members")).withColumn(
                "wish",
                F.expr("CASE WHEN array_contains(homes, shard) THEN shard"
                       f" ELSE get(homes, CAST(pmod(xxhash64('home', {turn}, key), size(homes)) AS INT)) END"),
            ).drop("homes", "members"), "wishes"
        )
        moves = wish.filter("shard <> wish").groupBy("shard", "wish").count().collect()
        asked = {(row["shard"], row["wish"]): row["count"] for row in moves}
        share = admitted(asked, load, quota)
        parts = 1 << 20
        allowed = {k: int(v * parts) for k, v in share.items() if int(v * parts) > 0}
        if not allowed:
            return wish.drop("wish")
        # at most shards * shards numbers, looked up by position
        limits = [allowed.get((a, b), 0) for a in range(shards) for b in range(shards)]
        limit = F.get(F.expr(f"array({', '.join(map(str, limits))})"), (F.col("shard") * shards + F.col("wish")).cast("int"))
        # a group that fits in a shard moves as one
        unit = F.when(F.col("n") <= least, F.xxhash64("group")).otherwise(F.col("key"))
        draw = F.pmod(F.xxhash64(F.lit("move"), F.lit(turn), unit), F.lit(parts))
        state = materialise(
            wish.withColumn("shard", F.when(draw < limit, F.col("wish")).otherwise(F.col("shard"))).drop("wish"),
            f"shards-{turn}",
        )
    return state


def shard_rows(rows: DataFrame, group: str = "group", shards: int = SHARDS) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: counts at most one apart, few groups cut.

    Columns of any name are kept, ``group`` as the last of them; if ``rows`` has ``shard`` or ``slot``, the new ones get underscores.
    """
    order = [c for c in rows.columns if c != group] + [group]
    if {c.lower() for c in order[:-1]} & WORKING:
        packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in order]).alias("packed"), F.col(f"`{group}`").alias("group"))
        done = shard_rows(packed, "group", shards)
        return done.select("packed.*", F.col("shard").alias(fresh(order, "shard")), F.col("slot").alias(fresh(order, "slot")))
    rows = materialise(rows.withColumn("key", F.xxhash64(*order)), "shard-rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    groups = materialise(rows.groupBy(group).agg(F.count("*").alias("n")).filter("n > 1"), "groups")
    marked = materialise(lookup(rows, groups, group, F.col("n")), "marked")
    linked = propagate(marked.filter("n IS NOT NULL").withColumnRenamed(group, "group"), quota)
    # members of a group stand together, so that a shard over its quota gives up few groups
    ranked = numbered(linked.withColumnRenamed("group", group).drop("n"), ["shard"], [group, "key", *order[:-1]], "slot")
    bound = F.get(F.expr(f"array({', '.join(map(str, quota))})"), F.col("shard"))
    stay = ranked.filter(F.col("slot") < bound)
    kept = {r["shard"]: r["count"] for r in stay.groupBy("shard").count().collect()}
    free, filled = [], 0
    for s in range(shards):
        free.append((filled, kept.get(s, 0)))
        filled += quota[s] - kept.get(s, 0)
    rest = ranked.filter(F.col("slot") >= bound).drop("shard", "slot").unionByName(
        marked.filter("n IS NULL").drop("n")
    )
    pool = numbered(rest, [], ["key", *order], "at")
    starts = f"array({', '.join(f'{a}L' for a, _ in free)})"
    used = f"array({', '.join(f'{k}L' for _, k in free)})"
    # the last shard whose free slots start at or before the row's number
    filled_in = pool.selectExpr(
        "*", f"size(filter({starts}, s -> s <= at)) - 1 AS shard"
    ).selectExpr("*", f"at - get({starts}, shard) + get({used}, shard) AS slot").drop("at")
    columns = [*order, "shard", "slot"]
    return stay.selectExpr(*columns).unionByName(filled_in.selectExpr(*columns))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of equal row counts."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), text_digest(F.col("text")).alias("group"),
    )
    return shard_rows(rows).selectExpr(
        "doc_id", "size", "text_crc32", "'rows' AS law", "CAST(shard AS INT) AS shard", "CAST(slot AS BIGINT) AS slot",
        "CAST(NULL AS INT) AS grown_shard",
    )
