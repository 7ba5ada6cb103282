"""Near-duplicate documents by DartMinHash signatures and a banded join.

A document is a bag of five-word shingles; a shingle's weight is how often it occurs. Hashed darts
fall on the plane of weight and rank of every shingle, as many per area everywhere and at the same
places for every document. A document owns the darts on its own region, weight below the shingle's
weight; for each coordinate of the signature the earliest dart in rank counts. Two documents have
the same dart in a coordinate with a probability equal to their weighted Jaccard similarity. Only
darts up to the rank that a document needs are thrown, so a signature costs about as much as reading
the document once.

Documents that agree in a band of coordinates share a bucket. Exact copies are one node. In a
bucket each node is compared with the bucket's hub, the node that meets most others. That settles
most buckets: a group of m near copies takes about m comparisons. Where a bucket still holds several
groups, the nodes outside its largest are compared with the rest, in a small bucket pair by pair,
in a larger one in blocks of bounded size, within which no pair becomes a row. So two nodes of a bucket
that are similar enough always end in one group. Comparisons are exact, over the whole bags.

Groups are the connected components of the pairs at or above the threshold. Signatures have 24 bands
of 6 coordinates: a pair at the threshold of 0.8 meets in a bucket with probability 0.9993, more
similar ones more surely.

Defined results: null text counts as empty; a text of fewer than five words is one shingle; texts
without words are linked to equal texts only; rows with equal texts are one class whatever their
ids; the smallest id leads a class or group, null ids come last; empty tables give empty results;
``keep_one`` carries columns of any name along, and of repeated rows it keeps one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from tidegrid.llm.common import components, fresh, is_small, lookup, table
from tidegrid.operators.skew import meet
from tidegrid.session import materialise

WORDS = 5
THRESHOLD = 0.8
BANDS = 24
ROWS = 6
COORDINATES = BANDS * ROWS
#: Darts thrown on average at first: enough that nearly every coordinate gets one.
DARTS = COORDINATES * (np.log(COORDINATES) + 2)

WORD = re.compile("[^\x20\x09-\x0d]+")
#: Odd constants of the integer hash.
M1, M2, M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Buckets up to this size are compared pair by pair, larger ones in blocks of so many shingles.
SMALL = 24
BLOCK = 250_000
#: Nodes on one side of a block at most, or about so many; a block has a matrix of both sides.
BLOCK_NODES = 4_000
#: Words whose hash a Python worker keeps.
KNOWN_WORDS = 200_000


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M2
    x = (x ^ (x >> np.uint64(27))) * M3
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


def shingles(text: str | None, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of ``text`` as numbers, and how often each occurs."""
    words = WORD.findall(text or "")
    if not words:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(words))
    count = len(words) - size + 1
    total = np.full(count, size, np.uint64)
    for k in range(size):
        total = mix(total + hashes[k : k + count]) * M1
    return np.unique(total, return_counts=True)


def signature(elements: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The identity of the earliest dart of each coordinate on the weighted region of the elements."""
    bound = DARTS / float(weights.sum())
    while True:
        ranks, darts = thrown(elements, weights, bound)
        place = (darts % np.uint64(COORDINATES)).astype(np.int64)
        order = np.argsort(-ranks, kind="stable")  # the earliest is written last
        chosen = np.zeros(COORDINATES, np.uint64)
        hit = np.zeros(COORDINATES, bool)
        chosen[place[order]], hit[place] = darts[order], True
        if hit.all():
            return chosen
        bound *= 2


def thrown(elements: np.ndarray, weights: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Ranks and identities of the darts on the elements' regions with a rank up to ``bound``.

    Layer v of the weight axis is [2^v - 1, 2^(v+1) - 1). On a layer of an element, darts arrive along
    the rank axis at exponential distances, as many per rank as the layer is wide; each has a hashed
    weight within the layer and counts if that is below the element's weight.
    """
    out_ranks, out_darts = [], []
    low, width = 0, 1
    while True:
        over = weights > low
        if not over.any():
            return np.concatenate(out_ranks), np.concatenate(out_darts)
        seed = mix(elements[over] + np.uint64(int(M1) * width % 2**64))
        top = weights[over]
        rank, number = np.zeros(len(seed)), 1
        darts = max(1, int(bound * width + 2 * np.sqrt(bound * width)))
        while len(seed):
            ids = mix(seed[:, None] + M1 * np.arange(number, number + darts, dtype=np.uint64))
            uniform = ((ids >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            ranks = rank[:, None] - np.cumsum(np.log(uniform), axis=1) / width
            kinds = mix(ids + M2)
            taken = ranks <= bound
            more = taken[:, -1]  # these have further darts within the bound
            if width > 1:
                height = low + width * ((kinds >> np.uint64(40)).astype(np.float64) + 0.5) * 2.0**-24
                taken &= height < top[:, None]
            out_ranks.append(ranks[taken])
            out_darts.append(kinds[taken])
            seed, top, rank = seed[more], top[more], ranks[more, -1]
            number += darts
            darts = max(1, darts // 2)
        low, width = low + width, 2 * width


def band_hashes(coordinates: np.ndarray) -> np.ndarray:
    bands = coordinates.reshape(BANDS, ROWS)
    total = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        total = mix(total * M1 + bands[:, k])
    return total.view(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """``doc_id``, digest of the text, number of shingles and band hashes of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            nodes, sizes, bands = [], [], []
            for text in batch.column(1):
                value = text.as_py() or ""
                nodes.append(hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest()[:16])
                elements, weights = shingles(value, known)
                sizes.append(int(weights.sum()))
                bands.append(band_hashes(signature(elements, weights)) if len(elements) else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "node", "size", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, node binary, size long, bands array<long>"
    )


def node_of(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def bags(texts: DataFrame) -> DataFrame:
    """``node`` and its shingles as an array of numbers, an occurrence each, for ``node``, ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            out = []
            for text in batch.column(1):
                elements, weights = shingles(text.as_py(), known)
                # the k-th occurrence of a shingle is an element of its own, so a bag is a set
                nth = np.arange(weights.sum(), dtype=np.uint64)
                nth -= np.repeat((np.cumsum(weights) - weights).astype(np.uint64), weights)
                out.append(mix(np.repeat(elements, weights) + nth * M1).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["node", "bag"]
            )

    return texts.select("node", "text").mapInArrow(run, "node binary, bag array<long>")


def compared(pairs: DataFrame, bag_table: DataFrame) -> DataFrame:
    """The similarity of each pair (``a``, ``b``). ``a`` may be hot; its bag is repeated as needed."""
    hubs = bag_table.select(F.col("node").alias("a"), F.col("bag").alias("bag_a"))
    with_a = meet(pairs, hubs, ["a"], ["b"], False)
    both = with_a.join(bag_table.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
    shared = F.size(F.array_intersect("bag_a", "bag_b"))
    return both.select("a", "b", shared.alias("shared"), (F.size("bag_a") + F.size("bag_b")).alias("sizes")).select(
        "a", "b", (F.col("shared") / (F.col("sizes") - F.col("shared"))).alias("similarity")
    )


def _could(a: str, b: str) -> Column:
    """Whether bags of these sizes can reach the threshold at all."""
    return F.least(a, b) >= THRESHOLD * F.greatest(a, b) - 1e-9


def near_links(sketch: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) between nodes: enough to join all that a bucket's similar pairs join."""
    # the row with the first id stands for its class
    lead = sketch.alias("s").join(
        classes.alias("c"),
        F.expr("s.node = c.node AND coalesce(s.doc_id, -1) = coalesce(c.first_id, -1) AND s.doc_id <=> c.first_id"),
    ).select("s.node", "s.size", "s.doc_id", "s.bands")
    rows = materialise(lead.select("node", "size", "doc_id", F.explode("bands").alias("bucket")), "bands")
    buckets = materialise(
        rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min("node").alias("one"), F.max("node").alias("other"))
        .filter("one <> other").select("bucket", "n"), "buckets"
    )
    met = materialise(lookup(rows, buckets, "bucket", F.col("n"), "inner"), "met")
    mass = met.groupBy("node").agg(F.sum("n").alias("mass"))
    weighed = materialise(met.join(mass, "node"), "weighed")
    hubs = materialise(
        weighed.groupBy("bucket").agg(
            F.max(F.struct("mass", "node")).getField("node").alias("hub"), F.max("n").alias("n")
        ), "hubs"
    )
    member = materialise(
        lookup(weighed.select("bucket", "node", "size"), hubs, "bucket", F.col("n"), "inner"), "members"
    )
    sizes = met.groupBy("node").agg(F.max("size").alias("size"), F.max(F.coalesce("doc_id", F.lit(-1))).alias("id"))
    nodes = materialise(sizes, "nodes")
    bag_table = materialise(bags(_texts(nodes, docs)), "bags")
    hub_size = nodes.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"))
    star = member.filter("node <> hub").select("hub", "node", "size").distinct()
    star = materialise(
        meet(star, hub_size, ["hub"], ["node"], False).filter(_could("size", "hub_size"))
        .select(F.col("hub").alias("a"), F.col("node").alias("b")), "star"
    )
    tested = materialise(compared(star, bag_table), "star-compared")
    links = tested.filter(F.col("similarity") >= THRESHOLD).select("a", "b")
    labels = components(links)
    labelled = materialise(
        member.filter("n > 2").join(labels.withColumnRenamed("label", "got"), "node", "left")
        .join(tested.select(F.col("a").alias("hub"), F.col("b").alias("node"), "similarity"), ["hub", "node"], "left")
        .select("bucket", "n", "node", "size", "hub", F.coalesce("got", "node").alias("label"),
                # unknown for a pair that sizes ruled out
                F.when(F.col("node") != F.col("hub"), 1 - F.col("similarity")).alias("far")), "labelled"
    )
    still = materialise(_unsettled(labelled), "unsettled")
    pairs = materialise(_left_over(still.filter(F.col("n") <= SMALL)), "left-over")
    rest = compared(pairs, bag_table).filter(F.col("similarity") >= THRESHOLD).select("a", "b")
    blocks = _links_in_blocks(still.filter(F.col("n") > SMALL), bag_table)
    return materialise(links.union(rest).union(blocks), "links")


def _texts(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The text of each node, read from the document that leads its class."""
    wanted = nodes.select("node", "id")
    if is_small(wanted, F.lit(64)):
        wanted = F.broadcast(wanted)
    found = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("id"), "text").join(wanted, "id")
    return found.filter(node_of(F.col("text")) == F.col("node")).select("node", "text").dropDuplicates(["node"])


def _unsettled(labelled: DataFrame) -> DataFrame:
    """Members of buckets that still hold several groups, but for the hub, with the bucket's largest group.

    Of two nodes in different groups at least one is outside the largest, so only such nodes need
    to look for partners.
    """
    groups = labelled.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    largest = groups.groupBy("bucket").agg(
        F.max(F.struct("c", "label")).getField("label").alias("main"), F.count("*").alias("groups"),
        F.sum("c").alias("members"),
    ).filter("groups > 1")
    largest = materialise(largest.select("bucket", "main", "members"), "open-buckets")
    return lookup(labelled, largest, "bucket", F.col("members"), "inner").filter("node <> hub")


def _left_over(still: DataFrame) -> DataFrame:
    """Pairs within buckets of at most ``SMALL`` nodes that could be similar: half as many per node at most.

    By the triangle inequality partners are about as far from the hub.
    """
    a = still.filter("label <> main").select(
        "bucket", F.col("node").alias("a"), F.col("label").alias("la"), F.col("size").alias("sa"), F.col("far").alias("fa")
    )
    b = still.select(
        "bucket", F.col("node").alias("b"), F.col("label").alias("lb"), F.col("size").alias("sb"), F.col("far").alias("fb"),
        (F.col("label") == F.col("main")).alias("in_main"),
    )
    near = F.coalesce(F.abs(F.col("fa") - F.col("fb")) <= 1 - THRESHOLD + 1e-9, F.lit(True))
    pairs = a.join(b, "bucket").filter("la <> lb AND (in_main OR a < b)").filter(_could("sa", "sb")).filter(near)
    return pairs.select("a", "b").distinct()


def _links_in_blocks(still: DataFrame, bag_table: DataFrame) -> DataFrame:
    """Links within larger buckets, from blocks of nodes that look for partners against blocks of members.

    A block has about ``BLOCK`` shingles and ``BLOCK_NODES`` nodes a side at most, so a task's memory is bounded however large the bucket. The
    shared shingles of all pairs of two blocks are one product of matrices; no pair is a row. A node
    that finds several members of a group is linked to one of them.
    """
    per_bucket = materialise(
        still.groupBy("bucket").agg(
            F.sum("size").alias("all"), F.sum(F.when(F.expr("label <> main"), F.col("size"))).alias("seek"), F.count("*").alias("c"),
            F.count_if(F.expr("label <> main")).alias("seekers"),
        ).select(
            "bucket", "c", F.ceil(F.greatest(F.col("all") / BLOCK, F.col("c") / BLOCK_NODES)).cast("int").alias("pieces"),
            F.ceil(F.greatest(F.coalesce("seek", F.lit(0)) / BLOCK, F.col("seekers") / BLOCK_NODES)).cast("int").alias("blocks"),
        ), "large-buckets"
    )
    sized = lookup(still.select("bucket", "node", "size", "label", "main"), per_bucket, "bucket", F.col("c"), "inner")
    place = F.xxhash64("node")
    members = sized.filter("blocks > 0").select(
        "bucket", "node", "label", F.lit(False).alias("seeks"), F.pmod(place, F.col("pieces")).cast("int").alias("piece"),
        F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
    )
    seekers = sized.filter("label <> main").select(
        "bucket", "node", "label", F.lit(True).alias("seeks"), F.explode(F.expr("sequence(0, pieces - 1)")).alias("piece"),
        F.pmod(place, F.col("blocks")).cast("int").alias("block"),
    )
    return members.unionByName(seekers).join(bag_table, "node").groupBy("bucket", "piece", "block").applyInArrow(
        _block_links, "a binary, b binary"
    ).distinct()


def _block_links(table: pa.Table) -> pa.Table:
    seeks = table["seeks"].to_numpy(zero_copy_only=False)
    nodes, labels = table["node"].to_pylist(), table["label"].to_pylist()
    bags = table["bag"].combine_chunks()
    values, ends = bags.flatten().to_numpy(), np.concatenate([[0], np.cumsum(bags.value_lengths().to_numpy())])
    rows = np.repeat(np.arange(len(nodes)), np.diff(ends))
    out_a, out_b = [], []
    own, other = np.flatnonzero(seeks), np.flatnonzero(~seeks)
    if len(own) and len(other):
        at = np.zeros(len(nodes), np.int64)
        at[own], at[other] = np.arange(len(own)), np.arange(len(other))
        _, element = np.unique(values, return_inverse=True)
        # only elements on both sides can be shared
        both = np.zeros((2, element.max() + 1), bool)
        both[seeks[rows].astype(int), element] = True
        new = np.cumsum(both.all(axis=0)) - 1
        used = both.all(axis=0)[element]
        rows, element = rows[used], new[element[used]]
        order = np.argsort(element, kind="stable")
        rows, element = rows[order], element[order]
        shared = np.zeros((len(own), len(other)), np.float32)
        step = 4096
        for low in range(0, int(element[-1]) + 1 if len(element) else 0, step):
            cut = slice(*np.searchsorted(element, [low, low + step]))
            part = [np.zeros((len(x), step), np.float32) for x in (other, own)]
            for side in (0, 1):
                some = seeks[rows[cut]] == bool(side)
                part[side][at[rows[cut][some]], element[cut][some] - low] = 1
            shared += part[1] @ part[0].T
        sizes = np.diff(ends)
        union = sizes[own][:, None] + sizes[other][None, :] - shared
        for i, j in zip(*np.nonzero(shared >= THRESHOLD * union - 1e-9), strict=True):
            out_a.append(own[i])
            out_b.append(other[j])
    seen, a, b = set(), [], []
    for x, y in zip(out_a, out_b, strict=True):
        # exactly as the similarity is computed elsewhere
        if labels[x] != labels[y] and (x, labels[y]) not in seen:
            both_sizes, common = ends[x + 1] - ends[x] + ends[y + 1] - ends[y], np.intersect1d(
                values[ends[x] : ends[x + 1]], values[ends[y] : ends[y + 1]], assume_unique=True
            ).size
            if common / (both_sizes - common) >= THRESHOLD:
                seen.add((x, labels[y]))
                a.append(nodes[x])
                b.append(nodes[y])
    return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})


def near_groups(docs: DataFrame) -> DataFrame:
    """For each row of ``docs``: its id and digest, class, group and whether it leads the group.

    ``class_id`` is the first id with the same text, ``group_id`` the first id of the group,
    ``group_node`` the digest of its text.
    """
    sketch = materialise(sketched(docs), "sketch")
    classes = materialise(
        sketch.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")), "classes"
    )
    links = near_links(sketch, classes, docs)
    labels = components(links)
    grouped = labels.join(classes, "node").select(
        "node", "label", F.struct(F.col("first_id").isNull().alias("no"), F.col("first_id").alias("id"), "node").alias("lead")
    )
    leads = grouped.groupBy("label").agg(F.min("lead").alias("lead"))
    lead_of = labels.join(leads, "label").select("node", F.col("lead.id").alias("group_id"), F.col("lead.node").alias("group_node"))
    joint = (
        classes.join(lead_of, "node", "left").filter("n > 1 OR group_node IS NOT NULL")
        .select("node", "n", "first_id", F.coalesce("group_node", "node").alias("group_node"),
                F.when(F.col("group_node").isNull(), F.col("first_id")).otherwise(F.col("group_id")).alias("group_id"))
    )
    joint = materialise(joint.withColumn("joint", F.lit(True)), "joint")
    all_rows = lookup(sketch.select("doc_id", "node", "size"), joint, "node", F.col("n"))
    class_id = F.when(F.col("joint"), F.col("first_id")).otherwise(F.col("doc_id"))
    group_id = F.when(F.col("joint"), F.col("group_id")).otherwise(F.col("doc_id"))
    group_node = F.coalesce("group_node", "node")
    return all_rows.select(
        "doc_id", "node", "size", class_id.alias("class_id"), group_id.alias("group_id"), group_node.alias("group_node"),
        (F.col("doc_id").eqNullSafe(group_id) & (F.col("node") == group_node)).alias("kept"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lead their group, with the columns of ``docs``."""
    groups = materialise(near_groups(docs), "near-groups")
    gone = groups.filter(~F.col("kept")).select("doc_id", "node").distinct()
    twice = groups.filter("kept").groupBy("doc_id", "node").count().filter("count > 1").select("doc_id", "node")
    mark = fresh(docs.columns, "_node")
    rows = docs.withColumn(mark, node_of(F.col("text")))

    def matches(listed: DataFrame, how: str, base: DataFrame) -> DataFrame:
        other = materialise(listed.select(F.col("doc_id").cast("long").alias(mark + "i"), F.col("node").alias(mark + "n")), "listed")
        if is_small(other, F.lit(64)):
            other = F.broadcast(other)
        same = F.col("doc_id").cast("long").eqNullSafe(F.col(mark + "i")) & (F.col(mark) == F.col(mark + "n"))
        return base.join(other, same, how)

    left = matches(gone, "left_anti", rows)
    if twice.limit(1).count():
        single = matches(twice, "left_semi", left).dropDuplicates(["doc_id", mark])
        left = matches(twice, "left_anti", left).unionByName(single)
    return left.select(*docs.columns)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and group of every document."""
    return near_groups(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "class_id", "group_id", "kept", F.col("size").alias("n_shingles")
    )
