"""Signatures against exact similarity, groups against all pairs, and rows out of the ordinary."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidegrid.llm import neardup

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_force(rows):
    """The smallest id of each document's group, from all pairs of texts."""
    texts = defaultdict(list)
    for i, t in rows:
        texts[t or ""].append(i)
    keys, bags, postings = list(texts), [], defaultdict(list)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, t in enumerate(keys):
        words = WORD.findall(t)
        k = min(5, len(words))
        bags.append(Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else Counter())
    sizes = [sum(b.values()) for b in bags]
    for n, bag in enumerate(bags):
        shared = Counter()
        for s, c in bag.items():
            for m, d in postings[s]:
                shared[m] += min(c, d)
            postings[s].append((n, c))
        for m, x in shared.items():
            if x / (sizes[n] + sizes[m] - x) >= 0.8 - 1e-12:
                parent[find(n)] = find(m)
    groups = defaultdict(list)
    for n, t in enumerate(keys):
        groups[find(n)] += texts[t]
    return {i: min(ids) for ids in groups.values() for i in ids}


def test_signature_estimates_weighted_similarity():
    rng = np.random.default_rng(0)
    off = []
    for _ in range(60):
        n = rng.integers(1, 300)
        e = rng.integers(0, 2**63, n).astype(np.uint64)
        a = rng.integers(0, 6, n)
        b = np.where(rng.random(n) < 0.7, a, rng.integers(0, 6, n))
        a[0] = b[0] = 3
        same = neardup.signature(e[a > 0], a[a > 0]) == neardup.signature(e[b > 0], b[b > 0])
        off.append(same.mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.06


def test_darts_are_as_many_as_the_area():
    rng = np.random.default_rng(5)
    e = rng.integers(0, 2**63, 4000).astype(np.uint64)
    w = rng.integers(1, 9, 4000)
    for bound in (0.2, 1.5):
        ranks, _ = neardup.thrown(e, w, bound)
        area = w.sum() * bound
        assert abs(len(ranks) - area) < 5 * np.sqrt(area) and ranks.max() <= bound


def test_groups_equal_all_pairs(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = {r["doc_id"]: r["group_id"] for r in neardup.near_groups(documents).collect()}
    assert got == brute_force(rows)


def test_many_variants_of_one_text(docs_of):
    rng = random.Random(4)
    base = [f"w{rng.randrange(3000)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(0, 7)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[3][1]) for i in range(60)]  # exact copies of one
    rows += [(2000 + i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(100))) for i in range(30)]
    got = {r["doc_id"]: r["group_id"] for r in neardup.near_groups(docs_of(rows)).collect()}
    assert got == brute_force(rows)


def test_odd_rows(docs_of):
    long = " ".join(f"word{i}" for i in range(30_000))
    rows = [(5, "a b"), (4, "a b"), (None, "a b"), (6, "a  b"), (7, None), (8, ""), (9, " \n"), (1, long), (2, long + " end"),
            (3, "x y z"), (3, "x y z"), (None, "alone here"), (None, "alone here"), (10, "a a a a a a a"), (11, "a a a a a a a a")]
    docs = docs_of(rows, "node")
    out = neardup.keep_one(docs)
    assert out.columns == docs.columns
    kept = sorted((str(r["doc_id"]), r["text"]) for r in out.collect())
    assert kept == sorted([("4", "a b"), ("7", None), ("9", " \n"), ("1", long), ("3", "x y z"), ("None", "alone here"),
                           ("10", "a a a a a a a"), ("11", "a a a a a a a a")], key=lambda x: (x[0], x[1] or ""))
    assert neardup.keep_one(docs.limit(0)).collect() == []


def test_blocks_of_short_texts_are_bounded_by_nodes(spark, monkeypatch):
    def sides(table):
        seekers = sum(table["seeks"].to_pylist())
        return pa.table({"a": pa.array([b"%d" % seekers]), "b": pa.array([b"%d" % (len(table) - seekers)])})

    monkeypatch.setattr(neardup, "_block_links", sides)
    nodes = spark.range(12_000).select(F.lit(1).alias("bucket"), F.expr("CAST(CAST(id AS STRING) AS BINARY)").alias("node"))
    still = nodes.selectExpr("bucket", "node", "2 AS size", "node AS label", "CAST('0' AS BINARY) AS main")
    bags = nodes.select("node", F.array(F.lit(1), F.lit(2)).alias("bag"))
    got = neardup._links_in_blocks(still, bags).collect()
    assert got and max(int(x) for r in got for x in r) < 1.1 * neardup.BLOCK_NODES
