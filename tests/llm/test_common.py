"""Look-ups by every path, and components against a plain union."""

import random

from pyspark.sql import functions as F

from tidegrid.llm import common
from tidegrid.session import materialise


def test_lookup_is_the_join_whatever_the_path(spark, monkeypatch):
    rows = [(i, f"k{i % 7 if i % 3 else 0}") for i in range(2000)] + [(9000, None), (9001, "lost")]
    big = spark.createDataFrame(rows, "id long, key string")
    small = materialise(
        big.filter("key <> 'lost'").groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("v")), "small"
    )
    many = spark.createDataFrame([(f"x{i}", 1, i) for i in range(3000)], "key string, n long, v long")
    small = materialise(small.unionByName(many.select("key", "n", "v")), "small")
    for how in ("left", "inner"):
        want = sorted(map(str, big.join(small, "key", how).select("id", "key", "n", "v").collect()))
        for limit in (1 << 24, 0):
            monkeypatch.setattr(common, "BROADCAST_BYTES", limit)
            got = common.lookup(big, small, "key", F.col("n"), how).select("id", "key", "n", "v")
            assert sorted(map(str, got.collect())) == want


def test_components(spark):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(40)]
    links += [(2000, 2001 + i) for i in range(100)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    want = {x: find(x) for x in list(parent)}
    got = {r["node"]: r["label"] for r in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).collect() == []
