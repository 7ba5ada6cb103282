"""The law of equal counts, groups kept together, quotas under pressure, and rows out of the ordinary."""

import pytest

from tidegrid.llm import sharding


def frame(spark, groups):
    """Rows of (doc_id, group) from a list of group sizes."""
    rows, n = [], 0
    for g, size in enumerate(groups):
        for _ in range(size):
            rows.append((n, f"g{g}"))
            n += 1
    return spark.createDataFrame(rows, "doc_id long, group string")


def checked(out, shards):
    got = out.toPandas()
    counts = got.groupby("shard").size().reindex(range(shards), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    return got


def cut(got):
    return int((got.groupby("group")["shard"].nunique() - 1).sum())


@pytest.mark.parametrize("groups", [[1] * 103, [2] * 40 + [1] * 100, [5] * 12 + [3] * 9 + [1] * 80])
def test_groups_stay_whole_where_there_is_room(spark, groups):
    got = checked(sharding.shard_rows(frame(spark, groups), shards=8), 8)
    assert sorted(got["doc_id"]) == list(range(sum(groups)))
    assert cut(got) == 0


def test_a_third_of_all_rows_in_one_group(spark):
    got = checked(sharding.shard_rows(frame(spark, [300] + [1] * 600), shards=10), 10)
    # 90 rows a shard: four shards at least
    assert got[got["group"] == "g0"]["shard"].nunique() <= 5


def test_everything_linked(spark):
    groups = [4] * 100
    got = checked(sharding.shard_rows(frame(spark, groups), shards=10), 10)
    at_random = 100 * 2.44  # a group of four falls into 3.44 of ten shards on average
    assert cut(got) < 0.5 * at_random


def test_admitted_keeps_every_shard_within_its_quota():
    asked = {(0, 1): 50, (1, 2): 10, (2, 0): 5, (3, 1): 40}
    load, quota = [60, 60, 60, 60], [70, 70, 70, 70]
    share = sharding.admitted(asked, load, quota)
    after = list(load)
    for (a, b), n in asked.items():
        after[a] -= n * share[a, b]
        after[b] += n * share[a, b]
    assert all(x <= q + 0.5 for x, q in zip(after, quota, strict=True)) and share[2, 0] == 1


def test_odd_rows(spark):
    rows = [(1, "x"), (1, "x"), (None, "x"), (2, None), (3, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, group string")
    got = checked(sharding.shard_rows(docs, shards=4), 4)
    assert len(got) == 6
    assert sharding.shard_rows(docs.limit(0), shards=4).collect() == []
    assert len(checked(sharding.shard_rows(docs.limit(1), shards=4), 4)) == 1


def test_query(spark, documents):
    got = sharding.op6(spark, "/root/testdata/sf0.001").toPandas()
    rows = documents.toPandas()
    assert sorted(got["doc_id"]) == sorted(rows["doc_id"])
    sizes = {r.doc_id: len(r.text.encode()) + 16 for r in rows.itertuples()}
    assert dict(zip(got["doc_id"], got["size"], strict=True)) == sizes
    counts = got.groupby("shard").size()
    assert len(counts) == 40 and counts.max() - counts.min() <= 1
    assert (got["law"] == "rows").all() and got["grown_shard"].isna().all()


def test_columns_of_any_name_are_kept(spark):
    names = ["key", "n", "shard", "Slot", "at", "wish", "group"]
    given = frame(spark, [3] * 5 + [1] * 20).selectExpr(
        "doc_id", "'x' AS key", "CAST(doc_id AS INT) AS n", "'s' AS shard", "9 AS Slot", "2.5D AS at", "'w' AS wish", "group AS bunch", "'g' AS group")
    out = sharding.shard_rows(given, group="bunch", shards=4)
    assert out.columns == ["doc_id", *names, "bunch", "shard_", "slot_"]
    got = checked(out.selectExpr("doc_id", "bunch AS group", "shard_ AS shard", "slot_ AS slot"), 4)
    assert sorted(got["doc_id"]) == list(range(35)) and cut(got) == 0
    plain = sharding.shard_rows(given.selectExpr("doc_id", "shard", "bunch"), group="bunch", shards=4)
    assert plain.columns == ["doc_id", "shard", "bunch", "shard_", "slot"]
    assert {r["shard"] for r in plain.collect()} == {"s"}
