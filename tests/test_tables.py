"""Cleaning, contracts, merge, reports, classification."""

import json

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import RING_TYPE
from tidegrid.operators import classify, cleaning, contracts, merge, reports, validity
from tidegrid.plans.derived import reference_areas
from tidegrid.session import replace_table

RUN_TS = "2024-07-01 02:00:00"


def ring(*xy):
    return [{"x": float(x), "y": float(y)} for x, y in xy]


@pytest.mark.parametrize(
    "vertices, reason",
    [
        (ring((0, 0), (1, 0), (1, 1), (0, 1), (0, 0)), None),
        (ring((0, 0), (0, 1), (1, 1), (1, 0), (0, 0)), None),
        (ring((0, 0), (1, 0), (1, 0), (1, 1), (0, 0)), None),
        (ring((0, 0), (2, 0), (1, 0), (1, 1), (0, 0)), "self_intersection"),
        (ring((0, 0), (1, 1), (1, 0), (0, 1.5), (0, 0)), "self_intersection"),
        (ring((0, 0), (2, 0), (2, 2), (1, 0), (0, 2), (0, 0)), "self_intersection"),
        (ring((0, 0), (1, 0), (1, 1), (0, 1)), "not_closed"),
        (ring((0, 0), (1, 0), (0, 0)), "too_few_vertices"),
        (ring((0, 0), (1, 0), (2, 0), (0, 0)), "zero_area"),
        (ring((0, 0), (200, 0), (1, 1), (0, 0)), "out_of_range"),
        (ring((0, 0), (float("nan"), 0), (1, 1), (0, 0)), "missing"),
        ([], "missing"),
        (None, "missing"),
    ],
)
def test_ring_validity(spark, vertices, reason):
    df = spark.createDataFrame([(1, vertices)], f"area_id long, ring {RING_TYPE}")
    row = validity.check_rings(df).first()
    assert (row["invalid_reason"], row["geometry_valid"]) == (reason, reason is None)


def test_long_ring_with_one_crossing(spark):
    """A saw-tooth of 4,000 vertices, clean and with two neighbouring teeth crossed."""
    teeth = [(i, 1 + (i % 2) * 0.5) for i in range(2000)]
    clean = ring((0, 0), *[(x / 100, y) for x, y in teeth], (19.99, 0), (0, 0))
    crossed = list(clean)
    crossed[1000], crossed[1002] = crossed[1002], crossed[1000]
    df = spark.createDataFrame([(1, clean), (2, crossed), (3, clean)], f"area_id long, ring {RING_TYPE}")
    got = {r["area_id"]: r["invalid_reason"] for r in validity.check_rings(df).collect()}
    assert got == {1: None, 2: "self_intersection", 3: None}


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 5, "x"), (1, 2, "b"), (None, 1, "n")], "k long, o long, v string")
    assert {(r["k"], r["v"]) for r in cleaning.keep_first(df, ["k"], ["o"]).collect()} == {(1, "a"), (2, "x"), (None, "n")}
    assert {(r["k"], r["v"]) for r in cleaning.keep_last(df, ["k"], ["o"]).collect()} == {(1, "c"), (2, "x"), (None, "n")}


def test_clean_citizens(spark):
    raw = spark.createDataFrame(
        [("1", "  Ana ", None, "2024-01-02", 1.0, 2.0, 1), ("1", "Later", "5", "2024-01-03", 1.0, 2.0, 2),
         ("2", "Bia", "6", None, None, 2.0, 3), ("3", "Caio", "7", "2024-02-01", 999.0, 2.0, 4)],
        "citizen_id string, name string, phone string, registration_date string, lon double, lat double, n int",
    )
    silver, bad = cleaning.clean_citizens(raw, ["n"], RUN_TS)
    rows = silver.collect()
    assert [(r["citizen_id"], r["name"], r["phone"], r["data_quality_score"]) for r in rows] == [(1, "Ana", "N/A", 1.0)]
    assert str(rows[0]["registration_date"]) == "2024-01-02 00:00:00" and str(rows[0]["normalized_date"]) == RUN_TS
    assert {(r["citizen_id"], r["invalid_reason"]) for r in bad.collect()} == {("2", "missing"), ("3", "out_of_range")}


def test_auto_types(spark):
    long_text = "X" * 100
    df = spark.createDataFrame(
        [("2024-01-01", "Centro", "nothing", long_text, 1), ("soon", "SUL", None, "Y", 2), (None, None, None, None, 3)],
        "some string, place string, none string, long string, n int",
    )
    out = cleaning.auto_types(df)
    assert dict(out.dtypes)["some"] == "timestamp" and dict(out.dtypes)["place"] == "string"
    rows = out.orderBy("n").collect()
    assert str(rows[0]["some"]) == "2024-01-01 00:00:00" and rows[1]["some"] is None
    assert (rows[0]["place"], rows[1]["place"], rows[2]["place"]) == ("centro", "sul", None)
    assert rows[0]["none"] == "nothing" and rows[0]["long"] == long_text
    # what is no date stays as text beside the dates
    assert [r["some_text"] for r in rows] == [None, "soon", None] and "place_text" not in out.columns
    fixed = cleaning.auto_types(df, dates=["some"], lowercase=["long"])
    assert fixed.columns == [*df.columns, "some_text"]
    rows = fixed.orderBy("n").collect()
    assert (rows[1]["some_text"], rows[0]["place"], rows[0]["long"]) == ("soon", "Centro", long_text.lower())
    named = cleaning.auto_types(df, dates=["place"])
    assert dict(named.dtypes)["place"] == "timestamp" and dict(named.dtypes)["some"] == "string"


def test_auto_types_on_an_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert cleaning.auto_types(df).columns == ["a", "b"]


def test_source_columns_and_projection(spark):
    df = cleaning.source_columns(spark.range(1), "csv", RUN_TS)
    assert df.first().asDict() == {
        "id": 0, "_processed_date": "2024-07-01T02:00:00", "_source_type": "csv", "_data_quality": "validated"
    }
    assert cleaning.keep_columns(df, ["_source_type", "gone", "id"]).columns == ["_source_type", "id"]


def people(spark):
    return spark.createDataFrame(
        [(1, "a", -51.25, -30.0), (2, "b", -51.21, -30.0), (3, "c", -51.0, -30.0), (4, "d", -51.25, -30.05)],
        "citizen_id long, name string, lon double, lat double",
    )


def test_classification_and_published_tables(spark):
    pairs = classify.classify(people(spark), reference_areas(spark)).cache()
    got = sorted((r["citizen_id"], r["affected_area_id"] or 0) for r in pairs.collect())
    assert got == [(1, 1), (2, 1), (2, 2), (3, 0), (4, 0)]  # 2 in the overlap, 4 on an edge
    affected = classify.affected_table(pairs, RUN_TS)
    assert affected.columns == [
        "citizen_id", "name", "lon", "lat", "affected_by_flooding", "affected_area_id", "area_name",
        "flood_date", "severity", "processing_date",
    ]
    assert affected.count() == 3 and classify.unaffected_table(pairs, RUN_TS).count() == 2
    assert "affected_area_id" in classify.all_table(pairs, RUN_TS).columns
    marks = {r["citizen_id"]: r["marker_colour"] for r in classify.with_markers(pairs).collect()}
    assert marks == {1: "red", 2: "red", 3: "blue", 4: "blue"}


def test_contracts(spark):
    df = spark.createDataFrame(
        [(1, "a", "1" * 21, 0.0, 0.0), (1, None, None, 0.0, 0.0), (None, "b", None, 0.0, 99.0), (2, "ok", "5", 1.0, 1.0)],
        "citizen_id int, name string, phone string, lon double, lat double",
    )
    table = contracts.conform(df, contracts.CITIZENS)
    assert table.schema["citizen_id"].dataType.simpleString() == "bigint"
    assert [r["affected_by_flooding"] for r in table.collect()] == [False] * 4
    counts = {r["violation"]: r["rows"] for r in contracts.violation_counts(table, contracts.CITIZENS).collect()}
    assert counts == {"too_long_phone": 1, "null_name": 1, "null_citizen_id": 1, "duplicate_key": 2}
    area = spark.createDataFrame([(7, None)], "area_id long, severity string")
    loaded = contracts.conform(area, contracts.FLOODING_AREAS).first()
    assert (loaded["area_name"], loaded["severity"], loaded["affected_population"]) == ("Area_7", "unknown", 0)


def test_merges(spark):
    schema = "citizen_id long, name string, affected_by_flooding boolean"
    current = spark.createDataFrame([(1, "old", True), (2, "old", False), (3, "old", None), (4, "old", True)], schema)
    new = spark.createDataFrame([(1, "new", False), (5, "new", True)], schema)

    def rows(df):
        return {(r["citizen_id"], r["name"], r["affected_by_flooding"]) for r in df.collect()}

    merged = merge.upsert(current, new, ["citizen_id"])
    assert rows(merged) == {(1, "new", False), (2, "old", False), (3, "old", None), (4, "old", True), (5, "new", True)}
    assert rows(merge.upsert(merged, new, ["citizen_id"])) == rows(merged)
    flag_only = merge.upsert_column(current, new, ["citizen_id"], "affected_by_flooding")
    assert rows(flag_only) == {(1, "old", False), (2, "old", False), (3, "old", None), (4, "old", True), (5, "new", True)}
    fresh = merge.refresh(current, new.filter("affected_by_flooding"), new.filter("NOT affected_by_flooding"), ["citizen_id"])
    assert rows(fresh) == {(1, "new", False), (3, "old", None), (5, "new", True)}
    assert rows(merge.delete_rows(current, "affected_by_flooding")) == {(2, "old", False), (3, "old", None)}


def test_upsert_column_takes_a_null(spark):
    schema = "k long, v string, flag boolean"
    out = merge.upsert_column(
        spark.createDataFrame([(1, "a", True)], schema), spark.createDataFrame([(1, "b", None)], schema), ["k"], "flag"
    )
    assert out.first()["v"] == "a"


def test_reports_on_an_empty_table(spark):
    empty = people(spark).withColumn("affected_by_flooding", F.lit(True)).filter("false")
    assert reports.status_share(empty).first().asDict() == {
        "total_citizens": 0, "affected": 0, "unaffected": 0, "affected_pct": None
    }
    assert [r["count"] for r in reports.summary(empty).collect()] == [0, 0, 0]
    assert [r["count"] for r in reports.summary_sql(empty).collect()] == [0, 0, 0]
    assert reports.point_extent(empty).first()["bbox"] is None


def test_summaries_agree(spark):
    table = people(spark).selectExpr("*", "citizen_id > 1 AS affected_by_flooding")
    key = "category"
    assert sorted(reports.summary(table).collect()) == sorted(reports.summary_sql(table).collect())
    assert {r[key]: r["percentage"] for r in reports.summary(table).collect()} == {
        "total": 0.0, "affected": 75.0, "unaffected": 25.0
    }


def test_feature_collection_is_json(spark, tmp_path):
    table = people(spark).selectExpr(
        "citizen_id", "name || '\"x' AS name", "CAST(NULL AS STRING) AS address", "'5' AS phone",
        "true AS affected_by_flooding", "lon", "lat",
    )
    def written(features):
        reports.write_collection(features, str(tmp_path / "out"))
        return json.loads("".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))))

    whole = written(reports.citizen_features(table.repartition(3)))
    assert whole["type"] == "FeatureCollection" and [f["properties"]["id"] for f in whole["features"]] == [1, 2, 3, 4]
    assert written(reports.citizen_features(table.filter("false"))) == {"type": "FeatureCollection", "features": []}
    first = whole["features"][0]
    assert first["properties"] == {
        "id": 1, "name": 'a"x', "address": None, "phone": "5", "affected": True, "type": "citizen"
    }
    assert first["geometry"] == {"type": "Point", "coordinates": [-51.25, -30.0]}


def test_a_table_is_replaced_by_what_is_made_from_it(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(10).selectExpr("id", "id % 2 = 0 AS flag").write.parquet(path)
    left = merge.rewrite_without(spark, path, "flag")
    assert sorted(r["id"] for r in left.collect()) == [1, 3, 5, 7, 9]
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t.parquet"]
    assert replace_table(spark.range(3), str(tmp_path / "new.parquet")).count() == 3


def test_flag_of_a_key_given_twice_does_not_depend_on_partitions(spark):
    schema = "k int, v string, flag boolean"
    current = spark.createDataFrame([(1, "a", None)], schema)
    incoming = [(1, "b", True), (1, "c", False), (1, "d", True)]
    out = {
        str(merge.upsert_column(current, spark.createDataFrame(incoming, schema).repartition(n, "v"), ["k"], "flag").collect())
        for n in (1, 2, 5)
    }
    assert len(out) == 1
