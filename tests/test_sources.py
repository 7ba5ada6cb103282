import json

import pytest
from pyspark.sql import functions as F

from tidegrid.functions.geometry import RING_TYPE, ring_of
from tidegrid.operators.grid import index_areas
from tidegrid.plans import medallion
from tidegrid.plans.derived import reference_areas
from tidegrid.session import shared_dir
from tidegrid.sources import csv_points, geojson, ingest, layers, runlog, sample
from tidegrid.streaming import drops

RUN_TS = "2024-07-01 02:00:00"
SQUARE = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
HOLE = [SQUARE[0], [[0.2, 0.2], [0.4, 0.2], [0.4, 0.4], [0.2, 0.2]]]


def features():
    def one(i, geometry):
        return {"type": "Feature", "properties": {"id": i, "name": f"N{i}"}, "geometry": geometry}

    return [
        one(1, {"type": "Point", "coordinates": [-51.2, -30.0]}),
        one(2, {"type": "Polygon", "coordinates": SQUARE}),
        one(3, {"type": "Polygon", "coordinates": HOLE}),
        one(4, None),
    ]


def collection(crs=None, indent=None):
    whole = {"type": "FeatureCollection"}
    if crs:
        whole["crs"] = {"type": "name", "properties": {"name": crs}}
    return json.dumps({**whole, "features": features()}, indent=indent)


def by_line(crs="urn:ogc:def:crs:OGC:1.3:CRS84"):
    lines = ",\n".join(json.dumps(f) for f in features())
    return (
        '{\n"type": "FeatureCollection",\n"name": "x",\n"crs": { "type": "name", "properties": { "name": "'
        + crs + '" } },\n"features": [\n' + lines + "\n]\n}\n"
    )


@pytest.mark.parametrize(
    "content", [collection(), collection("EPSG:4326", indent=2), by_line(), "\n".join(json.dumps(f) for f in features())]
)
def test_geojson_layouts(spark, tmp_path, content):
    path = tmp_path / "x.geojson"
    path.write_text(content)
    rows = {r["id"]: r for r in geojson.read_geojson(spark, str(path)).collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert (rows[1]["lon"], rows[1]["lat"], rows[1]["name"], rows[1]["ring"]) == (-51.2, -30.0, "N1", None)
    assert len(rows[2]["ring"]) == 5 and rows[2]["lon"] is None
    assert len(rows[3]["ring"]) == 10 and rows[3]["ring"][5] is None and rows[3]["geometry_type"] == "Polygon"
    assert rows[4]["geometry_type"] is None and not rows[4]["malformed"]


@pytest.mark.parametrize("content", [collection("EPSG:31982"), by_line("EPSG:31982")])
def test_other_crs_is_refused(spark, tmp_path, content):
    path = tmp_path / "x.geojson"
    path.write_text(content)
    with pytest.raises(ValueError):
        geojson.read_geojson(spark, str(path))


def test_broken_feature_line_is_reported(spark, tmp_path):
    path = tmp_path / "x.geojson"
    path.write_text(json.dumps(features()[0]) + '\n{"type": "Feature", "properties": {"id": 9, }}\n')
    got = geojson.read_geojson(spark, str(path), layout="lines")
    assert sorted(r["malformed"] for r in got.collect()) == [False, True]


def test_layout_is_decided_for_each_file(spark, tmp_path):
    (tmp_path / "a.geojson").write_text(collection(indent=2))
    (tmp_path / "b.geojson").write_text(by_line())
    (tmp_path / "c.geojson").write_text("\n".join(f"// note {i}" for i in range(70)) + "\n" + json.dumps(features()[0]))
    (tmp_path / "d.geojson").write_text(json.dumps(features()[1], indent=1))
    (tmp_path / "e.geojson").write_text(collection() + "\n" + collection())
    (tmp_path / "f.geojson").write_text('{"type": "FeatureCollection", "features": null}')
    (tmp_path / "g.geojson").write_text("")
    rows = geojson.read_geojson(spark, str(tmp_path)).collect()
    good = sorted((r["source_file"][-9], r["id"]) for r in rows if not r["malformed"])
    assert good == [*[("a", i) for i in (1, 2, 3, 4)], *[("b", i) for i in (1, 2, 3, 4)], ("c", 1), ("d", 2),
                    *[("e", i) for i in (1, 1, 2, 2, 3, 3, 4, 4)]]
    assert sorted(r["source_file"][-9] for r in rows if r["malformed"]) == ["c"] * 70 + ["f"]


@pytest.mark.parametrize("other", [collection("EPSG:31982"), collection("EPSG:31982", indent=2), "\n" * 60 + by_line("EPSG:31982")])
def test_crs_of_every_file_counts(spark, tmp_path, other):
    (tmp_path / "a.geojson").write_text(by_line("EPSG:4326"))
    (tmp_path / "b.geojson").write_text(other)
    with pytest.raises(ValueError, match="31982"):
        geojson.read_geojson(spark, str(tmp_path))


def test_geojson_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, None, [{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 0.0}])],
        f"id long, note string, ring {RING_TYPE}",
    )
    geojson.write_geojson(df, str(tmp_path / "out"))
    back = geojson.read_geojson(spark, str(tmp_path / "out"), properties=df.select("id", "note").schema).first()
    assert (back["id"], back["note"], back["ring"]) == (1, None, df.first()["ring"])


def test_csv(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text('citizen_id,name,latitude,longitude\nC001,"Silva, J",-30.0326,-51.2093\nC002,Ana,abc,-51.1\n')
    df = csv_points.read_csv_points(spark, str(path))
    assert df.columns == ["citizen_id", "name", "lon", "lat"]
    assert [(r["name"], r["lon"], r["lat"]) for r in df.orderBy("citizen_id").collect()] == [
        ("Silva, J", -51.2093, -30.0326), ("Ana", -51.1, None)
    ]
    assert csv_points.read_csv_points(spark, str(path), lat_col="longitude", lon_col="latitude").first()["lat"] == -51.2093
    with pytest.raises(ValueError):
        csv_points.read_csv_points(spark, str(path), lat_col="lat")
    with pytest.raises(ValueError):
        csv_points.read_csv_points(spark, str(path), crs="EPSG:31982")


def test_ingest_reports_and_goes_on(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "citizens.csv").write_text(
        "citizen_id,name,registered_date,latitude,longitude\nC001,ANA,2024-01-15,-30.0,-51.2\nC002,BIA,2024-01-20,,-51.1\n"
    )
    (inbox / "citizens.geojson").write_text(collection())
    (inbox / "bad.csv").write_text("a,b\n1,2\n")
    report = ingest.ingest_all(spark, [str(inbox), str(tmp_path / "none")], str(tmp_path / "out"), RUN_TS).cache()
    assert {(r["source"], r["status"], r["records"]) for r in report.collect()} == {
        ("citizens.csv", "success", 2), ("citizens.geojson", "success", 4), ("bad.csv", "error", None)
    }
    assert ingest.report_summary(report).first().asDict() == {
        "total_files": 3, "successful": 2, "failed": 1, "total_records": 6
    }
    csv = spark.read.parquet(str(tmp_path / "out" / "citizens_csv.parquet")).orderBy("citizen_id").collect()
    assert [(r["citizen_id"], r["name"], r["invalid_reason"]) for r in csv] == [("c001", "ana", None), ("c002", "bia", "missing")]
    assert str(csv[0]["registered_date"])[:10] == "2024-01-15" and csv[0]["_source_type"] == "csv"
    shapes = spark.read.parquet(str(tmp_path / "out" / "citizens_geojson.parquet"))
    assert {r["id"]: r["invalid_reason"] for r in shapes.collect()} == {1: None, 2: None, 3: None, 4: "missing"}
    assert ingest.records_by_source(shapes).first().asDict() == {"_source_type": "geojson", "records": 4, "rejected": 1}


def test_damaged_records_are_marked_and_kept(spark, tmp_path):
    path = tmp_path / "d.csv"
    path.write_text("id,latitude,longitude\n1,5.5,6.5\n2,7.5\n3,8.5,9.5,10\n4,x,1.5\n")
    schema = "id long, latitude double, longitude double"
    rows = csv_points.read_csv_points(spark, str(path), schema=schema, damaged="why").select("id", "lon", "lat", "why").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        (1, 6.5, 5.5, None), (2, None, 7.5, "2,7.5"), (3, 9.5, 8.5, "3,8.5,9.5,10"), (4, 1.5, None, "4,x,1.5")
    ]
    # the mark does not depend on the columns asked for
    few = csv_points.read_csv_points(spark, str(path), schema=schema, damaged="why").select("id", "why").orderBy("id")
    assert [r["why"] is None for r in few.collect()] == [True, False, False, False]
    with pytest.raises(ValueError):
        csv_points.read_csv_points(spark, str(path), schema=schema, damaged="id")
    (tmp_path / "d.csv").write_text("id,latitude,longitude\n1,5.5,6.5\n2,7.5\n3,8.5,9.5,10\n")
    report = ingest.ingest_all(spark, [str(tmp_path)], str(tmp_path / "out"), RUN_TS).first()
    assert (report["status"], report["records"]) == ("success", 3)
    converted = spark.read.parquet(report["output"])
    assert {r["id"]: (r["invalid_reason"], r["_damaged"]) for r in converted.collect()} == {
        1: (None, None), 2: ("malformed", "2,7.5"), 3: ("malformed", "3,8.5,9.5,10")
    }
    assert ingest.records_by_source(converted).first()["rejected"] == 2


def _rows_scanned(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_box_scan_reads_few_rows(spark, tmp_path):
    # a third of all points in one place, and some without one
    points = spark.range(30_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 10D WHEN id % 1000 <> 1 THEN pmod(xxhash64(id), 36000) / 100D - 180D END AS lon",
        "CASE WHEN id % 3 = 0 THEN 20D ELSE pmod(xxhash64(id, 1), 18000) / 100D - 90D END AS lat",
    ).cache()
    path = layers.write_clustered(points, str(tmp_path / "points"), rows_per_file=500)
    assert sorted(spark.read.parquet(path).collect(), key=str) == sorted(points.collect(), key=str)
    largest = spark.read.parquet(path).groupBy(F.expr("_metadata.file_path")).count().agg(F.max("count")).first()[0]
    assert largest < 2_000
    box = (-60.0, -40.0, -45.0, -30.0)
    found = layers.read_box(spark, path, box)
    wanted = points.filter("lon BETWEEN -60 AND -45 AND lat BETWEEN -40 AND -30")
    assert sorted(found.collect()) == sorted(wanted.collect()) and wanted.count() > 20
    assert _rows_scanned(found) < 4_000


def test_box_scan_of_areas(spark, tmp_path):
    side = spark.range(400).selectExpr("id AS area_id", "(id % 20) * 2D AS x", "floor(id / 20) * 2D AS y")
    squares = side.selectExpr(
        "area_id", f"CAST(CASE WHEN area_id <> 7 THEN {ring_of([('x', 'y'), ('x + 1', 'y'), ('x + 1', 'y + 1'), ('x', 'y')])} END AS {RING_TYPE}) AS ring")
    path = layers.write_clustered(squares, str(tmp_path / "areas"), rows_per_file=20)
    assert spark.read.parquet(path).count() == 400
    found = layers.read_box(spark, path, (3.0, 3.0, 6.0, 5.0))
    assert found.columns == ["area_id", "ring"]
    assert sorted(r["area_id"] for r in found.collect()) == sorted(
        20 * y + x for x in range(20) for y in range(20) if 2 * x <= 6 and 2 * x + 1 >= 3 and 2 * y <= 5 and 2 * y + 1 >= 3)
    with pytest.raises(ValueError):
        layers.write_clustered(squares.selectExpr("*", "1 AS _xmin"), str(tmp_path / "other"))


def test_a_new_checkpoint_keeps_earlier_drops(spark, tmp_path):
    schema = "citizen_id long, name string, drop_no int"
    table = str(tmp_path / "table")
    for n in (1, 2, 3):
        inbox, checkpoint = str(tmp_path / f"inbox{min(n, 2)}"), str(tmp_path / f"checkpoint{min(n, 2)}")
        spark.createDataFrame([(n, "own", n), (0, f"from {n}", n)], schema).write.mode("append").parquet(inbox)
        drops.merge_drops(drops.watch_parquet(spark, inbox, schema), table, checkpoint, ["citizen_id"], ["drop_no"]).awaitTermination()
    # the third drop went on with the second checkpoint
    assert spark.read.parquet(table).select("run", "epoch").distinct().count() == 3
    assert spark.read.parquet(table).select("run").distinct().count() == 2
    folded = str(tmp_path / "folded")
    drops.compact(spark, table, folded, ["citizen_id"])
    for place in (table, folded):
        rows = {r["citizen_id"]: r["name"] for r in drops.merged(spark, place, ["citizen_id"]).collect()}
        assert rows == {0: "from 3", 1: "own", 2: "own", 3: "own"}
    inbox = str(tmp_path / "inbox4")
    spark.createDataFrame([(0, "from 4", 4)], schema).write.parquet(inbox)
    drops.merge_drops(drops.watch_parquet(spark, inbox, schema), folded, str(tmp_path / "c4"), ["citizen_id"], ["drop_no"]).awaitTermination()
    assert drops.merged(spark, folded, ["citizen_id"]).filter("citizen_id = 0").first()["name"] == "from 4"


def test_sample_does_not_depend_on_partitions(spark):
    few = sample.citizens_from_ids(spark.range(0, 500, 1, 2), "id").orderBy("citizen_id").collect()
    many = sample.citizens_from_ids(spark.range(0, 500, 1, 16), "id").orderBy("citizen_id").collect()
    assert few == many
    assert sample.sample_citizens(spark).count() == 100


def test_wkb_layer(spark, tmp_path):
    path = str(tmp_path / "areas.parquet")
    layers.with_wkb(reference_areas(spark)).write.parquet(path)
    back = {r["area_id"]: r["ring"] for r in layers.read_wkb_areas(spark, path).collect()}
    assert back == {r["area_id"]: r["ring"] for r in reference_areas(spark).collect()}


def test_medallion_twice(spark, tmp_path):
    raw = sample.sample_citizens(spark, 200).selectExpr("*", "citizen_id AS arrival")
    areas = reference_areas(spark).selectExpr("*", "area_id AS arrival")
    first = medallion.run(spark, str(tmp_path / "a"), raw, areas, ["arrival"], RUN_TS)
    table = first.citizens.collect()
    assert len(table) == 200 == first.citizens.select("citizen_id").distinct().count()
    ids = {r["citizen_id"] for r in first.affected.collect()}
    assert ids.isdisjoint({r["citizen_id"] for r in first.unaffected.collect()})
    assert len(ids) + first.unaffected.count() == 200
    second = medallion.run(spark, str(tmp_path / "b"), raw, areas, ["arrival"], RUN_TS, current=first.citizens)
    assert sorted(second.citizens.collect()) == sorted(table)
    runs = runlog.run_history(spark, str(tmp_path / "a" / "tables" / "pipeline_runs.parquet")).collect()
    assert [(r["total_citizens"], r["status"]) for r in runs] == [(200, "success")]


def test_stream_of_drops_equals_batch(spark, tmp_path):
    schema = "citizen_id long, name string, lon double, lat double, drop_no int"
    everyone = sample.sample_citizens(spark, 120)
    first = everyone.selectExpr("citizen_id", "name", "lon", "lat", "1 AS drop_no")
    second = everyone.filter("citizen_id >= 100").selectExpr("citizen_id", "name || '!' AS name", "lon", "lat", "2 AS drop_no")
    index = index_areas(reference_areas(spark), ["area_id"])
    inbox = str(tmp_path / "inbox")
    for frame in (first, second):
        frame.write.mode("append").parquet(inbox)
        for kind in ("plain", "once", "merge", "classified"):
            stream = drops.watch_parquet(spark, inbox, schema)
            out, checkpoint = str(tmp_path / kind), str(tmp_path / f"{kind}-checkpoint")
            if kind == "merge":
                run = drops.merge_drops(stream, out, checkpoint, ["citizen_id"], ["drop_no"])
            elif kind == "classified":
                run = drops.classify_drops(stream, index, out, checkpoint)
            else:
                run = drops.append_to(stream if kind == "plain" else drops.first_seen(stream, ["citizen_id"]), out, checkpoint)
            run.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 140
    once = spark.read.parquet(str(tmp_path / "once"))
    assert once.count() == 120 and once.filter("drop_no = 2").count() == 0
    merged = drops.merged(spark, str(tmp_path / "merge"), ["citizen_id"])
    assert merged.count() == 120 and merged.filter("drop_no = 2").count() == 20
    folded = drops.compact(spark, str(tmp_path / "merge"), str(tmp_path / "folded"), ["citizen_id"])
    assert sorted(folded.collect()) == sorted(merged.collect())
    from tidegrid.operators.classify import classify

    streamed = spark.read.parquet(str(tmp_path / "classified")).select("citizen_id", "drop_no", "affected_area_id")
    batch = classify(first.union(second), reference_areas(spark)).select("citizen_id", "drop_no", "affected_area_id")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_shared_dir_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        assert shared_dir(spark) == named.rstrip("/")


def test_wkb_of_missing_geometry(spark):
    import struct

    from tidegrid.functions.formats import point_wkb, ring_wkb

    points = spark.createDataFrame([(1, 1.5, -2.0), (2, None, 1.0), (3, 0.0, None), (4, -0.25, 9.0)], "id int, lon double, lat double")
    got = [r["w"] for r in points.select("id", point_wkb("lon", "lat").alias("w")).orderBy("id").collect()]
    assert got[1] is None and got[2] is None
    assert [bytes(g) for g in (got[0], got[3])] == [struct.pack("<BIdd", 1, 1, 1.5, -2.0), struct.pack("<BIdd", 1, 1, -0.25, 9.0)]
    ring = [{"x": 0.0, "y": 0.5}, {"x": 1.0, "y": 0.0}, {"x": 0.0, "y": 0.5}]
    rings = spark.createDataFrame([(1, ring), (2, None), (3, []), (4, ring[:2])], f"id int, ring {RING_TYPE}")
    got = [r["w"] for r in rings.select("id", ring_wkb("ring").alias("w")).orderBy("id").collect()]
    assert got[1] is None and bytes(got[2]) == struct.pack("<BIII", 1, 3, 1, 0)
    assert bytes(got[0]) == struct.pack("<BIII", 1, 3, 1, 3) + struct.pack("<6d", 0.0, 0.5, 1.0, 0.0, 0.0, 0.5)
    assert bytes(got[3]) == struct.pack("<BIII", 1, 3, 1, 2) + struct.pack("<4d", 0.0, 0.5, 1.0, 0.0)


def test_first_settled_keeps_keys_by_the_bucket(spark, tmp_path):
    """Whole numbers of 64 bits beside nulls stay exact, null is a key, and Python is called by the bucket."""
    big = 2**60 + 1
    schema = "id long, seq int, note long"
    batches = [
        [(big, 2, None), (big, 1, big), (None, 1, None), (None, 0, big + 2), (big + 1, 1, None)],
        [(big, 0, 5), (None, 0, 5), (big + 2, 1, big + 4), (7, 3, None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(f"{tmp_path}/in")
        stream = drops.first_settled(drops.watch_parquet(spark, f"{tmp_path}/in", schema), ["id"], ["seq"])
        assert "pick(" in stream._jdf.queryExecution().analyzed().toString() and "_bucket" in stream._jdf.queryExecution().analyzed().toString()
        drops.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    got = sorted((tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()), key=str)
    want = [(big, 1, big), (None, 0, big + 2), (big + 1, 1, None), (big + 2, 1, big + 4), (7, 3, None)]
    assert got == sorted(want, key=str)


def test_first_settled_forgets_each_key_for_itself(spark, tmp_path, monkeypatch):
    """In one bucket a key is forgotten once the watermark has passed its last record, and others are not."""
    monkeypatch.setattr(drops, "BUCKETS", 1, raising=False)
    schema = "id long, seq int, at timestamp"
    hour = "timestamp_seconds((1000 + {}) * 3600)".format
    for rows in ([(1, 0, 0), (2, 1, 0)], [(2, 2, 5), (3, 3, 9)], [(3, 4, 9), (4, 5, 9)], [(1, 6, 9), (2, 7, 9)]):
        frame = spark.createDataFrame(rows, "id long, seq int, h long").selectExpr("id", "seq", f"{hour('h')} AS at")
        frame.write.mode("append").parquet(f"{tmp_path}/in")
        stream = drops.first_settled(drops.watch_parquet(spark, f"{tmp_path}/in", schema), ["id"], ["seq"], "at", "4 hours")
        drops.append_to(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert sorted(r["seq"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1, 3, 5, 6]
