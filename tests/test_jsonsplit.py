"""GeoJSON in any legal layout of lines, over splits of any size."""

import json
import random

import pytest

from tidegrid.sources import geojson, jsonsplit

HARD = ["}", '"', "\\", '{"features":[', ']}', '"features": [{', "\\\"}", "a\nb", "é漢😀", '","crs":{"properties":{"name":"EPSG:1"}}', ""]


def make(rnd, n, start=0):
    out = []
    for i in range(start, start + n):
        props = {"id": i, "name": "".join(rnd.choice(HARD) for _ in range(rnd.randint(0, 3)))}
        if rnd.random() < 0.3:
            props["nested"] = {"list": [{"features": [1, {"x": 2}]}, {}], "text": rnd.choice(HARD)}
        geometry = rnd.choice([
            {"type": "Point", "coordinates": [i / 8, -i / 4]},
            {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, i], [0, 0]]]}, None])
        out.append({"type": "Feature", "properties": props, "geometry": geometry})
    return out


def spaced(rnd, text_of, value, indent=None):
    """JSON text of a value with white space of any kind between its tokens."""
    if indent is None and rnd.random() < 0.5:
        return json.dumps(value, ensure_ascii=rnd.random() < 0.5, separators=rnd.choice([(",", ":"), (", ", ": "), (",\n", ":\n ")]))
    return json.dumps(value, indent=rnd.choice([0, 1, 2, "\t"]))


def collection(rnd, features, crs=True, type_last=False):
    frame = {}
    if not type_last:
        frame["type"] = "FeatureCollection"
    if rnd.random() < 0.5:
        frame["bbox"] = [0, 0, 1, 1]
    if crs:
        frame["crs"] = {"type": "name", "properties": {"name": "urn:ogc:def:crs:OGC:1.3:CRS84"}}
    if rnd.random() < 0.5:
        frame["meta"] = [{"features": 3}, {"a": {"b": []}}]
    head = spaced(rnd, json, frame)[:-1].rstrip()
    body = rnd.choice([",", ",\n", ", \n\n "]).join(spaced(rnd, json, f) for f in features)
    tail = ', "type": "FeatureCollection"' if type_last else rnd.choice(["", ', "note": {"x": "]}"}', ',\n"a": [1]'])
    return f'{head}{", " if frame else ""}"features"{rnd.choice(["", " "])}:{rnd.choice(["", " ", chr(10)])}[{body}]{tail}}}'


def ids(df):
    rows = df.collect()
    assert not [r for r in rows if r["malformed"]]
    return sorted(r["id"] for r in rows)


@pytest.fixture
def small_splits(spark):
    def set_to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 0)
    yield set_to
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("size", [211, 4001])
def test_random_layouts(spark, tmp_path, small_splits, size):
    rnd = random.Random(size)
    expected = {}
    for k in range(8):
        documents, features = [], []
        for _ in range(rnd.randint(1, 3)):
            some = make(rnd, rnd.randint(1, 12), 1000 * k + len(features))
            features += some
            if rnd.random() < 0.6:
                documents.append(collection(rnd, some, rnd.random() < 0.5, rnd.random() < 0.2))
            else:
                documents += [spaced(rnd, json, f) for f in some]
        text = rnd.choice(["", "\n", " \n "]) + rnd.choice(["\n", " ", "\n\n", ",\n"]).join(documents) + rnd.choice(["", "\n", "  "])
        (tmp_path / f"{k}.geojson").write_bytes((b"\xef\xbb\xbf" if k == 5 else b"") + text.encode())
        for f in features:
            point = f["geometry"] and f["geometry"]["type"] == "Point"
            expected[f["properties"]["id"]] = (
                f["properties"]["name"], f["geometry"] and f["geometry"]["type"], f["geometry"]["coordinates"][0] if point else None)
    small_splits(size)
    rows = geojson.read_geojson(spark, str(tmp_path)).collect()
    assert not [r for r in rows if r["malformed"]]
    assert len(rows) == len(expected)
    assert {r["id"]: (r["name"], r["geometry_type"], r["lon"]) for r in rows} == expected


def test_files_that_line_rules_misread(spark, tmp_path):
    f = [json.dumps(x) for x in make(random.Random(1), 4)]
    files = {
        "two_on_a_line": '{"type":"FeatureCollection","features":[\n' + f[0] + "," + f[1] + ",\n" + f[2] + "\n]}",
        "first_beside_the_frame": '{"type":"FeatureCollection","features":[' + f[0] + ",\n" + f[1] + "]}",
        "one_over_several_lines": f[0] + "\n" + json.dumps(json.loads(f[1]), indent=1) + "\n" + f[2],
        "frame_over_lines": '{"type":"FeatureCollection",\n"crs":{\n"type":"name",\n"properties":{\n"name":"EPSG:4326"\n}\n},\n"features":[\n'
        + f[0] + ",\n" + f[1] + "\n]\n}",
    }
    counts = {"two_on_a_line": 3, "first_beside_the_frame": 2, "one_over_several_lines": 3, "frame_over_lines": 2}
    for name, text in files.items():
        (tmp_path / f"{name}.geojson").write_text(text)
    for name, count in counts.items():
        assert ids(geojson.read_geojson(spark, str(tmp_path / f"{name}.geojson"))) == list(range(count)), name
    assert len(ids(geojson.read_geojson(spark, str(tmp_path)))) == 10


@pytest.mark.parametrize("behind", [False, True])
def test_foreign_crs_over_lines_is_refused(spark, tmp_path, behind):
    crs = '"crs":\n{\n"type":"name",\n"properties":{\n"name":"EPSG:31982"\n}\n}'
    features = '"features":[\n' + ",\n".join(json.dumps(x) for x in make(random.Random(2), 3)) + "\n]"
    parts = [features, crs] if behind else [crs, features]
    (tmp_path / "a.geojson").write_text('{"type":"FeatureCollection",\n' + ",\n".join(parts) + "\n}")
    with pytest.raises(ValueError, match="31982"):
        geojson.read_geojson(spark, str(tmp_path / "a.geojson"))


def test_a_property_named_like_a_crs_is_none(spark, tmp_path):
    text = json.dumps({"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"id": 1, "crs": {"name": "EPSG:31982"}}, "geometry": None}]}, indent=1)
    (tmp_path / "a.geojson").write_text(text)
    assert ids(geojson.read_geojson(spark, str(tmp_path / "a.geojson"))) == [1]


def test_broken_files_leave_a_trace(spark, tmp_path, small_splits):
    f = [json.dumps(x) for x in make(random.Random(3), 6)]
    (tmp_path / "cut.geojson").write_text('{"type":"FeatureCollection","features":[' + ", ".join(f)[:-5])
    (tmp_path / "junk.geojson").write_text("no json at all")
    (tmp_path / "list.geojson").write_text('{"type":"FeatureCollection","features":[1, 2]}')
    (tmp_path / "line.geojson").write_text(f[0] + '\n{"type": "Feature", "properties": {"id": 7,\n' + f[2] + "\n")
    (tmp_path / "empty.geojson").write_text('{"type":"FeatureCollection",\n"features":\n[ ]}')
    small_splits(150)
    rows = geojson.read_geojson(spark, str(tmp_path)).collect()
    found = {}
    for r in rows:
        found.setdefault(r["source_file"].rsplit("/")[-1].split(".")[0], []).append(None if r["malformed"] else r["id"])
    assert sorted(found["cut"][:], key=str) == [0, 1, 2, 3, 4, None]
    assert found["junk"] == [None] and found["list"] == [None]
    assert sorted(found["line"], key=str) == [0, 2, None]
    assert "empty" not in found


def test_one_document_by_many_tasks(spark, tmp_path, small_splits):
    path = tmp_path / "one.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": make(random.Random(4), 4000)}))
    assert "\n" not in path.read_text()
    small_splits(20_000)
    pieces = jsonsplit.units(spark, [str(path)])
    assert pieces.groupBy("kind").count().collect() is not None
    assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 20
    assert ids(geojson.read_geojson(spark, str(path))) == list(range(4000))


def test_line_that_is_too_long_for_the_line_check(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(geojson, "LINE_BYTES", 500)
    few = make(random.Random(5), 60)
    (tmp_path / "a.geojson").write_text(json.dumps(few[0]) + "\n" + json.dumps({"type": "FeatureCollection", "features": few[1:]}) + "\n")
    assert ids(geojson.read_geojson(spark, str(tmp_path / "a.geojson"))) == list(range(60))


def test_features_do_not_carry_their_collection(spark):
    """Rows of features are listed without the parsed collection, else one line costs the square of its features."""
    features = ",".join('{"type":"Feature","properties":{"id":%d},"geometry":null}' % i for i in range(20))
    texts = spark.createDataFrame(
        [("a", '{"type":"FeatureCollection","features":[%s]}' % features), ("a", "no json"), ("a", '{"type":"FeatureCollection"}')],
        "source_file string, value string")
    wanted = "type string, properties struct<id: long>, geometry struct<type: string, coordinates: string>"
    found = geojson._documents(texts, spark.createDataFrame([], wanted).schema)
    assert found.filter("NOT malformed").count() == 20 and found.filter("malformed").count() == 2
    above = found._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "isnull(f#" not in above and "_broken" not in above
