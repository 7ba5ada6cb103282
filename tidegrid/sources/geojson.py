"""GeoJSON feature collections and newline-delimited features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegrid.functions.formats import feature, geojson_point, geojson_ring, point_geojson, ring_geojson
from tidegrid.sources import jsonsplit

# Names under which collections state longitude/latitude on WGS84.
ACCEPTED_CRS = ("EPSG:4326", "urn:ogc:def:crs:EPSG::4326", "urn:ogc:def:crs:OGC:1.3:CRS84")

# lines of a collection that surround its features
_AROUND = "|".join([
    r"[\s\[\]{}]*,?\s*",
    r"\s*\{?\s*\"type\"\s*:\s*\"FeatureCollection\"\s*,?\s*(\"features\"\s*:\s*\[\s*)?",
    r"\s*\"name\"\s*:\s*\"[^\"]*\"\s*,?\s*",
    r"\s*\"(crs|bbox)\"\s*:\s*[\[{].*[\]}]\s*,?\s*",
    r"\s*\"features\"\s*:\s*\[\s*",
])


# the name in a crs member; the member's own type is "name" too
_CRS_NAME = r'"crs"\s*:\s*\{.*?"name"\s*:\s*"(?!name")([^"]*)"'


#: A longer line is not looked at when files that can be read by line are told from others.
LINE_BYTES = 32 << 20


def _single_value(text: str) -> str:
    """Whether SQL text holds one whole object: its brackets, outside strings, close once and at the end."""
    plain = f"regexp_replace(regexp_replace({text}, r'(?s)\\\\.', ''), r'\"[^\"]*\"', '')"
    brackets = f"regexp_replace({plain}, r'[^\\[\\]{{}}]', '')"
    for _ in range(4):  # leave few brackets of coordinates
        brackets = f"replace({brackets}, '[]', '')"
    depths = f"""aggregate(split({brackets}, ''), named_struct('depth', 0, 'closed', 0),
        (s, c) -> named_struct('depth', s.depth + CASE c WHEN '{{' THEN 1 WHEN '[' THEN 1 WHEN '' THEN 0 ELSE -1 END,
            'closed', s.closed + CAST(s.depth <= 1 AND c IN ('}}', ']') AS INT)))"""
    return (
        f"({text} RLIKE r'(?s)^\\s*\\{{.*\\}}\\s*$' AND NOT contains({plain}, '\"') "
        f"AND {depths} = named_struct('depth', 0, 'closed', 1))"
    )


def _sources(spark: SparkSession, path: str | list[str], layout: str) -> tuple[list[str], list[str]]:
    """The files to be read line by line, and those to be split by structure.

    One pass over the text, one row per file back: Spark's driver lists the files anyhow. A file is
    read by line if some line is a whole feature or collection and each other line is one too or belongs to the frame around them.
    A file with broken lines among whole features that does not close all its brackets is read by line as well, so that one
    broken feature does not take the others with it. The reference system is looked for in every line, and one that is not
    accepted stops the read.
    """
    text = r"regexp_replace(value, r',\s*$', '')"
    read = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", LINE_BYTES).text(path)
    lines = read.selectExpr(
        "_metadata.file_path AS file", "_metadata.file_size AS size", "value", f"{text} AS text",
        f"value RLIKE r'^({_AROUND})$' AS frame",
        f"CASE WHEN contains(value, '\"crs\"') THEN regexp_extract(value, r'{_CRS_NAME}', 1) END AS crs",
    ).selectExpr("*", f"CASE WHEN NOT frame THEN {_single_value('text')} END AS single").selectExpr(
        "*", "single AND get_json_object(text, '$.type') IN ('Feature', 'FeatureCollection') AS feature",
        r"""length(regexp_replace(regexp_replace(regexp_replace(value, r'\\.', ''), r'"[^"]*"', ''), r'[^\[{]', ''))
          - length(regexp_replace(regexp_replace(regexp_replace(value, r'\\.', ''), r'"[^"]*"', ''), r'[^\]}]', '')) AS step""",
    )
    files = lines.groupBy("file").agg(
        # lines that are too long are not among those read
        F.expr("sum(octet_length(value) + 1) >= max(size) - 3 AND bool_or(coalesce(feature, false))").alias("features"),
        F.expr("bool_and(frame OR coalesce(single, false))").alias("whole_lines"),
        F.expr("sum(step) <> 0").alias("broken"),
        F.expr("max(size) > 0").alias("filled"),
        F.collect_set("crs").alias("crs"),
    ).filter("filled").collect()
    by_line, by_structure = [], []
    for row in files:
        for name in row["crs"]:
            _check_crs(name, row["file"])
        single = layout == "lines" or layout == "auto" and row["features"] and (row["whole_lines"] or row["broken"])
        (by_line if single else by_structure).append(row["file"])
    return sorted(by_line), sorted(by_structure)


def _check_crs(name: str | None, file: str) -> None:
    if name and name not in ACCEPTED_CRS:
        raise ValueError(f"only longitude/latitude on WGS84 is supported, not {name} as in {file}")


def _check_frames(texts: DataFrame) -> None:
    """Stops at a reference system that is not accepted in what surrounds the features of collections."""
    named = texts.filter("kind <> 'feature' AND contains(value, '\"crs\"')").selectExpr(
        "source_file", f"regexp_extract(value, r'(?s){_CRS_NAME}', 1) AS name")
    for row in named.filter((F.col("name") != "") & ~F.col("name").isin(*ACCEPTED_CRS)).limit(1).collect():
        _check_crs(row["name"], row["source_file"])


def _documents(texts: DataFrame, wanted: T.StructType) -> DataFrame:
    """Features of texts (``source_file``, ``value``), each of which is a feature or a collection."""
    document = T.StructType([
        *wanted.fields, T.StructField("features", T.ArrayType(wanted)), T.StructField("_broken", T.StringType())])
    parsed = texts.select(
        "source_file", "value",
        F.from_json(F.regexp_replace("value", r",\s*$", ""), document, {"columnNameOfCorruptRecord": "_broken"}).alias("f"),
    )
    one = "struct(f.type AS type, f.properties AS properties, f.geometry AS geometry)"
    # told before the features are listed, so that no row of a feature carries its whole collection
    return parsed.selectExpr(
        "source_file", "value", "f IS NULL OR f._broken IS NOT NULL AS broken",
        # a collection without a list of features is malformed, an empty one has no rows
        f"CASE WHEN f.type = 'FeatureCollection' AND f.features IS NOT NULL AND f._broken IS NULL"
        f" THEN f.features ELSE array({one}) END AS found",
    ).selectExpr("source_file", "value", "broken", "explode(found) AS feature").selectExpr(
        "source_file", "value", "feature.type", "feature.properties", "feature.geometry",
        "broken OR NOT feature.type <=> 'Feature' AS malformed",
    )


def _lines_of(texts: DataFrame) -> DataFrame:
    """Lines that are no part of the frame around features."""
    return texts.filter(~F.col("value").rlike(f"^({_AROUND})$"))


def read_geojson(
    spark: SparkSession,
    path: str | list[str],
    properties: T.StructType | None = None,
    layout: str = "auto",
) -> DataFrame:
    """One row per feature: its properties, ``geometry_type``, ``lon``, ``lat``, ``ring``, ``source_file``.

    Files with one feature (or one collection) on each line, as most tools write them, with or without
    the collection around them, are read by line. Any other file is cut into features by
    the structure of its brackets (:mod:`tidegrid.sources.jsonsplit`), whatever its lines are, one document or many.
    Spark splits both kinds of files, so no task reads a file as a whole. ``layout``
    ``auto`` decides that for each file from all its lines; ``lines`` and ``collection`` hold for all. What is
    neither a feature nor part of the frame around features comes out with ``malformed`` set and the
    name of its file, line by line if it has several, so nothing is lost without a trace. Geometries other than points and single rings
    have neither coordinates nor ring, and so fail validation rather than vanish.
    """
    if layout not in ("auto", "lines", "collection"):
        raise ValueError(f"layout must be auto, lines or collection, not {layout!r}")
    by_line, by_structure = _sources(spark, path, layout)
    texts = []
    if by_line:
        texts.append(_lines_of(spark.read.text(by_line).selectExpr("_metadata.file_path AS source_file", "value", "'line' AS kind")))
    if by_structure:
        found = jsonsplit.units(spark, by_structure)
        _check_frames(found)
        texts.append(found.filter("kind <> 'frame'").select("source_file", "value", "kind"))
    if not texts:
        texts.append(spark.createDataFrame([], "source_file string, value string, kind string"))
    every = texts[0] if len(texts) == 1 else texts[0].unionByName(texts[1])
    if properties is None:
        properties = _infer_properties(every)
    geometry = T.StructType().add("type", "string").add("coordinates", "string")
    wanted = T.StructType().add("type", "string").add("properties", properties).add("geometry", geometry)

    features = _documents(texts[0], wanted)
    if by_structure:
        whole = _documents(texts[-1], wanted)
        # text around features that is no JSON may hold features on lines of their own
        again = _lines_of(whole.filter("malformed").selectExpr("source_file", "explode(split(value, '\\n')) AS value"))
        features = whole.filter("NOT malformed").unionByName(_documents(again, wanted))
        if by_line:
            features = features.unionByName(_documents(texts[0], wanted))

    return features.selectExpr(
        *[f"properties.`{f.name}` AS `{f.name}`" for f in properties.fields],
        "geometry.type AS geometry_type",
        f"{geojson_point('geometry')} AS _p",
        f"{geojson_ring('geometry')} AS ring",
        "malformed", "source_file",
    ).selectExpr(
        *[f"`{f.name}`" for f in properties.fields],
        "geometry_type", "_p.x AS lon", "_p.y AS lat", "ring", "malformed", "source_file",
    )


def _infer_properties(texts: DataFrame) -> T.StructType:
    """Types of the properties in all texts, as Spark's JSON reader finds them; a name with several types becomes text."""
    spark = texts.sparkSession
    values = getattr(texts.selectExpr(r"regexp_replace(value, r',\s*$', '') AS value")._jdf, "as")(
        spark._jvm.org.apache.spark.sql.Encoders.STRING())
    schema = DataFrame(spark._jsparkSession.read().json(values), spark).schema
    found: dict[str, T.DataType] = {}
    inner = [schema["features"].dataType.elementType] if "features" in schema.names and isinstance(
        schema["features"].dataType, T.ArrayType) else []
    for kind in [schema, *inner]:
        if isinstance(kind, T.StructType) and "properties" in kind.names and isinstance(kind["properties"].dataType, T.StructType):
            for f in kind["properties"].dataType.fields:
                same = found.get(f.name, f.dataType) == f.dataType
                found[f.name] = f.dataType if same else T.StringType()
    return T.StructType([T.StructField(n, t) for n, t in sorted(found.items())])


def write_geojson(df: DataFrame, path: str) -> None:
    """One feature per line; every column but the geometry becomes a property."""
    shape = ring_geojson("ring") if "ring" in df.columns else point_geojson("lon", "lat")
    props = ", ".join(f"`{c}`" for c in df.columns if c not in ("lon", "lat", "ring"))
    df.selectExpr(f"{feature(f'struct({props})', shape)} AS value").write.mode("overwrite").text(path)
