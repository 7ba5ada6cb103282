"""The registered queries: each operator over whole tables.

Names start with the operator's number in the survey. Every query takes the session and the
folder of the supplied tables and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions import formats, geodesy, geometry, registry, text
from tidegrid.operators import classify as cls
from tidegrid.operators import cleaning, contracts, merge, nearest, reports, spatial, validity
from tidegrid.operators.grid import index_areas
from tidegrid.plans import medallion
from tidegrid.plans.bronze import bronze
from tidegrid.plans.derived import AREA_FIELDS, basins, reference_areas, table
from tidegrid.session import work_path
from tidegrid.sources import csv_points, geojson, ingest, layers, runlog, sample
from tidegrid.streaming import drops

Query = Callable[[SparkSession, str], DataFrame]
RUN_TS = "2024-07-01 02:00:00"
LATER_TS = "2024-07-02 02:00:00"
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return register


def citizens(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "citizens")


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf, "areas")


def flagged(spark: SparkSession, sf: str, among: DataFrame | None = None) -> DataFrame:
    """The citizens table: one row per citizen, flagged against the reference areas or others."""
    index = index_areas(reference_areas(spark) if among is None else among, ["area_id"])
    return spatial.flag_index(citizens(spark, sf), index, reports.FLAG, row_id=["citizen_id"])


def silver_citizens(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_citizens(bronze(spark, sf, "raw_citizens"), ["arrival"], RUN_TS)[0]


def silver_areas(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_areas(bronze(spark, sf, "raw_areas"), ["arrival"], RUN_TS)[0]


# --- flagship ----------------------------------------------------------------


@query("flagship_affected_share")
def flagship(spark, sf):
    """Spatial left join, classification, share affected; pairs as published."""
    return reports.status_share(cls.classify(citizens(spark, sf), reference_areas(spark)))


# --- sources and sinks -------------------------------------------------------


@query("s1_csv_points")
def s1(spark, sf):
    path = work_path(spark, "s1")
    csv_points.write_csv_points(citizens(spark, sf), path)
    schema = "citizen_id bigint, name string, address string, phone string, registration_date date, longitude double, latitude double"
    return csv_points.read_csv_points(spark, path, schema=schema).select(
        "citizen_id", "name", "address", "phone", "lon", "lat"
    )


@query("s1_damaged_records")
def s1_damaged(spark, sf):
    """Records with a field too few or too many keep what can be read and are marked."""
    path = work_path(spark, "s1")
    lines = citizens(spark, sf).selectExpr(
        "pmod(citizen_id, 16) AS file", "1 AS nth",
        """CASE WHEN citizen_id % 7 = 0 THEN concat_ws(',', citizen_id, lat)
            WHEN citizen_id % 11 = 0 THEN concat_ws(',', citizen_id, lat, lon, 'more')
            ELSE concat_ws(',', citizen_id, lat, lon) END AS value""",
    )
    heads = spark.range(16).selectExpr("id AS file", "0 AS nth", "'citizen_id,latitude,longitude' AS value")
    lines.unionByName(heads).repartition("file").sortWithinPartitions("file", "nth").drop("nth").write.partitionBy(
        "file").text(path)
    read = csv_points.read_csv_points(
        spark, path, schema="citizen_id bigint, latitude double, longitude double", damaged="record"
    )
    return read.selectExpr("citizen_id", "lon", "lat", "record IS NOT NULL AS damaged", "record")


@query("s2_geojson_points")
def s2_points(spark, sf):
    path = work_path(spark, "s2")
    geojson.write_geojson(citizens(spark, sf), path)
    return geojson.read_geojson(spark, path).select(
        F.col("citizen_id"), "name", "phone", "geometry_type", "lon", "lat"
    )


@query("s2_geojson_areas")
def s2_areas(spark, sf):
    path = work_path(spark, "s2")
    geojson.write_geojson(areas(spark, sf), path)
    return geojson.read_geojson(spark, path).selectExpr(
        "area_id", "area_name", "geometry_type", f"{formats.ring_wkt('ring')} AS wkt"
    )


def _area_documents(features: DataFrame, head: str, between: str, tail: str) -> DataFrame:
    """Collections of some 10,000 features (``area_id``, ``feature``) each, as text."""
    buckets = features.count() // 10_000 + 1
    return features.groupBy(F.expr(f"pmod(xxhash64(area_id), {buckets})").alias("bucket")).agg(
        F.expr(f"concat('{head}', array_join(array_sort(collect_list(feature)), '{between}'), '{tail}')").alias("value")
    ).select("value")


def _dated_features(spark, sf):
    dated = areas(spark, sf).withColumn("flood_date", F.expr("CAST(flood_date AS DATE)"))
    return reports.area_features(dated).selectExpr("id AS area_id", "feature")


@query("s2_mixed_folder")
def s2_mixed(spark, sf):
    """Points a line each, and areas as documents over many lines, read together."""
    path = work_path(spark, "s2")
    geojson.write_geojson(citizens(spark, sf).select("citizen_id", "lon", "lat"), f"{path}/points")
    broken = _dated_features(spark, sf).withColumn("feature", F.expr("replace(feature, ',\"', ',\n\"')"))
    _area_documents(
        broken, '{\n"type": "FeatureCollection",\n"features": [\n', ",\n", "\n]\n}"
    ).write.text(f"{path}/areas")
    return geojson.read_geojson(spark, [f"{path}/points", f"{path}/areas"]).groupBy("geometry_type", "malformed").agg(
        F.count("*").alias("features"), F.sum(F.size("ring").cast("long")).alias("vertices")
    )


@query("s2_any_layout")
def s2_any_layout(spark, sf):
    """The areas in five legal layouts of lines, each read whole: rows and vertices by layout."""
    path = work_path(spark, "s2")
    plain = _dated_features(spark, sf)
    broken = plain.withColumn("feature", F.expr("replace(replace(feature, ',\"', ',\n\"'), '{\"', '{\n \"')"))
    crs = '"crs":\n{\n"type": "name",\n"properties":\n{ "name": "EPSG:4326" }\n},\n'
    layouts = {
        "one_line": (plain, '{"type":"FeatureCollection","features":[', ",", "]}"),
        "beside_the_frame": (plain, '{"type":"FeatureCollection","features":[', ",\n", "]}"),
        "frame_over_lines": (plain, '{"type":"FeatureCollection",\n' + crs + '"features":[\n', ",\n", "\n]\n}"),
        "feature_over_lines": (broken, '{\n"features":\n[', "\n,\n", '],\n"type":"FeatureCollection"\n}'),
        "no_collection": (broken, "", "\n", ""),
    }
    for name, (features, head, between, tail) in layouts.items():
        _area_documents(features, head, between, tail).write.text(f"{path}/{name}")
    return geojson.read_geojson(spark, [f"{path}/{name}" for name in layouts]).groupBy(
        F.expr("element_at(split(source_file, '/'), -2)").alias("layout"), "malformed"
    ).agg(
        F.count("*").alias("features"), F.countDistinct("id").alias("areas"), F.sum(F.size("ring").cast("long")).alias("vertices")
    )


@query("s2_lakes")
def s2_lakes(spark, sf):
    """Areas with holes and of several parts written as GeoJSON and read back."""
    path = work_path(spark, "s2")
    geojson.write_geojson(bronze(spark, sf, "lakes"), path)
    return geojson.read_geojson(spark, path).selectExpr(
        "area_id", "geometry_type", f"{formats.ring_wkt('ring')} AS wkt", f"{formats.wkt_ring(formats.ring_wkt('ring'))} = ring AS same"
    )


@query("s3_layer_scan")
def s3(spark, sf):
    base = work_path(spark, "s3")
    source = citizens(spark, sf).withColumn("registration_date", F.expr("CAST(registration_date AS TIMESTAMP)"))
    layers.write_layer(source, base, "bronze", layers.CITIZENS)
    return layers.read_layer(spark, base, "bronze", layers.CITIZENS, layers.CITIZENS_SCHEMA).filter(
        "lat > -29.95D"
    ).select("citizen_id", "lon", "lat")


#: The city's centre, for scans of a box.
CENTRE_BOX = (-51.25, -30.06, -51.18, -30.0)


@query("s3_box_scan")
def s3_box(spark, sf):
    """Points of a clustered layer within a box."""
    path = layers.write_clustered(citizens(spark, sf).select("citizen_id", "lon", "lat"), work_path(spark, "s3"))
    return layers.read_box(spark, path, CENTRE_BOX)


@query("s3_box_areas")
def s3_box_areas(spark, sf):
    """Areas of a clustered layer whose bounds touch a box."""
    path = layers.write_clustered(areas(spark, sf), work_path(spark, "s3"))
    return layers.read_box(spark, path, CENTRE_BOX).select("area_id", "area_name")


@query("s3_wkb_scan")
def s3_wkb(spark, sf):
    path = work_path(spark, "s3")
    layers.with_wkb(areas(spark, sf)).write.parquet(path)
    return layers.read_wkb_areas(spark, path).selectExpr("area_id", f"{formats.ring_wkt('ring')} AS wkt")


@query("s3_wkb_lakes")
def s3_wkb_lakes(spark, sf):
    """Areas with holes and of several parts through a WKB column."""
    path = work_path(spark, "s3")
    layers.with_wkb(bronze(spark, sf, "lakes")).write.parquet(path)
    return layers.read_wkb_areas(spark, path).selectExpr("area_id", f"{formats.ring_wkt('ring')} AS wkt")


@query("s3_wkb_points")
def s3_wkb_points(spark, sf):
    path = work_path(spark, "s3")
    layers.with_wkb(citizens(spark, sf).select("citizen_id", "lon", "lat")).write.parquet(path)
    return layers.read_wkb_points(spark, path)


@query("s4_layer_overwrite")
def s4(spark, sf):
    base = work_path(spark, "s4")
    layers.write_layer(areas(spark, sf), base, "silver", layers.FLOODING_AREAS)
    layers.write_layer(basins(spark, sf), base, "silver", layers.FLOODING_AREAS)
    return layers.read_layer(spark, base, "silver", layers.FLOODING_AREAS).select("area_id", "area_name", "severity")


@query("s5_csv_export")
def s5(spark, sf):
    path = work_path(spark, "s5")
    csv_points.write_csv_points(citizens(spark, sf), path)
    return spark.read.option("header", True).csv(path).selectExpr(
        "CAST(citizen_id AS BIGINT) AS citizen_id", "name", "longitude", "latitude"
    )


@query("s6_geojson_export")
def s6(spark, sf):
    path = work_path(spark, "s6")
    geojson.write_geojson(citizens(spark, sf).select("citizen_id", "name", "phone", "lon", "lat"), path)
    return spark.read.text(path).withColumnRenamed("value", "feature")


def _ingested(spark, sf):
    """Three sources: a CSV, a GeoJSON of the same name, and a CSV without coordinates."""
    folder = work_path(spark, "inbox")
    csv_points.write_csv_points(citizens(spark, sf), f"{folder}/citizens_data.csv")
    geojson.write_geojson(areas(spark, sf), f"{folder}/citizens_data.geojson")
    table(spark, sf, "nation").write.option("header", True).csv(f"{folder}/no_coordinates.csv")
    return ingest.ingest_all(spark, [folder], work_path(spark, "converted"), RUN_TS)


@query("s7_ingest_sources")
def s7(spark, sf):
    return _ingested(spark, sf).select("source", "source_type", "status", "records")


@query("s8_source_report")
def s8(spark, sf):
    return ingest.report_summary(_ingested(spark, sf))


@query("s9_store_copy")
def s9(spark, sf):
    base = work_path(spark, "s9")
    source = layers.write_layer(citizens(spark, sf), base, "bronze", layers.CITIZENS)
    copy = layers.copy_table(spark, source, f"{base}-bucket/bronze/citizens.parquet")
    return spark.read.parquet(copy).select("citizen_id", "name", "lon", "lat")


@query("s10_table_load")
def s10(spark, sf):
    path = work_path(spark, "s10")
    contracts.conform(silver_areas(spark, sf), contracts.FLOODING_AREAS, RUN_TS).write.parquet(path)
    return spark.read.parquet(path).selectExpr(
        "area_id", "area_name", f"{text.iso_date('flood_date')} AS flood_date", "severity", "affected_population"
    )


def _current(spark, sf):
    """A citizens table of a run before: old names, some without status, some since gone."""
    flag = "CASE citizen_id % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END"
    return citizens(spark, sf).selectExpr(
        "inline(array(struct(citizen_id, 'Old ' || name AS name), "
        "struct(citizen_id + 10000000 AS citizen_id, 'Gone ' || name AS name)))",
    ).selectExpr("citizen_id", "name", f"{flag} AS {reports.FLAG}")


@query("s11_refresh_citizens")
def s11(spark, sf):
    table_now = flagged(spark, sf).select("citizen_id", "name", reports.FLAG)
    return merge.refresh(
        _current(spark, sf), table_now.filter(reports.FLAG), table_now.filter(f"NOT {reports.FLAG}"), ["citizen_id"]
    )


@query("s11_upsert_citizens")
def s11_upsert(spark, sf):
    return merge.upsert(
        _current(spark, sf), flagged(spark, sf).select("citizen_id", "name", reports.FLAG), ["citizen_id"]
    )


@query("s11_upsert_flag_only")
def s11_flag(spark, sf):
    return merge.upsert_column(
        _current(spark, sf), flagged(spark, sf).select("citizen_id", "name", reports.FLAG), ["citizen_id"], reports.FLAG
    )


@query("s12_run_log")
def s12(spark, sf):
    path = work_path(spark, "s12")
    runlog.append_run(flagged(spark, sf), path, RUN_TS, run_id="first", seconds=1.5)
    runlog.append_run(flagged(spark, sf, areas(spark, sf)), path, LATER_TS, run_id="second", seconds=2.0)
    return runlog.run_history(spark, path).withColumn("run_date", F.expr(text.iso_timestamp("run_date")))


@query("s13_sample_citizens")
def s13(spark, sf):
    return sample.citizens_from_ids(table(spark, sf, "customer").select("c_custkey"), "c_custkey").selectExpr(
        "citizen_id", "name", "address", "phone", "date_format(registration_date, 'yyyy-MM-dd') AS registration_date",
        "round(lon, 6) AS lon", "round(lat, 6) AS lat",
    )


@query("s14_delete_rows")
def s14(spark, sf):
    path = work_path(spark, "s14")
    flagged(spark, sf).write.parquet(path)
    return merge.rewrite_without(spark, path, reports.FLAG).select("citizen_id", "name")


@query("s15_medallion")
def s15(spark, sf):
    published = medallion.run(
        spark, work_path(spark, "s15"), bronze(spark, sf, "raw_citizens"), bronze(spark, sf, "raw_areas"),
        ["arrival"], RUN_TS,
    )
    return medallion.summary(published)


# --- projections, filters, cleaning ------------------------------------------


@query("p1_affected")
def p1(spark, sf):
    return flagged(spark, sf).filter(reports.FLAG).select("citizen_id", "name")


@query("p1_unaffected")
def p1_not(spark, sf):
    return flagged(spark, sf).filter(f"NOT {reports.FLAG}").select("citizen_id", "name")


@query("p2_tolerant_projection")
def p2(spark, sf):
    return cleaning.keep_columns(citizens(spark, sf), ["name", "citizen_id", "not_there", "phone"])


@query("p3_point_validity")
def p3(spark, sf):
    return validity.check_points(bronze(spark, sf, "raw_citizens")).select(
        "arrival", "invalid_reason", "geometry_valid"
    )


@query("p3_ring_validity")
def p3_rings(spark, sf):
    return validity.check_rings(bronze(spark, sf, "raw_areas")).select(
        "arrival", "area_id", "invalid_reason", "geometry_valid"
    )


@query("p3_lake_validity")
def p3_lakes(spark, sf):
    return validity.check_rings(bronze(spark, sf, "raw_lakes")).select("area_id", "invalid_reason", "geometry_valid")


@query("p4_quarantine")
def p4(spark, sf):
    _, points = validity.split_valid(validity.check_points(bronze(spark, sf, "raw_citizens")))
    _, rings = validity.split_valid(validity.check_rings(bronze(spark, sf, "raw_areas")))
    both = points.selectExpr("'citizens' AS source", "invalid_reason").unionByName(
        rings.selectExpr("'areas' AS source", "invalid_reason")
    )
    return both.groupBy("source", "invalid_reason").agg(F.count(F.lit(1)).alias("records"))


@query("p5_standard_types")
def p5(spark, sf):
    return cleaning.standard_citizens(bronze(spark, sf, "raw_citizens")).selectExpr(
        "arrival", "citizen_id", "typeof(registration_date) AS date_type",
        f"{text.iso_timestamp('registration_date')} AS registration_date",
    )


@query("p6_phone_fill")
def p6(spark, sf):
    return cleaning.standard_citizens(bronze(spark, sf, "raw_citizens")).select("arrival", "phone")


@query("p7_trim")
def p7(spark, sf):
    return cleaning.standard_citizens(bronze(spark, sf, "raw_citizens")).select("arrival", "name", "address")


@query("p8_control_columns")
def p8(spark, sf):
    out = cleaning.control_columns(citizens(spark, sf), RUN_TS)
    return out.selectExpr(
        "citizen_id", f"{text.iso_timestamp('normalized_date')} AS normalized_date", "data_quality_score"
    )


@query("p9_source_columns")
def p9(spark, sf):
    return cleaning.source_columns(citizens(spark, sf), "csv", RUN_TS).select(
        "citizen_id", "_processed_date", "_source_type", "_data_quality"
    )


@query("p10_auto_dates")
def p10(spark, sf):
    raw = bronze(spark, sf, "raw_citizens").selectExpr(
        "arrival", "registration_date",
        "CASE WHEN arrival % 9 = 0 THEN 'unknown' ELSE registration_date END AS seen", "phone",
    )
    return cleaning.auto_types(raw).selectExpr(
        "arrival", f"{text.iso_date('registration_date')} AS registration_date",
        f"{text.iso_date('seen')} AS seen", "seen_text", "phone",
    )


@query("p11_auto_lowercase")
def p11(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang", F.upper("source").alias("source"))
    return cleaning.auto_types(docs)


@query("p12_classified")
def p12(spark, sf):
    return cls.classify(citizens(spark, sf), reference_areas(spark)).select(
        "citizen_id", "affected_by_flooding", "affected_area_id"
    )


@query("p12_published_affected")
def p12_affected(spark, sf):
    pairs = cls.classify(silver_citizens(spark, sf), silver_areas(spark, sf).drop("normalized_date", "data_quality_score"))
    return cls.affected_table(pairs, RUN_TS).selectExpr(
        "citizen_id", "name", "phone", "affected_area_id", "area_name", "severity", "data_quality_score",
        f"{text.iso_timestamp('processing_date')} AS processing_date",
    )


@query("p12_published_unaffected")
def p12_unaffected(spark, sf):
    pairs = cls.classify(silver_citizens(spark, sf), silver_areas(spark, sf).drop("normalized_date", "data_quality_score"))
    return cls.unaffected_table(pairs, RUN_TS).select("citizen_id", "name", "affected_by_flooding")


@query("p12_published_all")
def p12_all(spark, sf):
    pairs = cls.classify(silver_citizens(spark, sf), silver_areas(spark, sf).drop("normalized_date", "data_quality_score"))
    return cls.all_table(pairs, RUN_TS).select("citizen_id", "affected_by_flooding", "affected_area_id")


@query("p13_defaults")
def p13(spark, sf):
    raw = bronze(spark, sf, "raw_areas").select("arrival", "area_name", "severity", "affected_population")
    return cleaning.with_defaults(raw, {"severity": "unknown", "affected_population": 0, "status": "new"})


@query("p14_export_guard")
def p14(spark, sf):
    raw = bronze(spark, sf, "raw_citizens").selectExpr(
        "arrival AS citizen_id", "name", "address", "phone", f"false AS {reports.FLAG}", "lon", "lat"
    )
    return reports.citizen_features(raw).select("id", "type")


@query("p15_markers")
def p15(spark, sf):
    return cls.with_markers(flagged(spark, sf)).select(
        "citizen_id", "marker_colour", "marker_icon", "marker_label"
    )


@query("p16_contract_violations")
def p16(spark, sf):
    raw = contracts.conform(bronze(spark, sf, "raw_citizens"), contracts.CITIZENS)
    return contracts.violation_counts(raw, contracts.CITIZENS)


# --- joins -------------------------------------------------------------------


@query("j1_left_within")
def j1(spark, sf):
    return spatial.within_join(citizens(spark, sf), reference_areas(spark), "left", AREA_FIELDS, ["citizen_id"]).select(
        "citizen_id", "name", *AREA_FIELDS
    )


@query("j1_left_within_basins")
def j1_basins(spark, sf):
    return spatial.within_join(citizens(spark, sf), areas(spark, sf), "left", ["area_id", "severity"], ["citizen_id"]).select(
        "citizen_id", "area_id", "severity"
    )


@query("j1_left_within_shuffled")
def j1_shuffled(spark, sf):
    """The path for areas too large to broadcast, hot cells spread."""
    return spatial.within_join(
        citizens(spark, sf), areas(spark, sf), "left", ["area_id", "severity"], ["citizen_id"], broadcast_bytes=0
    ).select("citizen_id", "area_id", "severity")


@query("j2_inner_within")
def j2(spark, sf):
    return spatial.within_join(citizens(spark, sf), areas(spark, sf), "inner", ["area_id"], ["citizen_id"]).select(
        "citizen_id", "area_id"
    )


@query("j3_contains_first_rows")
def j3(spark, sf):
    pairs = spatial.within_join(
        citizens(spark, sf), reference_areas(spark), "left", ["area_name"], ["citizen_id"]
    )
    return pairs.selectExpr(
        "citizen_id", "name", "area_name", f"{formats.point_wkt('lon', 'lat')} AS geometry"
    ).orderBy("citizen_id", "area_name").limit(10)


@query("j3_contains_left")
def j3_left(spark, sf):
    return reports.area_listing(areas(spark, sf), citizens(spark, sf)).select("area_id", "area_name", "citizen_id")


@query("j4_affected_per_area")
def j4(spark, sf):
    return reports.affected_per_area(areas(spark, sf), flagged(spark, sf))


@query("j5_citizens_per_area")
def j5(spark, sf):
    return reports.citizens_per_area(areas(spark, sf), citizens(spark, sf))


@query("j6_min_distance")
def j6(spark, sf):
    return nearest.min_distance(citizens(spark, sf), reference_areas(spark), ["citizen_id", "name"]).selectExpr(
        "citizen_id", "name", "round(min_distance_m, 2) AS min_distance_meters"
    )


@query("j7_anti")
def j7(spark, sf):
    return spatial.within_join(citizens(spark, sf), areas(spark, sf), "anti", ["area_id"], ["citizen_id"]).select(
        "citizen_id", "name"
    )


@query("j8_semi")
def j8(spark, sf):
    return spatial.within_join(citizens(spark, sf), areas(spark, sf), "semi", ["area_id"], ["citizen_id"]).select(
        "citizen_id", "name"
    )


@query("j9_within_distance")
def j9(spark, sf):
    return spatial.within_distance_join(
        citizens(spark, sf), areas(spark, sf), 500.0, ["area_id"], ["citizen_id"]
    ).selectExpr("citizen_id", "area_id", f"{geodesy.rounded_metres('distance_m')} AS distance_m")


@query("j1_within_lakes")
def j1_lakes(spark, sf):
    """Citizens in areas with holes and of several parts."""
    people = citizens(spark, sf).select("citizen_id", "lon", "lat")
    return spatial.within_join(people, bronze(spark, sf, "lakes"), "inner", ["area_id"]).select("citizen_id", "area_id")


@query("j6_distance_to_lakes")
def j6_lakes(spark, sf):
    """The least distance of every citizen to an area with holes and of several parts."""
    people = citizens(spark, sf).select("citizen_id", "lon", "lat")
    return nearest.min_distance(people, bronze(spark, sf, "lakes"), ["citizen_id"]).selectExpr(
        "citizen_id", "round(min_distance_m, 2) AS min_distance_m")


@query("j10_basins_meet_lakes")
def j10_lakes(spark, sf):
    """Basins that share a point with an area with holes."""
    return spatial.areas_intersect_join(
        basins(spark, sf).selectExpr("area_id AS basin_id", "ring"), bronze(spark, sf, "lakes"), "basin_id", "area_id")


@query("j10_areas_intersect")
def j10(spark, sf):
    rings = areas(spark, sf).select("area_id", "ring")
    return spatial.areas_intersect_join(rings, rings.withColumnRenamed("area_id", "other_id"), "area_id", "other_id")


# --- aggregates --------------------------------------------------------------


@query("a1_counts")
def a1(spark, sf):
    return flagged(spark, sf).selectExpr(
        "count(*) AS total_citizens", f"count_if({reports.FLAG}) AS affected_citizens"
    )


@query("a2_conditional_counts")
def a2(spark, sf):
    return reports.status_counts(flagged(spark, sf))


@query("a3_filtered_counts")
def a3(spark, sf):
    return reports.run_record(flagged(spark, sf), RUN_TS).drop("run_date", "run_id", "processing_time_seconds")


@query("a4_share")
def a4(spark, sf):
    return reports.status_share(flagged(spark, sf))


@query("a5_count_per_area")
def a5(spark, sf):
    pairs = spatial.within_join(citizens(spark, sf), areas(spark, sf), "inner", ["area_name", "severity"], ["citizen_id"])
    return pairs.groupBy("severity", "area_name").agg(F.count("citizen_id").alias("citizens"))


@query("a6_min_distance_basins")
def a6(spark, sf):
    return nearest.min_distance(citizens(spark, sf), basins(spark, sf), ["citizen_id"]).selectExpr(
        "citizen_id", "round(min_distance_m, 2) AS min_distance_meters"
    )


@query("a7_extent")
def a7(spark, sf):
    return reports.point_extent(citizens(spark, sf))


@query("a7_extent_areas")
def a7_areas(spark, sf):
    return reports.ring_extent(areas(spark, sf))


@query("a8_scalar_subquery_share")
def a8(spark, sf):
    return spark.sql(
        """SELECT area_id, count(*) AS citizens,
                  round(count(*) * 100D / nullif((SELECT count(*) FROM {people}), 0), 2) AS percentage
           FROM {pairs} GROUP BY area_id""",
        people=citizens(spark, sf),
        pairs=spatial.within_join(citizens(spark, sf), areas(spark, sf), "inner", ["area_id"], ["citizen_id"]),
    )


@query("a9_gold_summary")
def a9(spark, sf):
    return cls.classify(citizens(spark, sf), areas(spark, sf)).selectExpr(
        "count(*) AS evaluated",
        "sum(CAST(affected_by_flooding AS BIGINT)) AS affected",
        "sum(CAST(NOT affected_by_flooding AS BIGINT)) AS unaffected",
    )


@query("a10_quality_profile")
def a10(spark, sf):
    checked = cleaning.control_columns(validity.check_points(bronze(spark, sf, "raw_citizens")), RUN_TS)
    return reports.quality_profile(checked, ["phone", "lon", "name"])


@query("a11_source_records")
def a11(spark, sf):
    return _ingested(spark, sf).agg(F.sum("records").alias("total_records"))


@query("a12_geometry_kinds")
def a12(spark, sf):
    path = work_path(spark, "a12")
    geojson.write_geojson(citizens(spark, sf).selectExpr("citizen_id AS id", "lon", "lat"), f"{path}/points")
    geojson.write_geojson(areas(spark, sf).selectExpr("area_id AS id", "ring"), f"{path}/rings")
    both = geojson.read_geojson(spark, f"{path}/points").unionByName(geojson.read_geojson(spark, f"{path}/rings"))
    return both.groupBy("geometry_type").agg(F.count(F.lit(1)).alias("features"), F.expr("bool_and(NOT malformed) AS all_valid"))


@query("a13_layer_inventory")
def a13(spark, sf):
    base = work_path(spark, "a13")
    layers.write_layer(bronze(spark, sf, "raw_citizens").repartition(4), base, "bronze", layers.CITIZENS)
    layers.write_layer(silver_citizens(spark, sf).repartition(3), base, "silver", layers.CITIZENS)
    layers.write_layer(flagged(spark, sf).repartition(2), base, "gold", layers.ALL_EVALUATED)
    return reports.layer_inventory({
        "bronze": layers.read_layer(spark, base, "bronze", layers.CITIZENS),
        "silver": layers.read_layer(spark, base, "silver", layers.CITIZENS),
        "gold": layers.read_layer(spark, base, "gold", layers.ALL_EVALUATED),
    })


# --- duplicates, sorts, limits -----------------------------------------------


@query("w1_keep_first")
def w1(spark, sf):
    usable, _ = validity.split_valid(validity.check_points(bronze(spark, sf, "raw_citizens")))
    return cleaning.keep_first(usable, ["citizen_id"], ["arrival"]).select("citizen_id", "arrival", "address", "lon", "lat")


@query("w1_keep_first_areas")
def w1_areas(spark, sf):
    usable, _ = validity.split_valid(validity.check_rings(bronze(spark, sf, "raw_areas")))
    return cleaning.keep_first(usable, ["area_id"], ["arrival"]).select("area_id", "arrival", "area_name")


@query("w2_order_by_id")
def w2(spark, sf):
    return flagged(spark, sf).select("citizen_id", "name", "phone").orderBy("citizen_id")


@query("w3_latest_first")
def w3(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey AS run_id", f"{text.iso_date('o_orderdate')} AS run_date"
    ).orderBy(F.desc("run_date"), "run_id")


@query("w4_top_nearest")
def w4(spark, sf):
    return nearest.min_distance(citizens(spark, sf), reference_areas(spark), ["citizen_id", "name"]).selectExpr(
        "citizen_id", "name", "round(min_distance_m, 2) AS min_distance_meters"
    ).orderBy("min_distance_meters", "citizen_id").limit(10)


@query("w5_first_affected")
def w5(spark, sf):
    return flagged(spark, sf).filter(reports.FLAG).selectExpr(
        "citizen_id", "name", "address", f"{formats.point_wkt('lon', 'lat')} AS location", reports.FLAG
    ).orderBy("citizen_id").limit(10)


@query("w5_geometry_listing")
def w5_listing(spark, sf):
    return areas(spark, sf).selectExpr(
        "area_id AS id", f"{formats.ring_geojson('ring')} AS geometry",
        "to_json(struct(area_name, severity, affected_population)) AS properties",
    ).orderBy("id").limit(100)


@query("w6_nearest_area")
def w6(spark, sf):
    return nearest.nearest_area(citizens(spark, sf), reference_areas(spark), ["citizen_id"]).selectExpr(
        "citizen_id", "area_id", "round(min_distance_m, 2) AS min_distance_meters"
    )


# --- set operations and views ------------------------------------------------


@query("u1_summary")
def u1(spark, sf):
    return reports.summary(flagged(spark, sf))


@query("u1_summary_sql")
def u1_sql(spark, sf):
    return reports.summary_sql(flagged(spark, sf))


@query("u2_feature_union")
def u2(spark, sf):
    dated = areas(spark, sf).withColumn("flood_date", F.expr("CAST(flood_date AS DATE)"))
    return reports.all_features(flagged(spark, sf), dated)


@query("u3_id_difference")
def u3(spark, sf):
    everyone = citizens(spark, sf).select("citizen_id")
    hit = spatial.within_join(citizens(spark, sf), areas(spark, sf), "inner", ["area_id"], ["citizen_id"])
    return everyone.subtract(hit.select("citizen_id"))


@query("u4_point_union")
def u4(spark, sf):
    near = sample.citizens_from_ids(table(spark, sf, "customer"), "c_custkey")
    away = sample.citizens_from_ids(table(spark, sf, "supplier"), "s_suppkey")
    return near.union(away).selectExpr("citizen_id", "name", "round(lon, 6) AS lon", "round(lat, 6) AS lat")


@query("u5_view")
def u5(spark, sf):
    reports.summary(flagged(spark, sf)).createOrReplaceTempView("v_citizens_summary")
    return spark.sql("SELECT category, count, percentage FROM v_citizens_summary WHERE count > 0")


@query("u6_list_tables")
def u6(spark, sf):
    for name in ("citizens", "areas", "raw_citizens"):
        bronze(spark, sf, name).createOrReplaceTempView(f"tidegrid_{name}")
    names = [t.name for t in spark.catalog.listTables(pattern="tidegrid_*")]
    counts = " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in sorted(names))
    return spark.sql(counts)


# --- scalar functions --------------------------------------------------------


@query("f1_points_from_xy")
def f1(spark, sf):
    return citizens(spark, sf).selectExpr("citizen_id", f"{geometry.make_point('lon', 'lat')} AS p").selectExpr(
        "citizen_id", "p.x AS x", "p.y AS y"
    )


@query("f2_x_and_y")
def f2(spark, sf):
    corner = citizens(spark, sf).selectExpr("citizen_id", f"{geometry.make_point('lon', 'lat')} AS p")
    return corner.selectExpr(
        "citizen_id", f"{geometry.point_x('p')} AS st_x", f"{geometry.point_y('p')} AS st_y"
    )


@query("f3_contains")
def f3(spark, sf):
    """Whether each area holds the middle of its own bounds."""
    b = areas(spark, sf).selectExpr("area_id", "ring", f"{geometry.ring_bounds('ring')} AS b")
    middle = b.selectExpr("area_id", "ring", "(b.xmin + b.xmax) / 2D AS mx", "(b.ymin + b.ymax) / 2D AS my")
    return middle.selectExpr("area_id", f"{geometry.ring_contains('ring', 'mx', 'my')} AS holds_middle")


@query("f4_distance")
def f4(spark, sf):
    """Metres from the city centre to each area."""
    return areas(spark, sf).selectExpr(
        "area_id", f"round({geometry.ring_distance('ring', '-51.2093D', '-30.0326D')}, 2) AS distance_m"
    )


@query("f5_centroid")
def f5(spark, sf):
    return areas(spark, sf).selectExpr("area_id", f"{geometry.ring_centroid('ring')} AS c").selectExpr(
        "area_id", "round(c.x, 9) AS lon", "round(c.y, 9) AS lat"
    )


@query("f5_lake_measures")
def f5_lakes(spark, sf):
    """Extent, area and centroid of areas with holes and of several parts."""
    return bronze(spark, sf, "lakes").selectExpr(
        "area_id", f"{geometry.ring_bounds('ring')} AS b", f"{geometry.ring_centroid('ring')} AS c",
        f"round({geometry.ring_area('ring')} * 1e6D, 6) AS area"
    ).selectExpr("area_id", "b.*", "round(c.x, 9) AS lon", "round(c.y, 9) AS lat", "area")


@query("f6_wkt")
def f6(spark, sf):
    points = citizens(spark, sf).selectExpr("citizen_id AS id", f"{formats.point_wkt('lon', 'lat')} AS wkt")
    return points.unionByName(areas(spark, sf).selectExpr("-area_id AS id", f"{formats.ring_wkt('ring')} AS wkt"))


@query("f6_sql_functions")
def f6_sql(spark, sf):
    """The same formulas called by their SQL names."""
    registry.register(spark)
    return spark.sql(
        """SELECT area_id, st_astext(ring) AS wkt, round(st_x(st_centroid(ring)), 9) AS lon,
                  round(st_y(st_centroid(ring)), 9) AS lat, st_asgeojson(ring) AS geojson,
                  round(st_distance_m(ring, -51.2093D, -30.0326D), 2) AS distance_m,
                  size(st_polygonfromtext(st_astext(ring))) AS vertices
           FROM {areas}""",
        areas=areas(spark, sf),
    )


@query("f7_geojson")
def f7(spark, sf):
    points = citizens(spark, sf).selectExpr("citizen_id AS id", f"{formats.point_geojson('lon', 'lat')} AS geojson")
    return points.unionByName(areas(spark, sf).selectExpr("-area_id AS id", f"{formats.ring_geojson('ring')} AS geojson"))


@query("f8_from_wkt")
def f8(spark, sf):
    texts = areas(spark, sf).selectExpr(
        "area_id", f"{formats.ring_wkt('ring')} AS w", f"{formats.point_wkt('ring[0].x', 'ring[0].y')} AS p"
    )
    parsed = texts.selectExpr("area_id", f"{formats.wkt_ring('w')} AS r", f"{formats.wkt_point('p')} AS p")
    return parsed.selectExpr(
        "area_id", "size(r) AS vertices", "p.x AS first_x", "p.y AS first_y",
        "array_max(transform(r, v -> v.x)) AS xmax",
    )


@query("f9_is_valid")
def f9(spark, sf):
    return validity.check_rings(bronze(spark, sf, "raw_areas")).select("arrival", "geometry_valid")


@query("f10_bounds")
def f10(spark, sf):
    return areas(spark, sf).selectExpr("area_id", f"{geometry.ring_bounds('ring')} AS b").select("area_id", "b.*")


def _date_texts(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        "CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
        "WHEN 1 THEN date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") "
        "WHEN 2 THEN o_orderpriority ELSE CAST(o_orderkey AS STRING) END AS noted",
        "date_format(o_orderdate, 'yyyy-MM-dd') AS dated",
    )


@query("f11_date_parse")
def f11(spark, sf):
    return _date_texts(spark, sf).selectExpr(
        "o_orderkey",
        f"{text.iso_timestamp(text.parse_date('dated'))} AS strict",
        f"{text.iso_timestamp(text.try_parse_date('noted'))} AS lenient",
    )


@query("f12_iso_date")
def f12(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", f"{text.iso_date('ts')} AS day", f"{text.iso_timestamp('ts')} AS second"
    )


@query("f13_round")
def f13(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey", "round(c_custkey * 100D / 7D, 2) AS share")


@query("f14_nullif_case")
def f14(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", "CAST(nullif(c_custkey % 5, 0) AS BIGINT) AS part",
        "CASE WHEN c_acctbal > 5000 THEN 'high' WHEN c_acctbal > 0 THEN 'low' ELSE 'none' END AS level",
        "round(100D / nullif(c_custkey % 5, 0), 2) AS guarded",
    )


@query("f15_text")
def f15(spark, sf):
    return table(spark, sf, "documents").selectExpr(
        "doc_id", "lower(text) AS lowered", f"{text.tidy('text')} AS tidied", "length(text) AS n"
    )


@query("f16_zero_pad")
def f16(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", f"'Citizen_' || {text.zero_padded('c_custkey', 3)} AS name",
        f"'51 99999-' || {text.zero_padded('c_custkey', 4)} AS phone",
    )


@query("f17_daily_dates")
def f17(spark, sf):
    days = text.days_from("2024-01-01", "c_custkey % 3650")
    return table(spark, sf, "customer").selectExpr("c_custkey", f"{text.iso_date(days)} AS day")


@query("f18_feature_text")
def f18(spark, sf):
    return reports.citizen_features(flagged(spark, sf)).select("id", "feature")


@query("f18_feature_collection")
def f18_collection(spark, sf):
    path = work_path(spark, "f18")
    dated = areas(spark, sf).withColumn("flood_date", F.expr("CAST(flood_date AS DATE)"))
    reports.write_collection(reports.all_features(flagged(spark, sf), dated), path)
    kind = "get_json_object(rtrim(',', value), '$.properties.type')"
    return spark.read.text(path).selectExpr(
        "max(CASE WHEN startswith(value, '{\"type\":\"FeatureCollection\"') THEN 'FeatureCollection' END) AS type",
        f"count({kind}) AS features",
        f"count_if({kind} = 'flood_area') AS areas",
        "count_if(endswith(value, ',')) AS continued",
        f"min_by(get_json_object(rtrim(',', value), '$.properties.name'),"
        f" CASE WHEN {kind} = 'citizen' THEN CAST(get_json_object(rtrim(',', value), '$.properties.id') AS BIGINT) END) AS first_name",
    )


@query("f19_json_geometry")
def f19(spark, sf):
    texts = areas(spark, sf).selectExpr("area_id", f"{formats.ring_geojson('ring')} AS t")
    parsed = texts.selectExpr("area_id", f"{formats.parse_geometry('t')} AS g")
    return parsed.selectExpr(
        "area_id", "g.type AS type", f"{formats.geojson_ring('g')} AS r"
    ).selectExpr("area_id", "type", "size(r) AS vertices", "r[1].x AS second_x")


@query("f20_properties")
def f20(spark, sf):
    return table(spark, sf, "events").selectExpr(
        "event_id", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    )


@query("f21_normal_draw")
def f21(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "c_custkey", f"round({text.normal_draw('c_custkey', 'risk/lon', '-51.24D', 0.03)}, 6) AS draw"
    )


# --- streaming ---------------------------------------------------------------


def _drop_frames(spark, sf):
    """Three drops: six of seven, then those without a phone, then those up north, renamed."""
    people = citizens(spark, sf)
    for n, who in enumerate(("citizen_id % 7 <> 0", "phone IS NULL", "lat > -29.95D"), start=1):
        yield people.filter(who).selectExpr(
            "citizen_id", f"name || ' v{n}' AS name", "lon", "lat", f"{n} AS drop_no"
        )


DROP_SCHEMA = "citizen_id bigint, name string, lon double, lat double, drop_no int"


@query("t1_new_files")
def t1(spark, sf):
    base = work_path(spark, "t1")
    for frame in _drop_frames(spark, sf):
        frame.write.mode("append").option("header", True).csv(f"{base}/inbox")
        stream = drops.watch_csv(spark, f"{base}/inbox", DROP_SCHEMA)
        drops.append_to(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("citizen_id", "name", "drop_no")


@query("t2_classified_drops")
def t2(spark, sf):
    base = work_path(spark, "t2")
    index = index_areas(reference_areas(spark), ["area_id", "area_name"])
    for frame in _drop_frames(spark, sf):
        frame.write.mode("append").parquet(f"{base}/inbox")
        stream = drops.watch_parquet(spark, f"{base}/inbox", DROP_SCHEMA)
        drops.classify_drops(stream, index, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select(
        "citizen_id", "drop_no", "affected_by_flooding", "affected_area_id"
    )


@query("t2_classified_batches")
def t2_batches(spark, sf):
    base = work_path(spark, "t2")
    index = index_areas(areas(spark, sf), ["area_id"])
    for frame in _drop_frames(spark, sf):
        frame.write.mode("append").parquet(f"{base}/inbox")
        stream = drops.watch_parquet(spark, f"{base}/inbox", DROP_SCHEMA)
        drops.classify_drops(stream, index, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("citizen_id", "drop_no", "affected_area_id")


@query("t3_merged_drops")
def t3(spark, sf):
    base = work_path(spark, "t3")
    for frame in _drop_frames(spark, sf):
        frame.write.mode("append").parquet(f"{base}/inbox")
        stream = drops.watch_parquet(spark, f"{base}/inbox", DROP_SCHEMA)
        drops.merge_drops(stream, f"{base}/table", f"{base}/checkpoint", ["citizen_id"], ["drop_no"]).awaitTermination()
    return drops.merged(spark, f"{base}/table", ["citizen_id"]).select("citizen_id", "name", "drop_no")


@query("t4_first_seen")
def t4(spark, sf):
    base = work_path(spark, "t4")
    for frame in _drop_frames(spark, sf):
        frame.write.mode("append").parquet(f"{base}/inbox")
        dated = drops.watch_parquet(spark, f"{base}/inbox", DROP_SCHEMA).selectExpr(
            "*", "timestamp_seconds(drop_no * 86400L) AS seen_at"
        )
        stream = drops.first_seen(dated, ["citizen_id"], "seen_at", "90 days")
        drops.append_to(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("citizen_id", "name", "drop_no")


@query("t4_first_settled")
def t4_settled(spark, sf):
    """Every record twice in a drop, in several files: the first of its drop wins, wherever it lies."""
    base = work_path(spark, "t4")
    for n, frame in enumerate(_drop_frames(spark, sf)):
        twice = frame.selectExpr("*", "explode(array(2, 1)) AS seq").withColumn("name", F.expr("name || ' ' || CAST(seq AS STRING)"))
        twice.repartition(3 + n).write.mode("append").parquet(f"{base}/inbox")
        dated = drops.watch_parquet(spark, f"{base}/inbox", DROP_SCHEMA + ", seq int").selectExpr(
            "*", "timestamp_seconds(drop_no * 86400L) AS seen_at"
        )
        stream = drops.first_settled(dated, ["citizen_id"], ["drop_no", "seq"], "seen_at", "90 days")
        drops.append_to(stream, f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("citizen_id", "name", "drop_no", "seq")
