"""Queries: time repair, validation, facts, keys, dimensions, joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions import columns as fn
from sensorjobs.operators import dims, gold, silver
from sensorjobs.plans import base
from sensorjobs.plans.base import FA, FACT, IDM, M, ST, S, V, W, query, r, rd, sk, stamp, ts
from sensorjobs.plans.ingest import GEO, raw_geo
from sensorjobs.operators import staging

TIMES = f"event_id AS source_row_id, station_code, {ts('st')} AS measured_at_silver"


@query("running_last_valid", f"WITH {S} SELECT event_id AS source_row_id, station_code, {ts('lt')} AS last_valid_ts, lc AS last_valid_cursor FROM s")
def running_last_valid(spark: SparkSession, d: str) -> DataFrame:
    return silver.running_last_valid(views.measurements(spark, d)).select("source_row_id", "station_code", stamp("last_valid_ts").alias("last_valid_ts"), "last_valid_cursor")


@query("running_last_valid_blocks", f"WITH {S} SELECT event_id AS source_row_id, station_code, {ts('lt')} AS last_valid_ts, lc AS last_valid_cursor FROM s")
def running_last_valid_blocks(spark: SparkSession, d: str) -> DataFrame:
    return silver.running_last_valid_blocks(views.measurements(spark, d), 1000).select("source_row_id", "station_code", stamp("last_valid_ts").alias("last_valid_ts"), "last_valid_cursor")


@query("impute_timestamps", f"WITH {S} SELECT {TIMES}, NOT ok AND lt IS NOT NULL AS is_time_imputed, CASE WHEN ok THEN NULL WHEN lt IS NOT NULL THEN 'fiuna_id_5min' ELSE 'unfixable_no_anchor' END AS imputation_method FROM s")
def impute_timestamps(spark: SparkSession, d: str) -> DataFrame:
    return _times(silver.repair(views.measurements(spark, d)))


def _times(df: DataFrame) -> DataFrame:
    return df.select("source_row_id", "station_code", stamp("measured_at_silver").alias("measured_at_silver"), "is_time_imputed", "imputation_method")


@query("passthrough_timestamps", f"WITH {M} SELECT event_id AS source_row_id, station_code, CASE WHEN ok THEN {ts('t')} END AS measured_at_silver, false AS is_time_imputed, CASE WHEN NOT ok THEN 'invalid_timestamp_no_imputation' END AS imputation_method FROM m")
def passthrough_timestamps(spark: SparkSession, d: str) -> DataFrame:
    return _times(silver.repair(views.measurements(spark, d).withColumn("cursor_id", F.lit(None).cast("bigint"))))


@query("carry_anchor", f"WITH {S} SELECT {TIMES}, NOT ok AND lt IS NOT NULL AS is_time_imputed, CASE WHEN ok THEN NULL WHEN lt IS NOT NULL THEN 'fiuna_id_5min' ELSE 'unfixable_no_anchor' END AS imputation_method FROM s WHERE ext >= TIMESTAMP '2024-01-15'")
def carry_anchor(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d)
    new = F.col("extracted_at") >= F.lit("2024-01-15").cast("timestamp")
    return _times(silver.carry_anchor(rows.filter(new), silver.anchors(rows.filter(~new))))


@query("validate_values", f"WITH {V} SELECT event_id AS source_row_id, variable_code, fine AS is_value_valid, CASE WHEN fine THEN v END AS value_silver FROM va")
def validate_values(spark: SparkSession, d: str) -> DataFrame:
    return base.validated(spark, d).select("source_row_id", "variable_code", "is_value_valid", "value_silver")


def named_dims(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stations, variables and sources as dimensions."""
    stations = base.stations(spark, d).select("id", "code")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    variables = dims.dim_build(views.rules(spark).select(F.col("variable_code").alias("code")), ["code"], now)
    sources = dims.dim_build(views.measurements(spark, d).select(F.col("data_source_name").alias("name")).distinct(), ["name"], now)
    return stations, variables, sources


def streams(spark: SparkSession, d: str) -> DataFrame:
    return dims.stream_dim(dims.stream_candidates(views.measurements(spark, d)), *named_dims(spark, d))


KEY = "station_code || '_' || variable_code || '_net'"


@query("silver_fact", f"WITH {V} SELECT event_id AS source_row_id, {sk(KEY)} AS stream_id, {ts('st')} AS measured_at, v AS value_parsed, {ts('ext')} AS ingested_at FROM va WHERE fine")
def silver_fact(spark: SparkSession, d: str) -> DataFrame:
    out = silver.silver_fact(base.validated(spark, d), streams(spark, d))
    return out.select("source_row_id", "stream_id", stamp("timestamp").alias("measured_at"), "value_parsed", stamp("ingested_at").alias("ingested_at"))


@query("dedupe_latest", f"WITH {M} SELECT station_code, variable_code, {ts('hr')} AS hour, event_id AS source_row_id, v AS value_parsed FROM (SELECT *, date_trunc('hour', t) AS hr FROM m) QUALIFY row_number() OVER (PARTITION BY station_code, variable_code, hr ORDER BY ext DESC, event_id DESC) = 1")
def dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d).select("station_code", "variable_code", F.date_trunc("hour", "measured_at_parsed").alias("hour"), "source_row_id", "value_parsed", "extracted_at")
    out = silver.dedupe_latest(rows, ["station_code", "variable_code", "hour"], ["extracted_at", "source_row_id"])
    return out.select("station_code", "variable_code", stamp("hour").alias("hour"), "source_row_id", "value_parsed")


# --- keys and dimensions ---------------------------------------------------------------------------


@query("surrogate_key", "SELECT o_orderkey, " + sk("o_orderstatus || '-' || CASE WHEN o_orderkey % 5 = 0 THEN '_dbt_utils_surrogate_key_null_' ELSE CAST(o_custkey AS VARCHAR) END") + " AS id FROM orders")
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    cust = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey"))
    return views.table(spark, d, "orders").select("o_orderkey", fn.surrogate_key(F.col("o_orderstatus"), cust).alias("id"))


@query("dim_build", f"SELECT {sk('c_name')} AS id, c_name, c_mktsegment, '2024-02-01 00:00:00' AS created_at, '2024-02-01 00:00:00' AS updated_at FROM customer")
def dim_build(spark: SparkSession, d: str) -> DataFrame:
    seed = views.table(spark, d, "customer").select("c_name", "c_mktsegment")
    return dims.dim_build(seed, ["c_name"], F.lit("2024-02-01").cast("timestamp")).select("id", "c_name", "c_mktsegment", stamp("created_at").alias("created_at"), stamp("updated_at").alias("updated_at"))


@query("dim_build_with_parent", f"SELECT {sk('s_name')} AS id, s_name, {sk('n_name')} AS parent_id FROM supplier JOIN nation ON s_nationkey = n_nationkey AND n_nationkey < 20")
def dim_build_with_parent(spark: SparkSession, d: str) -> DataFrame:
    nations = dims.dim_build(views.table(spark, d, "nation").filter("n_nationkey < 20").select("n_nationkey", "n_name"), ["n_name"], F.current_timestamp())
    out = dims.dim_build_with_parent(views.table(spark, d, "supplier").select("s_name", "s_nationkey"), nations, "s_nationkey", "n_nationkey", "id", ["s_name"], F.current_timestamp())
    return out.select("id", "s_name", "parent_id")


ORDER_KEYS = {"a": sk("CAST(o_orderkey AS VARCHAR)"), "b": sk("CAST(p_partkey AS VARCHAR)")}


@query("bridge_build", f"WITH x AS (SELECT {ORDER_KEYS['a']} AS order_id, {ORDER_KEYS['b']} AS part_id FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'P' JOIN part ON p_partkey = l_partkey) SELECT {sk('order_id || ' + chr(39) + '-' + chr(39) + ' || part_id')} AS id, order_id, part_id FROM x")
def bridge_build(spark: SparkSession, d: str) -> DataFrame:
    key = lambda t, k: views.table(spark, d, t).select(k, fn.surrogate_key(F.col(k)).alias("id"))
    pairs = views.table(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct()
    orders = views.table(spark, d, "orders").filter("o_orderstatus <> 'P'").select("o_orderkey", fn.surrogate_key(F.col("o_orderkey")).alias("id"))
    return dims.bridge_build(pairs, orders, "l_orderkey", "o_orderkey", key("part", "p_partkey"), "l_partkey", "p_partkey", ("order_id", "part_id"))


@query("stream_candidates", f"WITH {M} SELECT station_code, variable_code, {ts('max(ext)')} AS last_extracted_at, {KEY} AS station_variable_source, station_code || ' / ' || variable_code || ' / net' AS stream_name FROM m GROUP BY station_code, variable_code")
def stream_candidates(spark: SparkSession, d: str) -> DataFrame:
    out = dims.stream_candidates(views.measurements(spark, d))
    return out.select("station_code", "variable_code", stamp("last_extracted_at").alias("last_extracted_at"), "station_variable_source", "stream_name")


@query("stream_dim", f"WITH {M}, {ST} SELECT {sk(KEY)} AS stream_id, station_code, variable_code, st.id AS station_id, {sk('variable_code')} AS variable_id, {sk(chr(39) + 'net' + chr(39))} AS data_source_id FROM (SELECT DISTINCT station_code, variable_code FROM m) JOIN st ON st.code = station_code WHERE station_code <> 'st_4'")
def stream_dim(spark: SparkSession, d: str) -> DataFrame:
    candidates = dims.stream_candidates(views.measurements(spark, d))
    known = candidates.filter("station_code = 'st_4'")
    return dims.stream_dim(candidates, *named_dims(spark, d), existing=known).select("stream_id", "station_code", "variable_code", "station_id", "variable_id", "data_source_id")


@query("station_candidates", f"WITH {GEO}, {ST}, k AS (SELECT code, name, lat, lon FROM st), a AS (SELECT 'airelibre_' || right(station_code, 1) AS code, coalesce(des, 'airelibre_' || right(station_code, 1)) AS name, lat, -57.0::DOUBLE AS lon FROM g WHERE tm >= TIMESTAMP '2018-01-01' AND lat IS NOT NULL QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY tm DESC, 'geo-' || event_id DESC) = 1) SELECT code, name, {rd('lat')} AS latitude, {rd('lon')} AS longitude FROM k UNION ALL SELECT code, name, {rd('lat')}, {rd('lon')} FROM a")
def station_candidates(spark: SparkSession, d: str) -> DataFrame:
    out = dims.station_candidates(base.stations(spark, d), staging.stage_geo_source(raw_geo(spark, d)))
    return out.select("code", "name", r("latitude").alias("latitude"), r("longitude").alias("longitude"))


@query("latest_per_key", f"WITH {M} SELECT station_code, {ts('t')} AS measured_at, event_id AS source_row_id FROM m WHERE ok QUALIFY row_number() OVER (PARTITION BY station_code ORDER BY t DESC, event_id DESC) = 1")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d).select("station_code", "measured_at_parsed", "source_row_id", "is_measured_at_valid")
    return dims.latest_per_key(rows, "station_code", "measured_at_parsed", "source_row_id", F.col("is_measured_at_valid")).select("station_code", stamp("measured_at_parsed").alias("measured_at"), "source_row_id")


@query("project_scope", f"WITH {M}, {ST} SELECT DISTINCT st.id AS station_id, station_code FROM m JOIN st ON st.code = station_code")
def project_scope(spark: SparkSession, d: str) -> DataFrame:
    all_streams = streams(spark, d)
    ids = all_streams.select("data_source_id").distinct()
    bridge = ids.select(F.lit(1).cast("bigint").alias("project_id"), "data_source_id").unionByName(ids.select(F.lit(2).cast("bigint").alias("project_id"), (F.col("data_source_id") + 1).alias("data_source_id")))
    projects = spark.createDataFrame([(1, "main"), (2, "other")], "id bigint, code string")
    return dims.project_scope(projects, bridge, all_streams, "main")[1]


@query("dense_station_ids", f"WITH {ST}, {IDM} SELECT pid AS project_station_id, id AS core_station_id, code FROM idm")
def dense_station_ids(spark: SparkSession, d: str) -> DataFrame:
    return base.station_ids(spark, d).withColumn("project_station_id", F.col("project_station_id").cast("bigint"))


PLAIN_BOX = "concat_ws(',', CAST(CAST(round(lon - 5.0::DOUBLE / (111.0::DOUBLE * cos(radians(lat))), 6) AS DECIMAL(18,6)) AS VARCHAR), CAST(CAST(round(lat - 5.0::DOUBLE / 111.0, 6) AS DECIMAL(18,6)) AS VARCHAR), CAST(CAST(round(lon + 5.0::DOUBLE / (111.0::DOUBLE * cos(radians(lat))), 6) AS DECIMAL(18,6)) AS VARCHAR), CAST(CAST(round(lat + 5.0::DOUBLE / 111.0, 6) AS DECIMAL(18,6)) AS VARCHAR))"
BOX = f"CASE WHEN i = 5 THEN NULL ELSE {PLAIN_BOX} END"


@query("regions_seed_or_generated", f"WITH {ST} SELECT 'seeded' AS mode, 'r' || r_regionkey AS region_code, r_name AS name, '0,0,1,1' AS bbox FROM region UNION ALL SELECT 'generated', code, name, {PLAIN_BOX} FROM st")
def regions_seed_or_generated(spark: SparkSession, d: str) -> DataFrame:
    seed = views.table(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("region_code"), F.col("r_name").alias("name"), F.lit("0,0,1,1").alias("bbox"))
    st = base.stations(spark, d)
    parts = [dims.regions_seed_or_generated(s, st).select(F.lit(m).alias("mode"), "region_code", "name", "bbox") for m, s in (("seeded", seed), ("generated", seed.filter(F.lit(False))))]
    return parts[0].unionByName(parts[1])




@query("bbox_text", f"WITH {ST} SELECT code, {BOX} AS bbox FROM st")
def bbox_text(spark: SparkSession, d: str) -> DataFrame:
    return base.stations(spark, d).select("code", fn.bbox_text(F.when(F.col("code") != "st_5", F.col("latitude")), F.col("longitude")).alias("bbox"))


def region_map(spark: SparkSession, d: str) -> DataFrame:
    st = base.stations(spark, d)
    return dims.station_region_map(st, st.filter("code <> 'st_7'").select(F.col("code").alias("station_code"), "region_code"), "default")


@query("station_region_map", f"WITH {ST} SELECT code AS station_code, CASE WHEN code = 'st_7' THEN 'default' ELSE rc END AS region_code FROM st")
def station_region_map(spark: SparkSession, d: str) -> DataFrame:
    return region_map(spark, d)


@query("region_flags", f"WITH {ST} SELECT {sk('r_name')} AS id, r_name AS region_code, r_name AS name, '' AS bbox, coalesce(bool_or(src = 'Meteostat' AND i < 9), false) AS has_weather_data, coalesce(bool_or(pat AND src <> 'Meteostat' AND i > 12), false) AS has_pattern_data FROM region LEFT JOIN st ON rc = r_name GROUP BY r_name")
def region_flags(spark: SparkSession, d: str) -> DataFrame:
    st = base.stations(spark, d).withColumn("i", F.substring("code", 4, 9).cast("int"))
    regions = views.table(spark, d, "region").select(F.col("r_name").alias("region_code"), F.col("r_name").alias("name"), F.lit("").alias("bbox"))
    air = staging.source_kind_filter(st, False).filter("i > 12").select("region_code", "is_pattern_station")
    return dims.region_flags(regions, air, staging.source_kind_filter(st, True).filter("i < 9").select("region_code")).select("id", "region_code", "name", "bbox", "has_weather_data", "has_pattern_data")


@query("station_activity", f"WITH {W}, {ST}, {IDM}, la AS (SELECT station_code, max(hr) AS x FROM w GROUP BY 1) SELECT pid AS id, CASE src WHEN 'fiuna' THEN 'FIUNA: ' || name WHEN 'airelibre' THEN 'AireLibre: ' || name ELSE name END AS name, {rd('lat')} AS latitude, {rd('lon')} AS longitude, {sk('CASE WHEN st.code = ' + chr(39) + 'st_7' + chr(39) + ' THEN ' + chr(39) + 'default' + chr(39) + ' ELSE st.rc END')} AS region_id, status = 'active' AND coalesce(x >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY, false) AS is_station_on, pat AS is_pattern_station FROM st JOIN idm ON idm.id = st.id LEFT JOIN la ON la.station_code = st.code")
def station_activity(spark: SparkSession, d: str) -> DataFrame:
    st = base.stations(spark, d).drop("region_code")
    latest = gold.latest_reading(base.wide(spark, d))
    out = dims.station_activity(st, base.station_ids(spark, d), region_map(spark, d), latest, F.lit("2024-01-31").cast("timestamp"), fn.display_name(F.col("name"), F.col("properties")))
    return out.select(F.col("id").cast("bigint").alias("id"), "name", r("latitude").alias("latitude"), r("longitude").alias("longitude"), "region_id", "is_station_on", "is_pattern_station")


@query("weather_station_list", f"WITH {ST} SELECT id, code, name, {rd('lat')} AS latitude, {rd('lon')} AS longitude, {sk('rc')} AS region_id FROM st WHERE src = 'Meteostat'")
def weather_station_list(spark: SparkSession, d: str) -> DataFrame:
    st = base.stations(spark, d)
    mapped = st.select(F.col("code").alias("station_code"), "region_code")
    out = dims.weather_station_list(staging.source_kind_filter(st, True).drop("region_code"), mapped)
    return out.select("id", "code", "name", r("latitude").alias("latitude"), r("longitude").alias("longitude"), "region_id")


@query("display_name", f"WITH {ST} SELECT code, CASE src WHEN 'fiuna' THEN 'FIUNA: ' || name WHEN 'airelibre' THEN 'AireLibre: ' || name ELSE name END AS name FROM st")
def display_name(spark: SparkSession, d: str) -> DataFrame:
    return base.stations(spark, d).select("code", fn.display_name(F.col("name"), F.col("properties")).alias("name"))


# --- joins -----------------------------------------------------------------------------------------


@query("star_join", f"WITH {FACT} SELECT event_id AS source_row_id, station_code, variable_code, 'net' AS data_source_name, v AS value_parsed FROM f")
def star_join(spark: SparkSession, d: str) -> DataFrame:
    known = named_dims(spark, d)
    own = base.stored(dims.stream_dim(dims.stream_candidates(views.measurements(spark, d)), *known), "streams")
    keyed = silver.silver_fact(base.validated(spark, d), own)
    fact = silver.dedupe_latest(keyed, ["stream_id", "timestamp"], ["ingested_at", "source_row_id"])
    return gold.star_join(fact, own, *known).select("source_row_id", "station_code", "variable_code", "data_source_name", "value_parsed")


@query("feature_join", f"WITH {base.READ}{base.REG}{base.WE} SELECT station_id, {ts('rd.hr')} AS hour, {rd('pavg')} AS pm2_5_region_avg, {rd('we.wind_speed')} AS wind_speed FROM rd LEFT JOIN rg ON rg.region_id = {sk('rd.rc')} AND rg.hr = rd.hr LEFT JOIN we ON we.region_id = {sk('rd.rc')} AND we.hr = rd.hr")
def feature_join(spark: SparkSession, d: str) -> DataFrame:
    return base.feature_rows(spark, d).select(F.col("station_id").cast("bigint").alias("station_id"), stamp("date_utc").alias("hour"), r("pm2_5_region_avg").alias("pm2_5_region_avg"), r("wind_speed").alias("wind_speed"))


@query("calibration_asof", f"WITH {W}, {FA} SELECT station_code, {ts('hr')} AS hour, (SELECT arg_max(fac, s) FROM fa WHERE sc = w.station_code AND s <= w.hr AND (e IS NULL OR w.hr < e)) AS factor FROM w")
def calibration_asof(spark: SparkSession, d: str) -> DataFrame:
    return gold.calibration_asof(base.stored(base.wide(spark, d), "wide"), views.factors(spark)).select("station_code", stamp("hour").alias("hour"), "factor")


@query("nearest_station", f"WITH p AS (SELECT vec_id AS id, round(embedding[1]::DOUBLE, 6) AS lat, round(embedding[2]::DOUBLE, 6) AS lon, label FROM embeddings), s AS (SELECT 'v' || id AS code, lat AS slat, lon AS slon FROM p WHERE label < 3) SELECT p.id, arg_min(code, (power(lat - slat, 2), code)) AS nearest_code, {rd('min(power(lat - slat, 2) + power(lon - slon, 2))')} AS distance2 FROM p, s WHERE label >= 3 GROUP BY 1".replace("(power(lat - slat, 2), code)", "((lat - slat) * (lat - slat) + (lon - slon) * (lon - slon), code)"))
def nearest_station(spark: SparkSession, d: str) -> DataFrame:
    p = views.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.round(F.col("embedding")[0].cast("double"), 6).alias("lat"), F.round(F.col("embedding")[1].cast("double"), 6).alias("lon"), "label")
    s = p.filter("label < 3").select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("code"), F.col("lat").alias("slat"), F.col("lon").alias("slon"))
    out = dims.nearest_station(p.filter("label >= 3").select("id", "lat", "lon"), s)
    return out.select("id", "nearest_code", r("distance2").alias("distance2"))


@query("cross_constant", f"WITH {ST} SELECT code, 'main' AS project, (SELECT count(*) FROM region) AS n_regions FROM st")
def cross_constant(spark: SparkSession, d: str) -> DataFrame:
    one = views.table(spark, d, "region").agg(F.count(F.lit(1)).alias("n_regions")).withColumn("project", F.lit("main"))
    return base.stations(spark, d).select("code").crossJoin(one)


@query("anti_join_missing", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 2)")
def anti_join_missing(spark: SparkSession, d: str) -> DataFrame:
    lines = views.table(spark, d, "lineitem").filter("l_linenumber = 2").select(F.col("l_orderkey").alias("o_orderkey"))
    return dims.anti_join_missing(views.table(spark, d, "orders").select("o_orderkey"), lines, "o_orderkey")


