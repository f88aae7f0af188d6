"""Queries: sources and sinks, staging, reshape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions import columns as fn
from sensorjobs.operators import gold, staging
from sensorjobs.plans import base
from sensorjobs.plans.marts import FEATURES, feature_columns
from sensorjobs.plans.base import FACT, H, M, query, r, rd, scratch, stamp, ts
from sensorjobs.sources import io, versioned

NAMES = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")


@query("read_raw_tables", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in NAMES))
def read_raw_tables(spark: SparkSession, d: str) -> DataFrame:
    tables = io.read_raw_tables(spark, d, NAMES)
    counts = {n: t.agg(F.count(F.lit(1)).alias("n_rows")) for n, t in tables.items()}
    return staging.union_tagged(counts, "table_name")


@query("read_seed", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier UNION ALL SELECT NULL, 'header only', count(*), NULL FROM supplier WHERE false")
def read_seed(spark: SparkSession, d: str) -> DataFrame:
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    full, empty = scratch(spark, "seed"), scratch(spark, "seed")
    rows = views.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    rows.write.csv(full, header=True)
    rows.filter(F.lit(False)).write.csv(empty, header=True)
    none = io.read_seed(spark, empty, schema).agg(F.count(F.lit(1)).alias("n"))
    end = none.select(F.lit(None).cast("bigint").alias("s_suppkey"), F.lit("header only").alias("s_name"), F.col("n").alias("s_nationkey"), F.lit(None).cast("double").alias("s_acctbal"))
    return io.read_seed(spark, full, schema).withColumn("s_nationkey", F.col("s_nationkey").cast("bigint")).unionByName(end)




@query("read_features_csv", f"WITH {base.FEAT} SELECT station_id, {ts('hr')} AS date_utc, {FEATURES} FROM fe")
def read_features_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "features")
    rows = base.feature_rows(spark, d).withColumn("scenario", F.lit("all"))
    rows.select("station_id", "date_utc", "scenario", *io.FEATURE_COLUMNS).write.csv(path, header=True, timestampFormat="yyyy-MM-dd'T'HH:mm:ssXXX")
    got = io.read_features_csv(spark, path)
    return feature_columns(got)


@query("table_or_seed", "SELECT n_nationkey, n_name FROM nation")
def table_or_seed(spark: SparkSession, d: str) -> DataFrame:
    return io.table_or_seed(spark, "external_calibration_factors", views.table(spark, d, "nation").select("n_nationkey", "n_name"))


@query("incremental_read", f"WITH {M}, w AS (SELECT max(ext) AS x FROM m WHERE ext < TIMESTAMP '2024-01-15') SELECT event_id AS source_row_id, station_code, {ts('ext')} AS extracted_at FROM m WHERE ext >= (SELECT coalesce(x, TIMESTAMP '1970-01-01') FROM w)")
def incremental_read(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d)
    old = rows.filter(F.col("extracted_at") < F.lit("2024-01-15").cast("timestamp"))
    return io.incremental_read(rows, old).select("source_row_id", "station_code", stamp("extracted_at").alias("extracted_at"))


@query("incremental_read_by_source", f"WITH {M}, w AS (SELECT station_code sc, max(ext) AS x FROM m WHERE ext < TIMESTAMP '2024-01-10' + (ascii(right(station_code, 1)) - 48) * INTERVAL 1 DAY GROUP BY 1) SELECT event_id AS source_row_id, station_code FROM m LEFT JOIN w ON sc = station_code WHERE x IS NULL OR ext >= x")
def incremental_read_by_source(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d)
    last = F.expr("timestamp'2024-01-10' + make_dt_interval(cast(right(station_code, 1) as int))")
    old = rows.filter(F.col("extracted_at") < last)
    return io.incremental_read(rows, old, by="station_code").select("source_row_id", "station_code")


@query("lookback_read", f"WITH {H} SELECT station_code, variable_code, {ts('hr')} AS hour FROM h WHERE hr >= (SELECT max(hr) FROM h WHERE hr < TIMESTAMP '2024-01-20 06:00:00') - INTERVAL 2 DAY")
def lookback_read(spark: SparkSession, d: str) -> DataFrame:
    rows = base.hourly(spark, d)
    old = rows.filter(F.col("hour") < F.lit("2024-01-20 06:00:00").cast("timestamp"))
    return io.lookback_read(rows, old, "hour").select("station_code", "variable_code", stamp("hour").alias("hour"))


def _orders(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Target and batch: finished orders are new, open ones only known, the others in both."""
    o = views.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return o.filter("o_orderstatus <> 'F'"), o.filter("o_orderstatus <> 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2).withColumn("o_orderstatus", F.lit("N"))


@query("upsert_by_key", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN 'N' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN 2 ELSE 1 END * o_totalprice AS o_totalprice FROM orders")
def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    return io.upsert_by_key(*_orders(spark, d), ["o_orderkey"])


@query("upsert_keep_columns", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'N' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus <> 'O' THEN 2 ELSE 1 END * o_totalprice AS o_totalprice FROM orders")
def upsert_keep_columns(spark: SparkSession, d: str) -> DataFrame:
    return io.upsert_keep_columns(*_orders(spark, d), ["o_orderkey"], ["o_totalprice"])


@query("insert_missing", "SELECT o_orderkey, 'N' AS o_orderstatus, 2 * o_totalprice AS o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def insert_missing(spark: SparkSession, d: str) -> DataFrame:
    return io.insert_missing(*_orders(spark, d), "o_orderkey")


@query("full_rebuild", f"WITH {H} SELECT station_code, variable_code, {ts('hr')} AS hour, {rd('a')} AS value_avg FROM h")
def full_rebuild(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "rebuild")
    rows = base.hourly(spark, d).withColumn("day", F.to_date("hour"))
    io.full_rebuild(rows.withColumn("value_avg", F.lit(-1.0)).filter("variable_code = 'hum'"), path, ["day"])
    io.full_rebuild(rows, path, ["day"])
    return io.read_table(spark, path).select("station_code", "variable_code", stamp("hour").alias("hour"), r("value_avg").alias("value_avg"))


@query("write_partitions", f"WITH {H} SELECT station_code, variable_code, {ts('hr')} AS hour, {rd('a')} + CASE WHEN hr >= TIMESTAMP '2024-01-20' THEN 1 ELSE 0 END AS value_avg FROM h")
def write_partitions(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "partitions")
    rows = base.hourly(spark, d).select("station_code", "variable_code", "hour", r("value_avg").alias("value_avg"), F.to_date("hour").alias("day"))
    io.full_rebuild(rows, path, ["day"])
    io.write_partitions(rows.filter("hour >= timestamp'2024-01-20'").withColumn("value_avg", F.col("value_avg") + 1), path)
    return io.read_table(spark, path).select("station_code", "variable_code", stamp("hour").alias("hour"), "value_avg")


@query("merge_into", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS o_month, CASE WHEN o_orderdate >= TIMESTAMP '1997-06-01' AND o_orderdate < TIMESTAMP '1997-09-01' AND o_orderstatus <> 'O' THEN 2 ELSE 1 END * o_totalprice AS o_totalprice FROM orders")
def merge_into(spark: SparkSession, d: str) -> DataFrame:
    """Orders stored by month; a batch changes finished orders of a summer and adds those that were missing in it."""
    path = scratch(spark, "merge")
    rows = views.table(spark, d, "orders").withColumn("o_month", F.trunc("o_orderdate", "month"))
    summer = (F.col("o_orderdate") >= F.lit("1997-06-01").cast("timestamp")) & (F.col("o_orderdate") < F.lit("1997-09-01").cast("timestamp"))
    done = summer & (F.col("o_orderstatus") != "O")
    columns = ["o_orderkey", "o_totalprice", "o_month"]
    io.full_rebuild(rows.filter(~(done & (F.col("o_orderstatus") == "P"))).select(*columns), path, ["o_month"])
    io.merge_into(path, rows.filter(done).withColumn("o_totalprice", F.col("o_totalprice") * 2).select(*columns), ["o_orderkey"])
    return io.read_table(spark, path).select(*columns)


@query("read_since", f"WITH {M}, w AS (SELECT max(ext) AS x FROM m WHERE ext < TIMESTAMP '2024-01-15') SELECT event_id AS source_row_id, station_code, {ts('ext')} AS extracted_at FROM m WHERE ext >= (SELECT coalesce(x, TIMESTAMP '1970-01-01') FROM w)")
def read_since(spark: SparkSession, d: str) -> DataFrame:
    """The watermark is published, loaded by another session, and prunes the days of extraction."""
    path, state = scratch(spark, "raw"), scratch(spark, "marks")
    rows = views.measurements(spark, d)
    rows.withColumn("extracted_day", F.to_date("extracted_at")).write.partitionBy("extracted_day").parquet(path)
    versioned.publish(spark, state, {"marks": {"net": io.newest(rows.filter(F.col("extracted_at") < F.lit("2024-01-15").cast("timestamp")))}})
    mark = versioned.load(spark.newSession(), state)["marks"]["net"]
    return io.read_since(spark.read.parquet(path), mark).select("source_row_id", "station_code", stamp("extracted_at").alias("extracted_at"))


@query("payload_store", "SELECT 'supplier' AS data_source_name, s_suppkey AS source_row_id, CAST(to_json({'s_suppkey': s_suppkey, 's_name': s_name, 's_nationkey': s_nationkey, 'note': CASE WHEN s_suppkey % 2 = 0 THEN 'even' END}) AS VARCHAR) AS raw_payload FROM supplier")
def payload_store(spark: SparkSession, d: str) -> DataFrame:
    raw = views.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey", F.when(F.col("s_suppkey") % 2 == 0, F.lit("even")).alias("note"))
    out = io.payloads(raw.unionByName(raw), "supplier", "s_suppkey", "s_suppkey")
    return out.select("data_source_name", "source_row_id", "raw_payload")


@query("write_json_results", "SELECT n_regionkey, count(*) AS n, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def write_json_results(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "results")
    rows = views.table(spark, d, "nation").groupBy("n_regionkey").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("n_name")), ",").alias("names"))
    io.write_json_results(path, regions=rows)
    return spark.read.json(f"{path}/regions", schema="n_regionkey int, n bigint, names string")


# --- staging ---------------------------------------------------------------------------------------


def _values(names) -> list:
    """All values of a staged source as rounded numbers."""
    return [r(F.col(c).cast("double")).alias(c) for c in names]


def _cursor_columns(events: DataFrame) -> list[Column]:
    """Events as messages of a cursor source; every eleventh message has an unreadable date."""
    value = lambda t: F.when(F.col("event_type") == t, F.col("value"))
    return [
        F.concat(F.lit("raw-"), F.col("event_id").cast("string")).alias("_airbyte_raw_id"), F.date_trunc("day", "ts").alias("_airbyte_extracted_at"),
        F.col("event_id").alias("ID"), F.when(F.col("event_id") % 11 == 0, F.lit("31-02-2024")).otherwise(F.date_format("ts", "dd-MM-yyyy")).alias("FECHA"), F.date_format("ts", "HH:mm").alias("HORA"),
        value("click").alias("MP1"), value("view").alias("MP2_5"), value("purchase").alias("MP10"), value("signup").alias("TEMPERATURA"), value("error").alias("HUMEDAD"),
        F.lit(None).cast("double").alias("PRESION"), F.lit(None).cast("double").alias("BATERIA"),
    ]


def raw_cursor(spark: SparkSession, d: str) -> DataFrame:
    """All messages of the cursor source, with the name of their station's table."""
    events = views.table(spark, d, "events")
    name = F.concat(F.lit("FIUNA_Estacion"), (F.col("user_id") % 10).cast("string"))
    return events.select(name.alias("_source_table"), *_cursor_columns(events))


def cursor_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The same messages as ten written tables, one a station."""
    path = scratch(spark, "raw")
    views.table(spark, d, "events").withColumn("k", F.col("user_id") % 10).write.partitionBy("k").parquet(path)
    tables = {}
    for k in range(10):
        own = spark.read.parquet(path).filter(F.col("k") == k)
        tables[f"FIUNA_Estacion{k}"] = own.select(*_cursor_columns(own))
    return tables


RAW = M + ", x AS (SELECT *, CASE WHEN event_id % 11 <> 0 THEN date_trunc('minute', t) + INTERVAL 3 HOUR END AS at FROM m)".replace(" AS at ", " AS tm ")


@query("union_tagged", "SELECT 'FIUNA_Estacion' || (user_id % 10) AS source_table, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def union_tagged(spark: SparkSession, d: str) -> DataFrame:
    return staging.union_tagged(cursor_tables(spark, d)).groupBy(F.col("_source_table").alias("source_table")).agg(F.count(F.lit(1)).alias("n"), F.sum("ID").alias("ids"))


@query("stage_cursor_source", f"WITH {RAW} SELECT 'raw-' || event_id AS source_row_id, 'fiuna_' || right(station_code, 1) AS station_code, event_id AS cursor_id, CASE WHEN event_id % 11 = 0 THEN '31-02-2024' ELSE strftime(t, '%d-%m-%Y') END || ' ' || strftime(t, '%H:%M') AS measured_at_raw, {ts('tm')} AS measured_at_parsed, tm IS NOT NULL AS is_measured_at_valid, " + ", ".join(f"CASE WHEN variable_code = '{c}' THEN {rd('v')} END AS {c}" for c in staging.CURSOR_VARIABLES) + " FROM x")
def stage_cursor_source(spark: SparkSession, d: str) -> DataFrame:
    out = staging.stage_cursor_source(raw_cursor(spark, d))
    return out.select("source_row_id", "station_code", "cursor_id", "measured_at_raw", stamp("measured_at_parsed").alias("measured_at_parsed"), "is_measured_at_valid", *_values(staging.CURSOR_VARIABLES))


def raw_geo(spark: SparkSession, d: str) -> DataFrame:
    """Purchases as a geolocated source."""
    e = views.table(spark, d, "events").filter("event_type = 'purchase'")
    k = F.col("event_id")
    return e.select(
        F.concat(F.lit("geo-"), k.cast("string")).alias("_airbyte_raw_id"), F.date_trunc("day", "ts").alias("_airbyte_extracted_at"), (F.col("user_id") % 10).cast("string").alias("source"),
        F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit("2001-01-01 00:00:00")).otherwise(stamp("ts")).alias("recorded"),
        F.col("value").alias("pm1dot0"), (F.col("value") * 2).alias("pm2dot5"), F.lit(None).cast("double").alias("pm10"),
        F.when(k % 3 != 0, F.lit(-25.0) + (F.col("user_id") % 10)).alias("latitude"), F.lit(-57.0).alias("longitude"), F.when(k % 2 == 0, F.lit("")).otherwise(F.lit("roof")).alias("description"),
    )


GEO = M + ", g AS (SELECT *, CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN TIMESTAMP '2001-01-01' ELSE date_trunc('second', t) END AS tm, CASE WHEN event_id % 3 <> 0 THEN -25.0::DOUBLE + CAST(right(station_code, 1) AS INTEGER) END AS lat, CASE WHEN event_id % 2 <> 0 THEN 'roof' END AS des FROM m WHERE variable_code = 'pm10')"


@query("stage_geo_source", f"WITH {GEO} SELECT 'geo-' || event_id AS source_row_id, 'airelibre_' || right(station_code, 1) AS station_code, {ts('tm')} AS measured_at_parsed, coalesce(tm >= TIMESTAMP '2018-01-01', false) AS is_measured_at_valid, {rd('v')} AS pm1, {rd('v * 2')} AS pm25, NULL::DOUBLE AS pm10, lat AS latitude, -57.0::DOUBLE AS longitude, des AS description, NULL::BIGINT AS cursor_id FROM g")
def stage_geo_source(spark: SparkSession, d: str) -> DataFrame:
    out = staging.stage_geo_source(raw_geo(spark, d))
    return out.select("source_row_id", "station_code", stamp("measured_at_parsed").alias("measured_at_parsed"), "is_measured_at_valid", *_values(staging.GEO_VARIABLES), "latitude", "longitude", "description", "cursor_id")


def raw_weather(spark: SparkSession, d: str) -> DataFrame:
    e = views.table(spark, d, "events").filter("event_type = 'signup'")
    none = F.lit(None).cast("double")
    return e.select(
        F.concat(F.lit("met-"), F.col("event_id").cast("string")).alias("_airbyte_raw_id"), F.date_trunc("day", "ts").alias("_airbyte_extracted_at"), F.when(F.col("event_id") % 4 != 0, F.col("ts")).alias("time"),
        F.col("value").alias("temp"), F.when(F.col("event_id") % 3 == 0, F.col("value") / 5).alias("rhum"), none.alias("pres"), none.alias("prcp"), none.alias("wspd"), none.alias("wdir"), none.alias("dwpt"), none.alias("coco"),
    )


@query("stage_weather_source", f"WITH {M} SELECT 'met-' || event_id AS source_row_id, 'met_1' AS station_code, CASE WHEN event_id % 4 <> 0 THEN {ts('t')} END AS measured_at_parsed, CASE WHEN event_id % 4 <> 0 THEN t >= TIMESTAMP '2018-01-01' END AS is_measured_at_valid, {rd('v')} AS temperature_c, CASE WHEN event_id % 3 = 0 THEN {rd('v / 5')} END AS hum, " + ", ".join(f"NULL::DOUBLE AS {c}" for c in list(staging.WEATHER_VARIABLES)[2:]) + " FROM m WHERE variable_code = 'temperature_c'")
def stage_weather_source(spark: SparkSession, d: str) -> DataFrame:
    out = staging.stage_weather_source(raw_weather(spark, d), "met_1")
    return out.select("source_row_id", "station_code", stamp("measured_at_parsed").alias("measured_at_parsed"), "is_measured_at_valid", *_values(staging.WEATHER_VARIABLES))


@query("parse_local_timestamp", f"WITH {M} SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN {ts(chr(100) + 'ate_trunc(' + chr(39) + 'minute' + chr(39) + ', t) + INTERVAL 3 HOUR')} END AS measured_at FROM m")
def parse_local_timestamp(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    date = F.when(k % 11 == 0, F.lit("no date")).when(k % 2 == 0, F.date_format("ts", "d-M-yyyy")).otherwise(F.date_format("ts", "dd-MM-yyyy"))
    time = F.when(k % 3 == 0, F.date_format("ts", "H:mm")).otherwise(F.date_format("ts", "HH:mm"))
    return views.table(spark, d, "events").select("event_id", stamp(fn.parse_local_timestamp(date, time)).alias("measured_at"))


@query("validity_flag", "SELECT event_id, event_id % 5 <> 0 AND ts >= TIMESTAMP '2024-01-10' AS is_valid FROM events")
def validity_flag(spark: SparkSession, d: str) -> DataFrame:
    at = F.when(F.col("event_id") % 5 != 0, F.col("ts").cast("timestamp"))
    return views.table(spark, d, "events").select("event_id", fn.is_valid_time(at, "2024-01-10 00:00:00").alias("is_valid"))


@query("station_code_from_name", "SELECT DISTINCT 'fiuna_' || user_id AS station_code FROM events")
def station_code_from_name(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.lit("FIUNA_Estacion"), F.col("user_id").cast("string"))
    return views.table(spark, d, "events").select(fn.station_code_from_name(name).alias("station_code")).distinct()


@query("blank_to_null", "SELECT o_orderkey, nullif(trim(CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderpriority END), '') AS priority FROM orders")
def blank_to_null(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("o_orderkey") % 3 == 0, F.lit("")).otherwise(F.col("o_orderpriority"))
    return views.table(spark, d, "orders").select("o_orderkey", fn.blank_to_null(F.trim(text)).alias("priority"))


@query("source_kind_filter", "SELECT 'st_' || n_nationkey AS code, n_nationkey % 3 = 2 AS is_weather FROM nation")
def source_kind_filter(spark: SparkSession, d: str) -> DataFrame:
    st = base.stations(spark, d)
    parts = [staging.source_kind_filter(st, w).select("code", F.lit(w).alias("is_weather")) for w in (True, False)]
    return parts[0].unionByName(parts[1])


@query("variable_subset_filter", f"WITH {M} SELECT station_code, variable_code, count(*) AS n FROM m WHERE variable_code IN ('pm1', 'hum') GROUP BY ALL")
def variable_subset_filter(spark: SparkSession, d: str) -> DataFrame:
    rows = staging.variable_subset_filter(views.measurements(spark, d), ("pm1", "hum", "coco"))
    return rows.groupBy("station_code", "variable_code").agg(F.count(F.lit(1)).alias("n"))


# --- reshape ---------------------------------------------------------------------------------------

LINES = staging.Source("lineitem", {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}, station_code="l_returnflag", measured_at="l_shipdate", row_id="l_orderkey", extracted_at="l_shipdate", is_valid=None)


@query("unpivot_measurements", "SELECT l_orderkey AS source_row_id, l_linenumber, l_returnflag AS station_code, v.variable_code, v.value AS value_parsed FROM (SELECT *, unnest([{'variable_code': 'quantity', 'value': l_quantity}, {'variable_code': 'price', 'value': l_extendedprice}, {'variable_code': 'discount', 'value': CASE WHEN l_linenumber <> 2 THEN l_discount END}, {'variable_code': 'tax', 'value': l_tax}]) AS v FROM lineitem) WHERE v.value IS NOT NULL")
def unpivot_measurements(spark: SparkSession, d: str) -> DataFrame:
    wide = views.table(spark, d, "lineitem").withColumn("l_discount", F.when(F.col("l_linenumber") != 2, F.col("l_discount")))
    wide = wide.withColumn("l_orderkey", F.struct("l_orderkey", "l_linenumber"))
    out = staging.unpivot_measurements(wide, LINES)
    return out.select(F.col("source_row_id.l_orderkey").alias("source_row_id"), F.col("source_row_id.l_linenumber").alias("l_linenumber"), "station_code", "variable_code", "value_parsed")


@query("long_union", f"WITH {GEO} SELECT 'cursor' AS data_source_name, variable_code, count(*) AS n, {rd('sum(v)', 2)} AS total FROM m GROUP BY ALL UNION ALL SELECT 'geo', 'pm1', count(*), {rd('sum(v)', 2)} FROM g UNION ALL SELECT 'geo', 'pm25', count(*), {rd('sum(v * 2)', 2)} FROM g UNION ALL SELECT 'weather', 'temperature_c', count(*), {rd('sum(v)', 2)} FROM m WHERE variable_code = 'temperature_c' UNION ALL SELECT 'weather', 'hum', count(*), {rd('sum(v / 5)', 2)} FROM m WHERE variable_code = 'temperature_c' AND event_id % 3 = 0")
def long_union(spark: SparkSession, d: str) -> DataFrame:
    staged = {"cursor": staging.stage_cursor_source(raw_cursor(spark, d)), "geo": staging.stage_geo_source(raw_geo(spark, d)), "weather": staging.stage_weather_source(raw_weather(spark, d), "met_1")}
    own = lambda names: {v: v for v in names}
    registry = [staging.Source("cursor", own(staging.CURSOR_VARIABLES), cursor_id="cursor_id"), staging.Source("geo", own(staging.GEO_VARIABLES)), staging.Source("weather", own(staging.WEATHER_VARIABLES))]
    rows = staging.long_union(staged, registry)
    return rows.groupBy("data_source_name", "variable_code").agg(F.count(F.lit(1)).alias("n"), r(F.sum("value_parsed"), 2).alias("total"))


@query("pivot_wide", f"WITH {FACT} SELECT station_code, {ts('st')} AS second, " + ", ".join(f"max(CASE WHEN variable_code = '{c}' THEN v END) AS {c}" for c in views.TYPES.values()) + " FROM f GROUP BY 1, 2")
def pivot_wide(spark: SparkSession, d: str) -> DataFrame:
    rows = base.facts(spark, d).withColumn("second", stamp("timestamp"))
    return staging.pivot_wide(rows, ["station_code", "second"], list(views.TYPES.values()))


@query("pivot_hourly", f"WITH {M}, hs AS (SELECT station_code, variable_code, k % 2 AS source, date_trunc('hour', t) AS hr, avg(v) AS a FROM m GROUP BY ALL), w AS (SELECT station_code, hr, avg(a) FILTER (variable_code = 'pm1') AS pm1, avg(a) FILTER (variable_code = 'pm25') AS pm2_5, avg(a) FILTER (variable_code = 'pm10') AS pm10, avg(a) FILTER (variable_code = 'temperature_c') AS temperature_c, avg(a) FILTER (variable_code = 'hum') AS humidity FROM hs GROUP BY ALL) SELECT station_code, {ts('hr')} AS hour, {rd('pm1')} AS pm1, {rd('pm2_5')} AS pm2_5, {rd('pm10')} AS pm10, {rd('temperature_c')} AS temperature_c, {rd('humidity')} AS humidity, NULL::DOUBLE AS wind_dir FROM w")
def pivot_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Two sources a station: each counts once in an hour, whatever its number of readings."""
    rows = views.measurements(spark, d).withColumn("data_source_name", F.concat(F.lit("net-"), (F.col("k") % 2).cast("string")))
    wide = staging.pivot_hourly(gold.hourly_avg(rows, "measured_at_parsed"), gold.HOURLY_NAMES)
    return wide.select("station_code", stamp("hour").alias("hour"), *[r(c).alias(c) for c in ("pm1", "pm2_5", "pm10", "temperature_c", "humidity")], F.col("wind_dir"))
