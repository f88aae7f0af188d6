"""The registry of queries, and the steps that many of them share, in Spark and in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions.columns import surrogate_key
from sensorjobs.operators import gold, silver
from sensorjobs.operators.staging import pivot_hourly
from sensorjobs.sources.io import scratch, stored  # noqa: F401  (for the queries)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and its SQL."""

    def put(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return put


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded for comparison between engines, without a negative zero.

    As the SQL does it: scaled, rounded half away from zero, scaled back. (``F.round`` rounds the decimal text of a number, which lies
    on the other side of some ties: 272.425 times 100 is less than 27242.5.)
    """
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    scale = F.lit(10.0**digits)
    y = F.abs(x) * scale
    whole = F.rint(y)
    # ``rint`` rounds ties to even.
    whole = F.when(y - whole == 0.5, whole + 1.0).otherwise(whole)
    return F.when(F.isnan(x), x).otherwise(F.signum(x) * whole / scale) + F.lit(0.0)


def stamp(c: Column | str) -> Column:
    """A time as text."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# --- shared steps in Spark -------------------------------------------------------------------------


def stations(spark: SparkSession, d: str) -> DataFrame:
    """Nations as stations: code, name, position, status, JSON properties, region."""
    n, region = views.table(spark, d, "nation"), views.table(spark, d, "region")
    k = F.col("n_nationkey")
    kind = F.element_at(F.array(F.lit("fiuna"), F.lit("airelibre"), F.lit("Meteostat")), (k % 3 + 1).cast("int"))
    code = F.concat(F.lit("st_"), k.cast("string"))
    return n.join(region, n.n_regionkey == region.r_regionkey).select(
        surrogate_key(code).alias("id"), code.alias("code"), F.col("n_name").alias("name"), (k * 3.5 - 40).alias("latitude"), (k * 7.25 - 80).alias("longitude"),
        F.when(k % 4 != 3, F.lit("active")).otherwise(F.lit("inactive")).alias("status"), F.concat(F.lit('{"source":"'), kind, F.lit('"}')).alias("properties"),
        (k % 2 == 0).alias("is_pattern_station"), F.col("r_name").alias("region_code"),
    )


def repaired(spark: SparkSession, d: str) -> DataFrame:
    return silver.repair(views.measurements(spark, d))


def validated(spark: SparkSession, d: str) -> DataFrame:
    return silver.validate_values(repaired(spark, d), views.rules(spark))


def facts(spark: SparkSession, d: str) -> DataFrame:
    """Deduplicated valid values with their codes."""
    rows = validated(spark, d).filter("is_value_valid").select("station_code", "variable_code", "data_source_name", F.col("measured_at_silver").alias("timestamp"), "source_row_id", F.col("value_silver").alias("value_parsed"), F.col("extracted_at").alias("ingested_at"))
    return silver.dedupe_latest(rows, ["station_code", "variable_code", "data_source_name", "timestamp"], ["ingested_at", "source_row_id"])


def hourly(spark: SparkSession, d: str) -> DataFrame:
    return gold.hourly_avg(facts(spark, d))


def wide(spark: SparkSession, d: str) -> DataFrame:
    return pivot_hourly(hourly(spark, d), gold.HOURLY_NAMES)


def calibrated(spark: SparkSession, d: str) -> DataFrame:
    return gold.station_hourly_aqi(gold.calibrate_pm(stored(wide(spark, d), "wide"), views.factors(spark)))


def station_ids(spark: SparkSession, d: str) -> DataFrame:
    from sensorjobs.operators.dims import dense_station_ids

    return dense_station_ids(stations(spark, d))


def readings(spark: SparkSession, d: str) -> DataFrame:
    return gold.station_readings(stored(calibrated(spark, d), "hours"), station_ids(spark, d))


def region_table(spark: SparkSession, d: str) -> DataFrame:
    return gold.region_readings(calibrated(spark, d), stations(spark, d).select(F.col("code").alias("station_code"), "region_code"))


def weather(spark: SparkSession, d: str) -> DataFrame:
    """Wind from the events' counter, by region and hour of the raw time."""
    # Spark takes nations joined with regions for as large as the product of their files, and would send small events instead, station by station.
    of = F.broadcast(stations(spark, d).select(F.col("code").alias("station_code"), surrogate_key(F.col("region_code")).alias("region_id")))
    rows = views.measurements(spark, d).join(of, "station_code")
    value = lambda code: F.when(F.col("variable_code") == code, F.col("value_parsed"))
    rows = rows.select(
        "region_id", F.date_trunc("hour", "measured_at_parsed").alias("hour"), value("temperature_c").alias("temperature_c"), value("hum").alias("humidity"),
        (F.col("value_parsed") + 900).alias("pressure"), F.col("k").cast("double").alias("wind_speed"), (F.col("k") * 3.6).alias("wind_dir"),
    )
    return gold.circular_wind(rows)


def feature_rows(spark: SparkSession, d: str) -> DataFrame:
    own = stations(spark, d)
    ids = station_ids(spark, d)
    hours = stored(calibrated(spark, d), "hours")
    regions = gold.region_readings(hours, own.select(F.col("code").alias("station_code"), "region_code"))
    of = ids.join(own.select("code", surrogate_key(F.col("region_code")).alias("region_id")), "code").select(F.col("project_station_id").alias("station_id"), "region_id")
    return gold.features(gold.station_readings(hours, ids), of, regions, weather(spark, d))


#: The end of the forecast window: noon of a day all scales have data for.
AS_OF = "2024-01-30 12:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


# --- the same steps in SQL -------------------------------------------------------------------------


def sk(x: str) -> str:
    """The signed key of a text expression."""
    h = f"('0x' || substr(md5({x}), 1, 16))::UBIGINT::HUGEINT"
    return f"(CASE WHEN {h} >= 9223372036854775808 THEN {h} - 18446744073709551616 ELSE {h} END)::BIGINT"


def ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def rd(x: str, digits: int = 6) -> str:
    return f"(round(({x})::DOUBLE, {digits}) + 0.0::DOUBLE)"


def aqi(x: str, pieces: tuple[tuple[str, str, int, int], ...]) -> str:
    whens = " ".join(f"WHEN {x} <= {hi} THEN CAST(({x} - {lo}) * (CAST({b} - {a} AS DOUBLE) / ({hi} - {lo})::DOUBLE) + {a} AS INTEGER)" for lo, hi, a, b in pieces)
    return f"(CASE WHEN {x} IS NULL OR {x} < 0 THEN NULL {whens} ELSE 500 END)"


def level(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 50 THEN 1 WHEN {x} <= 100 THEN 2 WHEN {x} <= 150 THEN 3 WHEN {x} <= 200 THEN 4 WHEN {x} <= 300 THEN 5 ELSE 6 END)"


def skew(values: str, std: str) -> str:
    """Population skewness of a list of doubles; null if flat."""
    mean = f"list_avg({values})"
    return f"(CASE WHEN {std} = 0 OR {std} IS NULL THEN NULL ELSE list_avg(list_transform({values}, lambda x: pow(x - {mean}, 3))) / pow(sqrt(list_avg(list_transform({values}, lambda x: pow(x - {mean}, 2)))), 3) END)"


from sensorjobs.functions.aqi import PM10_PIECES, PM25_PIECES  # noqa: E402

M = "m AS (SELECT event_id, 'st_' || (user_id % 10) AS station_code, CASE event_type WHEN 'click' THEN 'pm1' WHEN 'view' THEN 'pm25' WHEN 'purchase' THEN 'pm10' WHEN 'signup' THEN 'temperature_c' WHEN 'error' THEN 'hum' END AS variable_code, ts AS t, event_id % 7 <> 0 AS ok, date_trunc('day', ts) AS ext, value AS v, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"
S = M + ", lv AS (SELECT *, max(CASE WHEN ok THEN t END) OVER w AS lt, max(CASE WHEN ok THEN event_id END) OVER w AS lc FROM m WINDOW w AS (PARTITION BY station_code ORDER BY event_id ROWS UNBOUNDED PRECEDING)), s AS (SELECT *, CASE WHEN ok THEN t WHEN lt IS NOT NULL THEN lt + (event_id - lc) * INTERVAL 5 MINUTE END AS st FROM lv)"
V = S + ", va AS (SELECT *, CASE variable_code WHEN 'hum' THEN v BETWEEN 0 AND 100 WHEN 'temperature_c' THEN v BETWEEN -100 AND 80 WHEN 'pm10' THEN v BETWEEN 0 AND 3000 ELSE v BETWEEN 0 AND 2000 END AS fine FROM s WHERE st IS NOT NULL)"
FACT = V + ", f AS (SELECT * FROM va WHERE fine QUALIFY row_number() OVER (PARTITION BY station_code, variable_code, st ORDER BY ext DESC, event_id DESC) = 1)"
H = FACT + ", h AS (SELECT station_code, variable_code, date_trunc('hour', st) AS hr, avg(v) AS a FROM f GROUP BY ALL)"
W = H + ", w AS (SELECT station_code, hr, avg(a) FILTER (variable_code = 'pm1') AS pm1, avg(a) FILTER (variable_code = 'pm25') AS pm2_5, avg(a) FILTER (variable_code = 'pm10') AS pm10, avg(a) FILTER (variable_code = 'temperature_c') AS temperature_c, avg(a) FILTER (variable_code = 'hum') AS humidity FROM h GROUP BY ALL)"
FA = "fa(sc, s, e, fac) AS (VALUES ('st_1', TIMESTAMP '2024-01-03', TIMESTAMP '2024-01-20', 0.5::DOUBLE), ('st_1', TIMESTAMP '2024-01-10', NULL, 0.8::DOUBLE), ('st_2', TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-06 12:00:00', 1.25::DOUBLE), ('st_3', TIMESTAMP '2024-01-01', NULL, 2.0::DOUBLE))"
C = W + ", " + FA + ", cf AS (SELECT w.*, (SELECT arg_max(fac, s) FROM fa WHERE sc = w.station_code AND s <= w.hr AND (e IS NULL OR w.hr < e)) AS fac FROM w), c0 AS (SELECT station_code, hr, pm1 * coalesce(fac, 1) AS pm1, pm2_5 * coalesce(fac, 1) AS pm2_5, pm10 * coalesce(fac, 1) AS pm10, temperature_c, humidity, fac IS NOT NULL AS cal, fac FROM cf)" + f", c1 AS (SELECT *, {aqi('pm2_5', PM25_PIECES)} AS a25, {aqi('pm10', PM10_PIECES)} AS a10 FROM c0), c AS (SELECT *, {level('greatest(coalesce(a25, -1), coalesce(a10, -1))')} AS lvl FROM c1)"
ST = f"st AS (SELECT n_nationkey AS i, 'st_' || n_nationkey AS code, {sk(chr(39) + 'st_' + chr(39) + ' || n_nationkey')} AS id, n_name AS name, n_nationkey * 3.5::DOUBLE - 40 AS lat, n_nationkey * 7.25::DOUBLE - 80 AS lon, CASE WHEN n_nationkey % 4 <> 3 THEN 'active' ELSE 'inactive' END AS status, ['fiuna', 'airelibre', 'Meteostat'][n_nationkey % 3 + 1] AS src, n_nationkey % 2 = 0 AS pat, r_name AS rc FROM nation JOIN region ON n_regionkey = r_regionkey)"
IDM = "idm AS (SELECT row_number() OVER (ORDER BY code, id) AS pid, id, code, rc FROM st)"
ROLL = ", ro AS (SELECT *, list(pm2_5) FILTER (pm2_5 IS NOT NULL) OVER w6 AS l6, stddev_pop(pm2_5) OVER w6 AS s6, list(a25::DOUBLE) FILTER (a25 IS NOT NULL) OVER w24 AS l24, stddev_pop(a25) OVER w24 AS s24 FROM c WINDOW w6 AS (PARTITION BY station_code ORDER BY hr RANGE BETWEEN INTERVAL 5 HOURS PRECEDING AND CURRENT ROW), w24 AS (PARTITION BY station_code ORDER BY hr RANGE BETWEEN INTERVAL 23 HOURS PRECEDING AND CURRENT ROW))" + f", rr AS (SELECT *, list_avg(l6) AS avg6, list_max(l6) AS max6, {skew('l6', 's6')} AS sk6, list_max(l24)::INTEGER AS max24, {skew('l24', 's24')} AS sk24 FROM ro)"
READ = C + ROLL + ", " + ST + ", " + IDM + ", rd AS (SELECT pid AS station_id, rc, rr.* FROM rr JOIN idm ON idm.code = rr.station_code)"
REG = f", rg0 AS (SELECT {sk('rc')} AS region_id, hr, avg(pm2_5) AS pavg, max(pm2_5) AS pmax, stddev_pop(pm2_5) AS pstd, list(pm2_5) FILTER (pm2_5 IS NOT NULL) AS pl, avg(a25) AS aavg, max(a25) AS amax, stddev_pop(a25) AS astd, list(a25::DOUBLE) FILTER (a25 IS NOT NULL) AS al, max(lvl) AS lmax, avg(pm2_5 * pm2_5) AS pm2, avg(pm2_5 * pm2_5 * pm2_5) AS pm3 FROM rd GROUP BY 1, 2), rg AS (SELECT *, {skew('pl', 'pstd')} AS psk, {skew('al', 'astd')} AS ask FROM rg0)"
WE = f", we AS (SELECT {sk('rc')} AS region_id, date_trunc('hour', t) AS hr, avg(CASE WHEN variable_code = 'temperature_c' THEN v END) AS temperature, avg(CASE WHEN variable_code = 'hum' THEN v END) AS humidity, avg(v + 900) AS pressure, avg(k) AS wind_speed, avg(sin(radians(k * 3.6::DOUBLE))) AS wsin, avg(cos(radians(k * 3.6::DOUBLE))) AS wcos FROM m JOIN st ON st.code = m.station_code GROUP BY 1, 2)"
FEAT = READ + REG + WE + ", fe AS (SELECT rd.station_id, rd.hr, rd.pm1, rd.pm2_5, rd.pm10, rd.avg6, rd.max6, rd.sk6, rd.s6, rd.a25, rd.a10, rd.lvl, rd.max24, rd.sk24, rd.s24, rg.pavg, rg.pmax, rg.psk, rg.pstd, rg.aavg, rg.amax, rg.ask, rg.astd, rg.lmax, we.temperature, we.humidity AS whum, we.pressure, we.wind_speed, we.wsin, we.wcos FROM rd LEFT JOIN rg ON rg.region_id = " + sk("rd.rc") + " AND rg.hr = rd.hr LEFT JOIN we ON we.region_id = " + sk("rd.rc") + " AND we.hr = rd.hr)"
