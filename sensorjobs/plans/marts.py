"""Queries: aggregation, windows, indices, forecasts, quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions import aqi as index
from sensorjobs.functions import columns as fn
from sensorjobs.functions.aqi import PM10_PIECES, PM25_PIECES
from sensorjobs.operators import gold, quality
from sensorjobs.plans import base, forecast, scoring
from sensorjobs.sources.io import FEATURE_COLUMNS
from sensorjobs.plans.base import AS_OF, C, FEAT, H, IDM, M, READ, REG, ROLL, S, ST, V, W, WE, aqi, level, query, r, rd, sk, stamp, ts


@query("hourly_avg", f"WITH {H} SELECT station_code, variable_code, {ts('hr')} AS hour, {rd('a')} AS value_avg FROM h")
def hourly_avg(spark: SparkSession, d: str) -> DataFrame:
    return base.hourly(spark, d).select("station_code", "variable_code", stamp("hour").alias("hour"), r("value_avg").alias("value_avg"))


@query("region_moments", f"WITH {READ}{REG} SELECT region_id, {ts('hr')} AS hour, {rd('pavg')} AS pm2_5_avg, {rd('pmax')} AS pm2_5_max, {rd('pstd')} AS pm2_5_std, {rd('pm2', 8)} AS pm2_5_m2, {rd('pm3', 0)} AS pm2_5_m3, {rd('aavg')} AS aqi_avg, amax AS aqi_max, lmax AS level_region_max FROM rg")
def region_moments(spark: SparkSession, d: str) -> DataFrame:
    rows = base.calibrated(spark, d).join(base.stations(spark, d).select(F.col("code").alias("station_code"), fn.surrogate_key(F.col("region_code")).alias("region_id")), "station_code")
    out = gold.region_moments(rows)
    return out.select("region_id", stamp("hour").alias("hour"), *[r(c, k).alias(c) for c, k in (("pm2_5_avg", 6), ("pm2_5_max", 6), ("pm2_5_std", 6), ("pm2_5_m2", 8), ("pm2_5_m3", 0), ("aqi_avg", 6))], "aqi_max", "level_region_max")


@query("skew_from_moments", f"SELECT event_type, user_id, {rd('CASE WHEN stddev_pop(value) = 0 THEN NULL ELSE (avg(pow(value, 3)) - 3 * avg(value) * avg(pow(value, 2)) + 2 * pow(avg(value), 3)) / pow(stddev_pop(value), 3) END', 4)} AS skew FROM events GROUP BY ALL HAVING stddev_pop(value) > 1")
def skew_from_moments(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("value")
    m = views.table(spark, d, "events").groupBy("event_type", "user_id").agg(F.avg(v).alias("a"), F.avg(v * v).alias("b"), F.avg(v * v * v).alias("c"), F.stddev_pop(v).alias("s")).filter("s > 1")
    return m.select("event_type", "user_id", r(fn.skew_from_moments(F.col("a"), F.col("b"), F.col("c"), F.col("s")), 4).alias("skew"))


@query("region_readings", f"WITH {READ}{REG} SELECT {sk('region_id || ' + chr(39) + '-' + chr(39) + ' || strftime(hr, ' + chr(39) + '%Y-%m-%d %H:%M:%S+00' + chr(39) + ')')} AS id, region_id, {ts('hr')} AS date_utc, {rd('pavg')} AS pm2_5_region_avg, {rd('pmax')} AS pm2_5_region_max, {rd('psk', 4)} AS pm2_5_region_skew, {rd('pstd')} AS pm2_5_region_std, {rd('aavg')} AS aqi_region_avg, amax::DOUBLE AS aqi_region_max, {rd('ask', 4)} AS aqi_region_skew, {rd('astd')} AS aqi_region_std, lmax AS level_region_max FROM rg")
def region_readings(spark: SparkSession, d: str) -> DataFrame:
    out = base.region_table(spark, d)
    numbers = [r(c, 4 if "skew" in c else 6).alias(c) for c in ("pm2_5_region_avg", "pm2_5_region_max", "pm2_5_region_skew", "pm2_5_region_std", "aqi_region_avg", "aqi_region_max", "aqi_region_skew", "aqi_region_std")]
    return out.select("id", "region_id", stamp("date_utc").alias("date_utc"), *numbers, "level_region_max")


@query("circular_wind", f"WITH {M}, {ST}{WE} SELECT region_id, {ts('hr')} AS hour, {rd('temperature')} AS temperature, {rd('humidity')} AS humidity, {rd('pressure')} AS pressure, {rd('wind_speed')} AS wind_speed, {rd('wsin')} AS wind_dir_sin, {rd('wcos')} AS wind_dir_cos FROM we")
def circular_wind(spark: SparkSession, d: str) -> DataFrame:
    return base.weather(spark, d).select("region_id", stamp("hour").alias("hour"), *[r(c).alias(c) for c in ("temperature", "humidity", "pressure", "wind_speed", "wind_dir_sin", "wind_dir_cos")])


@query("latest_reading", f"WITH {W} SELECT station_code, {ts('max(hr)')} AS latest_reading_at FROM w GROUP BY 1")
def latest_reading(spark: SparkSession, d: str) -> DataFrame:
    return gold.latest_reading(base.wide(spark, d)).select("station_code", stamp("latest_reading_at").alias("latest_reading_at"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "lineitem").select("l_suppkey", "l_returnflag").distinct()


SIX = f"{rd('avg6')} AS pm2_5_avg_6h, {rd('max6')} AS pm2_5_max_6h, {rd('s6')} AS pm2_5_std_6h, {rd('sk6', 4)} AS pm2_5_skew_6h"
DAY = f"max24 AS aqi_pm2_5_max_24h, {rd('s24')} AS aqi_pm2_5_std_24h, {rd('sk24', 4)} AS aqi_pm2_5_skew_24h"
SIX_C = [("pm2_5_avg_6h", 6), ("pm2_5_max_6h", 6), ("pm2_5_std_6h", 6), ("pm2_5_skew_6h", 4)]
DAY_C = [("aqi_pm2_5_std_24h", 6), ("aqi_pm2_5_skew_24h", 4)]


@query("rolling_6h", f"WITH {C}{ROLL} SELECT station_code, {ts('hr')} AS hour, {SIX} FROM rr")
def rolling_6h(spark: SparkSession, d: str) -> DataFrame:
    return gold.rolling_6h(base.calibrated(spark, d)).select("station_code", stamp("hour").alias("hour"), *[r(c, k).alias(c) for c, k in SIX_C])


@query("rolling_24h", f"WITH {C}{ROLL} SELECT station_code, {ts('hr')} AS hour, {DAY} FROM rr")
def rolling_24h(spark: SparkSession, d: str) -> DataFrame:
    return gold.rolling_24h(base.calibrated(spark, d)).select("station_code", stamp("hour").alias("hour"), "aqi_pm2_5_max_24h", *[r(c, k).alias(c) for c, k in DAY_C])


@query("rolling_by_day", f"WITH {C}{ROLL} SELECT station_code, {ts('hr')} AS hour, {SIX}, {DAY} FROM rr")
def rolling_by_day(spark: SparkSession, d: str) -> DataFrame:
    return gold.rolling_by_day(base.stored(base.calibrated(spark, d), "hours")).select("station_code", stamp("hour").alias("hour"), "aqi_pm2_5_max_24h", *[r(c, k).alias(c) for c, k in SIX_C + DAY_C])


KEY_TIME = "strftime(hr, '%Y-%m-%d %H:%M:%S+00')"


@query("station_readings", f"WITH {READ} SELECT {sk('station_id || ' + chr(39) + '-' + chr(39) + ' || ' + KEY_TIME)} AS id, station_id, NULL::BIGINT AS airnow_id, {ts('hr')} AS date_localtime, cal AS pm_calibrated, {rd('pm1')} AS pm1, {rd('pm2_5')} AS pm2_5, {rd('pm10')} AS pm10, {SIX}, a25 AS aqi_pm2_5, a10 AS aqi_pm10, lvl AS aqi_level, {DAY} FROM rd")
def station_readings(spark: SparkSession, d: str) -> DataFrame:
    out = base.readings(spark, d)
    numbers = [r(c, k).alias(c) for c, k in [("pm1", 6), ("pm2_5", 6), ("pm10", 6), *SIX_C, *DAY_C]]
    return out.select("id", F.col("station_id").cast("bigint").alias("station_id"), "airnow_id", stamp("date_localtime").alias("date_localtime"), "pm_calibrated", *numbers, "aqi_pm2_5", "aqi_pm10", "aqi_level", "aqi_pm2_5_max_24h")


#: The feature columns of the SQL table ``fe``, in their order, with the digits that both engines agree on.
FE = dict(zip(FEATURE_COLUMNS, ("pm1", "pm2_5", "pm10", "avg6", "max6", "sk6", "s6", "a25", "a10", "lvl", "max24", "sk24", "s24", "pavg", "pmax", "psk", "pstd", "aavg", "amax", "ask", "astd", "lmax", "temperature", "whum", "pressure", "wind_speed", "wsin", "wcos"), strict=True))
FEATURES = ", ".join(f"{rd(x, 4 if 'skew' in c else 6)} AS {c}" for c, x in FE.items())


def feature_columns(rows: DataFrame) -> DataFrame:
    """Every feature, rounded."""
    return rows.select(F.col("station_id").cast("bigint").alias("station_id"), stamp("date_utc").alias("date_utc"), *[r(c, 4 if "skew" in c else 6).alias(c) for c in FEATURE_COLUMNS])


@query("station_features", f"WITH {FEAT} SELECT station_id, {ts('hr')} AS date_utc, {FEATURES} FROM fe")
def station_features(spark: SparkSession, d: str) -> DataFrame:
    return feature_columns(base.feature_rows(spark, d))


# --- indices ---------------------------------------------------------------------------------------


@query("aqi_linear", "SELECT event_id, CAST((value - 12.1) * (49 / 23.3::DOUBLE) + 51 AS INTEGER) AS aqi FROM events")
def aqi_linear(spark: SparkSession, d: str) -> DataFrame:
    return views.table(spark, d, "events").select("event_id", index.aqi_linear(F.col("value"), "12.1", "35.4", 51, 100).alias("aqi"))


SIGNED = "(CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 10 = 0 THEN -value ELSE value * 1.3::DOUBLE END)"


def _signed(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    return views.table(spark, d, "events").select("event_id", F.when(k % 9 == 0, F.lit(None).cast("double")).when(k % 10 == 0, -F.col("value")).otherwise(F.col("value") * 1.3).alias("x"))


@query("aqi_pm25", f"SELECT event_id, {aqi('x', PM25_PIECES)} AS aqi FROM (SELECT event_id, {SIGNED} AS x FROM events)")
def aqi_pm25(spark: SparkSession, d: str) -> DataFrame:
    return _signed(spark, d).select("event_id", index.aqi_pm25(F.col("x")).alias("aqi"))


@query("aqi_pm10", f"SELECT event_id, {aqi('x', PM10_PIECES)} AS aqi FROM (SELECT event_id, {SIGNED} AS x FROM events)")
def aqi_pm10(spark: SparkSession, d: str) -> DataFrame:
    return _signed(spark, d).select("event_id", index.aqi_pm10(F.col("x")).alias("aqi"))


@query("aqi_level", f"SELECT event_id, {level('x')} AS level FROM (SELECT event_id, {SIGNED} AS x FROM events)")
def aqi_level(spark: SparkSession, d: str) -> DataFrame:
    return _signed(spark, d).select("event_id", index.aqi_level(F.col("x")).alias("level"))


@query("station_hourly_aqi", f"WITH {C} SELECT station_code, {ts('hr')} AS hour, a25 AS aqi_pm2_5, a10 AS aqi_pm10, lvl AS aqi_level FROM c")
def station_hourly_aqi(spark: SparkSession, d: str) -> DataFrame:
    return base.calibrated(spark, d).select("station_code", stamp("hour").alias("hour"), "aqi_pm2_5", "aqi_pm10", "aqi_level")


@query("calibrate_pm", f"WITH {C} SELECT station_code, {ts('hr')} AS hour, {rd('pm1')} AS pm1, {rd('pm2_5')} AS pm2_5, {rd('pm10')} AS pm10, {rd('humidity')} AS humidity, cal AS pm_calibrated FROM c")
def calibrate_pm(spark: SparkSession, d: str) -> DataFrame:
    return base.calibrated(spark, d).select("station_code", stamp("hour").alias("hour"), *[r(c).alias(c) for c in ("pm1", "pm2_5", "pm10", "humidity")], "pm_calibrated")


# --- forecasts -------------------------------------------------------------------------------------

#: The product's gate. The tables have a reading of a station every few hours, so the queries' window is the month.
LEAST, HOURS = forecast.MIN_POINTS, 720
END = f"TIMESTAMP '{AS_OF}'"
WIN = C + f", {ST}, {IDM}, fw AS (SELECT pid AS station_id, hr, pm2_5, a25::DOUBLE AS a25, lvl FROM c JOIN idm ON idm.code = c.station_code), wi AS (SELECT * FROM fw WHERE hr > {END} - INTERVAL {HOURS} HOUR AND hr <= {END})"
GATE = f", ga AS (SELECT station_id, count(*) AS n_rows, count(pm2_5) AS n_complete FROM wi GROUP BY 1), ga2 AS (SELECT *, CASE WHEN n_rows < {LEAST} THEN 'min_points' WHEN n_complete < {LEAST} THEN 'min_points_or_nulls' END AS reason, CASE WHEN n_rows < {LEAST} THEN 'Rows in window: ' || n_rows WHEN n_complete < {LEAST} THEN 'Rows after null filter: ' || n_complete END AS detail FROM ga)"
GRID = GATE + f", re AS (SELECT wi.* FROM wi JOIN ga2 USING (station_id) WHERE reason IS NULL AND pm2_5 IS NOT NULL), gr AS (SELECT station_id, unnest(range(a, {END} + INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hr FROM (SELECT station_id, min(hr) AS a FROM re GROUP BY 1)), rx AS (SELECT gr.station_id, gr.hr, re.pm2_5, re.a25 FROM gr LEFT JOIN re USING (station_id, hr)), gf AS (SELECT station_id, hr, coalesce(last_value(pm2_5 IGNORE NULLS) OVER p, first_value(pm2_5 IGNORE NULLS) OVER q) AS pm2_5, coalesce(last_value(a25 IGNORE NULLS) OVER p, first_value(a25 IGNORE NULLS) OVER q) AS a25 FROM rx WINDOW p AS (PARTITION BY station_id ORDER BY hr ROWS UNBOUNDED PRECEDING), q AS (PARTITION BY station_id ORDER BY hr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"


def small_features(spark: SparkSession, d: str) -> DataFrame:
    """The columns the forecast queries use."""
    ids = base.station_ids(spark, d).select(F.col("code").alias("station_code"), F.col("project_station_id").cast("bigint").alias("station_id"))
    return base.calibrated(spark, d).join(ids, "station_code").select("station_id", F.col("hour").alias("date_utc"), "pm2_5", F.col("aqi_pm2_5").cast("double").alias("aqi_pm2_5"), "aqi_level")


def window(spark: SparkSession, d: str) -> DataFrame:
    return base.stored(forecast.station_window(small_features(spark, d), base.as_of(), HOURS), "window")


def prepared(spark: SparkSession, d: str) -> DataFrame:
    rows = window(spark, d)
    gate = forecast.min_points_gate(rows, ["pm2_5"], LEAST)
    ready = rows.join(gate.filter("status = 'ready'").select("station_id"), "station_id", "left_semi")
    return forecast.hourly_reindex(forecast.complete_rows(ready, ["pm2_5"]), base.as_of())


def filled(spark: SparkSession, d: str) -> DataFrame:
    return forecast.gap_fill(prepared(spark, d), ["pm2_5", "aqi_pm2_5"])


@query("candidate_stations", f"WITH {WIN} SELECT DISTINCT station_id FROM wi")
def candidate_stations(spark: SparkSession, d: str) -> DataFrame:
    return forecast.candidate_stations(small_features(spark, d), base.as_of(), HOURS)


@query("station_window", f"WITH {WIN} SELECT station_id, {ts('hr')} AS date_utc, {rd('pm2_5')} AS pm2_5, a25 AS aqi_pm2_5 FROM wi")
def station_window(spark: SparkSession, d: str) -> DataFrame:
    return window(spark, d).select("station_id", stamp("date_utc").alias("date_utc"), r("pm2_5").alias("pm2_5"), "aqi_pm2_5")


@query("complete_rows", f"WITH {C} SELECT station_code, {ts('hr')} AS hour FROM c WHERE pm2_5 IS NOT NULL AND pm10 IS NOT NULL")
def complete_rows(spark: SparkSession, d: str) -> DataFrame:
    return forecast.complete_rows(base.calibrated(spark, d), ["pm2_5", "pm10"]).select("station_code", stamp("hour").alias("hour"))


@query("min_points_gate", f"WITH {WIN}{GATE} SELECT station_id, n_rows, n_complete, CASE WHEN reason IS NULL THEN 'ready' ELSE 'skipped' END AS status, reason AS reason_code, detail AS reason_detail FROM ga2")
def min_points_gate(spark: SparkSession, d: str) -> DataFrame:
    return forecast.min_points_gate(window(spark, d), ["pm2_5"], LEAST)


@query("feature_frame", f"WITH {M} SELECT CAST(right(station_code, 1) AS BIGINT) AS station_id, {ts('hr')} AS date_utc, CASE WHEN event_id % 4 <> 0 THEN v END AS pm2_5 FROM (SELECT *, date_trunc('hour', t) AS hr FROM m) QUALIFY row_number() OVER (PARTITION BY station_code, hr ORDER BY event_id DESC) = 1")
def feature_frame(spark: SparkSession, d: str) -> DataFrame:
    rows = views.measurements(spark, d).select(
        F.substring("station_code", 4, 1).alias("station_id"), stamp(F.date_trunc("hour", "measured_at_parsed")).alias("date_utc"),
        F.when(F.col("source_row_id") % 4 == 0, F.lit("bad")).otherwise(F.col("value_parsed").cast("string")).alias("pm2_5"), "source_row_id",
    )
    out = forecast.feature_frame(rows, ["pm2_5"], "source_row_id")
    return out.select("station_id", stamp("date_utc").alias("date_utc"), "pm2_5")


@query("hourly_reindex", f"WITH {WIN}{GRID} SELECT station_id, {ts('hr')} AS date_utc, {rd('pm2_5')} AS pm2_5 FROM rx")
def hourly_reindex(spark: SparkSession, d: str) -> DataFrame:
    return prepared(spark, d).select("station_id", stamp("date_utc").alias("date_utc"), r("pm2_5").alias("pm2_5"))


@query("gap_fill", f"WITH {WIN}{GRID} SELECT station_id, {ts('hr')} AS date_utc, {rd('pm2_5')} AS pm2_5, a25 AS aqi_pm2_5 FROM gf")
def gap_fill(spark: SparkSession, d: str) -> DataFrame:
    return filled(spark, d).select("station_id", stamp("date_utc").alias("date_utc"), r("pm2_5").alias("pm2_5"), "aqi_pm2_5")


@query("predict_window", f"WITH {WIN}{GRID}, la AS (SELECT station_id, a25 FROM gf WHERE hr = {END}) SELECT station_id, h.horizon, {ts(END + ' + i * INTERVAL 1 HOUR')} AS at, a25 AS yhat FROM la, (VALUES (6), (12)) h(horizon), range(1, 13) t(i) WHERE i <= h.horizon".replace(" AS at,", " AS point_at,"))
def predict_window(spark: SparkSession, d: str) -> DataFrame:
    out = forecast.predict_window(filled(spark, d), forecast.persistence)
    return out.select("station_id", "horizon", F.explode("points").alias("p")).select("station_id", "horizon", stamp("p.ts").alias("point_at"), "p.yhat")


@query("predict_saved_model", f"WITH {WIN}{GRID}, la AS (SELECT station_id, a25 FROM gf WHERE hr = {END}) SELECT station_id, 6 AS horizon, {ts(END + ' + i * INTERVAL 1 HOUR')} AS point_at, {rd('1.5 + 0.5 * a25 + 0.25 * i')} AS yhat FROM la, range(1, 7) t(i)")
def predict_saved_model(spark: SparkSession, d: str) -> DataFrame:
    """A linear model, written and read again as text, made once for each process that scores."""
    path = base.scratch(spark, "model")
    scoring.save_model(spark, scoring.Saved("linear", {"weights": {"aqi_pm2_5": 0.5}, "intercept": 1.5, "by_hour": 0.25}, "v1"), path)
    out = forecast.predict_window(filled(spark, d), scoring.read_model(spark, path), (6,))
    return out.select("station_id", "horizon", F.explode("points").alias("p")).select("station_id", "horizon", stamp("p.ts").alias("point_at"), r("p.yhat").alias("yhat"))


@query("normalize_points", f"WITH {WIN}{GRID}, la AS (SELECT station_id, a25 FROM gf WHERE hr = {END}) SELECT station_id, 6 AS horizon, {ts(END + ' + INTERVAL 6 HOUR')} AS point_at, a25 AS yhat, a25 - 1 AS yhat_lower FROM la WHERE station_id % 2 = 0 UNION ALL SELECT station_id, 6, {ts(END + ' + i * INTERVAL 1 HOUR')}, a25 + i, NULL FROM la, range(1, 4) t(i) WHERE station_id % 2 = 1")
def normalize_points(spark: SparkSession, d: str) -> DataFrame:
    def model(rows, horizon):
        last = float(rows["aqi_pm2_5"].iloc[-1])
        return {"yhat": last, "yhat_lower": last - 1} if rows["station_id"].iloc[0] % 2 == 0 else [last + 1, (last + 2,), {"yhat": last + 3}]

    out = forecast.predict_window(filled(spark, d), model, (6,))
    return out.select("station_id", "horizon", F.explode("points").alias("p")).select("station_id", "horizon", stamp("p.ts").alias("point_at"), "p.yhat", "p.yhat_lower")


@query("storage_points", f"WITH {WIN}{GRID}, la AS (SELECT station_id, a25 FROM gf WHERE hr = {END}) SELECT station_id, '[' || string_agg('{{\"value\":' || a25::INTEGER || ',\"timestamp\":\"' || strftime({END} + i * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '\"}}', ',' ORDER BY i) || ']' AS forecast_6h FROM la, range(1, 7) t(i) GROUP BY 1")
def storage_points(spark: SparkSession, d: str) -> DataFrame:
    out = forecast.predict_window(filled(spark, d), forecast.persistence, (6,))
    return out.select("station_id", F.to_json(forecast.storage_points(F.col("points"))).alias("forecast_6h"))


@query("aqi_input_points", f"WITH {WIN} SELECT station_id, '[' || coalesce(string_agg('{{\"value\":' || a25::INTEGER || ',\"timestamp\":\"' || strftime(hr, '%Y-%m-%dT%H:%M:%S') || '\"}}', ',' ORDER BY hr) FILTER (a25 IS NOT NULL), '') || ']' AS aqi_input FROM wi GROUP BY 1")
def aqi_input_points(spark: SparkSession, d: str) -> DataFrame:
    return forecast.aqi_input_points(window(spark, d)).select("station_id", F.to_json("aqi_input").alias("aqi_input"))


def failing(rows, horizon):
    """A model that fails for every third station."""
    if rows["station_id"].iloc[0] % 3 == 0:
        raise ValueError("no model")
    return forecast.persistence(rows, horizon)


def at(text: str) -> Column:
    return F.lit(text).cast("timestamp")


STARTED, ENDED = "2024-02-01 00:00:00", "2024-02-01 00:01:30"


def run(spark: SparkSession, d: str, run_id: str = "run-1") -> tuple[DataFrame, DataFrame, DataFrame]:
    header = forecast.Run(run_id, "main", base.as_of(), at(STARTED), HOURS, LEAST, "6h-v1", "12h-v2", deployment="hourly")
    return forecast.forecast_run(small_features(spark, d).drop("aqi_level"), failing, header, ["pm2_5"], at(ENDED))


STATUS = f"{WIN}{GATE}, ss AS (SELECT station_id, CASE WHEN reason IS NOT NULL THEN 'skipped' WHEN station_id % 3 = 0 THEN 'failed' ELSE 'success' END AS status, coalesce(reason, CASE WHEN station_id % 3 = 0 THEN 'exception' END) AS reason_code, coalesce(detail, CASE WHEN station_id % 3 = 0 THEN 'no model' END) AS reason_detail FROM ga2)"
STATUS_ID = sk("'main-run-1-' || station_id")
STATUS_ROWS = f"SELECT {STATUS_ID} AS id, 'main' AS project_code, 'run-1' AS inference_run_id, station_id, status, reason_code, reason_detail, '{ENDED}' AS created_at FROM ss"


@query("station_status", f"WITH {STATUS} {STATUS_ROWS}")
def station_status(spark: SparkSession, d: str) -> DataFrame:
    """All but the measured seconds, which no two runs share."""
    return run(spark, d)[1].drop("duration_s").withColumn("created_at", stamp("created_at"))


SUMMARY_ROW = f"'run-1' AS id, 'local' AS flow_run_id, 'hourly' AS deployment, '{AS_OF}' AS as_of, {HOURS} AS window_hours, {LEAST} AS min_points, '6h-v1' AS model_6h_version, '12h-v2' AS model_12h_version, NULL::VARCHAR AS model_6h_path, NULL::VARCHAR AS model_12h_path, '{STARTED}' AS started_at, '{ENDED}' AS ended_at, 90 AS duration_s, 'success' AS status"
HEADER_SQL = f"WITH {STATUS} SELECT {SUMMARY_ROW}, count(*) AS stations_total, count_if(status = 'success')::BIGINT AS stations_success, count_if(status = 'skipped')::BIGINT AS stations_skipped, count_if(status = 'failed')::BIGINT AS stations_failed, NULL::VARCHAR AS error_summary FROM ss"


def _header(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: stamp(c) for c in ("as_of", "started_at", "ended_at")})


@query("run_summary", HEADER_SQL)
def run_summary(spark: SparkSession, d: str) -> DataFrame:
    return _header(run(spark, d)[2])


POINTS = "'[' || string_agg('{{\"value\":' || a25::INTEGER || ',\"timestamp\":\"' || strftime({END} + i * INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S') || '\"}}', ',' ORDER BY i) {0} || ']'".replace("{END}", END)
INPUTS = "inp AS (SELECT station_id, '[' || coalesce(string_agg('{\"value\":' || a25::INTEGER || ',\"timestamp\":\"' || strftime(hr, '%Y-%m-%dT%H:%M:%S') || '\"}', ',' ORDER BY hr) FILTER (a25 IS NOT NULL), '') || ']' AS aqi_input FROM gf GROUP BY 1)"
RESULT_ROWS = f", la AS (SELECT station_id, a25 FROM gf WHERE hr = {END} AND station_id % 3 <> 0), fc AS (SELECT station_id, {POINTS.format('FILTER (i <= 6)')} AS forecast_6h, {POINTS.format('')} AS forecast_12h FROM la, range(1, 13) t(i) GROUP BY 1), {INPUTS}"
RESULT_ID = sk("'run-1-' || station_id")


@query("forecast_results", f"WITH {WIN}{GRID}{RESULT_ROWS} SELECT {RESULT_ID} AS id, 'run-1' AS inference_run_id, station_id, forecast_6h, forecast_12h, aqi_input, '{ENDED}' AS created_at FROM fc JOIN inp USING (station_id)")
def forecast_results(spark: SparkSession, d: str) -> DataFrame:
    return run(spark, d)[0].withColumn("created_at", stamp("created_at"))


@query("persist_forecasts", f"WITH {WIN}{GRID}{RESULT_ROWS} SELECT CASE WHEN station_id % 2 = 0 THEN -station_id ELSE {RESULT_ID} END AS id, 'run-1' AS inference_run_id, station_id, forecast_6h, forecast_12h, aqi_input, CASE WHEN station_id % 2 = 0 THEN '{STARTED}' ELSE '{ENDED}' END AS created_at FROM fc JOIN inp USING (station_id) UNION ALL SELECT -station_id, 'run-0', station_id, NULL, NULL, NULL, '{STARTED}' FROM fc WHERE station_id % 2 = 0")
def persist_forecasts(spark: SparkSession, d: str) -> DataFrame:
    """The result table after a second run over rows of an earlier run, and of the same run for stations with an even id."""
    results = base.stored(run(spark, d)[0], "results")
    gone = {c: F.lit(None).cast("string") for c in ("forecast_6h", "forecast_12h", "aqi_input")}
    old = results.filter("station_id % 2 = 0").withColumns({"id": -F.col("station_id"), "created_at": at(STARTED), **gone})
    target = old.unionByName(old.withColumn("inference_run_id", F.lit("run-0")))
    return forecast.persist_results(target, results).withColumn("created_at", stamp("created_at"))


@query("persist_status", f"WITH {STATUS} SELECT * REPLACE (CASE WHEN station_id % 2 = 0 THEN -station_id ELSE id END AS id, CASE WHEN station_id % 2 = 0 THEN '{STARTED}' ELSE created_at END AS created_at) FROM ({STATUS_ROWS})")
def persist_status(spark: SparkSession, d: str) -> DataFrame:
    """The status table after a run that was already noted as running for stations with an even id."""
    rows = base.stored(run(spark, d)[1], "status")
    none = {c: F.lit(None).cast("string") for c in ("reason_code", "reason_detail")}
    old = rows.filter("station_id % 2 = 0").withColumns({"id": -F.col("station_id"), "status": F.lit("running"), "created_at": at(STARTED), "duration_s": F.lit(None).cast("int"), **none})
    return forecast.persist_status(old, rows).drop("duration_s").withColumn("created_at", stamp("created_at"))


@query("persist_run", HEADER_SQL + " UNION ALL SELECT 'run-0', 'local', 'hourly', as_of, window_hours, min_points, '6h-v1', '12h-v2', NULL, NULL, started_at, NULL, NULL, 'running', NULL, NULL, NULL, NULL, NULL FROM (" + HEADER_SQL + ")")
def persist_run(spark: SparkSession, d: str) -> DataFrame:
    """The run table after a run that was written as running at its start, beside one that never ended."""
    header = base.stored(run(spark, d)[2], "header")
    open_ = {c: F.lit(None).cast(header.schema[c].dataType) for c in ("ended_at", "duration_s", "stations_total", "stations_success", "stations_skipped", "stations_failed")}
    begun = header.withColumns({**open_, "status": F.lit("running")})
    return _header(forecast.persist_run(begun.unionByName(begun.withColumn("id", F.lit("run-0"))), header))


# --- quality ---------------------------------------------------------------------------------------


@query("check_not_null", f"WITH {S} SELECT 'not_null' AS check_kind, 'measured_at_silver' AS subject, count_if(st IS NULL)::BIGINT AS failures FROM s UNION ALL SELECT 'not_null', 'value_parsed', count_if(v IS NULL)::BIGINT FROM s")
def check_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_not_null(base.repaired(spark, d), ["measured_at_silver", "value_parsed"])


@query("check_unique", "SELECT 'unique' AS check_kind, 'o_custkey' AS subject, count(*) AS failures FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)")
def check_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_unique(views.table(spark, d, "orders"), "o_custkey")


@query("check_unique_combination", "SELECT 'unique_combination' AS check_kind, 'l_orderkey,l_suppkey' AS subject, count(*) AS failures FROM (SELECT l_orderkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(*) > 1)")
def check_unique_combination(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_unique_combination(views.table(spark, d, "lineitem"), ["l_orderkey", "l_suppkey"])


@query("check_relationship", "SELECT 'relationship' AS check_kind, 'l_orderkey' AS subject, count(*) AS failures FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def check_relationship(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_relationship(views.table(spark, d, "lineitem"), "l_orderkey", views.table(spark, d, "orders").filter("o_orderstatus <> 'P'"), "o_orderkey")


@query("check_table", """WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS cust FROM orders), c AS (SELECT c_custkey FROM customer WHERE c_nationkey < 20)
SELECT 'not_null' AS check_kind, 'cust' AS subject, count_if(cust IS NULL)::BIGINT AS failures FROM o
UNION ALL SELECT 'not_null', 'o_orderkey', count_if(o_orderkey IS NULL)::BIGINT FROM o
UNION ALL SELECT 'accepted_values', 'o_orderstatus', count_if(o_orderstatus NOT IN ('O', 'P'))::BIGINT FROM o
UNION ALL SELECT 'expression', 'price', count_if(NOT coalesce(o_totalprice > 1000, false))::BIGINT FROM o
UNION ALL SELECT 'unique', 'o_orderkey', count(*) FROM (SELECT o_orderkey FROM o GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique', 'cust', count(*) FROM (SELECT cust FROM o WHERE cust IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'unique_combination', 'cust,o_orderstatus', count(*) FROM (SELECT cust, o_orderstatus FROM o WHERE cust IS NOT NULL GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'relationship', 'cust', count(*) FROM o WHERE cust IS NOT NULL AND cust NOT IN (SELECT c_custkey FROM c)""")
def check_table(spark: SparkSession, d: str) -> DataFrame:
    """Eight checks of one table in one scan of it."""
    orders = views.table(spark, d, "orders").withColumn("cust", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")))
    parents = views.table(spark, d, "customer").filter("c_nationkey < 20")
    return quality.check_table(
        orders, ["cust", "o_orderkey"], {"o_orderstatus": ["O", "P"]}, {"price": F.col("o_totalprice") > 1000},
        [["o_orderkey"], ["cust"], ["cust", "o_orderstatus"]], {"cust": (parents, "c_custkey")},
    )


@query("check_accepted_values", "SELECT 'accepted_values' AS check_kind, 'event_type' AS subject, count_if(event_type NOT IN ('click', 'view'))::BIGINT AS failures FROM events")
def check_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_accepted_values(views.table(spark, d, "events"), {"event_type": ["click", "view"]})


@query("check_expression", f"WITH {V} SELECT 'expression' AS check_kind, 'value in rule' AS subject, count_if(NOT fine)::BIGINT AS failures FROM va")
def check_expression(spark: SparkSession, d: str) -> DataFrame:
    return quality.check_expression(base.validated(spark, d), {"value in rule": F.col("is_value_valid")})


RESULTS = "res AS (SELECT 'run-' || (o_orderkey % 7) AS run_id, o_orderkey AS place, CASE WHEN o_orderkey % 3 = 0 THEN 'test.' ELSE 'model.' END || o_orderkey AS uid, CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'pass' ELSE 'fail' END AS status, o_orderpriority AS message FROM orders)"
SUMMARY = RESULTS + ", sm AS (SELECT run_id, count_if(uid LIKE 'model.%' AND status <> 'fail')::BIGINT AS models_passed, count_if(uid LIKE 'model.%' AND status = 'fail')::BIGINT AS models_failed, count_if(uid LIKE 'test.%' AND status <> 'fail')::BIGINT AS tests_passed, count_if(uid LIKE 'test.%' AND status = 'fail')::BIGINT AS tests_failed, array_to_string((list(uid || ': ' || trim(message) ORDER BY place) FILTER (status = 'fail'))[1:5], '; ') AS error_summary FROM res GROUP BY 1)"


def summaries(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the results of seven runs, as JSON documents."""
    k = F.col("o_orderkey")
    status = F.when(F.col("o_orderstatus") == "F", F.lit("success")).when(F.col("o_orderstatus") == "O", F.lit("PASS")).otherwise(F.lit("fail"))
    uid = F.concat(F.when(k % 3 == 0, F.lit("test.")).otherwise(F.lit("model.")), k.cast("string"))
    rows = views.table(spark, d, "orders").select(F.concat(F.lit("run-"), (k % 7).cast("string")).alias("run_id"), k.alias("place"), uid.alias("unique_id"), status.alias("status"), F.col("o_orderpriority").alias("message"))
    return quality.summarize(rows)


@query("run_results_summary", f"WITH {SUMMARY} SELECT run_id, models_passed, models_failed, tests_passed, tests_failed, error_summary FROM sm")
def run_results_summary(spark: SparkSession, d: str) -> DataFrame:
    return summaries(spark, d)


@query("run_results_documents", "SELECT 'nation-' || n_regionkey AS run_id, count_if(n_nationkey % 2 = 0)::BIGINT AS models_passed, 0::BIGINT AS models_failed, 0::BIGINT AS tests_passed, count_if(n_nationkey % 2 = 1)::BIGINT AS tests_failed, array_to_string((list('test.' || n_name || ': a message of two lines' ORDER BY n_name) FILTER (n_nationkey % 2 = 1))[1:5], '; ') AS error_summary FROM nation GROUP BY 1")
def run_results_documents(spark: SparkSession, d: str) -> DataFrame:
    even = F.col("n_nationkey") % 2 == 0
    one = F.struct(F.concat(F.when(even, F.lit("model.")).otherwise(F.lit("test.")), "n_name").alias("unique_id"), F.when(even, F.lit("success")).otherwise(F.lit("error")).alias("status"), F.lit("a message\nof two lines").alias("message"))
    runs = views.table(spark, d, "nation").groupBy(F.concat(F.lit("nation-"), F.col("n_regionkey").cast("string")).alias("run_id")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("results"))).alias("document"))
    return quality.run_results_summary(runs)


@query("quality_gate", f"WITH {SUMMARY} SELECT run_id, models_failed = 0 AS passed, CASE WHEN tests_failed > 0 THEN 'checks of ''silver'': ' || tests_failed || ' failed, ' || tests_passed || ' passed. ' || error_summary END AS alert FROM sm")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality_gate(summaries(spark, d), "silver")


