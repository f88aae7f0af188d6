"""Per-station forecasts as one grouped job: window, gates, hourly grid, fill, model call, results, run header."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from functools import partial
from time import time as time_of_day
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorjobs.functions.columns import surrogate_key
from sensorjobs.operators.silver import dedupe_latest
from sensorjobs.plans.scoring import Model, Saved, Scorer, drift, persistence, windows  # noqa: F401  (models for tests and baselines)
from sensorjobs.sources.io import stored, upsert_keep_columns

MIN_POINTS = 18
WINDOW_HOURS = 24
HORIZONS = (6, 12)
POINT = "struct<ts:timestamp,yhat:double,yhat_lower:double,yhat_upper:double>"


def station_window(features: DataFrame, as_of: Column, hours: int = WINDOW_HOURS, time: str = "date_utc") -> DataFrame:
    """Rows in (as_of - hours, as_of], of all stations at once."""
    return features.filter((F.col(time) > as_of - F.expr(f"INTERVAL {hours} HOURS")) & (F.col(time) <= as_of))


def candidate_stations(features: DataFrame, as_of: Column, hours: int = WINDOW_HOURS, time: str = "date_utc") -> DataFrame:
    """Stations with a row in the window, in order."""
    return station_window(features, as_of, hours, time).select("station_id").distinct().orderBy("station_id")


def complete_rows(rows: DataFrame, required: Sequence[str]) -> DataFrame:
    """Rows without null or NaN in the required columns."""
    return rows.dropna(subset=list(required))


def min_points_gate(rows: DataFrame, required: Sequence[str], least: int = MIN_POINTS) -> DataFrame:
    """Per station: rows, complete rows, whether it is skipped, and the reason's code and detail."""
    whole = F.lit(True)
    for c in required:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    n = rows.groupBy("station_id").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(whole).alias("n_complete"))
    few, fewer = F.col("n_rows") < least, F.col("n_complete") < least
    code = F.when(few, F.lit("min_points")).when(fewer, F.lit("min_points_or_nulls"))
    detail = F.when(few, F.concat(F.lit("Rows in window: "), F.col("n_rows").cast("string"))).when(fewer, F.concat(F.lit("Rows after null filter: "), F.col("n_complete").cast("string")))
    return n.withColumns({"status": F.when(few | fewer, F.lit("skipped")).otherwise(F.lit("ready")), "reason_code": code, "reason_detail": detail})


def feature_frame(rows: DataFrame, columns: Sequence[str], tie: str, station: str = "station_id", time: str = "date_utc") -> DataFrame:
    """Typed feature rows, the last (greatest ``tie``) of each station and time.

    A missing column is an error at once; an unreadable feature becomes null, an unreadable station id fails the job.
    """
    missing = [c for c in (station, time, *columns) if c not in rows.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    typed = rows.select(F.col(station).cast("bigint").alias("station_id"), F.expr(f"try_cast({time} AS timestamp)").alias("date_utc"), *[F.expr(f"try_cast({c} AS double)").alias(c) for c in columns], F.col(tie).alias("__tie"))
    return dedupe_latest(typed.filter(F.col("date_utc").isNotNull()), ["station_id", "date_utc"], ["__tie"]).drop("__tie")


def hourly_reindex(frame: DataFrame, as_of: Column, time: str = "date_utc") -> DataFrame:
    """A row an hour from each station's first row to ``as_of``; rows off this grid drop out."""
    starts = frame.groupBy("station_id").agg(F.min(time).alias("__first")).filter(F.col("__first") <= as_of)
    grid = starts.select("station_id", F.explode(F.sequence(F.col("__first"), as_of, F.expr("INTERVAL 1 HOUR"))).alias(time))
    return grid.join(frame, ["station_id", time], "left")


def gap_fill(frame: DataFrame, columns: Sequence[str], time: str = "date_utc") -> DataFrame:
    """Forward, then backward fill of each column within its station."""
    w = Window.partitionBy("station_id").orderBy(time)
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    fill = {c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(future)) for c in columns}
    return frame.withColumns(fill)


def _number(x: Any) -> float | None:
    try:
        return None if x is None else float(x)
    except (TypeError, ValueError):
        return None


def normalize_points(raw: Any, last: datetime, horizon: int) -> list[dict[str, Any]]:
    """What a model returned, as points (ts, yhat, yhat_lower, yhat_upper).

    A series (also one that a forecasting library wraps and gives by ``pd_series()``) or frame brings its times; a list counts hours from the last one; a dict may hold points
    or one value; a scalar stands at the horizon. Unreadable values are null.
    """

    def point(ts: Any, *values: Any) -> dict[str, Any]:
        when = pd.to_datetime(ts, utc=True, errors="coerce")
        y = [_number(v) for v in (*values, None, None, None)[:3]]
        when = last + timedelta(hours=horizon) if pd.isna(when) else when.tz_localize(None).to_pydatetime()
        return {"ts": when, "yhat": y[0], "yhat_lower": y[1], "yhat_upper": y[2]}

    def of(item: dict[str, Any], ts: Any) -> dict[str, Any]:
        given = next((item[k] for k in ("ts", "date_utc", "timestamp") if item.get(k) is not None), ts)
        return point(given, item.get("yhat"), item.get("yhat_lower"), item.get("yhat_upper"))

    if callable(getattr(raw, "pd_series", None)):
        raw = raw.pd_series()
    match raw:
        case pd.Series():
            return [point(t, round(v, 0)) for t, v in raw.items()]
        case pd.DataFrame():
            return [of(item, None) for item in raw.to_dict("records")]
        case {"points": list(items)}:
            return [of(item, None) for item in items if isinstance(item, dict)]
        case dict():
            return [of(raw, last + timedelta(hours=horizon))]
        case list() | tuple():
            hours = [last + timedelta(hours=k + 1) for k in range(len(raw))]
            rows = [of(x, t) if isinstance(x, dict) else point(t, *(x if isinstance(x, list | tuple) else (x,))) for x, t in zip(raw, hours, strict=True)]
            return rows or [point(last + timedelta(hours=horizon))]
        case _:
            return [point(last + timedelta(hours=horizon), raw)]


#: Seconds that a model has for one station and horizon, and how often a station is tried.
DEADLINE, ATTEMPTS = 60.0, 2


def _points(raw: Any, frame: pd.DataFrame, horizon: int, time: str) -> list[dict[str, Any]]:
    return normalize_points(raw, frame[time].iloc[-1].to_pydatetime(), horizon)


def predict_window(frame: DataFrame, model: Model | Saved, horizons: Sequence[int] = HORIZONS, time: str = "date_utc", deadline: float = DEADLINE, attempts: int = ATTEMPTS) -> DataFrame:
    """(``station_id``, ``horizon``, ``points``, ``error``, ``seconds``): the model's points for every station's prepared window.

    Stations are dealt to tasks and come sorted; a task holds one station's window, which its hours bound, and asks a model that is
    made once for the task. A station's exception, a call over the deadline, or a model that ends its process becomes the
    station's error; the others go on.
    """

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with Scorer(model, partial(_points, time=time), deadline, attempts) as scorer:
            for rows in windows(batches, "station_id"):
                out = []
                for h in horizons:
                    began = time_of_day()
                    points, error = scorer.ask(rows, h)
                    out.append((rows["station_id"].iloc[0], h, points, error, time_of_day() - began))
                yield pd.DataFrame(out, columns=["station_id", "horizon", "points", "error", "seconds"])

    dealt = frame.repartition("station_id").sortWithinPartitions("station_id", time)
    return dealt.mapInPandas(run, f"station_id bigint, horizon int, points array<{POINT}>, error string, seconds double")


def storage_points(points: Column) -> Column:
    """Points as stored: value rounded half to even, time without zone in UTC to the second; null values are left out."""
    kept = F.filter(points, lambda p: p["yhat"].isNotNull())
    return F.transform(kept, lambda p: F.struct(F.rint(p["yhat"]).cast("int").alias("value"), F.date_format(p["ts"], "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp")))


def aqi_input_points(rows: DataFrame, time: str = "date_utc", column: str = "aqi_pm2_5") -> DataFrame:
    """Each station's index history in its window as stored points, nulls skipped."""
    p = F.struct(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), F.rint(column).cast("int").alias("value"))
    listed = F.array_sort(F.collect_list(F.when(F.col(column).isNotNull(), p)))
    return rows.groupBy("station_id").agg(F.transform(listed, lambda x: F.struct(x["value"].alias("value"), x["timestamp"].alias("timestamp"))).alias("aqi_input"))


#: Fixed value: the reason code of a station whose model raised an error.
FAILED = "exception"


@dataclass(frozen=True)
class Run:
    """What a run's header tells: its id and project, its parameters, the models' versions and paths, its start."""

    run_id: str
    project: str
    as_of: Column
    started_at: Column
    window_hours: int = WINDOW_HOURS
    min_points: int = MIN_POINTS
    model_6h_version: str = "unversioned"
    model_12h_version: str = "unversioned"
    model_6h_path: str | None = None
    model_12h_path: str | None = None
    flow_run_id: str = "local"
    deployment: str | None = None


def station_status(gate: DataFrame, predictions: DataFrame, run: Run, at: Column) -> DataFrame:
    """One row a station and run: success, skipped or failed; the reason's code and detail; whole seconds of the model calls."""
    calls = predictions.groupBy("station_id").agg(F.max("error").alias("error"), F.floor(F.sum("seconds")).cast("int").alias("duration_s"))
    failed = F.col("error").isNotNull()
    rows = gate.join(calls, "station_id", "left")
    return rows.select(
        surrogate_key(F.lit(run.project), F.lit(run.run_id), F.col("station_id")).alias("id"), F.lit(run.project).alias("project_code"), F.lit(run.run_id).alias("inference_run_id"), "station_id",
        F.when(F.col("status") == "skipped", F.lit("skipped")).when(failed, F.lit("failed")).otherwise(F.lit("success")).alias("status"),
        F.coalesce("reason_code", F.when(failed, F.lit(FAILED))).alias("reason_code"), F.coalesce("reason_detail", "error").alias("reason_detail"), "duration_s", at.alias("created_at"),
    )


def run_summary(status: DataFrame, run: Run, ended_at: Column) -> DataFrame:
    """The run's header with its totals by status. A failed station does not fail the run."""
    of = lambda s: F.count_if(F.col("status") == s)
    rows = status.agg(F.count(F.lit(1)).alias("stations_total"), of("success").alias("stations_success"), of("skipped").alias("stations_skipped"), of("failed").alias("stations_failed"))
    text = lambda x: F.lit(x).cast("string")
    return rows.select(
        F.lit(run.run_id).alias("id"), text(run.flow_run_id).alias("flow_run_id"), text(run.deployment).alias("deployment"), run.as_of.alias("as_of"), F.lit(run.window_hours).alias("window_hours"), F.lit(run.min_points).alias("min_points"),
        text(run.model_6h_version).alias("model_6h_version"), text(run.model_12h_version).alias("model_12h_version"), text(run.model_6h_path).alias("model_6h_path"), text(run.model_12h_path).alias("model_12h_path"),
        run.started_at.alias("started_at"), ended_at.alias("ended_at"), F.floor(F.unix_timestamp(ended_at) - F.unix_timestamp(run.started_at)).cast("int").alias("duration_s"),
        F.lit("success").alias("status"), "stations_total", "stations_success", "stations_skipped", "stations_failed", F.lit(None).cast("string").alias("error_summary"),
    )


def forecast_run(features: DataFrame, model: Model | Saved, run: Run, required: Sequence[str], at: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Results (forecast_6h, forecast_12h, aqi_input), station status and run header, all as of the time ``at``.

    The window and the predictions are written once; gates, results and status read them.
    """
    rows = stored(station_window(features, run.as_of, run.window_hours), "window")
    gate = min_points_gate(rows, required, run.min_points)
    ready = rows.join(gate.filter("status = 'ready'").select("station_id"), "station_id", "left_semi")
    columns = [c for c in ready.columns if c not in ("station_id", "date_utc")]
    prepared = stored(gap_fill(hourly_reindex(complete_rows(ready, required), run.as_of), columns), "prepared")
    predicted = stored(predict_window(prepared, model), "predicted")
    failed = predicted.filter("error IS NOT NULL").select("station_id").distinct()
    named = predicted.join(failed, "station_id", "left_anti").groupBy("station_id").agg(*[F.max(F.when(F.col("horizon") == h, F.to_json(storage_points(F.col("points"))))).alias(f"forecast_{h}h") for h in HORIZONS])
    inputs = aqi_input_points(prepared).withColumn("aqi_input", F.to_json("aqi_input"))
    results = named.join(inputs, "station_id").select(
        surrogate_key(F.lit(run.run_id), F.col("station_id")).alias("id"), F.lit(run.run_id).alias("inference_run_id"), "station_id", *[f"forecast_{h}h" for h in HORIZONS], "aqi_input", at.alias("created_at")
    )
    status = stored(station_status(gate, predicted, run, at), "status")
    return results, status, run_summary(status, run, at)


def persist_results(target: DataFrame, results: DataFrame) -> DataFrame:
    """The result table after a run: known (run, station) pairs keep id and creation time, their forecasts are replaced."""
    return upsert_keep_columns(target, results, ["inference_run_id", "station_id"], [*[f"forecast_{h}h" for h in HORIZONS], "aqi_input"])


def persist_status(target: DataFrame, status: DataFrame) -> DataFrame:
    """The status table after a run: known (project, run, station) rows keep id and creation time."""
    return upsert_keep_columns(target, status, ["project_code", "inference_run_id", "station_id"], ["status", "reason_code", "reason_detail", "duration_s"])


def persist_run(target: DataFrame, header: DataFrame) -> DataFrame:
    """The run table after a run has ended: its end, state and totals are set on the header written at its start."""
    return upsert_keep_columns(target, header, ["id"], ["ended_at", "duration_s", "status", "stations_total", "stations_success", "stations_skipped", "stations_failed", "error_summary"])
