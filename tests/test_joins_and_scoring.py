"""As-of and nearest joins against brute force, and model calls that hang, die or fail."""

from __future__ import annotations

import os
import random
import time
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorjobs.operators import dims, gold
from sensorjobs.plans import base, forecast, scoring

T = datetime


def test_calibration_against_brute_force(spark):
    chance, start = random.Random(2), T(2024, 1, 1)
    hour = lambda: start + timedelta(minutes=30 * chance.randint(0, 48 * 9))
    factors = [(chance.choice("ab"), hour(), chance.choice([None, hour(), hour()]), float(k)) for k in range(25)]
    rows = [(k, chance.choice("abc"), chance.choice([None, hour(), hour(), hour()])) for k in range(400)]

    def want(code, at):
        held = [(s, f) for c, s, e, f in factors if c == code and at is not None and s <= at and (e is None or at < e)]
        return max(held)[1] if held else None

    f = spark.createDataFrame(factors, "station_code string, date_start timestamp, date_end timestamp, factor double")
    df = spark.createDataFrame(rows, "k int, station_code string, hour timestamp")
    out = gold.calibration_asof(df, f)
    assert {(r["k"], r["factor"]) for r in out.collect()} == {(k, want(c, t)) for k, c, t in rows}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__d#" in plan and "(station_code#" in plan
    assert gold.calibration_asof(df.limit(0), f).count() == 0
    assert gold.calibration_asof(df, f.limit(0)).filter("factor IS NULL").count() == 400


def test_calibration_joins_on_station_and_day(spark):
    f = spark.createDataFrame([("s", T(2024, 1, 1), None, 0.5)], "station_code string, date_start timestamp, date_end timestamp, factor double")
    df = spark.createDataFrame([("s", T(2024, 1, 15))], "station_code string, hour timestamp")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.calibration_asof(df, f)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [x for x in plan.splitlines() if "SortMergeJoin" in x and "LeftOuter" in x]
    assert joins and all("[station_code#" in x and "cast(hour#" in x for x in joins)


def places(kind, n, chance):
    if kind == "clustered":
        return [(round(chance.gauss(-25, 1e-4), 7), round(chance.gauss(-57, 1e-4), 7)) if chance.random() < 0.9 else (chance.uniform(-90, 90), chance.uniform(-180, 180)) for _ in range(n)]
    if kind == "grid":
        return [(float(chance.randint(0, 9)), float(chance.randint(0, 9))) for _ in range(n)]
    return [(chance.uniform(-90, 90), chance.uniform(-180, 180)) for _ in range(n)]


@pytest.mark.parametrize("kind", ["clustered", "grid", "even"])
def test_nearest_against_brute_force(spark, kind):
    chance = random.Random(7)
    stations = [(f"c{k:03d}", *p) for k, p in enumerate(places(kind, 300, chance))]
    points = [(k, *p) for k, p in enumerate(places(kind, 150, chance) + [(1e6, -1e6), (0.0, 0.0)])] + [(900, None, 1.0), (901, float("nan"), 1.0)]
    want = {}
    for k, a, b in points:
        best = None if a is None or a != a else min(((a - y) * (a - y) + (b - x) * (b - x), c) for c, y, x in stations)
        want[k] = best and (best[1], best[0])
    s = spark.createDataFrame([*stations, ("none", None, 0.0)], "code string, slat double, slon double")
    p = spark.createDataFrame(points, "id long, lat double, lon double")
    for most in (1, 4, 16):
        got = {r["id"]: (r["nearest_code"], r["distance2"]) if r["nearest_code"] else None for r in dims.nearest_station(p, s, most).collect()}
        assert got == want


def test_cells_are_split_by_occupancy(spark):
    """However the stations lie, a point meets only a few cells."""
    chance = random.Random(1)
    where = places("clustered", 2000, chance)
    s = spark.createDataFrame([(f"c{k}", *p) for k, p in enumerate(where)], "code string, slat double, slon double")
    low = (min(a for a, _ in where), min(b for _, b in where))
    width = max(max(a for a, _ in where) - low[0], max(b for _, b in where) - low[1])
    cells = dims.quad_cells(s.withColumns({"sx": dims._position("slat", low[0], width), "sy": dims._position("slon", low[1], width)}))
    totals = {r["level"]: r["n"] for r in cells.groupBy("level").agg(F.sum("n").alias("n")).collect()}
    assert set(totals.values()) == {2000}
    leaves = cells.filter(F.col("n") <= dims.CELL_STATIONS).count()
    assert leaves > 500 and cells.filter(F.col("level") == 30).agg(F.max("n")).first()[0] <= dims.CELL_STATIONS


def windows_of(spark, n=6):
    start = T(2024, 1, 1)
    rows = [(s, start + timedelta(hours=h), float(s * 10 + h)) for s in range(n) for h in range(4)]
    return spark.createDataFrame(rows, "station_id bigint, date_utc timestamp, aqi_pm2_5 double")


def outcome(df):
    return {(r["station_id"], r["horizon"]): ([p["yhat"] for p in r["points"]] if r["points"] is not None else None, r["error"]) for r in df.collect()}


def test_points_of_all_stations(spark):
    got = outcome(forecast.predict_window(windows_of(spark), forecast.drift, (2, 3)))
    assert got == {(s, h): ([s * 10 + 3.0 + k + 1 for k in range(h)], None) for s in range(6) for h in (2, 3)}


def test_a_model_that_hangs_or_dies_or_raises(spark):
    def model(rows, horizon):
        match int(rows["station_id"].iloc[0]):
            case 1:
                time.sleep(600)
            case 2:
                os._exit(3)
            case 3:
                raise ValueError("no model")
        return forecast.persistence(rows, horizon)

    began = time.perf_counter()
    got = outcome(forecast.predict_window(windows_of(spark).coalesce(1), model, (2,), deadline=1.0))
    assert time.perf_counter() - began < 60
    assert {k: e for (k, _), (_, e) in got.items()} == {0: None, 1: "no answer within 1 s", 2: "the model's process ended (exit code 3)", 3: "no model", 4: None, 5: None}
    assert got[5, 2][0] == [53.0, 53.0]


def test_a_station_is_tried_again(spark, tmp_path):
    mark = str(tmp_path / "died")

    def model(rows, horizon):
        if rows["station_id"].iloc[0] == 2 and not os.path.exists(mark):
            open(mark, "w").close()
            os._exit(9)
        return forecast.persistence(rows, horizon)

    assert all(e is None for _, e in outcome(forecast.predict_window(windows_of(spark), model, (1,))).values())
    os.remove(mark)
    once = outcome(forecast.predict_window(windows_of(spark), model, (1,), attempts=1))
    assert {s for (s, _), (_, e) in once.items() if e} == {2}


def test_a_dead_model_fails_its_station_only(spark):
    def model(rows, horizon):
        if rows["station_id"].iloc[0] == 1:
            os._exit(1)
        return forecast.persistence(rows, horizon)

    hours = [(s, T(2024, 1, 1) + timedelta(hours=h), 5.0) for s in (1, 2) for h in range(20)]
    features = spark.createDataFrame(hours, "station_id bigint, date_utc timestamp, aqi_pm2_5 double")
    run = forecast.Run("r", "p", F.lit("2024-01-01 19:00:00").cast("timestamp"), F.lit("2024-01-02").cast("timestamp"))
    results, status, summary = forecast.forecast_run(features, model, run, ["aqi_pm2_5"], F.lit("2024-01-02").cast("timestamp"))
    assert [r["station_id"] for r in results.collect()] == [2]
    assert {r["station_id"]: (r["status"], r["reason_code"]) for r in status.collect()} == {1: ("failed", "exception"), 2: ("success", None)}
    assert tuple(summary.select("stations_total", "stations_success", "stations_failed").first()) == (2, 1, 1)


def test_saved_models(spark, tmp_path):
    path = str(tmp_path / "model")
    model = scoring.Saved("linear", {"weights": {"aqi_pm2_5": 2.0}, "intercept": 1.0, "by_hour": 0.5}, "v7")
    scoring.save_model(spark, model, path)
    assert scoring.read_model(spark, path) == model
    got = outcome(forecast.predict_window(windows_of(spark), scoring.read_model(spark, path), (2,)))
    assert got == {(s, 2): ([1 + 2 * (s * 10 + 3) + 0.5, 1 + 2 * (s * 10 + 3) + 1.0], None) for s in range(6)}
    scoring.save_model(spark, scoring.Saved("other"), path)
    with pytest.raises(ValueError, match="unknown kind"):
        scoring.read_model(spark, path)
    assert scoring.made(model.text()) is scoring.made(model.text())


def test_wrapped_series():
    class Wrapped:
        def pd_series(self):
            return pd.Series([1.4, 2.6], index=[T(2024, 1, 2), T(2024, 1, 3)])

    points = forecast.normalize_points(Wrapped(), T(2024, 1, 1), 6)
    assert [(p["ts"], p["yhat"]) for p in points] == [(T(2024, 1, 2), 1.0), (T(2024, 1, 3), 3.0)]


def test_windows_of_sorted_batches():
    frames = [pd.DataFrame({"k": k, "v": range(len(k))}) for k in ([1, 1], [1, 2], [2], [2, 3, 4])]
    assert [(f["k"].iloc[0], len(f)) for f in scoring.windows(frames, "k")] == [(1, 3), (2, 3), (3, 1), (4, 1)]


def test_events_are_not_broadcast_to_find_their_region(spark, sf_dir):
    """The stations are sent, whatever Spark takes their size for; the events stay in the order of their file."""
    plan = base.weather(spark, sf_dir)._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(plan) if "BroadcastHashJoin" in line)
    sent = next(k for k, line in enumerate(plan[at:], at) if "BroadcastExchange" in line)
    scans = [line for line in plan if "FileScan" in line]
    assert "BuildRight" in plan[at] and "event_type" in next(line for line in plan[at:sent] if "FileScan" in line) and sum("event_type" in line for line in scans) == 1
