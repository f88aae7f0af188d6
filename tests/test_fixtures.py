"""Small cases with known answers, and properties that hold for any slicing."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions import aqi
from sensorjobs.functions import columns as fn
from sensorjobs.operators import dims, gold, silver, staging
from sensorjobs.plans import base, forecast, pipelines
from sensorjobs.sources import io

T = datetime


def repair_rows(spark, rows):
    return spark.createDataFrame([("s", c, t, v, T(2024, 1, 1), str(c)) for c, t, v in rows], "station_code string, cursor_id bigint, measured_at_parsed timestamp, is_measured_at_valid boolean, extracted_at timestamp, source_row_id string")


def test_time_repair(spark):
    rows = [(9, None, False), (10, T(2024, 1, 1), True), (11, T(2000, 1, 1), False), (13, None, False), (14, T(2024, 1, 1, 0, 20), True)]
    df = repair_rows(spark, rows)
    want = {9: (None, False, "unfixable_no_anchor"), 10: (T(2024, 1, 1), False, None), 11: (T(2024, 1, 1, 0, 5), True, "fiuna_id_5min"), 13: (T(2024, 1, 1, 0, 15), True, "fiuna_id_5min"), 14: (T(2024, 1, 1, 0, 20), False, None)}
    got = {r.cursor_id: (r.measured_at_silver, r.is_time_imputed, r.imputation_method) for r in silver.repair(df).collect()}
    assert got == want
    later = silver.carry_anchor(repair_rows(spark, [(15, None, False)]), silver.anchors(df)).first()
    assert later.measured_at_silver == T(2024, 1, 1, 0, 25)


def test_repair_in_slices_equals_full(spark, sf_dir):
    rows = views.measurements(spark, sf_dir)
    full = silver.repair(rows)
    cuts = [0, 300, 301, 700, 10**9]
    parts = []
    for a, b in zip(cuts, cuts[1:]):
        new = rows.filter((F.col("cursor_id") >= a) & (F.col("cursor_id") < b))
        parts.append(silver.carry_anchor(new, silver.anchors(rows.filter(F.col("cursor_id") < a))))
    sliced = parts[0]
    for p in parts[1:]:
        sliced = sliced.unionByName(p)
    c = ["source_row_id", "measured_at_silver", "imputation_method"]
    assert full.select(c).exceptAll(sliced.select(c)).count() == 0 and full.count() == sliced.count()


def test_block_carry_equals_running(spark, sf_dir):
    rows = views.measurements(spark, sf_dir)
    c = ["source_row_id", "last_valid_ts", "last_valid_cursor"]
    a, b = silver.running_last_valid(rows).select(c), silver.running_last_valid_blocks(rows, 7).select(c)
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("v, want", [(0.0, 0.0), (100.0, 100.0), (100.1, None), (-0.1, None)])
def test_validation(spark, v, want):
    df = spark.createDataFrame([("hum", v, T(2024, 1, 1))], "variable_code string, value_parsed double, measured_at_silver timestamp")
    assert silver.validate_values(df, views.rules(spark)).first().value_silver == want


def test_validation_without_rule_and_null(spark):
    df = spark.createDataFrame([("other", 5.0, T(2024, 1, 1)), ("hum", None, T(2024, 1, 1)), ("hum", 1.0, None)], "variable_code string, value_parsed double, measured_at_silver timestamp")
    got = {(r.variable_code, r.is_value_valid, r.value_silver) for r in silver.validate_values(df, views.rules(spark)).collect()}
    assert got == {("other", True, 5.0), ("hum", True, None)}


def test_aqi_edges(spark):
    cases = [(None, None), (-1.0, None), (0.0, 0), (12.0, 50), (12.05, 51), (12.1, 51), (35.4, 100), (55.4, 150), (150.4, 200), (250.4, 300), (350.4, 400), (500.4, 500), (600.0, 500)]
    df = spark.createDataFrame(cases, "x double, want int")
    assert df.filter(~aqi.aqi_pm25(F.col("x")).eqNullSafe(F.col("want"))).count() == 0
    ten = spark.createDataFrame([(54.0, 50), (55.0, 51), (154.0, 100), (604.0, 500), (605.0, 500)], "x double, want int")
    assert ten.filter(~aqi.aqi_pm10(F.col("x")).eqNullSafe(F.col("want"))).count() == 0
    levels = spark.createDataFrame([(-1, 1), (50, 1), (51, 2), (150, 3), (200, 4), (300, 5), (301, 6), (500, 6)], "x int, want int")
    assert levels.filter(~aqi.aqi_level(F.col("x")).eqNullSafe(F.col("want"))).count() == 0


def test_calibration(spark):
    f = spark.createDataFrame([("s", T(2024, 1, 1), T(2024, 3, 1), 0.5), ("s", T(2024, 2, 1), None, 0.8)], "station_code string, date_start timestamp, date_end timestamp, factor double")
    at = [(T(2023, 12, 31), None), (T(2024, 1, 15), 0.5), (T(2024, 2, 1), 0.8), (T(2024, 2, 15), 0.8), (T(2024, 4, 1), 0.8)]
    df = spark.createDataFrame([("s", t, w) for t, w in at], "station_code string, hour timestamp, want double")
    out = gold.calibration_asof(df, f)
    assert out.count() == 5 and out.filter(~F.col("factor").eqNullSafe(F.col("want"))).count() == 0


def test_grid_and_fill(spark):
    rows = [(1, T(2024, 1, 1, 1), 5.0), (1, T(2024, 1, 1, 3), None), (1, T(2024, 1, 1, 4), 7.0), (2, T(2024, 1, 1, 5), None), (2, T(2024, 1, 1, 6), 4.0)]
    df = spark.createDataFrame(rows, "station_id bigint, date_utc timestamp, x double")
    as_of = F.lit("2024-01-01 06:30:00").cast("timestamp")
    got = forecast.gap_fill(forecast.hourly_reindex(df, as_of), ["x"]).orderBy("station_id", "date_utc").collect()
    assert [r.x for r in got if r.station_id == 1] == [5, 5, 5, 7, 7, 7]
    assert [r.x for r in got if r.station_id == 2] == [4, 4]


def test_gate_scenarios(spark):
    end = T(2024, 1, 31, 12)
    hours = lambda first, n, skip=(): [end - timedelta(hours=first + k) for k in range(n) if k not in skip]
    plan = {1: hours(0, 24), 2: hours(720, 24), 3: hours(0, 24, range(5, 13)), 4: hours(8, 24)}
    df = spark.createDataFrame([(s, t, 1.0) for s, ts in plan.items() for t in ts], "station_id bigint, date_utc timestamp, x double")
    at = F.lit(str(end)).cast("timestamp")
    got = {r.station_id: (r.n_rows, r.status) for r in forecast.min_points_gate(forecast.station_window(df, at), ["x"]).collect()}
    assert got == {1: (24, "ready"), 3: (16, "skipped"), 4: (16, "skipped")}
    assert [r.station_id for r in forecast.candidate_stations(df, at).collect()] == [1, 3, 4]


def test_normalized_points():
    last = T(2024, 1, 1, 6)
    points = lambda raw: [(p["ts"], p["yhat"]) for p in forecast.normalize_points(raw, last, 6)]
    assert points([12.5, 13.1]) == [(T(2024, 1, 1, 7), 12.5), (T(2024, 1, 1, 8), 13.1)]
    assert points(4) == [(T(2024, 1, 1, 12), 4.0)] == points({"yhat": 4})
    assert points("x") == [(T(2024, 1, 1, 12), None)] == points([])
    assert points(pd.Series([1.4], index=[T(2024, 1, 2)])) == [(T(2024, 1, 2), 1.0)]
    assert points({"points": [{"ts": "2024-01-03T00:00:00Z", "yhat": 2}, 5]}) == [(T(2024, 1, 3), 2.0)]
    assert points(pd.DataFrame({"ts": ["2024-01-03"], "yhat": [3]})) == [(T(2024, 1, 3), 3.0)]


def test_missing_feature_column(spark):
    with pytest.raises(ValueError, match="x"):
        forecast.feature_frame(spark.createDataFrame([(1, "2024-01-01")], "station_id bigint, date_utc string"), ["x"], "station_id")


def test_parse_local_timestamp(spark):
    df = spark.createDataFrame([("1-2-2024", "9:05", "2024-02-01 12:05:00"), ("31-02-2024", "09:05", None), ("01-02-2024", None, None), (None, "1:00", None)], "d string, t string, want string")
    assert df.filter(~base.stamp(fn.parse_local_timestamp(F.col("d"), F.col("t"))).eqNullSafe(F.col("want"))).count() == 0


def test_unpivot_then_pivot_is_identity(spark, sf_dir):
    wide = views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit(None).cast("timestamp").alias("t"), "c_acctbal", F.col("c_nationkey").cast("double").alias("c_nation"))
    src = staging.Source("x", {"c_acctbal": "c_acctbal", "c_nation": "c_nation"}, station_code="id", measured_at="t", row_id="id", extracted_at="t", is_valid=None)
    back = staging.pivot_wide(staging.unpivot_measurements(wide, src), ["source_row_id"], ["c_acctbal", "c_nation"]).withColumnRenamed("source_row_id", "id")
    assert wide.drop("t").exceptAll(back.select("id", "c_acctbal", "c_nation")).count() == 0


def test_upsert_is_idempotent(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = io.upsert_by_key(t, b, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")] == sorted(map(tuple, io.upsert_by_key(once, b, ["k"]).collect()))


def test_read_raw_jdbc(spark):
    url = "jdbc:derby:memory:raw;create=true"
    rows = spark.range(100).selectExpr("id AS k", "CAST(id * 2 AS double) AS v")
    rows.write.jdbc(url, "readings", mode="overwrite")
    got = io.read_raw_jdbc(spark, url, "readings", "K", 0, 100, 4)
    assert got.rdd.getNumPartitions() == 4 and sorted(map(tuple, got.collect())) == [(k, 2.0 * k) for k in range(100)]


def test_silver_runs_are_idempotent(spark, sf_dir):
    """A run without new messages reads the newest ones again and changes nothing; the fact does not depend on the block size."""
    sources = pipelines.staged(spark, sf_dir)
    known, rules = pipelines.known_dims(spark, sources), views.rules(spark)
    cut = {n: rows.filter(F.col("extracted_at") < F.lit("2024-01-12").cast("timestamp")) for n, rows in sources.items()}
    once = pipelines.silver_step(cut, pipelines.REGISTRY, rules, known, None, 50)
    twice = pipelines.silver_step(cut, pipelines.REGISTRY, rules, known, once, 50)
    other = pipelines.silver_step(cut, pipelines.REGISTRY, rules, known)
    rows = lambda df: set(map(tuple, df.select("source_row_id", "stream_id", base.stamp("timestamp"), "value_parsed").collect()))
    assert rows(once.fact) == rows(twice.fact) == rows(other.fact) and once.fact.count() == twice.fact.count() > 0


def test_dedupe_does_not_depend_on_partitions(spark, sf_dir):
    rows = views.measurements(spark, sf_dir).select("station_code", "variable_code", "extracted_at", "source_row_id", "value_parsed")
    args = (["station_code", "variable_code"], ["extracted_at", "source_row_id"])
    a, b = (set(map(tuple, silver.dedupe_latest(rows.repartition(n), *args).collect())) for n in (1, 7))
    assert a == b and len(a) == rows.select("station_code", "variable_code").distinct().count()


@pytest.mark.parametrize("share", [1.0, 0.9, 0.15])
def test_rolling_by_day_equals_plain(spark, share):
    """Gaps, flat windows, nulls, several days without any row, and a value that no float holds exactly."""
    import random

    chance = random.Random(4)
    hours = [T(2024, 1, 1) + timedelta(hours=h) for h in range(24 * 8) if not 50 < h < 120]
    rows = [(s, h, 0.1 if s == "flat" else chance.choice([None, 0.1, 0.1, chance.uniform(0, 500)]), chance.choice([None, 7, chance.randint(0, 500)])) for s in ("a", "b", "flat") for h in hours if chance.random() < share]
    df = spark.createDataFrame(rows, "station_code string, hour timestamp, pm2_5 double, aqi_pm2_5 int")
    plain = {(r["station_code"], r["hour"]): r.asDict() for r in gold.rolling_24h(gold.rolling_6h(df)).collect()}
    got = gold.rolling_by_day(df)
    assert set(got.columns) == set(gold.rolling_24h(gold.rolling_6h(df)).columns) and got.count() == len(plain) == len(rows)
    for r in got.collect():
        want = plain[r["station_code"], r["hour"]]
        assert {c: None if v is None else pytest.approx(v, rel=1e-6, abs=1e-9) if isinstance(v, float) else v for c, v in want.items()} == r.asDict()
    assert all(r["pm2_5_std_6h"] == 0 and r["pm2_5_skew_6h"] is None for r in got.filter("station_code = 'flat'").collect())
    assert "Generate" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_station_without_any(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 80.0, 170.0)], "id bigint, lat double, lon double")
    s = spark.createDataFrame([("a", 0.1, 0.1), ("b", -0.1, -0.1), ("c", 50.0, 100.0)], "code string, slat double, slon double")
    assert {(r.id, r.nearest_code) for r in dims.nearest_station(p, s).collect()} == {(1, "a"), (2, "c")}
    assert {(r.id, r.nearest_code) for r in dims.nearest_station(p, s.filter("code = 'z'")).collect()} == {(1, None), (2, None)}


def test_aqi_rounds_half_even_on_exact_halves(spark):
    df = spark.createDataFrame([(0.5, 0), (1.5, 2)], "x double, want int")
    assert df.filter(~aqi.aqi_linear(F.col("x"), "0", "1", 0, 1).eqNullSafe(F.col("want"))).count() == 0


def test_rebuilt_library_needs_no_llm():
    import subprocess
    import sys

    code = "import sys; sys.modules['sensorjobs.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert len(e.queries()) > 90 and 'pipeline' not in e.queries()"
    assert subprocess.run([sys.executable, "-c", code], cwd=str(__import__("conftest").ROOT)).returncode == 0


def hourly_means(spark, groups, slices):
    """Hourly means of groups of values that stand in this order, in so many partitions."""
    rows = [(str(k), "pm25", "net", T(2024, 1, 1, 0, 5), v) for k, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "station_code string, variable_code string, data_source_name string, timestamp timestamp, value_parsed double")
    got = {r["station_code"]: r["value_avg"] for r in gold.hourly_avg(df).collect()}
    return [got[str(k)] for k in range(len(groups))]


def test_hourly_means_in_any_order_of_rows(spark):
    chance = random.Random(4)
    groups = [[round(chance.uniform(-100, 2000) / chance.choice([1, 50]), 2) for _ in range(n)] for n in range(1, 120)]
    want = [math.fsum(g) / len(g) for g in groups]
    for slices in (1, 3, 7):
        assert hourly_means(spark, groups, slices) == want
        for g in groups:
            chance.shuffle(g)


def test_hourly_means_of_odd_values(spark):
    inf, nan = math.inf, math.nan
    groups = [[None, None], [None, 0.1, None], [1e300, 2e300], [1e-300, 3e-300], [2.0**42, 2.0**42, 2.0**42 - 1], [-0.25, -(2.0**-60)], [inf, 1.0], [nan, 1.0], [inf, -inf], [1e12, 1e-12], [-5e12] * 3]
    want = [None, 0.1, 1.5e300, 2e-300, 2.0**42 - 1 / 3, -0.125, inf, nan, nan, (1e12 + 1e-12) / 2, -5e12]
    assert repr(hourly_means(spark, groups, 2)) == repr(want)
