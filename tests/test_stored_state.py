"""Stored tables and the state of incremental jobs: what a run touches, what a failed run leaves, what a new session finds."""

from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.operators import silver
from sensorjobs.plans import base, pipelines
from sensorjobs.sources import io, versioned


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def files_of(df):
    return set(df.inputFiles())


@pytest.fixture
def days(spark):
    rows = [(k, f"2024-01-{1 + k % 5:02d}", f"v{k}") for k in range(50)]
    return spark.createDataFrame(rows, "k long, day string, v string").withColumn("day", F.col("day").cast("date"))


def test_merge_touches_only_the_batch_partitions(spark, days, tmp_path):
    path = str(tmp_path / "t")
    io.full_rebuild(days, path, ["day"])
    before = files_of(io.read_table(spark, path))
    batch = spark.createDataFrame([(1, "new"), (101, "more")], "k long, v string").withColumn("day", F.lit("2024-01-02").cast("date"))
    io.merge_into(path, batch, ["k"])
    after = files_of(io.read_table(spark, path))
    assert {f for f in before & after} == {f for f in before if "day=2024-01-02" not in f}
    assert all("day=2024-01-02" in f for f in after - before)
    want = rows_of(io.upsert_by_key(days, batch.select(*days.columns), ["k"]))
    assert rows_of(io.read_table(spark, path).select(*days.columns)) == want
    io.merge_into(path, batch, ["k"])
    assert rows_of(io.read_table(spark, path).select(*days.columns)) == want
    assert rows_of(io.read_table(spark, path, number=2).select(*days.columns)) == want


def test_merge_of_moved_rows_and_of_named_columns(spark, days, tmp_path):
    path = str(tmp_path / "t")
    io.full_rebuild(days, path, ["day"])
    moved = spark.createDataFrame([(1, "moved")], "k long, v string").withColumn("day", F.lit("2024-02-01").cast("date"))
    io.merge_into(path, moved, ["k"], moving=True)
    got = io.read_table(spark, path).filter("k = 1").collect()
    assert [(str(r["day"]), r["v"]) for r in got] == [("2024-02-01", "moved")] and io.read_table(spark, path).count() == 50
    again = spark.createDataFrame([(2, "x", "2024-01-03"), (200, "y", "2024-01-03")], "k long, v string, day string").withColumn("day", F.col("day").cast("date"))
    io.merge_into(path, again, ["k", "day"], updated=["v"])
    assert {r["k"]: r["v"] for r in io.read_table(spark, path).filter("v IN ('x', 'y')").collect()} == {2: "x", 200: "y"}


def test_null_and_unfit_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, "a")], "k long, p string")
    io.full_rebuild(df, path, ["p"])
    io.merge_into(path, spark.createDataFrame([(1, None), (3, None)], df.schema), ["k"])
    assert rows_of(io.read_table(spark, path).select("k", "p")) == [(1, None), (2, "a"), (3, None)]
    with pytest.raises(ValueError, match="cannot name"):
        io.merge_into(path, spark.createDataFrame([(4, "a/b")], df.schema), ["k"])


def test_a_failed_rebuild_leaves_the_table(spark, days, tmp_path):
    path = str(tmp_path / "t")
    io.full_rebuild(days, path, ["day"])
    broken = days.withColumn("v", F.when(F.col("k") == 37, F.raise_error(F.lit("stop"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="stop"):
        io.full_rebuild(broken, path, ["day"])
    with pytest.raises(Exception, match="stop"):
        io.merge_into(path, broken, ["k"])
    assert rows_of(io.read_table(spark, path).select(*days.columns)) == rows_of(days)
    io.full_rebuild(days.filter("k < 10"), path, ["day"])
    assert io.read_table(spark, path).count() == 10 and io.read_table(spark, path, number=1).count() == 50


def test_only_one_of_two_writers_publishes(spark, days, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    io.full_rebuild(days, path)
    monkeypatch.setattr(versioned, "latest_number", lambda *_: None)
    with pytest.raises(Exception, match="(?i)exist"):
        versioned.publish(spark, path, {})


def test_empty_tables(spark, days, tmp_path):
    path = str(tmp_path / "t")
    io.full_rebuild(days.limit(0), path, ["day"])
    assert io.read_table(spark, path).count() == 0
    io.merge_into(path, days, ["k"])
    assert io.read_table(spark, path).count() == 50
    with pytest.raises(FileNotFoundError):
        io.read_table(spark, str(tmp_path / "none"))


def test_watermark_prunes_partitions(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    rows = views.measurements(spark, sf_dir).withColumn("extracted_day", F.to_date("extracted_at"))
    rows.write.partitionBy("extracted_day").parquet(path)
    source, old = spark.read.parquet(path), rows.filter("extracted_at < '2024-01-20'")
    since = io.read_since(source, io.newest(old))
    plan = since._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(extracted_day" in plan and "PushedFilters: [IsNotNull(extracted_at)" in plan
    assert rows_of(since.select("source_row_id")) == rows_of(io.incremental_read(rows, old).select("source_row_id"))
    assert io.read_since(source, None).count() == source.count()


def test_no_window_by_station_alone(spark, sf_dir):
    rows = views.measurements(spark, sf_dir)
    for df in (silver.repair(rows, 50), silver.carry_anchor(rows, silver.anchors(rows.limit(5)), 50)):
        lines = [x for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
        assert lines and all("[station_code#" not in x or ", block#" in x or ", g#" in x for x in lines)


def test_carried_maxima_over_groups_of_blocks(spark):
    ends = [("s", b, b * 7 % 11, b * 5 % 13) for b in range(-3, 40) if b % 4] + [("t", 5, None, None), ("t", 9, 1, None), ("t", 10, 0, 2)]
    df = spark.createDataFrame(ends, "station_code string, block long, ts long, cursor long")
    want = set()
    for s, b, _, _ in ends:
        before = [e for e in ends if e[0] == s and e[1] < b]
        want.add((s, b, max((e[2] for e in before if e[2] is not None), default=None), max((e[3] for e in before if e[3] is not None), default=None)))
    for per in (1, 3, 256):
        assert set(map(tuple, silver.carried(df, per).collect())) == want


CUTS = ("2024-01-06", "2024-01-15", "2024-01-15", "2100-01-01")


def test_silver_state_in_new_sessions(spark, sf_dir, tmp_path):
    """Each run loads the state in a session of its own; it writes only days and blocks that change, and ends at the full build."""
    sources, folder = pipelines.staged(spark, sf_dir), str(tmp_path / "silver")
    known, rules = pipelines.known_dims(spark, sources), views.rules(spark)
    kept = None
    for k, cut in enumerate(CUTS):
        arrived = {n: rows.filter(F.col("extracted_at") < F.lit(cut).cast("timestamp")) for n, rows in sources.items()}
        state = pipelines.SilverState.load(spark.newSession(), folder)
        assert (state is None) == (k == 0)
        new = pipelines.silver_step(arrived, pipelines.REGISTRY, rules, known, state, 50, folder)
        if state is not None:
            changed = {n: {p for p in new.tables[n].parts.keys() | state.tables[n].parts.keys() if new.tables[n].parts.get(p) != state.tables[n].parts.get(p)} for n in new.tables}
            same = files_of(new.rows("fact")) & files_of(state.rows("fact"))
            assert len(same) > 0 and changed["fact"] <= changed["values"]
            if CUTS[k - 1] == cut:
                assert changed["fact"] == changed["values"] == set()
            else:
                old = state.tables["fact"].parts.keys()
                assert 2 * len(old - changed["fact"]) > len(old) and changed["fact"] - old
        kept = new
    full = pipelines.build_silver(sources, pipelines.REGISTRY, rules, known)
    assert rows_of(kept.fact.select(*full.columns)) == rows_of(full)
    assert kept.number == len(CUTS) and pipelines.SilverState.load(spark, folder).marks == kept.marks


def test_small_blocks_share_folders(spark, sf_dir):
    sources = pipelines.staged(spark, sf_dir)
    state = pipelines.silver_step({n: rows.filter("extracted_at < '2024-01-03'") for n, rows in sources.items()}, pipelines.REGISTRY, views.rules(spark), pipelines.known_dims(spark, sources), None, 2)
    assert state.rows("ends-cursor").select("block").distinct().count() > 10
    assert len(state.tables["messages-cursor"].parts) == len(state.tables["ends-cursor"].parts) == 1


def test_a_failed_silver_run_leaves_the_state(spark, sf_dir, tmp_path):
    sources, folder = pipelines.staged(spark, sf_dir), str(tmp_path / "silver")
    known, rules = pipelines.known_dims(spark, sources), views.rules(spark)
    cut = {n: rows.filter("extracted_at < '2024-01-12'") for n, rows in sources.items()}
    before = pipelines.silver_step(cut, pipelines.REGISTRY, rules, known, None, 50, folder)
    want = rows_of(before.fact)
    broken = dict(sources, weather=sources["weather"].withColumn("temperature_c", F.when(F.col("extracted_at") > "2024-01-20", F.raise_error(F.lit("stop")).cast("string")).otherwise(F.col("temperature_c"))))
    with pytest.raises(Exception, match="stop"):
        pipelines.silver_step(broken, pipelines.REGISTRY, rules, known, before, 50)
    again = pipelines.SilverState.load(spark, folder)
    assert again.number == before.number and rows_of(again.fact) == want
    done = pipelines.silver_step(sources, pipelines.REGISTRY, rules, known, again, 50)
    full = pipelines.build_silver(sources, pipelines.REGISTRY, rules, known)
    assert rows_of(done.fact.select(*full.columns)) == rows_of(full)


def test_gold_runs_write_their_slice(spark, sf_dir, tmp_path):
    facts = io.stored(base.facts(spark, sf_dir).withColumn("day", F.to_date("timestamp")), "facts")
    inputs, folder = pipelines.gold_inputs(spark, sf_dir), str(tmp_path / "gold")
    first = pipelines.gold_step(facts.filter("timestamp < '2024-01-20 05:30:00'"), *inputs, None, 2, folder)
    second = pipelines.gold_step(facts, *inputs, pipelines.GoldState.load(spark.newSession(), folder))
    for name, version in first.tables.items():
        old = {k for k in version.parts if k < "day=2024-01-18"}
        assert old and {k: version.parts[k] for k in old} == {k: second.tables[name].parts[k] for k in old}
        assert not {k for k in version.parts if k >= "day=2024-01-18" and second.tables[name].parts.get(k) == version.parts[k]}
    full = pipelines.build_gold(facts, *inputs)
    c = ["station_id", "date_utc", "pm2_5", "aqi_pm2_5_max_24h", "level_region_max"]
    assert rows_of(second.marts.features.select(*c)) == rows_of(full.features.select(*c))


def test_unused_batches_go(spark, days, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        io.full_rebuild(days.withColumn("v", F.lit(str(k))), path, ["day"])
    assert len(list((tmp_path / "t" / "data").iterdir())) == 2
    assert reduce(DataFrame.unionByName, [io.read_table(spark, path, number=n).select("v").distinct() for n in (3, 4)]).count() == 2
