"""End-to-end jobs: staged sources to the silver fact, and the fact to the hourly marts.

Forecasts over the feature table are ``sensorjobs.plans.forecast.forecast_run``.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timedelta
from functools import reduce
from typing import Self

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs import views
from sensorjobs.functions.columns import surrogate_key
from sensorjobs.operators import dims, gold, silver, staging
from sensorjobs.plans import base
from sensorjobs.plans.base import query, r, rd, sk, stamp, ts
from sensorjobs.plans.ingest import GEO, RAW, raw_cursor, raw_geo, raw_weather
from sensorjobs.plans.marts import FEATURES, feature_columns
from sensorjobs.sources import io, versioned
from sensorjobs.sources.io import stored, upsert_by_key
from sensorjobs.sources.versioned import Version


@dataclass(frozen=True)
class Dimensions:
    """Stations (id, code), variables (id, code), sources (id, name)."""

    stations: DataFrame
    variables: DataFrame
    sources: DataFrame


def with_a_value(wide: DataFrame, source: staging.Source) -> DataFrame:
    """Messages with any value: the others have no row in the long form and must not anchor."""
    return wide.filter(reduce(lambda a, b: a | b, [F.expr(f"try_cast(`{c}` AS double)").isNotNull() for c in source.variables.values()]))


def long_of(fixed: DataFrame, source: staging.Source) -> DataFrame:
    """The long form of repaired messages. Times are repaired before the reshape: the sort then handles messages, not values."""
    return staging.unpivot_measurements(fixed, replace(source, measured_at="measured_at_silver")).withColumnRenamed("measured_at_parsed", "measured_at_silver")


def facts_of(long: DataFrame, rules: DataFrame, known: Dimensions) -> DataFrame:
    """Valid values of the long form by stream; ``long`` is a written table, it is read for the streams and for the values."""
    streams = dims.stream_dim(dims.stream_candidates(long), known.stations, known.variables, known.sources)
    return silver.silver_fact(silver.validate_values(long, rules), streams)


def build_silver(staged: Mapping[str, DataFrame], registry: Sequence[staging.Source], rules: DataFrame, known: Dimensions) -> DataFrame:
    """The silver fact from all messages, one row a stream and time."""
    parts = [long_of(silver.repair(with_a_value(staged[s.name], s)), s) for s in registry]
    long = stored(reduce(DataFrame.unionByName, parts), "long")
    return silver.dedupe_latest(facts_of(long, rules, known), FACT_KEY, FACT_ORDER)


FACT_KEY, FACT_ORDER = ["stream_id", "timestamp"], ["ingested_at", "source_row_id"]


@dataclass(frozen=True)
class Stored:
    """What one incremental run leaves for the next: watermarks and versions of tables, published together under a number.

    It can be loaded in any later session (``load``); a run that fails publishes nothing, and the next one starts from here.
    """

    spark: SparkSession
    folder: str
    number: int
    marks: Mapping[str, str]
    tables: Mapping[str, Version]

    @classmethod
    def load(cls, spark: SparkSession, folder: str, number: int | None = None) -> Self | None:
        """The state that was published last (or under a number); None if there is none."""
        number = versioned.latest_number(spark, folder) if number is None else number
        content = versioned.load(spark, folder, number)
        return None if content is None else cls(spark, folder, number, content["marks"], {n: Version(**v) for n, v in content["tables"].items()})

    @classmethod
    def publish(cls, spark: SparkSession, folder: str, marks: Mapping[str, str], tables: Mapping[str, Version]) -> Self:
        """Publish a run's state; batches that neither it nor the state before needs are deleted."""
        number = versioned.publish(spark, folder, {"marks": dict(marks), "tables": {n: asdict(v) for n, v in tables.items()}})
        before = cls.load(spark, folder, number - 1) if number > 1 else None
        for n, v in tables.items():
            versioned.drop_unused(spark, v.base, [v, *([before.tables[n]] if before else [])])
        return cls(spark, folder, number, marks, tables)

    def rows(self, name: str, only: Collection[str] | Callable[[str], bool] | None = None) -> DataFrame:
        """A table of the state, or some of its partitions."""
        return versioned.read(self.spark, self.tables[name], only)


class SilverState(Stored):
    """Tables of the silver job, each with the partition that its rows are found by.

    ``messages-<source>`` by part of the cursors (``part_of``): what may have to be repaired again. ``ends-<source>`` by part: the maxima of each
    station's block and the days its repaired times lie in. ``values`` by day: every valid value, also those that another of the same
    time hides. ``fact`` by day: one a stream and time.
    """

    @property
    def fact(self) -> DataFrame:
        return self.rows("fact").drop("day")


VALUE_KEY = ["source_row_id", "stream_id"]


@dataclass(frozen=True)
class Repaired:
    """What one source brings to a run: repaired messages, the days they may have had values in, its tables."""

    fixed: DataFrame
    days: set[str]
    tables: Mapping[str, Version]


def part_of(block: int) -> Column:
    """The partition of a block: ``silver.BLOCK`` cursors or one block, whichever is more, so that small blocks do not become as many folders."""
    return F.floor(F.col("block") / max(1, silver.BLOCK // block)).alias("part")


def repair_touched(spark: SparkSession, source: str, new: DataFrame, state: SilverState | None, folder: str, block: int) -> Repaired:
    """Repair the new messages of a cursor source, and again the older ones whose result may change.

    These are the messages of the (station, block) pairs that have new messages, and of the later blocks into which other
    maxima are carried than before; all others keep their times.
    """
    pair = ["station_code", "block"]
    mine, edge = f"messages-{source}", f"ends-{source}"
    part = part_of(block)
    cut = new.filter("cursor_id IS NOT NULL").withColumn("block", F.floor(F.col("cursor_id") / block)).withColumn("part", part)
    fresh = stored(cut, "silver-cursor")
    if state is None:
        messages = versioned.write(fresh, f"{folder}/{mine}", ["part"])
        ends = silver.block_ends(fresh, block)
        affected = stored(ends.select(*pair).join(silver.carried(ends), pair), "silver-affected")
        merged, days = ends, set()
    else:
        came = fresh.select(*pair).distinct()
        # States of earlier versions are partitioned by block.
        by = list(state.tables[mine].partition_by)
        messages = versioned.change(spark, state.tables[mine], fresh, ["source_row_id"], lambda old, new: upsert_by_key(old, new, ["source_row_id"])) if not fresh.isEmpty() else state.tables[mine]
        touched = versioned.read(spark, messages, versioned.partitions_of(came.withColumn("part", part), by)).join(came, pair, "left_semi")
        # One row a station and block: of the stations that have new messages.
        old = state.rows(edge).join(came.select("station_code").distinct(), "station_code", "left_semi")
        merged = stored(upsert_by_key(old.select(*pair, "ts", "cursor"), silver.block_ends(touched, block), pair), "silver-ends")
        was = silver.carried(old).select(*pair, F.col("carried_ts").alias("t"), F.col("carried_cursor").alias("c"), F.lit(True).alias("known"))
        now = silver.carried(merged).join(was, pair, "left").join(came.withColumn("came", F.lit(True)), pair, "left")
        other = F.col("came").isNotNull() | F.col("known").isNull() | ~(F.col("carried_ts").eqNullSafe(F.col("t")) & F.col("carried_cursor").eqNullSafe(F.col("c")))
        affected = stored(now.filter(other).select(*pair, "carried_ts", "carried_cursor"), "silver-affected")
        spans = old.join(affected.select(*pair), pair, "left_semi").filter("first_day IS NOT NULL")
        days = versioned.partitions_of(spans.select(F.explode(F.sequence("first_day", "last_day")).alias("day")), ["day"])
    again = versioned.read(spark, messages, versioned.partitions_of(affected.withColumn("part", part), list(messages.partition_by))).drop("part").join(affected, pair)
    fixed = stored(silver.impute_timestamps(silver.last_valid_in_blocks(again)), "silver-fixed")
    at = fixed.groupBy("station_code", F.floor(F.col("cursor_id") / block).alias("block")).agg(F.min(F.to_date("measured_at_silver")).alias("first_day"), F.max(F.to_date("measured_at_silver")).alias("last_day"))
    rows = merged.select(*pair, "ts", "cursor").join(at, pair).withColumn("part", part)
    if state is None:
        edges = versioned.write(rows, f"{folder}/{edge}", ["part"])
    elif affected.isEmpty():
        edges = state.tables[edge]
    else:
        rows = stored(rows, "silver-edges")
        edges = versioned.change(spark, state.tables[edge], rows, pair, lambda old, new: upsert_by_key(old, new, pair))
    io.discard(*[df for df in (fresh, affected, merged, rows) if hasattr(df, "_sensorjobs_path")])
    return Repaired(fixed, days, {mine: messages, edge: edges})


def silver_step(staged: Mapping[str, DataFrame], registry: Sequence[staging.Source], rules: DataFrame, known: Dimensions, state: SilverState | None = None, block: int = silver.BLOCK, folder: str | None = None) -> SilverState:
    """One incremental run: after any number of runs the fact is what one full build of all messages gives.

    New messages are those at or after the source's kept watermark (inclusive, so the newest ones are read again). A message may
    come late: see ``repair_touched``. Values that are gone or new are found by comparing what the messages
    repaired again gave before and give now; only days with such values are written, in ``values`` and in the fact.
    A source row id names one raw row that never changes, and is unique over all sources.
    """
    spark = known.stations.sparkSession
    folder = state.folder if state is not None else folder or io.scratch(spark, "silver")
    marks, tables = dict(state.marks) if state is not None else {}, {}
    parts, fixed, days, written = [], [], set(), []
    for s in registry:
        new = stored(io.read_since(with_a_value(staged[s.name], s), marks.get(s.name)), "silver-new")
        written.append(new)
        if (mark := io.newest(new)) is not None:
            marks[s.name] = mark
        plain = new
        if s.cursor_id is not None:
            done = repair_touched(spark, s.name, new, state, folder, block)
            tables |= done.tables
            days |= done.days
            written.append(done.fixed)
            fixed.append(done.fixed.select("source_row_id"))
            parts.append(long_of(done.fixed, s))
            plain = new.filter("cursor_id IS NULL")
        fixed.append(plain.select("source_row_id"))
        parts.append(long_of(silver.passthrough_timestamps(plain), s))
    long = stored(reduce(DataFrame.unionByName, parts), "silver-long")
    fresh = stored(facts_of(long, rules, known).withColumn("day", F.to_date("timestamp")), "silver-values")
    written += [long, fresh]
    if state is None:
        tables["values"] = versioned.write(fresh, f"{folder}/values", ["day"])
        tables["fact"] = versioned.write(silver.dedupe_latest(fresh, FACT_KEY, FACT_ORDER), f"{folder}/fact", ["day"])
    else:
        old = state.rows("values", days | versioned.partitions_of(fresh, ["day"])).join(reduce(DataFrame.unionByName, fixed).distinct(), "source_row_id", "left_semi")
        gone, came = stored(old.exceptAll(fresh), "silver-gone"), stored(fresh.exceptAll(old), "silver-came")
        both = gone.select(*FACT_KEY, "day").unionByName(came.select(*FACT_KEY, "day"))
        touched, keys = versioned.partitions_of(both, ["day"]), both.select(*FACT_KEY).distinct()
        written += [gone, came]
        tables |= {n: state.tables[n] for n in ("values", "fact")}
        if touched:
            kept = state.rows("values", touched).join(gone.select(*VALUE_KEY, "timestamp"), [*VALUE_KEY, "timestamp"], "left_anti")
            tables["values"] = versioned.rewrite(state.tables["values"], touched, kept.unionByName(came))
            best = silver.dedupe_latest(versioned.read(spark, tables["values"], touched).join(keys, FACT_KEY, "left_semi"), FACT_KEY, FACT_ORDER)
            tables["fact"] = versioned.rewrite(state.tables["fact"], touched, state.rows("fact", touched).join(keys, FACT_KEY, "left_anti").unionByName(best))
    out = SilverState.publish(spark, folder, marks, tables)
    io.discard(*written)
    return out


@dataclass(frozen=True)
class Marts:
    """Hourly marts of a project."""

    station_readings: DataFrame
    region_readings: DataFrame
    weather: DataFrame
    features: DataFrame


def build_gold(fact: DataFrame, factors: DataFrame, ids: DataFrame, regions: DataFrame, weather_regions: DataFrame) -> Marts:
    """The marts from a fact with codes (station_code, variable_code, data_source_name, timestamp, value_parsed).

    ``ids``: code, project_station_id; ``regions`` and ``weather_regions``: station_code, region_code of air-quality and weather stations.
    """
    hours = gold.hourly_avg(staging.variable_subset_filter(fact))
    wide = stored(staging.pivot_hourly(hours, gold.HOURLY_NAMES), "gold-hours")
    air = wide.join(regions.select("station_code"), "station_code", "left_semi")
    judged = stored(gold.station_hourly_aqi(gold.calibrate_pm(air, factors)), "gold-judged")
    readings = gold.station_readings(judged, ids)
    area = gold.region_readings(judged, regions)
    mapped = wide.join(weather_regions.select("station_code", surrogate_key(F.col("region_code")).alias("region_id")), "station_code")
    weather = gold.circular_wind(mapped)
    station_regions = ids.join(regions, ids["code"] == regions["station_code"]).select(F.col("project_station_id").alias("station_id"), surrogate_key(F.col("region_code")).alias("region_id"))
    return Marts(readings, area, weather, gold.features(readings, station_regions, area, weather))


#: Times of the marts.
MART_TIMES = {"station_readings": "date_localtime", "region_readings": "date_utc", "weather": "hour", "features": "date_utc"}


class GoldState(Stored):
    """The marts as stored tables, partitioned by day; the mark ``newest`` is the newest hour of the readings."""

    @property
    def marts(self) -> Marts:
        return Marts(*[self.rows(n).drop("day") for n in MART_TIMES])


def gold_step(fact: DataFrame, factors: DataFrame, ids: DataFrame, regions: DataFrame, weather_regions: DataFrame, state: GoldState | None = None, days: int = 2, folder: str | None = None) -> GoldState:
    """One incremental run of the marts.

    The last ``days`` before the newest hour are built again, for late facts. The facts of 23 hours more are
    read, for the windows that reach back (only these days' partitions, if the fact has the partition column ``day``); the
    rows from the slice's start on are replaced. Only the slice's days are written.
    """
    spark = ids.sparkSession
    folder = state.folder if state is not None else folder or io.scratch(spark, "gold")
    newest = None if state is None else state.marks.get("newest")
    start = None if newest is None else datetime.fromisoformat(newest) - timedelta(days=days)
    first = None if start is None else f"day={start.date()}"
    recent = fact if start is None else io.read_since(fact, str(start - timedelta(hours=23)), "timestamp", "day")
    fresh = build_gold(recent, factors, ids, regions, weather_regions)
    tables = {}
    for n, time in MART_TIMES.items():
        own = getattr(fresh, n).withColumn("day", F.to_date(time))
        if start is None:
            tables[n] = versioned.write(own, f"{folder}/{n}", ["day"])
            continue
        since = F.lit(str(start)).cast("timestamp")
        own = stored(own.filter(F.col(time) >= since), "gold-slice")
        again = {k for k in state.tables[n].parts if k >= first}
        kept = state.rows(n, again).filter(F.col(time) < since)
        tables[n] = versioned.rewrite(state.tables[n], again | versioned.partitions_of(own, ["day"]), kept.unionByName(own))
        io.discard(own)
    # The newest hour lies in the last partition.
    last = max(tables["station_readings"].parts, default=None)
    mark = io.newest(versioned.read(spark, tables["station_readings"], {last}), "date_localtime")
    return GoldState.publish(spark, folder, {"newest": mark} if mark is not None else {}, tables)


def _own(names: Mapping[str, str]) -> dict[str, str]:
    return {v: v for v in names}


REGISTRY = (
    staging.Source("cursor", _own(staging.CURSOR_VARIABLES), cursor_id="cursor_id"),
    staging.Source("geo", _own(staging.GEO_VARIABLES)),
    staging.Source("weather", _own(staging.WEATHER_VARIABLES)),
)

SILVER = RAW + ", " + GEO[GEO.index("g AS (") :] + """, cu AS (SELECT *, max(tm) OVER w AS lt, max(CASE WHEN tm IS NOT NULL THEN event_id END) OVER w AS lc FROM x WINDOW w AS (PARTITION BY station_code ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
al AS (SELECT 'cursor' AS ds, 'raw-' || event_id AS rid, 'fiuna_' || right(station_code, 1) AS sc, variable_code AS vc, v, ext, coalesce(tm, lt + (event_id - lc) * INTERVAL 5 MINUTE) AS st FROM cu
  UNION ALL SELECT 'geo', 'geo-' || event_id, 'airelibre_' || right(station_code, 1), 'pm1', v, ext, CASE WHEN tm >= TIMESTAMP '2018-01-01' THEN tm END FROM g
  UNION ALL SELECT 'geo', 'geo-' || event_id, 'airelibre_' || right(station_code, 1), 'pm25', v * 2, ext, CASE WHEN tm >= TIMESTAMP '2018-01-01' THEN tm END FROM g
  UNION ALL SELECT 'weather', 'met-' || event_id, 'met_1', 'temperature_c', v, ext, CASE WHEN event_id % 4 <> 0 THEN t END FROM m WHERE variable_code = 'temperature_c'
  UNION ALL SELECT 'weather', 'met-' || event_id, 'met_1', 'hum', v / 5, ext, CASE WHEN event_id % 4 <> 0 THEN t END FROM m WHERE variable_code = 'temperature_c' AND event_id % 3 = 0),
si AS (SELECT * FROM al WHERE st IS NOT NULL AND CASE vc WHEN 'hum' THEN v BETWEEN 0 AND 100 WHEN 'temperature_c' THEN v BETWEEN -100 AND 80 WHEN 'pm10' THEN v BETWEEN 0 AND 3000 ELSE v BETWEEN 0 AND 2000 END
  QUALIFY row_number() OVER (PARTITION BY ds, sc, vc, st ORDER BY ext DESC, rid DESC) = 1)"""


def staged(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The staged sources, written once by the day of extraction."""
    out = {}
    for k, v in _staged(spark, d).items():
        path = io.scratch(spark, "staged")
        v.withColumn("extracted_day", F.to_date("extracted_at")).write.partitionBy("extracted_day").parquet(path)
        out[k] = spark.read.parquet(path)
    return out


def _staged(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {"cursor": staging.stage_cursor_source(raw_cursor(spark, d)), "geo": staging.stage_geo_source(raw_geo(spark, d)), "weather": staging.stage_weather_source(raw_weather(spark, d), "met_1")}


def known_dims(spark: SparkSession, sources: Mapping[str, DataFrame]) -> Dimensions:
    codes = reduce(DataFrame.unionByName, [df.select(F.col("station_code").alias("code")) for df in sources.values()]).distinct()
    now = F.lit("2024-02-01").cast("timestamp")
    names = spark.createDataFrame([(s.name,) for s in REGISTRY], "name string")
    return Dimensions(dims.dim_build(codes, ["code"], now), dims.dim_build(views.rules(spark).select(F.col("variable_code").alias("code")), ["code"], now), dims.dim_build(names, ["name"], now))


FACT_ROWS = f"SELECT rid AS source_row_id, {sk('sc || ' + chr(39) + '_' + chr(39) + ' || vc || ' + chr(39) + '_' + chr(39) + ' || ds')} AS stream_id, {ts('st')} AS measured_at, {rd('v')} AS value_parsed, {ts('ext')} AS ingested_at FROM si"


def _rows(fact: DataFrame) -> DataFrame:
    return fact.select("source_row_id", "stream_id", stamp("timestamp").alias("measured_at"), r("value_parsed").alias("value_parsed"), stamp("ingested_at").alias("ingested_at"))


@query("silver_pipeline", f"WITH {SILVER} {FACT_ROWS}")
def silver_pipeline(spark: SparkSession, d: str) -> DataFrame:
    sources = staged(spark, d)
    return _rows(build_silver(sources, REGISTRY, views.rules(spark), known_dims(spark, sources)))


@query("silver_incremental", f"WITH {SILVER} {FACT_ROWS}")
def silver_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same fact from four runs on what had been extracted by then. Cursors do not come in the order of extraction,
    so every run has late messages of earlier blocks; blocks are small here."""
    sources = staged(spark, d)
    known = known_dims(spark, sources)
    state = None
    for cut in ("2024-01-06", "2024-01-15", "2024-01-16", "2100-01-01"):
        arrived = {n: rows.filter(F.col("extracted_at") < F.lit(cut).cast("timestamp")) for n, rows in sources.items()}
        state = silver_step(arrived, REGISTRY, views.rules(spark), known, state, 200)
    return _rows(state.fact)


W2 = ", w2 AS (SELECT " + base.sk("rc") + " AS region_id, hr, avg(temperature_c) AS temperature, avg(humidity) AS whum FROM w JOIN st ON st.code = w.station_code AND w.station_code = 'st_2' GROUP BY 1, 2)"
GOLD = base.READ + base.REG + W2 + ", fe AS (SELECT rd.*, rg.pavg, rg.pmax, rg.psk, rg.pstd, rg.aavg, rg.amax, rg.ask, rg.astd, rg.lmax, w2.temperature, w2.whum, NULL::DOUBLE AS pressure, NULL::DOUBLE AS wind_speed, NULL::DOUBLE AS wsin, NULL::DOUBLE AS wcos FROM rd LEFT JOIN rg ON rg.region_id = " + sk("rd.rc") + " AND rg.hr = rd.hr LEFT JOIN w2 ON w2.region_id = " + sk("rd.rc") + " AND w2.hr = rd.hr)"
GOLD_ROWS = f"WITH {GOLD} SELECT station_id, {ts('hr')} AS date_utc, {FEATURES} FROM fe"


def gold_inputs(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    own = base.stations(spark, d).select(F.col("code").alias("station_code"), "region_code")
    return views.factors(spark), base.station_ids(spark, d), own, own.filter("station_code = 'st_2'")


@query("gold_pipeline", GOLD_ROWS)
def gold_pipeline(spark: SparkSession, d: str) -> DataFrame:
    return feature_columns(build_gold(base.facts(spark, d), *gold_inputs(spark, d)).features)


@query("gold_incremental", GOLD_ROWS)
def gold_incremental(spark: SparkSession, d: str) -> DataFrame:
    """The same features from three runs; a fifth of the facts comes a day late, within the look-back."""
    facts = stored(base.facts(spark, d), "facts")
    late = F.expr("timestamp + CASE WHEN source_row_id % 5 = 0 THEN INTERVAL 24 HOURS ELSE INTERVAL 0 HOURS END")
    state = None
    for cut in ("2024-01-20 05:30:00", "2024-01-21 00:00:00", "2100-01-01 00:00:00"):
        state = gold_step(facts.filter(late < F.lit(cut).cast("timestamp")), *gold_inputs(spark, d), state)
    return feature_columns(state.marts.features)
