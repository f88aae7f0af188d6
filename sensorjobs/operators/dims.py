"""Dimensions, bridges, streams, stations and regions: small tables, joined to each other and to facts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorjobs.functions.columns import bbox_text, surrogate_key
from sensorjobs.sources.io import stored


def dim_build(seed: DataFrame, key: Sequence[str], as_of: Column, id_column: str = "id") -> DataFrame:
    """A seed as a dimension: hashed id, its columns, created and updated times."""
    return seed.select(surrogate_key(*[F.col(k) for k in key]).alias(id_column), "*", as_of.alias("created_at"), as_of.alias("updated_at"))


def dim_build_with_parent(seed: DataFrame, parent: DataFrame, on: str, parent_key: str, parent_id: str, key: Sequence[str], as_of: Column) -> DataFrame:
    """A dimension with its parent's id; rows without a parent drop out."""
    lookup = parent.select(F.col(parent_key).alias("__p"), F.col(parent_id).alias(f"parent_{parent_id}"))
    joined = seed.join(lookup, F.col(on) == F.col("__p")).drop("__p")
    return dim_build(joined, key, as_of)


def bridge_build(mapping: DataFrame, left: DataFrame, left_on: str, left_key: str, right: DataFrame, right_on: str, right_key: str, names: tuple[str, str]) -> DataFrame:
    """Both sides of an n:m mapping as ids, with the bridge's own id."""
    a = left.select(F.col(left_key).alias("__l"), F.col("id").alias(names[0]))
    b = right.select(F.col(right_key).alias("__r"), F.col("id").alias(names[1]))
    rows = mapping.join(a, F.col(left_on) == F.col("__l")).join(b, F.col(right_on) == F.col("__r"))
    return rows.select(surrogate_key(F.col(names[0]), F.col(names[1])).alias("id"), *names)


def stream_candidates(long: DataFrame) -> DataFrame:
    """Each (station, variable, source) seen, with its latest extraction, code and name."""
    keys = ["station_code", "variable_code", "data_source_name"]
    return long.groupBy(*keys).agg(F.max("extracted_at").alias("last_extracted_at")).select(
        *keys, "last_extracted_at", F.concat_ws("_", *keys).alias("station_variable_source"), F.concat_ws(" / ", *keys).alias("stream_name")
    )


def stream_dim(candidates: DataFrame, stations: DataFrame, variables: DataFrame, sources: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Streams that are not known yet and whose station, variable and source are: hashed id and the three ids."""
    new = candidates
    if existing is not None:
        new = candidates.join(existing.select("station_variable_source"), "station_variable_source", "left_anti")
    s = stations.select(F.col("code").alias("station_code"), F.col("id").alias("station_id"))
    v = variables.select(F.col("code").alias("variable_code"), F.col("id").alias("variable_id"))
    d = sources.select(F.col("name").alias("data_source_name"), F.col("id").alias("data_source_id"))
    rows = new.join(s, "station_code").join(v, "variable_code").join(d, "data_source_name")
    return rows.select(
        surrogate_key(F.col("station_variable_source")).alias("stream_id"), "station_variable_source", "station_code", "variable_code", "data_source_name",
        "station_id", "variable_id", "data_source_id", "stream_name",
    )


def latest_per_key(rows: DataFrame, key: str, time: str, tie: str, condition: Column | None = None) -> DataFrame:
    """The newest row of each key (ties: greatest ``tie``) among those that meet the condition."""
    rest = [c for c in rows.columns if c != key]
    kept = rows if condition is None else rows.filter(condition)
    return kept.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(time, tie)).alias("__x")).select(key, "__x.*")


def station_candidates(static: DataFrame, geo: DataFrame) -> DataFrame:
    """Static stations and the latest valid position of every geolocated station (code, latitude, longitude, name, properties)."""
    placed = F.col("is_measured_at_valid") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    seen = latest_per_key(geo.select("station_code", "measured_at_parsed", "source_row_id", "latitude", "longitude", "description", "is_measured_at_valid"), "station_code", "measured_at_parsed", "source_row_id", placed)
    found = seen.select(
        F.col("station_code").alias("code"), F.coalesce("description", "station_code").alias("name"), "latitude", "longitude",
        F.to_json(F.struct(F.lit("AireLibre").alias("source"))).alias("properties"),
    )
    known = static.select("code", "name", "latitude", "longitude", "properties")
    return known.unionByName(found.join(known.select("code"), "code", "left_anti").select(*known.columns))


def project_scope(projects: DataFrame, bridge: DataFrame, streams: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """The streams of a project's sources, and the distinct stations of these."""
    sources = bridge.join(projects.filter(F.col("code") == code).select(F.col("id").alias("project_id")), "project_id", "left_semi").select("data_source_id")
    own = streams.join(sources, "data_source_id", "left_semi")
    return own, own.select("station_id", "station_code").distinct()


def dense_station_ids(stations: DataFrame) -> DataFrame:
    """Ids 1..n in code order. One window over a dimension of stations; never meant for facts."""
    w = Window.orderBy("code", "id")
    return stations.select(F.row_number().over(w).alias("project_station_id"), F.col("id").alias("core_station_id"), "code")


def regions_seed_or_generated(seed: DataFrame, stations: DataFrame) -> DataFrame:
    """The seeded regions if there are any, else one region a station with a box around it."""
    generated = stations.select(F.col("code").alias("region_code"), "name", bbox_text(F.col("latitude"), F.col("longitude")).alias("bbox"))
    rows = generated if seed.isEmpty() else seed.select("region_code", "name", "bbox")
    return rows.distinct()


def station_region_map(stations: DataFrame, seed: DataFrame, default: str) -> DataFrame:
    """Station to region by seed, else the default region."""
    lookup = seed.select(F.col("station_code").alias("__s"), F.col("region_code").alias("__r"))
    return stations.join(lookup, F.col("code") == F.col("__s"), "left").select(F.col("code").alias("station_code"), F.coalesce("__r", F.lit(default)).alias("region_code"))


def region_flags(regions: DataFrame, station_regions: DataFrame, weather_regions: DataFrame) -> DataFrame:
    """Regions with hashed id, ``has_weather_data`` and ``has_pattern_data`` (false without stations).

    ``station_regions`` has ``region_code`` and ``is_pattern_station``; ``weather_regions`` has ``region_code``.
    """
    pattern = station_regions.groupBy("region_code").agg(F.bool_or("is_pattern_station").alias("p"))
    weather = weather_regions.groupBy("region_code").agg(F.count(F.lit(1)).alias("w"))
    rows = regions.join(pattern, "region_code", "left").join(weather, "region_code", "left")
    return rows.select(
        surrogate_key(F.col("region_code")).alias("id"), "region_code", "name", "bbox",
        F.coalesce(F.col("w") > 0, F.lit(False)).alias("has_weather_data"), F.coalesce("p", F.lit(False)).alias("has_pattern_data"),
    )


def station_activity(stations: DataFrame, ids: DataFrame, region_map: DataFrame, latest: DataFrame, now: Column, name: Column) -> DataFrame:
    """Public station list; a station is on if it is active and has a reading of the last seven days before ``now``.

    ``latest`` has ``station_code`` and ``latest_reading_at``; ``name`` is the display name's column.
    """
    rows = stations.join(ids.select(F.col("core_station_id").alias("id"), "project_station_id"), "id")
    rows = rows.join(region_map.withColumnRenamed("station_code", "code"), "code", "left").join(latest.withColumnRenamed("station_code", "code"), "code", "left")
    fresh = F.coalesce(F.col("latest_reading_at") >= now - F.expr("INTERVAL 7 DAYS"), F.lit(False))
    return rows.select(
        F.col("project_station_id").alias("id"), name.alias("name"), "latitude", "longitude", surrogate_key(F.col("region_code")).alias("region_id"),
        ((F.col("status") == "active") & fresh).alias("is_station_on"), F.coalesce("is_pattern_station", F.lit(False)).alias("is_pattern_station"),
    )


def weather_station_list(stations: DataFrame, region_map: DataFrame) -> DataFrame:
    """Weather stations with their region's id."""
    rows = stations.join(region_map.withColumnRenamed("station_code", "code"), "code", "left")
    return rows.select("id", "code", "name", "latitude", "longitude", surrogate_key(F.col("region_code")).alias("region_id"))


#: Stations of a cell that is not split; bits of a cell number; bits that one round descends.
CELL_STATIONS, CELL_BITS, CELL_STEP = 16, 30, 2


def _position(column: str, low: float, width: float) -> Column:
    """The finest cell number of a coordinate."""
    most = (1 << CELL_BITS) - 1
    return F.greatest(F.lit(0), F.least(F.lit(most), F.floor((F.col(column) - low) / width * (most + 1)))).cast("bigint")


def quad_cells(stations: DataFrame, step: int = CELL_STEP) -> DataFrame:
    """The cells of a quad tree over placed stations (``sx``, ``sy``: finest cell numbers), every ``step`` levels.

    (``level``, ``x``, ``y``): how many stations a cell holds, and the box around them.
    """
    levels = F.explode(F.array(*[F.struct(F.lit(b).alias("level"), F.expr(f"sx >> {CELL_BITS - b}").alias("x"), F.expr(f"sy >> {CELL_BITS - b}").alias("y")) for b in range(0, CELL_BITS + 1, step)]))
    edges = [F.min("slat").alias("lat0"), F.max("slat").alias("lat1"), F.min("slon").alias("lon0"), F.max("slon").alias("lon1")]
    return stations.select("slat", "slon", levels.alias("c")).groupBy("c.level", "c.x", "c.y").agg(F.count(F.lit(1)).alias("n"), *edges)


def nearest_station(points: DataFrame, stations: DataFrame, most: int = CELL_STATIONS) -> DataFrame:
    """The nearest station (squared degrees, ties by code) of every point, left.

    ``points``: id (unique), lat, lon; ``stations``: code, slat, slon. Branch and bound over a quad tree of the stations: a point
    goes down from the root; of the cells it holds, those that lie farther away than some cell's farthest corner are left out.
    Cells of at most ``most`` stations are not split, so a point meets a few times ``most`` stations
    however unevenly they lie. Each round is written and the plans stay small. Cells are joined by their place; the few cells
    of the upper levels are sent to all tasks.
    """
    square = lambda c: c * c
    known = stations.filter("slat IS NOT NULL AND slon IS NOT NULL AND NOT isnan(slat) AND NOT isnan(slon)").groupBy("slat", "slon").agg(F.min("code").alias("code"))
    low = known.agg(F.min("slat"), F.min("slon"), F.max("slat"), F.max("slon")).first()
    placed = points.filter("lat IS NOT NULL AND lon IS NOT NULL AND NOT isnan(lat) AND NOT isnan(lon)")
    if low[0] is None:
        return points.select("id", F.lit(None).cast("string").alias("nearest_code"), F.lit(None).cast("double").alias("distance2"))
    width = max(low[2] - low[0], low[3] - low[1]) or 1.0
    where = stored(known.withColumns({"sx": _position("slat", low[0], width), "sy": _position("slon", low[1], width)}), "nearest-stations")
    cells = stored(quad_cells(where), "nearest-cells")

    def outside(c: str, a: str, b: str) -> Column:
        return F.greatest(F.col(a) - F.col(c), F.col(c) - F.col(b), F.lit(0.0))

    def farthest(c: str, a: str, b: str) -> Column:
        return F.greatest(F.abs(F.col(a) - F.col(c)), F.abs(F.col(b) - F.col(c)))

    near, far = (square(f("lat", "lat0", "lat1")) + square(f("lon", "lon0", "lon1")) for f in (outside, farthest))
    held, ends = placed.select("id", "lat", "lon", F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), F.lit(float("inf")).alias("reach")), []
    for level in range(0, CELL_BITS + 1, CELL_STEP):
        own = cells.filter(F.col("level") == level).drop("level")
        if level:
            parents = own.select("*", F.expr(f"x >> {CELL_STEP}").alias("px"), F.expr(f"y >> {CELL_STEP}").alias("py"))
        else:
            parents = own.select("*", F.col("x").alias("px"), F.col("y").alias("py"))
        # At most 4^6 cells.
        side = F.broadcast(parents) if level <= 6 else parents
        met = held.withColumnsRenamed({"x": "px", "y": "py"}).join(side, ["px", "py"]).withColumns({"near": near, "far": far})
        met = met.withColumn("reach", F.least("reach", F.min("far").over(Window.partitionBy("id")))).filter("near <= reach")
        met = stored(met.select("id", "lat", "lon", "x", "y", "n", "near", "reach"), "nearest-round")
        split = (F.col("n") > most) & F.lit(level + CELL_STEP <= CELL_BITS)
        ends.append(met.filter(~split).select("*", F.lit(level).alias("level")))
        held = met.filter(split).select("id", "lat", "lon", "x", "y", "reach")
        if held.isEmpty():
            break
    last = reduce(DataFrame.unionByName, ends)
    last = last.withColumn("reach", F.min("reach").over(Window.partitionBy("id"))).filter("near <= reach")
    used = sorted({level for level in range(0, len(ends) * CELL_STEP, CELL_STEP)})
    at = F.explode(F.array(*[F.struct(F.lit(b).alias("level"), F.expr(f"sx >> {CELL_BITS - b}").alias("x"), F.expr(f"sy >> {CELL_BITS - b}").alias("y")) for b in used]))
    leaves = cells.filter((F.col("n") <= most) | (F.col("level") == used[-1])).select("level", "x", "y")
    inside = where.select("code", "slat", "slon", at.alias("c")).select("code", "slat", "slon", "c.*").join(leaves, ["level", "x", "y"], "left_semi")
    d = square(F.col("lat") - F.col("slat")) + square(F.col("lon") - F.col("slon"))
    best = last.join(inside, ["level", "x", "y"]).groupBy("id").agg(F.min(F.struct(d.alias("d"), "code")).alias("b"))
    return points.select("id").join(best, "id", "left").select("id", F.col("b.code").alias("nearest_code"), F.col("b.d").alias("distance2"))


def anti_join_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of the left side without a partner."""
    return left.join(right.select(key), key, "left_anti")
