"""Hourly marts: star join, hourly means, calibration, indices, rolling statistics, regions, weather, features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorjobs.functions.aqi import aqi_pm10, aqi_pm25, overall_level
from sensorjobs.functions.columns import key_time, steady_avg, surrogate_key

HOUR = 3600


def star_join(fact: DataFrame, streams: DataFrame, stations: DataFrame, variables: DataFrame, sources: DataFrame) -> DataFrame:
    """The fact with the codes of its stream, station, variable and source, all inner.

    The dimensions are joined without a forced broadcast: Spark sends those below its size limit.
    """
    out = fact.join(streams.select("stream_id", "station_id", "variable_id", "data_source_id"), "stream_id")
    out = out.join(stations.select(F.col("id").alias("station_id"), F.col("code").alias("station_code")), "station_id")
    out = out.join(variables.select(F.col("id").alias("variable_id"), F.col("code").alias("variable_code")), "variable_id")
    return out.join(sources.select(F.col("id").alias("data_source_id"), F.col("name").alias("data_source_name")), "data_source_id")


def hourly_avg(rows: DataFrame, time: str = "timestamp", value: str = "value_parsed") -> DataFrame:
    """Mean of every station, variable, source and hour; it does not depend on the order of the rows."""
    return rows.groupBy("station_code", "variable_code", "data_source_name", F.date_trunc("hour", time).alias("hour")).agg(steady_avg(F.col(value)).alias("value_avg"))


def disjoint_factors(factors: DataFrame) -> DataFrame:
    """Factor intervals cut so that none overlap: at every time the factor with the latest start that still holds.

    Starts and ends of a station are its cut points; each elementary interval takes the latest start
    that covers it. Factor tables are small; a fact then needs a range join without a top-1 per row.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp")
    f = factors.select("station_code", F.col("date_start").alias("s"), F.coalesce("date_end", far).alias("e"), "factor").filter("s < e")
    cuts = f.select("station_code", F.explode(F.array("s", "e")).alias("a")).distinct()
    parts = cuts.withColumn("b", F.lead("a").over(Window.partitionBy("station_code").orderBy("a"))).filter("b IS NOT NULL")
    held = parts.join(f, "station_code").filter((F.col("s") <= F.col("a")) & (F.col("b") <= F.col("e")))
    return held.groupBy("station_code", "a", "b").agg(F.max_by("factor", F.struct("s", "factor")).alias("factor")).select("station_code", F.col("a").alias("starts"), F.col("b").alias("ends"), "factor")


def factors_by_day(factors: DataFrame, days: DataFrame) -> DataFrame:
    """``disjoint_factors`` with a row for each ``day`` that an interval touches, between the first and last of ``days`` (one row)."""
    cut = disjoint_factors(factors).crossJoin(days)
    first, last = F.greatest(F.to_date("starts"), F.col("first_day")), F.least(F.to_date("ends"), F.col("last_day"))
    return cut.filter(first <= last).select("station_code", "starts", "ends", "factor", F.explode(F.sequence(first, last)).alias("day"))


def calibration_asof(rows: DataFrame, factors: DataFrame, time: str = "hour") -> DataFrame:
    """``factor`` of the interval that holds at the row's time, latest start first; null without one.

    The join is on station and day: a station with much data is spread over its days, and a row meets only the
    intervals of its day. ``rows`` are also read for their first and last day, so they should be a written table.
    """
    day = F.to_date(time)
    days = rows.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    cut = factors_by_day(factors, days).withColumnsRenamed({"station_code": "__s", "day": "__d"})
    on = (F.col("station_code") == F.col("__s")) & (day == F.col("__d")) & (F.col("starts") <= F.col(time)) & (F.col(time) < F.col("ends"))
    return rows.join(cut, on, "left").drop("__s", "__d", "starts", "ends")


def calibrate_pm(rows: DataFrame, factors: DataFrame, columns: tuple[str, ...] = ("pm1", "pm2_5", "pm10"), time: str = "hour") -> DataFrame:
    """Particle columns times the factor, where one holds; ``pm_calibrated`` tells."""
    out = calibration_asof(rows, factors, time)
    f = F.coalesce(F.col("factor"), F.lit(1.0))
    return out.withColumns({**{c: F.col(c) * f for c in columns}, "pm_calibrated": F.col("factor").isNotNull()}).drop("factor")


def station_hourly_aqi(rows: DataFrame) -> DataFrame:
    """Both indices and the level of the greater one."""
    out = rows.withColumns({"aqi_pm2_5": aqi_pm25(F.col("pm2_5")), "aqi_pm10": aqi_pm10(F.col("pm10"))})
    return out.withColumn("aqi_level", overall_level(F.col("aqi_pm2_5"), F.col("aqi_pm10")))


def _range(time: str, key: str, hours: int):
    return Window.partitionBy(key).orderBy(F.unix_timestamp(time)).rangeBetween(-hours * HOUR, 0)


def _skew(value: Column, w) -> Column:
    """Population skewness over a window, from central moments (raw ones lose all digits on a nearly flat window); null if flat."""
    return F.skewness(value.cast("double")).over(w)


def rolling_6h(rows: DataFrame, time: str = "hour", key: str = "station_code") -> DataFrame:
    """Mean, maximum, deviation and skewness of PM2.5 over the last six hours."""
    w = _range(time, key, 5)
    v = F.col("pm2_5")
    return rows.withColumns({"pm2_5_avg_6h": F.avg(v).over(w), "pm2_5_max_6h": F.max(v).over(w), "pm2_5_std_6h": F.stddev_pop(v).over(w), "pm2_5_skew_6h": _skew(v, w)})


def rolling_24h(rows: DataFrame, time: str = "hour", key: str = "station_code") -> DataFrame:
    """Maximum, deviation and skewness of the PM2.5 index over the last 24 hours."""
    w = _range(time, key, 23)
    v = F.col("aqi_pm2_5")
    return rows.withColumns({"aqi_pm2_5_max_24h": F.max(v).over(w), "aqi_pm2_5_std_24h": F.stddev_pop(v).over(w), "aqi_pm2_5_skew_24h": _skew(v, w)})


def _moments(value: Column, w) -> Column:
    """Of the values of a frame: count, sum, second and third central moments (times the count), least and greatest."""
    v = value.cast("double")
    n = F.count(v).over(w)
    m2 = F.coalesce(F.var_pop(v).over(w) * n, F.lit(0.0))
    m3 = F.coalesce(F.skewness(v).over(w) * F.pow(m2, F.lit(1.5)) / F.sqrt(F.nullif(n, F.lit(0))), F.lit(0.0))
    return F.struct(n.alias("n"), F.coalesce(F.sum(v).over(w), F.lit(0.0)).alias("s"), m2.alias("m2"), m3.alias("m3"), F.min(value).over(w).alias("lo"), F.max(value).over(w).alias("hi"))


def _merged(rows: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """``rows`` with the moments of two disjoint frames ``a`` and ``b`` (null: none) in one."""
    of = lambda c, f: F.coalesce(F.col(f"{c}.{f}"), F.lit(0))
    na, nb, some = of(a, "n"), of(b, "n"), F.nullif(of(a, "n") + of(b, "n"), F.lit(0))
    mean = lambda c: F.col(f"{c}.s") / F.nullif(F.col(f"{c}.n"), F.lit(0))
    rows = rows.withColumn("__d", F.coalesce(mean(b) - mean(a), F.lit(0.0)))
    d, q = F.col("__d"), F.coalesce(na * nb / some, F.lit(0.0))
    m2 = of(a, "m2") + of(b, "m2") + d * d * q
    m3 = of(a, "m3") + of(b, "m3") + F.coalesce(d * d * d * q * (na - nb) / some + 3 * d * (na * of(b, "m2") - nb * of(a, "m2")) / some, F.lit(0.0))
    both = F.struct((na + nb).alias("n"), (of(a, "s") + of(b, "s")).alias("s"), m2.alias("m2"), m3.alias("m3"), F.least(f"{a}.lo", f"{b}.lo").alias("lo"), F.greatest(f"{a}.hi", f"{b}.hi").alias("hi"))
    return rows.withColumn(out, both).drop("__d")


def _spread(c: str) -> tuple[Column, Column, Column, Column]:
    """Mean, greatest, population deviation and skewness of moments; a flat frame has deviation 0 and no skewness."""
    n = F.nullif(F.col(f"{c}.n"), F.lit(0))
    flat = F.col(f"{c}.lo") == F.col(f"{c}.hi")
    std = F.when(flat, F.lit(0.0)).when(~flat, F.sqrt(F.col(f"{c}.m2") / n))
    skew = F.when(~flat, F.sqrt(n) * F.col(f"{c}.m3") / F.nullif(F.pow(f"{c}.m2", F.lit(1.5)), F.lit(0.0)))
    return F.col(f"{c}.s") / n, F.col(f"{c}.hi"), std, skew


def rolling_by_day(rows: DataFrame, time: str = "hour", key: str = "station_code") -> DataFrame:
    """Both rolling groups with a day as part of the partition, for few stations with long histories. Rows stand at full hours.

    A window is what it covers of its own day and the last hours of the day before. Each day leaves one row with the
    moments from each of its hours to its end; the next day's rows take theirs from it, and the two parts are merged. No row
    is copied. ``rows`` are read twice (the second time only the two values), so they should be a written table. The result is that
    of the two functions above.
    """
    own = rows.withColumn("__day", F.to_date(time)).repartition(key, "__day")
    line = Window.partitionBy(key, "__day").orderBy(F.unix_timestamp(time))
    rest = line.rangeBetween(0, 24 * HOUR)
    ends = own.select(key, "__day", F.hour(time).alias("h"), _moments(F.col("pm2_5"), rest).alias("a"), _moments(F.col("aqi_pm2_5"), rest).alias("b"))
    ends = ends.groupBy(key, "__day").agg(F.sort_array(F.collect_list(F.struct("h", "a", "b"))).alias("__late"))
    late = ends.select(F.col(key).alias("__key"), F.date_add("__day", 1).alias("__next"), "__late")
    marked = own.withColumns({"__a": _moments(F.col("pm2_5"), line.rangeBetween(-5 * HOUR, 0)), "__b": _moments(F.col("aqi_pm2_5"), line.rangeBetween(-23 * HOUR, 0))})
    both = marked.join(late, (F.col(key) == F.col("__key")) & (F.col("__day") == F.col("__next")), "left")
    since = lambda hours: F.get(F.filter("__late", lambda x: x["h"] > F.hour(time) + (23 - hours)), F.lit(0))
    both = both.withColumns({"__c": since(5)["a"], "__e": since(23)["b"]})
    out = _merged(_merged(both, "__a", "__c", "__six"), "__b", "__e", "__all")
    six, full = _spread("__six"), _spread("__all")
    names = {f"pm2_5_{n}_6h": c for n, c in zip(("avg", "max", "std", "skew"), six, strict=True)} | {f"aqi_pm2_5_{n}_24h": c for n, c in zip(("max", "std", "skew"), full[1:], strict=True)}
    return out.select(*rows.columns, *[c.alias(n) for n, c in names.items()])


def station_readings(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The station table: id map, both rolling groups and the row's key (one sort by station and day serves both frames)."""
    out = rolling_by_day(rows).join(ids.select(F.col("code").alias("station_code"), F.col("project_station_id").alias("station_id")), "station_code")
    return out.select(
        surrogate_key(F.col("station_id"), key_time(F.col("hour"))).alias("id"), "station_id", F.lit(None).cast("bigint").alias("airnow_id"), F.col("hour").alias("date_localtime"),
        "pm_calibrated", "pm1", "pm2_5", "pm10", "pm2_5_avg_6h", "pm2_5_max_6h", "pm2_5_skew_6h", "pm2_5_std_6h",
        "aqi_pm2_5", "aqi_pm10", "aqi_level", "aqi_pm2_5_max_24h", "aqi_pm2_5_skew_24h", "aqi_pm2_5_std_24h",
    )


def region_moments(rows: DataFrame, keys: tuple[str, str] = ("region_id", "hour")) -> DataFrame:
    """Mean, maximum, deviation, second and third moments and skewness of PM2.5 and its index by region and hour; greatest level."""
    out = []
    for c, name in (("pm2_5", "pm2_5"), ("aqi_pm2_5", "aqi")):
        v = F.col(c).cast("double")
        out += [F.avg(v).alias(f"{name}_avg"), F.max(c).alias(f"{name}_max"), F.stddev_pop(v).alias(f"{name}_std"), F.avg(v * v).alias(f"{name}_m2"), F.avg(v * v * v).alias(f"{name}_m3"), F.skewness(v).alias(f"{name}_skew")]
    return rows.groupBy(*keys).agg(*out, F.max("aqi_level").alias("level_region_max"))


def region_readings(rows: DataFrame, station_regions: DataFrame) -> DataFrame:
    """The region table: stations mapped to regions, moments, skewness, key. Never grouped by region alone."""
    mapped = rows.join(station_regions.select("station_code", surrogate_key(F.col("region_code")).alias("region_id")), "station_code")
    m = region_moments(mapped)
    columns = [c.alias(f"{n}_region_{k}") for n in ("pm2_5", "aqi") for k, c in (("avg", F.col(f"{n}_avg")), ("max", F.col(f"{n}_max")), ("skew", F.col(f"{n}_skew")), ("std", F.col(f"{n}_std")))]
    return m.select(surrogate_key(F.col("region_id"), key_time(F.col("hour"))).alias("id"), "region_id", F.col("hour").alias("date_utc"), *columns, "level_region_max")


def circular_wind(rows: DataFrame, keys: tuple[str, str] = ("region_id", "hour")) -> DataFrame:
    """Weather of a region and hour: means, and mean sine and cosine of the wind direction."""
    angle = F.radians("wind_dir")
    return rows.groupBy(*keys).agg(
        F.avg("temperature_c").alias("temperature"), F.avg("humidity").alias("humidity"), F.avg("pressure").alias("pressure"), F.avg("wind_speed").alias("wind_speed"),
        F.avg(F.sin(angle)).alias("wind_dir_sin"), F.avg(F.cos(angle)).alias("wind_dir_cos"),
    )


def latest_reading(rows: DataFrame, key: str = "station_code", time: str = "hour") -> DataFrame:
    """Newest time of each station."""
    return rows.groupBy(key).agg(F.max(time).alias("latest_reading_at"))


def feature_join(stations: DataFrame, regions: DataFrame, weather: DataFrame, keys: tuple[str, str] = ("region_id", "hour")) -> DataFrame:
    """Station hours with their region's and weather's columns. Region and weather are joined first: the large side moves once."""
    area = regions.join(weather, list(keys), "full_outer")
    return stations.join(area, list(keys), "left")


def features(readings: DataFrame, station_regions: DataFrame, regions: DataFrame, weather: DataFrame) -> DataFrame:
    """Feature rows: station_id, date_utc and the 28 feature columns.

    ``readings`` is ``station_readings``; ``station_regions`` has station_id and region_id.
    """
    from sensorjobs.sources.io import FEATURE_COLUMNS

    base = readings.withColumnRenamed("date_localtime", "hour").join(station_regions.select("station_id", "region_id"), "station_id")
    area = regions.drop("id").withColumnRenamed("date_utc", "hour")
    joined = feature_join(base, area, weather)
    return joined.select("station_id", F.col("hour").alias("date_utc"), *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS])


#: Variable codes and the columns of the hourly wide table.
HOURLY_NAMES: Mapping[str, str] = {
    "pm1": "pm1", "pm25": "pm2_5", "pm10": "pm10", "temperature_c": "temperature_c", "hum": "humidity", "pres": "pressure", "wspd": "wind_speed", "wdir": "wind_dir",
}
