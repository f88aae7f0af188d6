"""Staging: raw source tables to one contract of columns, and the wide-to-long reshape.

Every stager gives: source_row_id, extracted_at, data_source_name, station_code, cursor_id,
measured_at_raw, measured_at_parsed, is_measured_at_valid, the source's variables as text, raw_payload.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorjobs.functions.columns import blank_to_null, is_valid_time, parse_local_timestamp, station_code_from_name


@dataclass(frozen=True)
class Source:
    """How to read the long form out of a staged source: its variables' columns, and what it has."""

    name: str
    variables: Mapping[str, str]
    station_code: str = "station_code"
    measured_at: str = "measured_at_parsed"
    cursor_id: str | None = None
    is_valid: str | None = "is_measured_at_valid"
    row_id: str = "source_row_id"
    extracted_at: str = "extracted_at"
    tags: Mapping[str, str] = field(default_factory=dict)


#: The variables that each kind of source delivers.
CURSOR_VARIABLES = {"pm1": "MP1", "pm25": "MP2_5", "pm10": "MP10", "temperature_c": "TEMPERATURA", "hum": "HUMEDAD", "pres": "PRESION", "battery": "BATERIA"}
GEO_VARIABLES = {"pm1": "pm1dot0", "pm25": "pm2dot5", "pm10": "pm10"}
WEATHER_VARIABLES = {"temperature_c": "temp", "hum": "rhum", "pres": "pres", "prcp": "prcp", "wspd": "wspd", "wdir": "wdir", "dwpt": "dwpt", "coco": "coco"}
#: The variables of the hourly mart.
MART_VARIABLES = ("pm1", "pm25", "pm10", "temperature_c", "hum", "pres", "wspd", "wdir")


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "_source_table") -> DataFrame:
    """All rows of tables of one schema, each with its table's name."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def _common(source: str) -> list:
    return [
        F.col("_airbyte_raw_id").alias("source_row_id"), F.col("_airbyte_extracted_at").cast("timestamp").alias("extracted_at"),
        F.lit(source).alias("data_source_name"),
    ]


def _payload():
    return F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("raw_payload")


def stage_cursor_source(raw: DataFrame, source: str = "FIUNA", offset_hours: int = 3) -> DataFrame:
    """Stage tagged tables with split date and time text and a continuity cursor (``ID``)."""
    at = parse_local_timestamp(F.col("FECHA"), F.col("HORA"), offset_hours)
    return raw.select(
        *_common(source), station_code_from_name(F.col("_source_table")).alias("station_code"),
        F.expr("try_cast(ID AS bigint)").alias("cursor_id"), F.concat_ws(" ", "FECHA", "HORA").alias("measured_at_raw"),
        at.alias("measured_at_parsed"), is_valid_time(at).alias("is_measured_at_valid"),
        *[F.col(c).cast("string").alias(v) for v, c in CURSOR_VARIABLES.items()], _payload(),
    )


def stage_geo_source(raw: DataFrame, source: str = "AireLibre", prefix: str = "airelibre_") -> DataFrame:
    """Stage a source with its own time text and coordinates; no cursor."""
    at = F.expr("try_cast(nullif(recorded, '') AS timestamp)")
    return raw.select(
        *_common(source), F.concat(F.lit(prefix), F.col("source")).alias("station_code"), F.lit(None).cast("bigint").alias("cursor_id"),
        F.col("recorded").alias("measured_at_raw"), at.alias("measured_at_parsed"), is_valid_time(at).alias("is_measured_at_valid"),
        *[F.col(c).cast("string").alias(v) for v, c in GEO_VARIABLES.items()],
        F.expr("try_cast(latitude AS double)").alias("latitude"), F.expr("try_cast(longitude AS double)").alias("longitude"),
        blank_to_null(F.col("description")).alias("description"), _payload(),
    )


def stage_weather_source(raw: DataFrame, station_code: str, source: str = "Meteostat", first: str = "2018-01-01 00:00:00") -> DataFrame:
    """Stage an hourly weather feed of one station; its naive time is UTC; validity is null without a time."""
    at = F.col("time").cast("timestamp")
    return raw.select(
        *_common(source), F.lit(station_code).alias("station_code"), F.lit(None).cast("bigint").alias("cursor_id"),
        F.col("time").cast("string").alias("measured_at_raw"), at.alias("measured_at_parsed"), (at >= F.lit(first).cast("timestamp")).alias("is_measured_at_valid"),
        *[F.col(c).cast("string").alias(v) for v, c in WEATHER_VARIABLES.items()], _payload(),
    )


def unpivot_measurements(wide: DataFrame, source: Source) -> DataFrame:
    """One row a variable that has a value; text and number are both kept. No shuffle.

    Columns that are all doubles are exploded as numbers: their text is then made only where it is used.
    """
    none = lambda kind: F.lit(None).cast(kind)
    doubles = all(wide.schema[c].dataType.typeName() == "double" for c in source.variables.values() if c in wide.columns)
    kind = "double" if doubles else "string"
    cells = F.array(*[F.struct(F.lit(v).alias("variable_code"), F.col(c).cast(kind).alias("value")) for v, c in source.variables.items()])
    long = wide.select(
        F.col(source.row_id).alias("source_row_id"), F.col(source.extracted_at).alias("extracted_at"), F.col(source.station_code).alias("station_code"),
        F.lit(source.name).alias("data_source_name"), F.col(source.measured_at).alias("measured_at_parsed"),
        (F.col(source.cursor_id).cast("bigint") if source.cursor_id else none("bigint")).alias("cursor_id"),
        (F.col(source.is_valid) if source.is_valid else none("boolean")).alias("is_measured_at_valid"), F.explode(cells).alias("x"),
    )
    number = F.col("x.value") if doubles else F.expr("try_cast(x.value AS double)")
    out = long.select("*", "x.variable_code", F.col("x.value").cast("string").alias("value_raw"), number.alias("value_parsed")).drop("x")
    return out.filter(F.col("value_parsed").isNotNull())


def long_union(staged: Mapping[str, DataFrame], registry: Sequence[Source]) -> DataFrame:
    """The long form of all registered sources."""
    return reduce(DataFrame.unionByName, [unpivot_measurements(staged[s.name], s) for s in registry])


def source_kind_filter(stations: DataFrame, weather: bool, properties: str = "properties") -> DataFrame:
    """Weather stations, or all others."""
    from sensorjobs.functions.columns import is_weather

    kind = is_weather(F.col(properties))
    return stations.filter(kind if weather else ~kind)


def variable_subset_filter(long: DataFrame, codes: Sequence[str] = MART_VARIABLES) -> DataFrame:
    """Rows of the given variables."""
    return long.filter(F.col("variable_code").isin(*codes))


def pivot_wide(long: DataFrame, keys: Sequence[str], codes: Sequence[str], value: str = "value_parsed") -> DataFrame:
    """One column a variable (given, so no pass over the data to find them), greatest value of each key. One grouping."""
    return long.groupBy(*keys).agg(*[F.max(F.when(F.col("variable_code") == c, F.col(value))).alias(c) for c in codes])


def pivot_hourly(hourly: DataFrame, names: Mapping[str, str], keys: Sequence[str] = ("station_code", "hour"), value: str = "value_avg") -> DataFrame:
    """One column a variable: the mean over the sources' hourly means. ``names``: variable code to column."""
    return hourly.groupBy(*keys).agg(*[F.avg(F.when(F.col("variable_code") == code, F.col(value))).alias(name) for code, name in names.items()])
