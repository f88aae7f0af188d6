"""The sensor shapes over the benchmark tables: what plays the part of stations, messages and dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Event types as variables.
TYPES = {"click": "pm1", "view": "pm25", "purchase": "pm10", "signup": "temperature_c", "error": "hum"}
#: Inclusive ranges of the variables; a null value is allowed for all.
RULES = (
    ("pm1", 0.0, 2000.0), ("pm25", 0.0, 2000.0), ("pm10", 0.0, 3000.0), ("temperature_c", -100.0, 80.0), ("hum", 0.0, 100.0), ("pres", 800.0, 1100.0),
    ("battery", 0.0, 100.0), ("prcp", 0.0, 500.0), ("wspd", 0.0, 300.0), ("wdir", 0.0, 360.0), ("dwpt", -273.15, 60.0), ("coco", 0.0, 100.0),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as the long form: ten stations, five variables, every seventh time invalid."""
    kind = F.col("event_type")
    code = F.lit(None).cast("string")
    for event, variable in TYPES.items():
        code = F.when(kind == event, F.lit(variable)).otherwise(code)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("source_row_id"), F.col("event_id").alias("cursor_id"), F.concat(F.lit("st_"), (F.col("user_id") % 10).cast("string")).alias("station_code"),
        F.lit("net").alias("data_source_name"), code.alias("variable_code"), F.col("ts").cast("timestamp").alias("measured_at_parsed"),
        (F.col("event_id") % 7 != 0).alias("is_measured_at_valid"), F.date_trunc("day", "ts").alias("extracted_at"), F.col("value").alias("value_parsed"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def rules(spark: SparkSession) -> DataFrame:
    """The value rules, one row a variable."""
    return spark.createDataFrame([(*r, True) for r in RULES], "variable_code string, min_value double, max_value double, allow_null boolean")


def factors(spark: SparkSession) -> DataFrame:
    """Calibration factors with overlapping and open intervals."""
    rows = [("st_1", "2024-01-03 00:00:00", "2024-01-20 00:00:00", 0.5), ("st_1", "2024-01-10 00:00:00", None, 0.8), ("st_2", "2024-01-05 00:00:00", "2024-01-06 12:00:00", 1.25), ("st_3", "2024-01-01 00:00:00", None, 2.0)]
    df = spark.createDataFrame(rows, "station_code string, s string, e string, factor double")
    return df.select("station_code", F.to_timestamp("s").alias("date_start"), F.to_timestamp("e").alias("date_end"), "factor")
