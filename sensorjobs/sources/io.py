"""Reading and writing: raw tables, seeds, watermarks, keyed upserts.

An upsert here is a function of two frames; ``merge_into`` applies it to the partitions of a stored table that a batch
touches. Stored tables have versions (``sensorjobs.sources.versioned``): a change appears as a whole or not at all, and
nothing overwrites a path that is still being read.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorjobs.sources import versioned

#: The feature columns in the order models expect.
FEATURE_COLUMNS = (
    "pm1", "pm2_5", "pm10", "pm2_5_avg_6h", "pm2_5_max_6h", "pm2_5_skew_6h", "pm2_5_std_6h",
    "aqi_pm2_5", "aqi_pm10", "aqi_level", "aqi_pm2_5_max_24h", "aqi_pm2_5_skew_24h", "aqi_pm2_5_std_24h",
    "pm2_5_region_avg", "pm2_5_region_max", "pm2_5_region_skew", "pm2_5_region_std",
    "aqi_region_avg", "aqi_region_max", "aqi_region_skew", "aqi_region_std", "level_region_max",
    "temperature", "humidity", "pressure", "wind_speed", "wind_dir_sin", "wind_dir_cos",
)


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the folder that all nodes share (``spark.checkpoint.dir``); a temporary one only on one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/sensorjobs-{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and reread: what is used several times is computed once, and lineage is cut."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._sensorjobs_path = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what ``stored`` wrote, once nothing reads it any more."""
    for df in frames:
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(df._sensorjobs_path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def read_raw_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    """Raw tables by name (names keep their case) from Parquet under ``base``."""
    return {name: spark.read.parquet(f"{base}/{name}.parquet") for name in names}


def read_raw_jdbc(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """A raw table of a database, read in ranges of ``column`` so that every executor takes part."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=column, lowerBound=low, upperBound=high, numPartitions=partitions)
    return reader.options(**options).load()


def read_seed(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV configuration table; a file with only a header gives an empty frame."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False, escape='"')


def read_features_csv(spark: SparkSession, path: str) -> DataFrame:
    """A feature table in CSV, times in UTC, ordered by station and time."""
    columns = ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    schema = f"station_id bigint, date_utc timestamp, scenario string, {columns}"
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False).orderBy("station_id", "date_utc")


def table_or_seed(spark: SparkSession, table: str, seed: DataFrame) -> DataFrame:
    """The table if the catalog has it, else the seed."""
    return spark.table(table) if spark.catalog.tableExists(table) else seed


def incremental_read(source: DataFrame, target: DataFrame, column: str = "extracted_at", by: str | None = None) -> DataFrame:
    """Rows at or after the target's newest ``column`` (inclusive; all rows if the target is empty).

    With ``by`` the watermark is kept for each value of that column, so a slow source is not skipped.
    """
    newest = F.max(column)
    if by is None:
        mark = target.agg(newest).first()[0]
        return source if mark is None else source.filter(F.col(column) >= F.lit(mark))
    marks = target.groupBy(F.col(by).alias("__by")).agg(newest.alias("__mark"))
    # One row a source in the registry.
    joined = source.join(marks, F.col(by) == F.col("__by"), "left")
    return joined.filter(F.col("__mark").isNull() | (F.col(column) >= F.col("__mark"))).drop("__by", "__mark")


#: A watermark as text, to the microsecond.
MARK = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def newest(df: DataFrame, column: str = "extracted_at") -> str | None:
    """The newest ``column`` as a watermark that can be kept; None for an empty frame."""
    return df.agg(F.date_format(F.max(column), MARK)).first()[0]


def read_since(source: DataFrame, mark: str | None, column: str = "extracted_at", day: str = "extracted_day") -> DataFrame:
    """Rows at or after a kept watermark (inclusive); all without one.

    If the source has the partition column ``day`` (the day of ``column``), older partitions are not read.
    """
    if mark is None:
        return source
    since = F.lit(mark).cast("timestamp")
    rows = source.filter(F.col(column) >= since)
    return rows.filter(F.col(day) >= F.to_date(since)) if day in source.columns else rows


def lookback_read(source: DataFrame, target: DataFrame, column: str, days: int = 2, extra_hours: int = 0) -> DataFrame:
    """Rows of the target's last ``days`` again (and ``extra_hours`` before, for windows that reach back)."""
    newest = target.agg(F.max(column)).first()[0]
    if newest is None:
        return source
    return source.filter(F.col(column) >= F.lit(newest) - F.expr(f"INTERVAL {24 * days + extra_hours} HOURS"))


def upsert_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch, and those of the target whose key the batch lacks. The batch is unique by key."""
    return target.join(batch, list(keys), "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def upsert_keep_columns(target: DataFrame, batch: DataFrame, keys: Sequence[str], updated: Sequence[str]) -> DataFrame:
    """Insert new keys; for known keys change only the ``updated`` columns."""
    t, b = target.alias("t"), batch.alias("b")
    on = [F.col(f"t.{k}") == F.col(f"b.{k}") for k in keys]
    known = F.col(f"t.{keys[0]}").isNotNull()
    came = F.col(f"b.{keys[0]}").isNotNull()

    def pick(c: str) -> Column:
        if c in updated:
            return F.when(came, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))
        return F.when(known, F.col(f"t.{c}")).otherwise(F.col(f"b.{c}"))

    return t.join(b, on, "full_outer").select(*[pick(c).alias(c) for c in target.columns])


def insert_missing(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows of the batch whose key is set and not in the target yet."""
    return batch.filter(F.col(key).isNotNull()).join(target.select(key), key, "left_anti").select(*batch.columns)


def full_rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a stored table by ``df``, without any watermark.

    The new rows are written beside the old ones and become the table at once; the last version stays. A
    job that fails leaves the old table as it was.
    """
    versioned.publish_table(df.sparkSession, versioned.write(df, path, partition_by))


def read_table(spark: SparkSession, path: str, only: Callable[[str], bool] | None = None, number: int | None = None) -> DataFrame:
    """A stored table as it is now (or under a number); with ``only``, the partitions whose folder name (``day=2024-01-01``) it takes."""
    version = versioned.table(spark, path, number)
    if version is None:
        raise FileNotFoundError(f"no table at {path}")
    return versioned.read(spark, version, only)


def write_partitions(df: DataFrame, path: str) -> None:
    """Replace only the partitions of a stored table that ``df`` has rows for."""
    spark = df.sparkSession
    version = versioned.table(spark, path)
    versioned.publish_table(spark, versioned.rewrite(version, versioned.partitions_of(df, version.partition_by), df))


def merge_into(path: str, batch: DataFrame, keys: Sequence[str], moving: bool = False, updated: Sequence[str] | None = None) -> None:
    """Upsert a batch into a stored table; only the partitions that it touches are read and written.

    Known rows are replaced, or only their ``updated`` columns if given. The partition is a function of the
    key unless ``moving`` is set; then known rows are looked up in all partitions and leave their old one.
    """
    spark = batch.sparkSession
    new = stored(batch, "merge")
    version = versioned.table(spark, path)

    def combine(old: DataFrame, came: DataFrame) -> DataFrame:
        return upsert_by_key(old, came, keys) if updated is None else upsert_keep_columns(old, came, keys, updated)

    versioned.publish_table(spark, versioned.change(spark, version, new, keys, combine, moving))
    discard(new)


def payloads(raw: DataFrame, source_name: str, row_id: str, extracted_at: str) -> DataFrame:
    """Every raw row as JSON with all its fields, once for each source row: its newest extraction."""
    whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    rows = raw.select(F.lit(source_name).alias("data_source_name"), F.col(row_id).alias("source_row_id"), F.col(extracted_at).alias("extracted_at"), whole.alias("raw_payload"))
    newest = F.max(F.struct("extracted_at", "raw_payload"))
    return rows.groupBy("data_source_name", "source_row_id").agg(newest.alias("x")).select("data_source_name", "source_row_id", "x.extracted_at", "x.raw_payload")


def write_json_results(base: str, **frames: DataFrame) -> None:
    """Each frame as JSON lines under ``base``."""
    for name, df in frames.items():
        df.write.mode("overwrite").json(f"{base}/{name}")
