"""Helpers shared by the text operators: shared storage, Arrow batches, salted names."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words in most operators: space and \x09-\x0D.
#: ``bytes.split()`` without arguments splits on the same six characters.
SPACE_CLASS = "[ \\t-\\r]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Texts that a function sees at once.
PART_ROWS = 2000

_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every node sees, named by ``spark.checkpoint.dir``.

    Only where the setting is missing on one machine a temporary folder is made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all nodes share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="sensorjobs-")
    return _local[app]


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and return it reread: lineage is cut and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sensorjobs_path = path
    return out


def bucketed(df: DataFrame, tag: str, column: str) -> DataFrame:
    """Like ``materialize``, as a table in the shared folder bucketed by a column: later joins and groups on it do not move the rows.

    It has as many buckets as shuffles have partitions. Its name leaves the catalog at once; the files stay, the returned frame knows them.
    """
    spark = df.sparkSession
    name = f"{tag}-{uuid.uuid4().hex}".replace("-", "_")
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), column).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out.schema  # resolved now, while the name is known
    spark.sql(f"DROP TABLE {name}")
    out._sensorjobs_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote, once nothing reads it any more."""
    path = getattr(df, "_sensorjobs_path", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps whose results are written and read again: else they stay until the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_texts(df: DataFrame, keep: list[str], text: str, fn: Callable[[list[bytes | None]], dict[str, list]], added: str) -> DataFrame:
    """Run ``fn`` over batches of UTF-8 texts and append its columns (``added``, a DDL string) to ``keep``.

    ``fn`` gets the texts as bytes (``None`` for null) and returns one list for each added column. No
    shuffle. Spark bounds the rows and bytes of a batch (``spark.sql.execution.arrow.maxBytesPerBatch``);
    ``fn`` gets parts of at most ``PART_ROWS`` rows.
    """
    schema = df.sparkSession.createDataFrame([], added).schema
    names = [f.name for f in schema.fields]
    arrow = to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, PART_ROWS):
                batch = whole.slice(at, PART_ROWS)
                got = fn(batch.column(len(keep)).cast(pa.binary()).to_pylist())
                columns = [batch.column(i) for i in range(len(keep))]
                columns += [pa.array(got[n], type=arrow.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(columns, [*keep, *names])
                del batch, got, columns
        # The process stays for later steps: what this one held for its batches goes back.
        pa.default_memory_pool().release_unused()

    source = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").alias("__text"))
    out = type(schema)([*source.select(*[f"`{c}`" for c in keep]).schema.fields, *schema.fields])
    return source.mapInArrow(run, out)


def to_arrow(schema) -> pa.Schema:
    """The Arrow schema of simple Spark columns (long, int, double, boolean, string and arrays of them)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def split_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array, null and blank texts give an empty one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def count_words(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACE_CLASS))).cast("long")


def spare(df: DataFrame, name: str) -> str:
    """A column name derived from ``name`` that ``df`` does not use, whatever the letter case."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name = f"_{name}"
    return name


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """An equality join in which null equals null; the keys of the left side stay."""
    other = right.withColumnsRenamed({k: f"{k}__r" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}__r"))
    return left.join(other, on, how).drop(*[f"{k}__r" for k in keys])


def signed(v: int) -> int:
    """A 64-bit pattern as Spark's signed long."""
    return v - (1 << 64) if v >> 63 else v


def with_bit(rows: DataFrame, wanted: DataFrame, columns: list[str], name: str, buckets: int = 1024) -> DataFrame:
    """``rows`` with the boolean ``name``: whether the hash of ``columns`` has its bit set in a bitmap of the wanted ones (all wanted, and few others).

    The bitmap has ``buckets`` times 32768 bits whatever the data (4 MB here), so it can be sent to the tasks.
    """
    bit = F.pmod(F.xxhash64(*columns), F.lit(buckets * 32768))
    bits = wanted.select(bit.alias("x")).select(F.bitmap_bucket_number("x").alias("__g"), F.bitmap_bit_position("x").alias("p"))
    bitmap = bits.groupBy("__g").agg(F.bitmap_construct_agg("p").alias("__m"))
    at = rows.withColumn("__x", bit).withColumn("__g", F.bitmap_bucket_number("__x")).withColumn("__p", F.bitmap_bit_position("__x"))
    byte = F.conv(F.hex(F.expr("substring(__m, CAST(__p DIV 8 AS INT) + 1, 1)")), 16, 10).cast("int")
    met = at.join(F.broadcast(bitmap), "__g", "left")
    return met.select(*rows.columns, F.coalesce(F.getbit(byte, (F.col("__p") % 8).cast("int")) == 1, F.lit(False)).alias(name))


def maybe_in(rows: DataFrame, wanted: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that ``with_bit`` marks."""
    return with_bit(rows, wanted, columns, "__bit").filter("__bit").drop("__bit")


def shared_keys(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The rows whose ``columns`` have the values of another row's too, with ``n``, how many have them.

    Rows are counted in groups and joined back, so a value of very many rows is no window of one task;
    only rows that may have company are moved.
    """
    again = materialize(rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-keys")
    return maybe_in(rows, again, columns).join(again, columns)
