"""Partitioned Parquet tables whose changes touch few partitions and appear all at once.

A version of a table is a list of partition folders. A change writes the touched partitions anew under a
folder of its own (``data/batch=.../day=...``) and makes a new list in which only these differ; files are never
changed. A version, or a set of versions that belong together, is made current by one small numbered file in
``current/``, which is renamed into place: readers see all of a change or nothing, and a job that fails before leaves
the table as it was. ``drop_unused`` deletes the batches that no kept version names. The rename must be atomic and
must not replace a file, as on HDFS and local disks.

Partition columns hold dates, whole numbers or plain words; they are functions of the key, or ``moving`` has
to be set. What the driver handles is one entry for each partition.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: How Spark names the partition of a null.
NULL = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Version:
    """A table at one time: its folder, partition columns, schema (JSON), and the batch that holds each partition."""

    base: str
    partition_by: Sequence[str]
    schema: str
    parts: Mapping[str, str] = field(default_factory=dict)

    def columns(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path, as Hadoop knows them."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def partition_key(columns: Sequence[str], values: Sequence[Any]) -> str:
    """The folder name of a partition."""
    out = []
    for c, v in zip(columns, values, strict=True):
        text = NULL if v is None else str(v)
        if not re.fullmatch(r"[\w.-]+", text, re.ASCII):
            raise ValueError(f"{text!r} cannot name a partition of {c}")
        out.append(f"{c}={text}")
    return "/".join(out)


def partitions_of(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """The partitions that a frame has rows of."""
    return {partition_key(columns, r) for r in df.select(*columns).distinct().collect()} if columns else {""}


def _store(df: DataFrame, base: str, partition_by: Sequence[str]) -> dict[str, str]:
    """Write a new batch; returns its partitions. Rows are dealt by partition; large partitions are split."""
    spark, batch = df.sparkSession, f"batch={uuid.uuid4().hex}"
    path = f"{base}/data/{batch}"
    (df.hint("rebalance", *partition_by) if partition_by else df).write.partitionBy(*partition_by).parquet(path)
    if not partition_by:
        return {"": batch}
    files, where = _files(spark, path + "/*=*" * len(partition_by))
    found = [str(s.getPath()) for s in files.globStatus(where)]
    return {"/".join(f.split("/")[-len(partition_by) :]): batch for f in found}


def write(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> Version:
    """A version that holds exactly ``df``."""
    return Version(base, list(partition_by), df.schema.json(), _store(df, base, partition_by))


def read(spark: SparkSession, version: Version, only: Collection[str] | Callable[[str], bool] | None = None) -> DataFrame:
    """The table, or only the given partitions of it: other folders are not even listed."""
    wanted = only if callable(only) else (lambda k: only is None or k in only)
    paths = [f"{version.base}/data/{batch}/{k}" for k, batch in version.parts.items() if wanted(k)]
    schema = version.columns()
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{version.base}/data").parquet(*paths).select(*[f"`{c}`" for c in schema.names])


def rewrite(version: Version, touched: Collection[str], df: DataFrame) -> Version:
    """The touched partitions become what ``df`` holds of them; ``df`` has rows of these only."""
    new = _store(df.select(*[f"`{c}`" for c in version.columns().names]), version.base, version.partition_by)
    if extra := new.keys() - set(touched):
        raise ValueError(f"rows of partitions that are not rewritten: {sorted(extra)[:3]}")
    return Version(version.base, version.partition_by, version.schema, {k: b for k, b in version.parts.items() if k not in touched} | new)


def change(spark: SparkSession, version: Version, batch: DataFrame, keys: Sequence[str], combine: Callable[[DataFrame, DataFrame], DataFrame], moving: bool = False) -> Version:
    """``combine(rows of the touched partitions, batch)`` in place of these partitions.

    Touched are the partitions of the batch and, with ``moving``, those that hold its keys now: then the key
    columns of the whole table are read. ``batch`` is read several times, so it should be a written table.
    """
    columns = version.partition_by
    touched = partitions_of(batch, columns)
    if moving:
        known = read(spark, version).select(*dict.fromkeys([*keys, *columns]))
        touched |= partitions_of(known.join(batch.select(*keys), list(keys), "left_semi"), columns)
    return rewrite(version, touched, combine(read(spark, version, touched), batch))


def publish(spark: SparkSession, folder: str, content: Mapping[str, Any]) -> int:
    """Make a content current; returns its number. Fails if another writer was faster."""
    number = (latest_number(spark, folder) or 0) + 1
    temporary, final = f"{folder}/current/.{uuid.uuid4().hex}", f"{folder}/current/{number:012d}.json"
    files, where = _files(spark, temporary)
    out = files.create(where, False)
    out.write(json.dumps(content).encode())
    out.close()
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs
    none = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(where, fs.Path(final), none)
    return number


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    files, where = _files(spark, f"{folder}/current/*.json")
    return sorted(int(str(s.getPath()).rsplit("/", 1)[1].removesuffix(".json")) for s in files.globStatus(where) or [])


def latest_number(spark: SparkSession, folder: str) -> int | None:
    return max(_numbers(spark, folder), default=None)


def load(spark: SparkSession, folder: str, number: int | None = None) -> dict[str, Any] | None:
    """What was published last (or under a number); None if nothing was."""
    number = latest_number(spark, folder) if number is None else number
    if number is None:
        return None
    files, where = _files(spark, f"{folder}/current/{number:012d}.json")
    stream = files.open(where)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def table(spark: SparkSession, folder: str, number: int | None = None) -> Version | None:
    """The current version of a single table."""
    content = load(spark, folder, number)
    return None if content is None else Version(**content["version"])


def publish_table(spark: SparkSession, version: Version, keep: int = 2) -> int:
    """Make a version of a single table current; the last ``keep`` ones stay readable."""
    number = publish(spark, version.base, {"version": asdict(version)})
    kept = [table(spark, version.base, n) for n in _numbers(spark, version.base)[-keep:]]
    drop_unused(spark, version.base, [v for v in kept if v is not None])
    return number


def drop_unused(spark: SparkSession, base: str, live: Collection[Version]) -> None:
    """Delete the batches that none of the given versions names. No other writer may be at work."""
    named = {b for v in live for b in v.parts.values()}
    files, where = _files(spark, f"{base}/data/batch=*")
    for s in files.globStatus(where) or []:
        if str(s.getPath()).rsplit("/", 1)[1] not in named:
            files.delete(s.getPath(), True)

