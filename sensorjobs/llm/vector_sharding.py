"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Equal texts form a group. Small groups are bundled by the hash of their text (a group stays whole in its bundle); a
group of more than ``1 / (4 * shards)`` of all bytes, tokens or rows, or of more than an eighth of ``bundle_rows`` rows, is
split into pieces by the hash of its rows. There are ``bundles`` bundles, or as many as hold ``bundle_rows`` rows
each on average; what falls into a bundle or a piece beyond that is chance, since none of its parts is large. So a task
numbers about ``bundle_rows`` rows of an item, and the packer sees one item for each bundle and piece. It
places them from the largest down where the dot product with the residual capacity is highest.

Slots need no window over a shard: items have fixed offsets, rows are numbered within their item.

Defined results
---------------
* null text: size 1 (no bytes, plus 1), crc32 of nothing (0), no tokens; null texts form a group
  with empty texts;
* repeated rows: each has its own slot; rows that agree in everything may swap slots;
* empty table: empty result; the columns of the input stay, those named like the operator's give way.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorjobs.llm.common import count_words, materialize

OWN = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with ``size``, ``text_crc32``, tokens ``__t`` and the hash of the text ``__g``."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.drop(*[c for c in docs.columns if c.lower() in OWN])
    return rows.select("*", (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), count_words(t).alias("__t"), F.xxhash64(t).alias("__g"), F.monotonically_increasing_id().alias("__row"))


def pack(loads: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows of ``loads``: bytes, tokens, rows): largest first, highest dot product with what is left."""
    totals = np.maximum(loads.sum(axis=0), 1)
    need = loads * shards / totals
    left = np.ones((shards, loads.shape[1]))
    place = np.zeros(len(loads), int)
    for i in np.argsort(-need.max(axis=1), kind="stable"):
        place[i] = int(np.argmax(left @ need[i]))
        left[place[i]] -= need[i]
    return place


def items(rows: DataFrame, shards: int = 16, bundles: int = 4096, bundle_rows: int = 50_000, spread: list[str] | None = None) -> DataFrame:
    """``sized`` rows with ``__i``, the bundle or piece of a split group that each is dealt to. ``spread``: see ``shard``."""
    groups = rows.groupBy("__g", "text_crc32", "size").agg(F.count(F.lit(1)).alias("n"), F.max("__t").alias("t"))
    groups = groups.select("__g", "text_crc32", "size", F.col("n").alias("rows"), (F.col("n") * F.col("size")).alias("bytes"), (F.col("n") * F.col("t")).alias("tokens"))
    groups = materialize(groups, "shard-groups")
    whole = groups.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("bytes", "tokens", "rows")]).first()
    bundles, most = max(bundles, -(-(whole["rows"]) // bundle_rows)), max(1, bundle_rows // 8)
    share = F.greatest(*[F.col(c) / max(1, whole[c]) for c in ("bytes", "tokens", "rows")])
    # Fewer than 3 * 4 * shards groups can hold such a share, and than 8 * bundles so many rows.
    large = groups.filter(((share > 1 / (4 * shards)) | (F.col("rows") > most)) & (F.col("rows") > 1))
    by_share = F.when(share > 1 / (4 * shards), F.ceil(share * 16 * shards)).otherwise(F.lit(1))
    large = large.select("__g", "text_crc32", "size", F.least(F.col("rows"), F.greatest(by_share, F.ceil(F.col("rows") / most))).cast("long").alias("__pieces"))
    until = F.sum("__pieces").over(Window.orderBy("__g", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0))
    large = large.withColumn("__first", until - F.col("__pieces") + bundles)

    piece = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _spread(spread)]), F.col("__pieces"))
    item = F.when(F.col("__pieces").isNotNull(), F.col("__first") + piece).otherwise(F.pmod(F.xxhash64("__g", F.lit(3)), F.lit(bundles)))
    return rows.join(F.broadcast(large), ["__g", "text_crc32", "size"], "left").withColumn("__i", item.cast("long")).drop("__pieces", "__first")


def _spread(names: list[str] | None) -> list[str]:
    return [*(names or ["doc_id"]), "__row"]


def shard(rows: DataFrame, shards: int = 16, bundles: int = 4096, bundle_rows: int = 50_000, spread: list[str] | None = None) -> DataFrame:
    """From ``sized`` rows: ``shard``, ``slot``, ``law`` and ``grown_shard`` added.

    ``spread`` names the columns whose hash, with the row's number, deals the rows of a split group to its pieces.
    """
    spark: SparkSession = rows.sparkSession
    dealt = items(rows, shards, bundles, bundle_rows, spread)
    # One row for each bundle and piece.
    loads = dealt.groupBy("__i").agg(F.sum("size").alias("bytes"), F.sum("__t").alias("tokens"), F.count(F.lit(1)).alias("rows")).orderBy("__i").collect()
    places = pack(np.array([[r["bytes"], r["tokens"], r["rows"]] for r in loads], float).reshape(-1, 3), shards)
    used = [0] * shards
    table = []
    for r, s in zip(loads, places.tolist(), strict=True):
        table.append((r["__i"], s, used[s]))
        used[s] += r["rows"]
    placed = spark.createDataFrame(table, "__i long, shard int, __o long")
    turn = Window.partitionBy("__i").orderBy(*[F.col(f"`{c}`") for c in _spread(spread)], "__g", "text_crc32")
    out = dealt.withColumn("__n", F.row_number().over(turn)).join(F.broadcast(placed), "__i")
    return out.withColumns({"slot": F.col("__o") + F.col("__n") - 1, "law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}).drop("__i", "__o", "__n", "__t", "__g", "__row")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: shard and slot of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = materialize(sized(docs.select("doc_id", "text")).drop("text"), "shard-docs")
    return shard(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
