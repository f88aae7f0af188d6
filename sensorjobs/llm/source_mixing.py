"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame functions only.

1. Documents fall into blocks of their source by hash. A source has at least ``least_blocks`` blocks,
   and one for ``block_rows`` documents (up to ``CELLS``), so blocks stay small as sources grow; only
   block totals are grouped.
2. Targets are words: ``total_share`` of all words shared by weight, never over ``most_repeats``
   times a source's words; the excess is shared again by weight (a water level over the sources).
3. A source's quota is the number of blocks of its permuted order, one pass after the other, that
   hold its target. The splitting tree divides these exact quotas among the shards: all quota units
   stand in one random order, and every node gives the first of its units to its left half. So the
   counts by source of each child follow the multivariate hypergeometric law, those of two children
   add up to their parent's, and shards hold equal numbers of blocks (within the rounding of the levels).
4. Each shard draws as many blocks of every source as its leaf says: disjoint stretches of the
   source's permuted order. The last block of a source gives the first documents of its own permuted
   order (and the first words of one of them), so taken words equal the target, rounded.
5. Within a shard rows are ordered by a hash, ``place``: a local shuffle.

No step sees the rows of a source together. Quota units are ranked in ``RANKS`` hash ranges with
grouped counts. One task sees the block totals of a source at most (its rows over ``block_rows``), or
the table of sources.

Defined results
---------------
* null text: size 0, taken 0; empty texts likewise; null source: a source of its own, last in order;
* repeated rows: each may be drawn; rows that agree in everything may swap their draws;
* empty table: empty result; the result has the input's columns and ``size``, ``source_size``,
  ``target``, ``draws``, ``taken`` (a column of the input with such a name gives way).
* Reruns agree: all choices are hashes of the row and the seed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorjobs.llm.common import count_words, discard, materialize, null_safe_join, split_words

#: Weights given to the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
OWN = ("size", "source_size", "target", "draws", "taken")
#: The finest blocks of a source; coarser ones are runs of these.
CELLS = 1 << 16
#: Hash ranges in which quota units are ranked.
RANKS = 1024


def sized(docs: DataFrame, text: str = "text", source: str = "source", id_column: str = "doc_id", seed: int = 7) -> DataFrame:
    """The documents with ``size``, their source ``__s``, cell ``__f`` and place ``__r`` in the permuted block."""
    rows = docs.drop(*[c for c in docs.columns if c.lower() in OWN])
    t = F.col(f"`{text}`")
    place = F.xxhash64(F.lit(seed), F.col(f"`{id_column}`"), F.crc32(F.coalesce(t, F.lit("")).cast("binary")))
    return rows.select(
        "*", count_words(t).alias("size"), F.col(f"`{source}`").alias("__s"),
        F.pmod(F.xxhash64(place, F.lit(1)), F.lit(CELLS)).cast("int").alias("__f"), place.alias("__r"),
    )


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, total_share: float = 1.5, most_repeats: float = 2.0) -> DataFrame:
    """``totals`` (one row a source: ``__s``, ``source_size``, ...) with ``target``.

    A source is capped if its share at the common water level exceeds its cap. Ordered by cap for
    each unit of weight, the level is found where the sources before are capped and the rest fit.
    """
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("__s").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * most_repeats)
    rows = rows.withColumn("total", F.sum("source_size").over(every) * total_share).withColumn("ratio", F.col("cap") / F.col("w"))
    order = Window.orderBy("ratio", F.col("__s").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    fits = F.first(F.when(F.col("level") <= F.col("ratio"), F.col("level")), ignorenulls=True)
    rows = rows.withColumn("final", fits.over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.select(*totals.columns, F.least(F.col("w") * F.coalesce("final", F.lit(0.0)), F.col("cap")).alias("target"))


def ranked(rows: DataFrame, order: Column) -> DataFrame:
    """``rows`` with ``rank`` (from 0) in the order of a hash and ``total``, without one task for all rows."""
    keyed = rows.withColumn("__o", order).withColumn("__k", F.shiftrightunsigned("__o", 64 - (RANKS - 1).bit_length()))
    sizes = keyed.groupBy("__k").agg(F.count(F.lit(1)).alias("n"))
    # At most RANKS rows.
    before = Window.orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.select("__k", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"), F.sum("n").over(every).alias("total"))
    inner = Window.partitionBy("__k").orderBy("__o", *rows.columns)
    out = keyed.withColumn("__n", F.row_number().over(inner)).join(F.broadcast(sizes), "__k")
    return out.select(*rows.columns, (F.col("__before") + F.col("__n") - 1).alias("rank"), "total")


def split(units: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """``units`` (``__s``, ``turn``) with ``shard``: each node of the tree deals its units, in random order, to its halves.

    A node of several shards gives its left half the share of its units that the half has of its
    shards. The order is random over all units, so it is within every node.
    """
    out = ranked(units, F.xxhash64(F.lit(seed), F.lit(2), "__s", "turn"))
    out = out.withColumns({"low": F.lit(0), "high": F.lit(n_shards), "first": F.lit(0).cast("long"), "size": F.col("total")})
    for _ in range((n_shards - 1).bit_length()):
        shards = F.col("high") - F.col("low")
        half = F.when(shards > 1, F.floor(shards / 2)).otherwise(shards).cast("int")
        left = F.floor((F.col("size") * half * 2 + shards) / (shards * 2)).cast("long")
        goes_left = F.col("rank") < F.col("first") + F.col("left")
        out = out.withColumn("half", half).withColumn("left", left).withColumn("l", goes_left)
        out = out.select(
            *units.columns, "rank", F.when(F.col("l"), F.col("low")).otherwise(F.col("low") + F.col("half")).alias("low"),
            F.when(F.col("l"), F.col("low") + F.col("half")).otherwise(F.col("high")).alias("high"),
            F.when(F.col("l"), F.col("first")).otherwise(F.col("first") + F.col("left")).alias("first"),
            F.when(F.col("l"), F.col("left")).otherwise(F.col("size") - F.col("left")).alias("size"),
        )
    return out.select(*units.columns, F.col("low").alias("shard"))


def quotas(units: DataFrame, n_shards: int, seed: int = 7) -> DataFrame:
    """``__s``, ``shard``, ``quota``: the blocks of every source that each shard draws."""
    return split(units, n_shards, seed).groupBy("__s", "shard").agg(F.count(F.lit(1)).alias("quota"))


def plan(rows: DataFrame, n_shards: int = 16, passes: int = 2, seed: int = 7, least_blocks: int = 256, block_rows: int = 4096, **shares) -> tuple[DataFrame, DataFrame]:
    """The sources (``__s``, ``source_size``, ``target``, ``width`` of a block in cells), and the drawn
    blocks (``__s``, ``__b``) with ``__d``: their draws (pass, words, whole, shard)."""
    cells = materialize(rows.groupBy("__s", "__f").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")), "mix-cells")
    goal = targets(cells.groupBy("__s").agg(F.sum("words").alias("source_size"), F.sum("rows").alias("rows")), **shares)
    wanted = F.least(F.lit(CELLS), F.greatest(F.lit(least_blocks), F.ceil(F.col("rows") / block_rows)))
    width = F.floor(F.lit(CELLS) / F.pow(F.lit(2), F.ceil(F.log2(wanted) - 1e-9))).cast("int")
    sources = materialize(goal.select("__s", "source_size", "target", width.alias("width")), "mix-sources")

    blocks = null_safe_join(cells, sources, ["__s"]).groupBy("__s", F.floor(F.col("__f") / F.col("width")).cast("int").alias("__b"), "target").agg(F.sum("words").alias("words"))
    units = blocks.filter("words > 0").withColumn("pass", F.explode(F.array(*[F.lit(p) for p in range(passes)])))
    permuted = Window.partitionBy("__s").orderBy("pass", F.xxhash64(F.lit(seed), "__s", "__b", "pass"), "__b")
    done = F.coalesce(F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.round("target").cast("long") - done
    units = units.withColumn("turn", F.row_number().over(permuted) - 1).withColumn("take", F.greatest(F.lit(0), F.least(F.col("words"), left)).cast("long"))
    units = materialize(units.filter("take > 0").select("__s", "__b", "pass", "turn", "words", "take"), "mix-units")

    leaves = quotas(units.select("__s", "turn"), n_shards, seed)
    by_shard = Window.partitionBy("__s").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    leaves = leaves.withColumn("from", F.coalesce(F.sum("quota").over(by_shard), F.lit(0))).select(F.col("__s").alias("__q"), "shard", "from", (F.col("from") + F.col("quota")).alias("to"))
    mine = F.col("__s").eqNullSafe(F.col("__q")) & (F.col("turn") >= F.col("from")) & (F.col("turn") < F.col("to"))
    draw = F.struct(F.col("pass"), F.col("take").alias("words"), (F.col("take") == F.col("words")).alias("whole"), "shard")
    drawn = units.join(leaves, mine).groupBy("__s", "__b").agg(F.sort_array(F.collect_list(draw)).alias("__d"))
    drawn = materialize(drawn, "mix-drawn")
    discard(cells)
    discard(units)
    return sources, drawn


def _draws(before: Column, whole: bool = False) -> Column:
    """A document's draws: its words in each pass in which its block is drawn.

    The document in which a block's words end gives the words up to there; with ``whole``, all of
    them or none, whichever is nearer.
    """
    some = lambda d: F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), d["words"] - before))
    given = (lambda d: F.when(2 * some(d) >= F.col("size"), F.col("size")).otherwise(F.lit(0).cast("long"))) if whole else some
    words = lambda d: F.when(d["whole"], F.col("size")).otherwise(given(d))
    every = F.transform("__d", lambda d: F.struct(d["pass"].alias("pass"), d["shard"].alias("shard"), words(d).alias("words")))
    return F.filter(F.coalesce(every, F.array().cast("array<struct<pass:int,shard:int,words:bigint>>")), lambda d: d["words"] > 0)


def mix(rows: DataFrame, id_column: str = "doc_id", whole: bool = False, **options) -> DataFrame:
    """From ``sized`` rows: every document with ``source_size``, ``target``, ``draws`` and ``taken``.

    With ``whole`` no document is cut: a source misses its quota by half a document at most.
    """
    sources, drawn = plan(rows, **options)
    joined = null_safe_join(rows, sources, ["__s"], "left").withColumn("__b", F.floor(F.col("__f") / F.col("width")).cast("int"))
    joined = null_safe_join(joined, drawn, ["__s", "__b"], "left")
    cut = F.coalesce(F.exists("__d", lambda d: ~d["whole"]), F.lit(False))
    uncut = joined.filter(~cut).withColumn("draws", _draws(F.lit(0).cast("long")))
    order = Window.partitionBy("__s", "__b").orderBy("__r", f"`{id_column}`", "size").rowsBetween(Window.unboundedPreceding, -1)
    part = joined.filter(cut).withColumn("__before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    part = part.withColumn("draws", _draws(F.col("__before"), whole)).drop("__before")
    out = uncut.unionByName(part)
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda acc, d: acc + d["words"])
    return out.withColumn("taken", taken).drop("__s", "__f", "__b", "__d", "width")


def place(shard: Column, turn: Column, seed: int = 7) -> Column:
    """Where a draw of the row stands in the shuffled order of its shard."""
    return F.xxhash64(F.lit(seed), shard, turn, F.col("__r"))


def mixed_rows(mixed: DataFrame, text: str = "text", seed: int = 7) -> DataFrame:
    """One row a draw: the document's columns, ``shard`` and ``place`` (the order within the shard).

    A document drawn for less than its words gives its first words, joined by spaces.
    """
    t = F.col(f"`{text}`")
    rows = mixed.withColumn("__x", F.explode("draws"))
    some = F.array_join(F.slice(split_words(t), 1, F.col("__x.words").cast("int")), " ")
    return rows.withColumn(text, F.when(F.col("__x.words") < F.col("size"), some).otherwise(t)).select("*", F.col("__x.shard").alias("shard"), place(F.col("__x.shard"), F.col("__x.pass"), seed).alias("place")).drop("__x", "__r", *OWN)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: size, target and taken words of every document, and the shards and places of its draws."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = materialize(sized(docs).select("doc_id", "size", "__s", "__f", "__r"), "mix-docs")
    at = F.transform("draws", lambda d: place(d["shard"], d["pass"]))
    return mix(rows).select("doc_id", "size", "source_size", "target", "taken", F.transform("draws", lambda d: d["shard"]).alias("shards"), at.alias("places"))
