"""Near-duplicate search over 64-bit fingerprints by deletion-variant signatures.

A fingerprint is cut into ``limit // 2 + 1`` segments. Two fingerprints that differ in at most
``limit`` bits differ in at most one bit of some segment (were it two in each, the sum would exceed
the limit). Each fingerprint therefore emits every segment with one bit left out; equal variants
meet in an equality join and the whole distance is verified there.

* Equal fingerprints collapse before anything is joined, so copies cost one row.
* A variant shared by few fingerprints is joined in the JVM; the join condition holds the distance
  test and lets a pair through only in the first variant that finds it.
* A variant shared by many fingerprints is cut into blocks of ``block`` members. Each pair of blocks
  is a task of its own that returns a spanning forest of its links, so a crowd of near copies
  gives links in proportion to its size, not to its square, and loses no connection.
* Components are found on the links alone (large-star / small-star rounds, each written to the
  shared folder).

Defined results
---------------
* null, empty and blank texts have no words: fingerprint zero, linked like any other;
* texts of fewer words than a shingle: the whole sequence is the only shingle;
* repeated rows and equal texts: same fingerprint, same component, one output row each; ``keep_one`` keeps
  one row of a component, also of repeated rows and of rows without an id;
* null ids: the row is returned; the id takes no part in the choice of a component's smallest id
  (a component whose ids are all null has a null component_id);
* empty table: empty result; other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm import shingle_sketch
from sensorjobs.llm.common import discard, map_texts, materialize, maybe_in, signed, spare, with_bit

BITS = 64


def fingerprint_of(text: bytes | None, width: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text: a bit is set if over half of the shingle hashes have it."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    xxh64 = xxhash.xxh64_intdigest
    if len(words) <= width:
        return xxh64(b" ".join(words), seed)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.array([xxh64(joined[a:b], seed) for a, b in spans], dtype=">u8")
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text", width: int = 4) -> DataFrame:
    """``keep`` columns and ``fp``, the fingerprint as a signed long (no shuffle)."""

    def run(texts: list[bytes | None]) -> dict[str, list]:
        out = []
        for t in texts:
            v = fingerprint_of(t, width)
            out.append(v - (1 << 64) if v >> 63 else v)
        return {"fp": out}

    return map_texts(docs, [c for c in keep if c.lower() != "fp"], text, run, "fp long")


def segments(limit: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of each segment."""
    n = limit // 2 + 1
    edges = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(fps: DataFrame, limit: int) -> DataFrame:
    """One row for each one-bit-left-out segment: ``slot`` (which segment and bit), ``part`` (the other bits), ``fp``."""
    rows = []
    for low, size in segments(limit):
        seg = ((1 << size) - 1) << low
        rows += [F.struct(F.lit(low + k).alias("slot"), F.col("fp").bitwiseAND(F.lit(signed(seg ^ (1 << (low + k))))).alias("part")) for k in range(size)]
    return fps.select("fp", F.explode(F.array(*rows)).alias("v")).select("fp", "v.slot", "v.part")


def linked_once(a: Column, b: Column, slot: Column, limit: int) -> Column:
    """Within the limit, and found here first.

    A pair shares the variant ``slot`` of a segment if it differs there at that bit only, or not at
    all; the second kind counts at the segment's first bit only, and neither counts if an earlier
    segment has found the pair.
    """
    diff = a.bitwiseXOR(b)
    once = F.lit(False)
    earlier = F.lit(True)
    for low, size in segments(limit):
        seg = diff.bitwiseAND(F.lit(signed(((1 << size) - 1) << low)))
        here = (slot >= low) & (slot < low + size)
        once = once | (here & earlier & ((slot == low) | (seg != 0)))
        earlier = earlier & (F.bit_count(seg) > 1)
    return (F.bit_count(diff) <= limit) & once


def forest(left: np.ndarray, right: np.ndarray | None, limit: int) -> list[tuple[int, int]]:
    """Edges that connect what links within ``left``, or between ``left`` and ``right``, connect.

    Grows one component at a time from a queue: each member is compared with all that are not
    reached yet, so an edge is emitted once for each member that is reached.
    """
    edges: list[tuple[int, int]] = []
    members = left if right is None else np.concatenate((left, right))
    side = np.zeros(len(members), bool)
    side[len(left) :] = right is not None
    rest = np.arange(len(members))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = np.bitwise_count(members[rest] ^ members[at]) <= limit
            if right is not None:
                near &= side[rest] != side[at]
            if near.any():
                found = rest[near]
                edges += [(int(members[at]), int(members[x])) for x in found]
                queue.extend(found.tolist())
                rest = rest[~near]
    return edges


def links(fps: DataFrame, limit: int = 4, block: int = 64) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints that connect all that lie within ``limit`` bits.

    Every pair within the limit is connected by the links; each link is within the limit.
    """
    keys = ["slot", "part"]
    keyed = variants(fps, limit)
    again = materialize(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-again")
    crowds = again.filter(F.col("n") > block)
    # Only the rows of crowded variants meet their counts; the others go on as they are.
    met = materialize(with_bit(maybe_in(keyed, again, keys), crowds, keys, "maybe"), "simhash-keys")
    told = met.filter("maybe").join(crowds, keys, "left")
    few = met.filter("NOT maybe").select(*keys, "fp").unionByName(told.filter("n IS NULL").select(*keys, "fp"))
    a, b = few.withColumnRenamed("fp", "a"), few.withColumnRenamed("fp", "b")
    pairs = a.join(b, ["slot", "part"]).filter((F.col("a") < F.col("b")) & linked_once(F.col("a"), F.col("b"), F.col("slot"), limit)).select("a", "b")

    many = told.filter("n IS NOT NULL").select(*keys, "fp", "n")
    chunk = 16 * block
    parts = F.ceil(F.col("n") / chunk).cast("int")
    many = many.withColumn("parts", parts).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    tasks = many.select("slot", "part", "fp", "mine", other.alias("other")).select(
        "slot", "part", "fp", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    )

    def crowd(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        # Unsigned: numpy counts the bits of the absolute value of a signed number.
        values, mine = group["fp"].to_numpy(np.int64).view(np.uint64), group["mine"].to_numpy()
        i, j = key[2], key[3]
        got = [(signed(a), signed(b)) for a, b in (forest(values, None, limit) if i == j else forest(values[mine == i], values[mine == j], limit))]
        return pd.DataFrame({"a": [min(e) for e in got], "b": [max(e) for e in got]}, dtype="int64")

    crowded = tasks.groupBy("slot", "part", "i", "j").applyInPandas(crowd, "a long, b long")
    return pairs.unionByName(crowded).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of ``edges`` (``a``, ``b``, a < b): root is the component's smallest node.

    Alternating large-star and small-star rounds: every round keeps all connections and moves edges
    to smaller nodes until each node hangs on its root and a round changes nothing. A node's smallest neighbour is a grouped
    minimum (combined before the shuffle) joined back, so a node with very many edges can be split.
    """

    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    edges = materialize(edges.select("a", "b"), "components")
    before = None
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = smallest(both).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()
        down = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = smallest(down)
        small = down.join(low, "u").select(F.col("m").alias("a"), "v", "u")
        moved = small.select("a", F.col("v").alias("b")).unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b"))).filter("a < b").distinct()
        moved = materialize(moved, "components")
        now = moved.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        discard(edges)
        edges = moved
        if now == before:
            return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
        before = now


def assign(docs: DataFrame, keep: list[str], id_column: str = "doc_id", text: str = "text", limit: int = 4, width: int = 4) -> DataFrame:
    """``keep`` columns, ``fp`` and ``component_id``: the smallest id reachable over links of at most ``limit`` bits."""
    own = materialize(fingerprints(docs, keep, text, width), "simhash-docs")
    fps = own.groupBy("fp").agg(F.min(F.col(f"`{id_column}`")).alias("least_id"))
    found = components(links(fps.select("fp"), limit))
    # The root of a component is its smallest fingerprint; its smallest document id is a grouped minimum.
    rooted = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.filter(F.col("least_id").isNotNull()).groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(least, "root", "left").select("fp", "component_id")
    name = spare(own, "__fp")
    return own.join(named.withColumnRenamed("fp", name), F.col("fp") == F.col(name), "left").drop(name)


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", limit: int = 4, width: int = 4, similarity: float | None = None, block: int = 16) -> DataFrame:
    """One document of each component, with its own columns: the one of the smallest id (null ids come last),
    then of the smallest hash of the text, then any of the rows that agree in both.

    Documents link at ``limit`` bits or fewer of the fingerprints of shingles of ``width`` words. With ``similarity``
    0.8 (and width 5) they link at that Jaccard similarity of their sets of shingles, verified on whole
    texts: fingerprints are then those of ``shingle_sketch``, of symbols instead of bits.
    """
    own = [f"c{i}__" for i in range(len(docs.columns))]
    at = {n.lower(): o for n, o in zip(docs.columns, own, strict=True)}
    rows = docs.toDF(*own).withColumn("__row", F.monotonically_increasing_id())
    t, of = at[text.lower()], F.col(at[id_column.lower()])
    if similarity is None:
        rows = materialize(fingerprints(rows, rows.columns, t, width), "near-docs")
        found = lambda single: links(single.select("fp"), limit)
        more: list[str] = []
    elif (similarity, width) == (shingle_sketch.LEAST, shingle_sketch.WIDTH):
        rows = materialize(shingle_sketch.signatures(rows, rows.columns, t), "near-docs")
        found = lambda single: shingle_sketch.links(rows.select("fp", F.col(t).alias("text")), single, block)
        more = ["size", "keys"]
    else:
        raise ValueError("the sketch is made for a similarity of 0.8 of shingles of five words")
    place = F.struct(of.isNull().alias("none"), of.alias("id"), F.xxhash64(F.coalesce(F.col(t), F.lit(""))).alias("hash"), F.col("__row").alias("row"))
    single = materialize(rows.groupBy("fp").agg(F.min(place).alias("least"), *[F.first(c).alias(c) for c in more]), "near-single")
    roots = components(found(single)).withColumnRenamed("node", "fp")
    stay = single.select("fp", "least").join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("least").alias("least"))
    kept = rows.join(stay.select(F.col("least.row").alias("__row")), "__row", "left_semi")
    return kept.select(*[F.col(o).alias(n) for o, n in zip(own, docs.columns, strict=True)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = assign(docs, ["doc_id"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
