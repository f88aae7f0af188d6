"""Fingerprints of the near-duplicate operator for a similarity of 0.8 on word shingles.

Sign bits cannot tell such pairs apart: at a similarity of 0.8 they differ in 10 of 64 bits on average,
so no segment is both long enough to be selective and within one bit. Here a fingerprint has ``SEGMENTS``
segments of ``SYMBOLS`` MinHash values instead of bits. They are indexed in the same way: each segment with one
symbol left out, equal variants meet, every candidate is verified on the whole sets of shingles. A pair of
similarity 0.8 has a segment that differs at no more than one symbol with a probability of 1 - 1.6e-6
(``1 - (1 - 0.8 ** 5 - 5 * 0.2 * 0.8 ** 4) ** 10``), a more similar one with a higher one.

* Equal shingle sets collapse before anything is joined, so copies cost one row.
* A variant shared by few sets gives their pairs; each pair is verified once.
* In a crowd all sets are verified against one of them. Only those that fail are compared with the others,
  block by block, and a block returns a spanning forest of its links: a crowd costs its size and not its
  square unless it holds unlike texts, and never gives more links than members in each block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorjobs.llm.common import discard, map_texts, materialize, maybe_in, shared_keys, signed

WIDTH = 5
LEAST = 0.8
SYMBOLS = 5
SEGMENTS = 10

_random = np.random.default_rng(42)
#: Odd factors and offsets of the MinHash functions (fixed by the seed).
FACTORS = (_random.integers(0, 1 << 31, SYMBOLS * SEGMENTS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
OFFSETS = _random.integers(0, 1 << 32, SYMBOLS * SEGMENTS, dtype=np.uint32)


def shingles_of(text: bytes | None, width: int = WIDTH, seed: int = 42) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; fewer words are one shingle, none the empty one."""
    words = (text or b"").lower().split()
    xxh64 = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxh64(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.unique(np.array([xxh64(joined[a:b], seed) for a, b in spans], np.uint64))


def keys_of(shingles: np.ndarray) -> list[int]:
    """A hash of each segment with one symbol left out."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(SYMBOLS * SEGMENTS, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), 4096):
        least = np.minimum(least, (FACTORS[:, None] * h[None, k : k + 4096] + OFFSETS[:, None]).min(axis=1))
    parts = [least[k : k + SYMBOLS] for k in range(0, len(least), SYMBOLS)]
    return [signed(xxhash.xxh64_intdigest(np.delete(p, k).tobytes(), s * SYMBOLS + k)) for s, p in enumerate(parts) for k in range(SYMBOLS)]


def similar(common: np.ndarray | int, a: np.ndarray | int, b: int, least: float = LEAST) -> np.ndarray | bool:
    """Whether sets of ``a`` and ``b`` members of which ``common`` are shared are similar enough."""
    return common >= least * (a + b - common) - 1e-9


def cross_links(left: list[np.ndarray], right: list[np.ndarray], least: float = LEAST) -> list[tuple[int, int]]:
    """The pairs of positions in ``left`` and ``right`` whose sets are similar enough."""
    sizes = np.fromiter(map(len, right), np.int64, len(right))
    owner = np.repeat(np.arange(len(right)), sizes)
    members = np.concatenate(right)
    order = np.argsort(members)
    members, owner = members[order], owner[order]
    out = []
    for i, s in enumerate(left):
        a, b = np.searchsorted(members, s, "left"), np.searchsorted(members, s, "right")
        hit = np.repeat(a - np.concatenate(([0], np.cumsum(b - a)[:-1])), b - a) + np.arange(int((b - a).sum()))
        common = np.bincount(owner[hit], minlength=len(right))
        out += [(i, j) for j in np.flatnonzero(similar(common, sizes, len(s), least)).tolist()]
    return out


def forest(together: list[int], links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The links that connect what was not connected by those before; the nodes ``together`` are connected already."""
    root: dict[int, int] = dict.fromkeys(together, together[0]) if together else {}
    out = []

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        p, q = top(a), top(b)
        if p != q:
            root[p] = q
            out.append((a, b))
    return out


def signatures(docs: DataFrame, keep: list[str], text: str) -> DataFrame:
    """``keep``, ``fp`` (a hash of the set of shingles), ``size`` (its members) and ``keys`` (its variants)."""

    def run(texts: list[bytes | None]) -> dict[str, list]:
        sets = [shingles_of(t) for t in texts]
        return {"fp": [signed(xxhash.xxh64_intdigest(s.tobytes())) for s in sets], "size": list(map(len, sets)), "keys": list(map(keys_of, sets))}

    return map_texts(docs, keep, text, run, "fp long, size long, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (``a``, ``b``) whose texts are similar enough."""

    def run(batches):
        for batch in batches:
            a, b, x, y = batch.columns
            keep, known = [], {}
            for s, t in zip(x.cast(pa.binary()).to_pylist(), y.cast(pa.binary()).to_pylist(), strict=True):
                if s not in known:
                    known = {s: shingles_of(s)}
                s, t = known[s], shingles_of(t)
                keep.append(bool(similar(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t))))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = texts.select(F.col("fp").alias("a"), F.col("text").alias("x")), texts.select(F.col("fp").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def links(own: DataFrame, single: DataFrame, block: int = 16) -> DataFrame:
    """Links (``a``, ``b``, a < b) between distinct fingerprints that connect all that are similar enough; each link is.

    ``own`` has ``fp`` and ``text`` of every document, ``single`` one row of ``fp``, ``size`` and ``keys`` for each ``fp``.
    """
    keyed = single.select("fp", "size", F.explode("keys").alias("key"))
    met = materialize(shared_keys(keyed, ["key"]), "near-keys")
    few, many = met.filter(F.col("n") <= block), met.filter(F.col("n") > block)
    a, b = few.select("key", F.col("fp").alias("a"), F.col("size").alias("p")), few.select("key", F.col("fp").alias("b"), F.col("size").alias("q"))
    # Sets of too different sizes cannot be similar enough.
    close = F.least("p", "q") >= F.lit(LEAST) * F.greatest("p", "q") - F.lit(1e-9)
    met_few = a.join(b, "key").filter((F.col("a") < F.col("b")) & close).select("a", "b")
    leader = many.groupBy("key").agg(F.min(F.struct(F.col("fp").alias("a"), F.col("size").alias("p"))).alias("l")).select("key", "l.a", "l.p")
    led = many.join(leader, "key").filter("fp <> a")
    star = led.withColumnRenamed("size", "q").filter(close).select("a", F.col("fp").alias("b"))
    pairs = materialize(met_few.unionByName(star).distinct(), "near-pairs")

    wanted = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).unionByName(many.select("fp")).distinct()
    wanted = materialize(wanted, "near-wanted")
    # Rows are combined by fingerprint before the join, so copies do not meet in one task.
    texts = maybe_in(own.select("fp", "text"), wanted, ["fp"]).groupBy("fp").agg(F.first("text").alias("text"))
    texts = materialize(texts.join(wanted, "fp", "left_semi"), "near-texts")
    good = materialize(verified(pairs, texts), "near-good")
    discard(wanted)
    discard(pairs)

    # Members that are not like their leader are compared with all of their crowd.
    rest = materialize(led.select("key", "a", F.col("fp").alias("b")).join(good, ["a", "b"], "left_anti").select("key", F.col("b").alias("fp")), "near-rest")
    if rest.isEmpty():
        return good
    chunk = 64 * block
    counts = rest.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
    sized = many.select("key", "n").distinct().join(counts, "key").select("key", F.ceil(F.col("m") / chunk).cast("int").alias("ls"), F.ceil(F.col("n") / chunk).cast("int").alias("rs"))
    mine = lambda parts: F.pmod(F.xxhash64("fp"), F.col(parts)).cast("int")
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    # Sides: 0 those that are compared, 1 members that are linked to their leader (or lead), 2 others.
    left = rest.join(sized, "key").select("key", "fp", F.lit(0).alias("side"), mine("ls").alias("i"), every("rs").alias("j"))
    loose = F.when(F.col("x").isNull(), F.lit(1)).otherwise(F.lit(2))
    right = many.join(rest.withColumn("x", F.lit(1)), ["key", "fp"], "left").join(sized, "key").select("key", "fp", loose.alias("side"), mine("rs").alias("j"), every("ls").alias("i"))

    def crowd(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        sets = [shingles_of(t.encode() if t else None) for t in group["text"]]
        side, fps = group["side"].to_numpy(), group["fp"].to_numpy(np.int64).tolist()
        x, y = np.flatnonzero(side == 0).tolist(), np.flatnonzero(side > 0).tolist()
        pairs = cross_links([sets[k] for k in x], [sets[k] for k in y]) if x and y else []
        together = [fps[k] for k in np.flatnonzero(side == 1).tolist()]
        got = forest(together, [(fps[x[i]], fps[y[j]]) for i, j in pairs])
        return pd.DataFrame({"a": [min(e) for e in got], "b": [max(e) for e in got]}, dtype="int64")

    crowded = left.unionByName(right).join(texts, "fp").groupBy("key", "i", "j").applyInPandas(crowd, "a long, b long")
    return good.unionByName(crowded).distinct()
