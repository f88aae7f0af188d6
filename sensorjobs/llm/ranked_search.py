"""Ranked lexical search by dense blocked matrix products.

Each document is turned into the impacts of the query terms it holds, once. Items are put in tiles of
``TILE_ITEMS``; a tile has a compact vocabulary (its own terms only), cut into stretches of columns. For
tiles of ``TILE_DOCS`` documents the dense product (documents x columns) by (columns x items) gives all scores.

All numbers are integers. A stretch of columns is as wide as its partial sums stay below 2^53 at, so a product in
float64 is exact in any order of summation; stretches are added in 64-bit integers. Impacts are below
10^6 and a weight is at most 1000 ln(2N + 2).

Where the work is: one narrow pass counts the terms (its result, some numbers for each document, is written to
the shared folder), grouped sums give N, L and the document frequencies, one narrow pass multiplies. A task hands on its own
best ``k`` of each item; these are merged in two steps. No document meets an item in a join.

The query set is cut by hash of the item into parts of about ``most_pairs`` (item, term) pairs; each part is collected and
sent to the tasks, and takes its own two passes over the documents.

Defined results
---------------
* null and empty texts have no terms and are not counted; texts are read whole;
* repeated documents count, and rank, each for itself; equal scores go to the smaller id, null ids last;
* rows of the same item id are one item with the terms of all of them; null item ids are no items;
* items without terms or without a document above 0, and empty tables, give no rows;
* ids of documents are cast to long; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorjobs.llm.common import discard, map_texts, materialize
from sensorjobs.llm.decontaminate import words_of

#: (item, term) pairs of a part of the query set, items of a tile, documents of a tile, most columns of a stretch.
MOST_PAIRS, TILE_ITEMS, TILE_DOCS, TILE_COLUMNS = 200_000, 64, 1024, 2048
#: Impacts stay below this: 10^9 tf div (1000 tf + 8 m) with m of 10 or more.
TOP_IMPACT = 1_000_000
#: Partial results of an item are first merged in so many groups.
MERGE_GROUPS = 64

HITS = "n long, terms array<int>, counts array<long>"


def item_terms(bench: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item`` (as text) and ``term``, each pair once."""
    found = map_texts(bench.select(F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("words")).filter("item IS NOT NULL"), ["item"], "words", lambda texts: {"term": [[w.decode() for w in {*words_of(t)}] for t in texts]}, "term array<string>")
    return found.select("item", F.explode("term").alias("term")).distinct()


def count_terms(docs: DataFrame, id_column: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents with a term at all: ``id``, ``n`` (terms with repeats), and the counts of the vocabulary's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(texts: list[bytes | None]) -> dict[str, list]:
        known: dict[bytes, int] = shared.value
        got: dict[str, list] = {"n": [], "terms": [], "counts": []}
        for t in texts:
            words = words_of(t)
            held = Counter(filter(known.__contains__, words))
            got["n"].append(len(words))
            got["terms"].append([known[w] for w in held])
            got["counts"].append(list(held.values()))
        return got

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").alias("words"))
    return map_texts(rows, ["id"], "words", run, HITS).filter("n > 0")


class Tile:
    """Some items, and stretches of their compact vocabulary: (terms, weights by term and item)."""

    def __init__(self, items: list[int], wanted: list[list[int]], weight: np.ndarray) -> None:
        self.items = items
        terms = np.array(sorted({t for i in items for t in wanted[i]}), np.int64)
        room = max(1, min(TILE_COLUMNS, (2**53 - 1) // (TOP_IMPACT * max(1, int(weight.max(initial=0))))))
        self.stretches: list[tuple[np.ndarray, np.ndarray]] = []
        for at in range(0, len(terms), room):
            part = terms[at : at + room]
            matrix = np.zeros((len(items), len(part)))
            for row, i in enumerate(items):
                own = np.array(wanted[i], np.int64)
                place = np.searchsorted(part, own)
                inside = (place < len(part)) & (part[np.minimum(place, len(part) - 1)] == own)
                matrix[row, place[inside]] = weight[own[inside]]
            self.stretches.append((part, matrix))

    def scores(self, docs: int, rows: np.ndarray, terms: np.ndarray, impact: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Items x documents, exact. ``place`` is scratch room for all terms, filled with -1."""
        total = np.zeros((len(self.items), docs), np.int64)
        for part, matrix in self.stretches:
            place[part] = np.arange(len(part))
            column = place[terms]
            place[part] = -1
            here = column >= 0
            if here.any():
                dense = np.zeros((len(part), docs))
                dense[column[here], rows[here]] = impact[here]
                total += (matrix @ dense).astype(np.int64)
        return total


class Best:
    """The best ``k`` (score, id) of each item of a tile; ties at the limit are settled by the id."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.least = k, np.zeros(items, np.int64)
        self.score = [np.zeros(0, np.int64) for _ in range(items)]
        self.id = [np.zeros(0, np.int64) for _ in range(items)]
        self.null = [np.zeros(0, bool) for _ in range(items)]

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        better = (scores > 0) & (scores >= self.least[:, None])
        for i in np.nonzero(better.any(axis=1))[0]:
            at = np.nonzero(better[i])[0]
            score, own, none = np.concatenate([self.score[i], scores[i, at]]), np.concatenate([self.id[i], ids[at]]), np.concatenate([self.null[i], null[at]])
            order = np.lexsort((own, none, -score))[: self.k]
            self.score[i], self.id[i], self.null[i] = score[order], own[order], none[order]
            if len(order) == self.k:
                self.least[i] = score[order[-1]]


def best_of_tasks(hits: DataFrame, tiles: list[Tile], n_terms: int, k: int) -> DataFrame:
    """``item`` (number), ``score`` and ``id``: the best ``k`` of each item in each task. ``hits`` needs ``m``."""
    shared = hits.sparkSession.sparkContext.broadcast(tiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: list[Tile] = shared.value
        best = [Best(len(t.items), k) for t in mine]
        place = np.full(n_terms, -1, np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, TILE_DOCS):
                batch = whole.slice(at, TILE_DOCS)
                ids = batch.column(0)
                null = np.array(ids.is_null())
                own = np.array(ids.fill_null(0))
                m = np.array(batch.column(1))
                lists = batch.column(2)
                rows = np.repeat(np.arange(len(m)), np.array(lists.value_lengths()))
                terms, tf = np.array(lists.flatten()), np.array(batch.column(3).flatten())
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[rows])
                for tile, top in zip(mine, best, strict=True):
                    top.add(tile.scores(len(m), rows, terms, impact, place), own, null)
        items = [i for t, b in zip(mine, best, strict=True) for i, s in zip(t.items, b.score, strict=True) for _ in s]
        if items:
            score, own, null = (np.concatenate([x for b in best for x in getattr(b, name)]) for name in ("score", "id", "null"))
            yield pa.RecordBatch.from_arrays([pa.array(items, type=pa.int32()), pa.array(score), pa.array(own, mask=null)], ["item", "score", "id"])

    return hits.select("id", "m", "terms", "counts").mapInArrow(run, "item int, score long, id long")


def merged(rows: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each item with their ``rank``, merged in groups first."""
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    groups = rows.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(MERGE_GROUPS)))
    some = groups.withColumn("r", F.row_number().over(Window.partitionBy("item", "g").orderBy(*order))).filter(F.col("r") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)


def _ranked_part(docs: DataFrame, part: DataFrame, id_column: str, text: str, k: int) -> DataFrame | None:
    """The rows of one part of the query set, with ``item`` as text. None if no document has a term."""
    spark = docs.sparkSession
    # Bounded: a part has about most_pairs rows.
    pairs = part.orderBy("item", "term").collect()
    items = sorted({r["item"] for r in pairs})
    number = {i: n for n, i in enumerate(items)}
    vocabulary = {t: n for n, t in enumerate(sorted({r["term"].encode() for r in pairs}))}
    wanted: list[list[int]] = [[] for _ in items]
    for r in pairs:
        wanted[number[r["item"]]].append(vocabulary[r["term"].encode()])
    hits = materialize(count_terms(docs, id_column, text, vocabulary), "search-hits")
    n_docs, n_all = hits.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        discard(hits)
        return None
    held = hits.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    weight = np.zeros(len(vocabulary))
    for r in held:
        weight[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    tiles = [Tile(list(range(at, min(at + TILE_ITEMS, len(items)))), wanted, weight) for at in range(0, len(items), TILE_ITEMS)]
    # As decimals, so that the product cannot overflow.
    m = F.expr(f"CAST(10 + (CAST(90 * n AS DECIMAL(19, 0)) * CAST({n_docs} AS DECIMAL(19, 0))) DIV {n_all} AS BIGINT)")
    best = materialize(best_of_tasks(hits.withColumn("m", m), tiles, len(vocabulary), k), "search-best")
    discard(hits)
    names = spark.createDataFrame(list(enumerate(items)), "item int, name string")
    return merged(best, k).join(names, "item").select(F.col("name").alias("item"), "rank", "id", "score")


def rank(docs: DataFrame, bench: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item id, ``rank``, document id, ``score``."""
    pairs = materialize(item_terms(bench, item_id, item_text), "search-items")
    parts = max(1, -(-pairs.count() // most_pairs))
    found = [_ranked_part(docs, pairs.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == p), id_column, text, k) for p in range(parts)]
    discard(pairs)
    out = None
    for part in found:
        if part is not None:
            out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "item string, rank int, id long, score long")
    kind = dict(bench.dtypes)[item_id]
    return out.select(F.col("item").cast(kind).alias(item_id), "rank", F.col("id").alias(id_column), "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the ten best documents of every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return rank(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents WHERE text IS NOT NULL),
g AS (SELECT count(*) AS all_docs, sum(len(w))::BIGINT AS all_terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) term FROM benchmark WHERE item_id IS NOT NULL)),
tf AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w)::BIGINT n, unnest(w) term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
wt AS (SELECT term, floor(1000 * ln((2 * any_value(all_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, g GROUP BY term),
im AS (SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * all_docs) // all_terms)) AS impact FROM tf, g),
sc AS (SELECT item_id, r, doc_id, sum(w * impact)::BIGINT AS score FROM q JOIN im USING (term) JOIN wt USING (term) GROUP BY ALL),
rk AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INTEGER AS "rank", doc_id, score FROM sc WHERE score > 0)
SELECT item_id, "rank", doc_id, score FROM rk WHERE "rank" <= 10
"""
