"""Where stages and operators once did less than the whole job."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorjobs.llm import quality_ledger, shingle_sketch, simhash_dedup, source_mixing

ODD_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "en", "web", len(t or "")) for k, t in rows], ODD_SCHEMA)


def brute_stay(texts):
    """The smallest id of each component of five-word-shingle similarity 0.8 or more, on plain strings."""
    sets = {}
    for k, t in texts:
        w = (t or "").lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    root = {k: k for k in sets}
    pairs = 0
    for a in sorted(sets):
        for b in sorted(sets):
            common = len(sets[a] & sets[b])
            if a < b and 5 * common >= 4 * (len(sets[a]) + len(sets[b]) - common):
                pairs += 1
                low, high = sorted((root[a], root[b]))
                root = {k: low if r == high else r for k, r in root.items()}
    return set(root.values()), pairs


@pytest.mark.parametrize("block", [1, 16])
def test_near_copies_against_brute_force(spark, block):
    """Edited copies of 60 to 400 words with one to nine words replaced, above and below the limit."""
    rng = random.Random(block)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(2000)}" for _ in range(rng.choice([60, 120, 400]))]
        for edits in (0, 1, 1, 2, 3, 5, 9):
            w = list(base)
            for _ in range(edits):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    rows = [*enumerate(texts, 1), (901, None), (902, " "), (903, "few words"), (904, "Few  words")]
    want, pairs = brute_stay(rows)
    assert pairs > 150
    keep = lambda df: simhash_dedup.keep_one(df, width=5, similarity=0.8, block=block)
    # Of the blank texts, the repeated row and the row without an id, one row of each component stays.
    got = keep(table(spark, [*rows, rows[3], (None, texts[0]), (None, "only here"), (None, "only here")]))
    assert Counter(r.doc_id for r in got.collect()) == Counter([*want, None]) and got.columns == table(spark, rows).columns
    assert keep(table(spark, rows).limit(0)).count() == 0


def test_unlike_texts_in_a_crowd(spark):
    """Members of a crowd that are not like its first are compared with all of it; no link is lost."""
    rng = random.Random(9)
    words = [f"w{k}" for k in range(300)]
    texts = []
    for k in range(60):  # a chain: each like the next ones only, all with the first 240 words
        w = words[:240] + [f"c{k + j}" for j in range(60)]
        texts.append(" ".join(w))
    rows = list(enumerate(texts, 1))
    rng.shuffle(rows)
    want, pairs = brute_stay(rows)
    got = simhash_dedup.keep_one(table(spark, rows), width=5, similarity=0.8, block=4)
    assert pairs and {r.doc_id for r in got.collect()} == want


def test_cross_links_are_all_that_is_similar():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 40, 90).astype(np.uint64)
    sets = [np.unique(np.concatenate((base[k:], rng.integers(0, 1 << 40, k).astype(np.uint64)))) for k in (0, 5, 9, 14, 40, 44)]
    near = lambda a, b: 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
    assert sorted(shingle_sketch.cross_links(sets, sets[1:])) == [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[1:]) if near(a, b)]


def test_forest_connects_the_same(spark):
    rng = random.Random(4)
    for _ in range(50):
        links = [(rng.randrange(20), rng.randrange(20)) for _ in range(30)]
        together = rng.sample(range(20), 5)

        def parts(edges, together=together):
            root = {k: k for k in range(20)}
            for a, b in [*zip(together, together[1:]), *edges]:
                low, high = root[a], root[b]
                root = {k: low if r == high else r for k, r in root.items()}
            return {frozenset(k for k in root if root[k] == r) for r in root.values()}

        few = shingle_sketch.forest(together, links)
        assert parts(few) == parts(links) and set(few) <= set(links) and len(few) < 20


def test_pipeline_drops_edited_copies(spark):
    """The stage's rule is similarity 0.8: here copies over 4 bits apart, which stayed before."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.col("doc_id").isin(1, 255, 709, 944, 643, 770, 582, 875, 3))
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == [1, 3, 582, 643, 709]


def test_insults_of_all_languages(spark):
    """Learnt on three quarters of the labels, tried on the rest: toxic documents go in each language, others stay."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    unseen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    learned = quality_ledger.learned_insults(docs, labels.filter(~unseen))
    ledger = quality_ledger.build_ledger(docs, ["doc_id", "lang"], insults=learned)
    abused = F.expr(next(r.fails for r in quality_ledger.RULES if r.name == "abuse"))
    rows = ledger.withColumn("abused", abused).join(labels.filter(unseen), "doc_id").groupBy("lang", "toxic").agg(F.avg(F.col("abused").cast("int")).alias("share"), F.count("*").alias("n")).collect()
    share = {(r.lang, r.toxic): r.share for r in rows}
    assert {k[0] for k in share} == {"de", "en", "es", "fr"}
    assert all(v >= 0.8 if toxic else v <= 0.03 for (_, toxic), v in share.items()), [tuple(r) for r in rows]
    clean = [r for r in rows if not r.toxic]
    assert sum(r.share * r.n for r in clean) <= 0.01 * sum(r.n for r in clean)
    assert quality_ledger.learned_insults(docs, labels.limit(0)) == ()


def test_stage_of_rules_knows_all_languages(spark):
    """The stage itself drops toxic documents that are not English."""
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    kept = corpus_pipeline.quality_rules(spark, docs, d)
    assert kept.join(labels.filter("toxic = 1"), "doc_id", "left_semi").count() <= 10


def test_mixed_documents_are_whole(spark):
    """The stage cuts no text; each source stays within half of its longest document of the quota."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = corpus_pipeline.mix_sources(spark, docs, "")
    assert out.join(docs.select("doc_id", F.col("text").alias("was")), "doc_id").filter("text <> was").count() == 0
    rows = source_mixing.mix(source_mixing.sized(docs), whole=True)
    assert rows.filter(F.exists("draws", lambda x: x["words"] != F.col("size"))).count() == 0
    per = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")).collect()
    assert all(abs(r.taken - r.target) <= r.most / 2 + 1 for r in per)


def test_pipeline_odd_rows(spark, tmp_path):
    """Nulls in any column, blank and repeated rows, and columns that clash with the operators' names: no crash, the columns of documents only."""
    good = " ".join(f"word{k}" for k in range(80))
    rows = [(1, good, "en", "a", 5), (1, good, "en", "a", 5), (None, good + " more", None, None, None), (2, None, "en", "a", None), (3, "", None, "b", 0), (4, " \n ", "en", None, 3), (5, good[::-1], "en", "b", 1)]
    docs = spark.createDataFrame(rows, ODD_SCHEMA).withColumns({c: F.lit("x") for c in ("shard", "slot", "size", "fp", "kept", "c0__", "__row", "N_WORDS")})
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[:5] == corpus_pipeline.COLUMNS and (k == 4 or len(docs.columns) == 5)
    got = docs.collect()
    assert {r.doc_id for r in got} <= {1, None, 5} and {r.text for r in got} <= {good, good + " more", good[::-1]}
