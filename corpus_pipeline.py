"""Documents to training shards: rules, near-duplicates, benchmark passages, mixing, sharding.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and is written before the next.

Defined results
---------------
* null and blank texts have fewer than 50 words, so the rules reject them; null languages, sources and
  counts pass; rows without an id pass as rows of their own;
* repeated rows and rows that tie: one row of each near-duplicate component goes on (see ``keep_one``);
* an empty table gives an empty result with all columns; without labels no word counts as an insult;
* of the input only the columns of documents are read: others go, whatever their names.
* The mix draws whole documents in the shards of its tree; sharding then places every drawn row anew, since
  a stage hands on the columns of documents only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm import decontaminate, quality_ledger, simhash_dedup, source_mixing, vector_sharding
from sensorjobs.llm.common import materialize, release

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy; the labels give the insults of all languages."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    insults = quality_ledger.learned_insults(docs, labels)
    ledger = quality_ledger.build_ledger(docs, keep=COLUMNS, insults=insults)
    return quality_ledger.apply_policy(ledger).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component (five-word shingles, similarity 0.8): the smallest id."""
    return simhash_dedup.keep_one(docs.select(*COLUMNS), width=5, similarity=0.8).select(*COLUMNS)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly benchmark go."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontaminate.remove_spans(docs.select(*COLUMNS), bench)
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document appears once for each pass that draws it, always whole."""
    rows = source_mixing.sized(docs.select(*COLUMNS))
    drawn = source_mixing.mixed_rows(source_mixing.mix(rows, whole=True))
    return drawn.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot."""
    rows = vector_sharding.sized(docs.select(*COLUMNS))
    return vector_sharding.shard(rows).select(*COLUMNS, "size", "shard", "slot")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("mix_sources", mix_sources),
    ("shards", shards),
]

#: No stage list that holds fingerprints by XXH64 and hashed draws can be written in DuckDB SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
            release(spark)
    return docs
