"""Quality classifier with hierarchical empirical Bayes over hosts and paths.

1. Document evidence: measurements of the whole text and hits of a lexicon of abusive words, weighed
   by two logistic regressions that Spark fits on a bounded sample of labelled rows (``sample``
   documents in hash order: half of them give the lexicon, the other half the weights).
2. Site evidence: the evidence of all documents is summed by path (source and language) and host
   (source). Hosts shrink toward the global mean, paths toward their host, each by the ratio of the
   variance within to the variance between, estimated from the sums (method of moments).
3. A document's log-odds are its own plus what the other documents of its path and host add over the
   global mean: its own evidence is left out of these sums, so a document alone on its site gets nothing added.

Only sums are grouped, so a host of a third of all rows is combined before the shuffle. Tables of
hosts and paths have one row a site and are joined, not collected.

Defined results
---------------
* null and empty texts are texts without words; null hosts and paths are sites of their own;
* documents with several labels count once for each; without usable labels (none, or of one
  kind) the evidence is the share of good labels, or one half;
* repeated rows each get a row; empty table: empty result; other columns are ignored unless in ``keep``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import map_texts, materialize, null_safe_join
from sensorjobs.llm.quality_ledger import AZ, MEASURES, az, measure

#: Documents of the labelled sample at most.
SAMPLE = 20_000


def measured(docs: DataFrame, keep: list[str], lexicon: frozenset[bytes], text: str = "text") -> DataFrame:
    """``keep`` and the measurements of quality_ledger, with the lexicon's hits as ``n_insults``."""
    return map_texts(docs, keep, text, lambda texts: measure(texts, lexicon), MEASURES)


def features() -> dict[str, Column]:
    """Shape of a text as numbers near 0..1."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    part = lambda a, b: F.least(F.lit(1.0), F.col(a) / b)
    return {
        "f_symbols": part("n_symbols", words), "f_bangs": part("n_bangs", words), "f_repeats": part("n_repeat_words", words),
        "f_lines": part("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1))), "f_upper": F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1)),
        "f_length": F.least(F.lit(1.0), F.log1p("n_words") / 10), "f_blank": (F.col("n_words") == 0).cast("double"),
    }


@dataclass(frozen=True)
class Evidence:
    """Weights of the two regressions (intercept under '') and the lexicon."""

    good: dict[str, float]
    abuse: dict[str, float]
    lexicon: frozenset[bytes]

    def log_odds(self) -> Column:
        """log-odds that a measured document is good: of good shape and not abusive."""
        f = features() | {"hits": F.log1p("n_insults")}
        z = lambda w: sum((f[k] * v for k, v in w.items() if k), F.lit(w[""]))
        one = lambda x: 1 / (1 + F.exp(-x))
        p = F.least(F.lit(0.999), F.greatest(F.lit(0.001), one(z(self.good)) * (1 - one(z(self.abuse)))))
        return F.log(p / (1 - p))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_documents: int = 5, odds: float = 20.0) -> Evidence:
    """Fit on at most ``sample`` labelled documents (``doc_id``, ``quality``, ``toxic``)."""
    usable = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "quality", "toxic").distinct()
    few = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "toxic").limit(sample)
    # The sample is bounded, so it can be sent to the documents.
    rows = materialize(docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(2))), "site-sample")
    toxic, clean = F.col("toxic") == 1, F.col("toxic") != 1
    words = F.array_distinct(F.split(F.translate(F.coalesce("text", F.lit("")), AZ, az), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"))
    learning = rows.filter("half = 0")
    n_bad, n_fine = learning.agg(F.count_if(toxic), F.count_if(clean)).first()
    by_word = learning.select("toxic", F.explode(words).alias("word")).filter("word <> ''").groupBy("word").agg(F.count_if(toxic).alias("bad"), F.count_if(clean).alias("fine"))
    telling = by_word.filter((F.col("bad") >= least_documents) & ((F.col("bad") + 0.5) / (n_bad + 1) >= odds * (F.col("fine") + 0.5) / (n_fine + 1)))
    # No more words than the bounded sample has.
    lexicon = frozenset(r["word"].encode() for r in telling.select("word").toLocalIterator())
    fitting = materialize(measured(rows.filter("half = 1"), ["quality", "toxic"], lexicon), "site-fit")
    f = features()
    good = regression(fitting.select((F.col("quality") == 1).cast("double").alias("label"), *[c.alias(k) for k, c in f.items()]), list(f))
    abuse = regression(fitting.select((F.col("toxic") == 1).cast("double").alias("label"), F.log1p("n_insults").alias("hits")), ["hits"])
    return Evidence(good, abuse, lexicon)


def regression(rows: DataFrame, names: list[str]) -> dict[str, float]:
    """Weights of a logistic regression of ``label`` by name, the intercept under ''."""
    import math

    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0 or ones in (0, n):
        share = (ones + 0.5) / (n + 1)
        return {"": math.log(share / (1 - share)) if n else 0.0}
    model = LogisticRegression(regParam=1e-3, maxIter=50).fit(VectorAssembler(inputCols=names, outputCol="features").transform(rows))
    return dict(zip(names, map(float, model.coefficients), strict=True)) | {"": float(model.intercept)}


def shrink(judged: DataFrame) -> DataFrame:
    """One row a path: (``host``, ``path``, ``n``, ``s``, ``hn``, ``hs``), the counts and sums of the probabilities of
    the path and its host, and with them ``overall``, the global mean, and both prior strengths.

    ``judged`` has ``host``, ``path`` and ``p``, the probability of each document.
    """
    sums = [F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("q")]
    paths = judged.groupBy("host", "path").agg(*sums)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    # One row: the global mean, the variance within hosts and between them (weighted by size).
    whole = hosts.agg(F.sum("hn").alias("N"), F.sum("hs").alias("S"), F.sum("hq").alias("Q"), F.count(F.lit(1)).alias("k"), F.sum(F.col("hs") * F.col("hs") / F.col("hn")).alias("B"), F.sum(F.col("hn") * F.col("hn")).alias("nn"))
    within = F.greatest(F.lit(1e-6), (F.col("Q") - F.col("B")) / F.greatest(F.col("N") - F.col("k"), F.lit(1)))
    between = F.greatest(F.lit(1e-6), (F.col("B") - F.col("S") * F.col("S") / F.col("N") - (F.col("k") - 1) * F.col("within")) / F.greatest(F.col("N") - F.col("nn") / F.col("N"), F.lit(1.0)))
    whole = whole.filter("N > 0").withColumn("within", within).withColumn("strength", F.col("within") / between).select((F.col("S") / F.col("N")).alias("overall"), "within", "strength").first()
    overall, within, strength = map(F.lit, whole or (0.5, 1.0, 1.0))
    paths = null_safe_join(paths, hosts, ["host"])
    spread = F.sum(F.col("s") * F.col("s") / F.col("n") - F.col("s") * F.col("hs") / F.col("hn"))
    inner = paths.agg(spread.alias("PB"), F.sum("n").alias("N"), F.count(F.lit(1)).alias("pk"), F.countDistinct(F.struct("host")).alias("hk"))
    inner = inner.filter("N > 0").select(within / F.greatest(F.lit(1e-6), (F.col("PB") - (F.col("pk") - F.col("hk")) * within) / F.col("N"))).first()
    return paths.select("host", "path", "n", "s", "hn", "hs", overall.alias("overall"), strength.alias("strength"), F.lit(inner[0] if inner else 1.0).alias("path_strength"))


def others(p: Column) -> Column:
    """The posterior mean of a document's path from all its other documents: hosts shrink toward the global mean, paths toward their host.

    The document's own evidence is taken out of both sums, so that it counts once.
    """
    host = (F.col("hs") - p + F.col("strength") * F.col("overall")) / (F.col("hn") - 1 + F.col("strength"))
    return (F.col("s") - p + F.col("path_strength") * host) / (F.col("n") - 1 + F.col("path_strength"))


def classify(docs: DataFrame, evidence: Evidence, host: str = "source", path: str = "lang", id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``document_p``, ``site_p``, ``posterior`` and ``kept`` (posterior of at least one half) of every row."""
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{host}`").alias("host"), F.col(f"`{path}`").alias("path"), F.col(f"`{text}`").alias("text"))
    judged = measured(rows, ["doc_id", "host", "path"], evidence.lexicon).select("doc_id", "host", "path", evidence.log_odds().alias("z"))
    judged = materialize(judged.withColumn("p", 1 / (1 + F.exp(-F.col("z")))), "site-judged")
    limit = lambda c: F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), c))
    joined = null_safe_join(judged, shrink(judged), ["host", "path"]).withColumn("site", limit(others(F.col("p"))))
    odds = lambda c: F.log(c / (1 - c))
    z = F.col("z") + odds(F.col("site")) - odds(limit(F.col("overall")))
    return joined.select("doc_id", F.col("p").alias("document_p"), F.col("site").alias("site_p"), (1 / (1 + F.exp(-z))).alias("posterior"), (z >= 0).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: posterior quality of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, fit(docs, labels))
