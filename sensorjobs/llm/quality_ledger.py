"""Quality rules as a bitmask ledger.

``build_ledger`` reads every text once and stores, for each document, the measurements and one bit
for each failed rule. Policies are versioned masks over these bits: applying another policy, or
asking what one rule costs (``ablation``), touches the ledger and never the texts.

Defined results
---------------
* null text: no words, so every count is 0 and ``few_words`` fails;
* empty text: like null; very long texts: counted whole;
* repeated rows: each row gets its own ledger row; empty table: empty ledger;
* extra columns of the input are kept only if named in ``keep``; the ledger's own columns win on a clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import map_texts, materialize

#: Characters counted by ``n_symbols`` (fixed by the operator's contract).
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
#: Everything but ASCII letters, digits and bytes of other scripts becomes a space; A-Z become a-z.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
AZ, az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_lower long, n_bangs long, n_insults long"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of ``width`` words found at least twice in the list."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i : i + n] for i in range(width)), strict=True))
    if len(set(grams)) == n:
        return 0
    first: dict = {}
    hit = bytearray(len(words))
    ones = b"\x01" * width
    for i, g in enumerate(grams):
        j = first.setdefault(g, i)
        if j != i:
            hit[i : i + width] = ones
            hit[j : j + width] = ones
    return sum(hit)


def measure(texts: list[bytes | None], insults: frozenset[bytes]) -> dict[str, list[int]]:
    """The measurements of a batch of texts, one list a column of ``MEASURES``."""
    out: dict[str, list[int]] = {c.split()[0]: [] for c in MEASURES.split(", ")}
    for raw in texts:
        b = raw or b""
        words = b.split()
        chars = len(b.decode("utf-8", "replace"))
        lines = b.split(b"\n")
        seen: set[bytes] = set()
        again = filled = 0
        for line in lines:
            if line.translate(None, SPACES):
                filled += 1
                again += line in seen
                seen.add(line)
        size = len(b)
        row = {
            "n_words": len(words),
            "word_chars": chars - (size - len(b.translate(None, SPACES))),
            "n_symbols": size - len(b.translate(None, SYMBOLS)),
            "n_dup_lines": again,
            "n_repeat_words": repeated_words(words),
            "n_lines": filled,
            "n_upper": size - len(b.translate(None, UPPER)),
            "n_lower": size - len(b.translate(None, LOWER)),
            "n_bangs": b.count(b"!!"),
            "n_insults": sum(w in insults for w in b.translate(PLAIN).split()),
        }
        for k, v in row.items():
            out[k].append(v)
    return out


#: Labelled documents that the insults are learnt from at most.
SAMPLE = 20_000


def learned_insults(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least_documents: int = 5, least_share: float = 0.01, odds: float = 20.0, text: str = "text") -> tuple[str, ...]:
    """Words that tell toxic documents from others, in any language, from at most ``sample`` labels in hash order.

    Equal texts count once, and a word must stand in ``least_documents`` and ``least_share`` of the toxic ones,
    so that the words of a few texts with many copies are no insults. Otherwise the same test as the
    lexicon of ``site_quality.fit``, over the whole sample: nothing else is fitted on it.
    """
    usable = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic").distinct()
    few = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample)
    # The sample is bounded, so it can be sent to the documents.
    rows = materialize(docs.select("doc_id", F.col(f"`{text}`").alias("text")).join(F.broadcast(few), "doc_id"), "ledger-sample")
    rows = rows.select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") == 1).cast("int").alias("toxic")).distinct()
    toxic, clean = F.col("toxic") == 1, F.col("toxic") != 1
    words = F.array_distinct(F.split(F.translate(F.coalesce("text", F.lit("")), AZ, az), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"))
    n_bad, n_fine = rows.agg(F.count_if(toxic), F.count_if(clean)).first()
    by_word = rows.select("toxic", F.explode(words).alias("word")).filter("word <> ''").groupBy("word").agg(F.count_if(toxic).alias("bad"), F.count_if(clean).alias("fine"))
    telling = by_word.filter((F.col("bad") >= least_documents) & (F.col("bad") >= least_share * n_bad) & ((F.col("bad") + 0.5) / (n_bad + 1) >= odds * (F.col("fine") + 0.5) / (n_fine + 1)))
    # No more words than the bounded sample has.
    return tuple(sorted(r["word"] for r in telling.select("word").toLocalIterator()))


@dataclass(frozen=True)
class Rule:
    """One rule: its bit, its name and the SQL condition under which a document fails it."""

    bit: int
    name: str
    fails: str


#: Bits never change meaning; a new rule takes the next bit. All conditions compare integers.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "100 * n_symbols > 10 * n_words"),
    Rule(3, "duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule(4, "upper_case", "n_upper > n_lower"),
    Rule(5, "exclamations", "100 * n_bangs > 10 * n_words"),
    Rule(6, "word_length", "word_chars > 20 * n_words OR word_chars < 2 * n_words"),
    Rule(7, "some_repetition", "100 * n_repeat_words > 30 * n_words"),
    Rule(8, "abuse", "1000 * n_insults > 5 * n_words"),
)


def mask_of(*names: str) -> int:
    """The mask of the named rules."""
    return sum(1 << r.bit for r in RULES if r.name in names)


BASE = mask_of("few_words", "repeated_words")
#: Versioned policies: a document is kept if it fails none of the rules of the mask.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask_of("symbols", "duplicate_lines", "upper_case", "exclamations", "word_length"),
    "v2": BASE | mask_of("symbols", "duplicate_lines", "upper_case", "exclamations", "word_length", "some_repetition", "abuse"),
}
CURRENT = "v2"


def build_ledger(docs: DataFrame, keep: list[str] | None = None, text: str = "text", insults: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` columns, the measurements and ``fail_mask`` (bit k set: rule k failed).

    ``insults`` are the words that the abuse rule counts (see ``learned_insults``); without any, no document fails it.
    """
    keep = ["doc_id"] if keep is None else keep
    own = {c.split()[0] for c in MEASURES.split(", ")} | {"fail_mask"}
    keep = [c for c in keep if c.lower() not in own]
    listed = frozenset(w.lower().encode() for w in insults)
    rows = map_texts(docs, keep, text, lambda texts: measure(texts, listed), MEASURES)
    bits: Column = F.lit(0).cast("long")
    for rule in RULES:
        bits = bits + F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
    return rows.withColumn("fail_mask", bits)


def apply_policy(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    return ledger.withColumn("kept", F.col("fail_mask").bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0)


def ablation(ledger: DataFrame, version: str = CURRENT) -> DataFrame:
    """For each rule of a policy: how many documents fail it, and how many fail it alone (dropping the rule keeps these).

    One grouped count over distinct failure masks, then bit tests on at most ``2 ** rules`` rows.
    """
    spark = ledger.sparkSession
    policy = POLICIES[version]
    masks = ledger.groupBy(F.col("fail_mask").bitwiseAND(F.lit(policy).cast("long")).alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    rules = spark.createDataFrame([(r.bit, r.name, 1 << r.bit) for r in RULES if policy >> r.bit & 1], "bit int, rule string, flag long")
    hit = F.col("mask").bitwiseAND(F.col("flag")) != 0
    return (
        F.broadcast(rules)
        .join(masks, hit, "left")
        .groupBy("bit", "rule")
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_failed"),
            F.coalesce(F.sum(F.when(F.col("mask") == F.col("flag"), F.col("n"))), F.lit(0)).alias("n_failed_alone"),
        )
    )


def stored_ledger(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The ledger of all documents with the insults that the labels give, written to the shared folder: what reads it reads no text."""
    return materialize(build_ledger(docs, keep, insults=learned_insults(docs, labels)), "ledger")


def ledger_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored ledger of the documents of ``sf_dir``."""
    return stored_ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def policies(ledger: DataFrame) -> DataFrame:
    """How many documents each version of the policy keeps, in one pass over the ledger."""
    kept = lambda version: F.count_if(F.col("fail_mask").bitwiseAND(F.lit(POLICIES[version]).cast("long")) == 0)
    one = ledger.agg(F.count(F.lit(1)).alias("n"), *[kept(v).alias(v) for v in POLICIES])
    rows = F.array(*[F.struct(F.lit(v).alias("version"), F.lit(m).cast("long").alias("mask"), F.col(v).alias("n_kept"), (F.col("n") - F.col(v)).alias("n_rejected")) for v, m in POLICIES.items()])
    return one.select(F.explode(rows).alias("x")).select("x.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: the ledger of all documents with the base verdict and the current policy's."""
    base_failed = F.col("fail_mask").bitwiseAND(F.lit(BASE).cast("long")) != 0
    return apply_policy(ledger_of(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), "kept", "fail_mask",
    )


def ablation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy costs, from the ledger of all documents."""
    return ablation(ledger_of(spark, sf_dir))


def policies_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each version of the policy keeps, from the ledger of all documents."""
    return policies(ledger_of(spark, sf_dir))


def _ledger_sql() -> str:
    """The ledger in DuckDB SQL, on whole texts, as the table ``f``; labels are below the sample's bound at the scale it runs at."""
    words = rf"regexp_extract_all(translate(t, '{AZ}', '{az}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    gone = lambda chars: f"length(t) - length(regexp_replace(t, '{chars}', '', 'g'))"
    bits = " + ".join(f"CASE WHEN {r.fails} THEN {1 << r.bit} ELSE 0 END" for r in RULES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
lab AS (SELECT DISTINCT doc_id, toxic FROM labels WHERE doc_id IS NOT NULL AND toxic IS NOT NULL),
ld AS (SELECT DISTINCT toxic = 1 AS bad, t FROM d JOIN lab USING (doc_id)),
ln AS (SELECT count(*) FILTER (bad) AS nb, count(*) FILTER (NOT bad) AS nf FROM ld),
lw AS (SELECT word, count(*) FILTER (bad) AS b, count(*) FILTER (NOT bad) AS f FROM (SELECT bad, unnest(list_distinct({words})) AS word FROM ld) GROUP BY word),
listed AS (SELECT word FROM lw, ln WHERE b >= 5 AND b >= 0.01::DOUBLE * nb AND (b + 0.5::DOUBLE) / (nb + 1) >= 20.0::DOUBLE * (f + 0.5::DOUBLE) / (nf + 1)),
w AS (SELECT r, regexp_extract_all(t, '[^ 	-
]+') AS w FROM d),
g AS (SELECT r, k, concat_ws(' ', w[k], w[k + 1], w[k + 2]) AS s FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS k FROM w WHERE len(w) > 2)),
rp AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(k, k + 3)) AS p FROM (SELECT r, k, count(*) OVER (PARTITION BY r, s) AS c FROM g) WHERE c > 1) GROUP BY r),
l AS (SELECT r, count(*) AS n, count(DISTINCT x) AS u FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^ 	-
]') GROUP BY r),
i AS (SELECT r, count(*) AS n FROM (SELECT r, unnest({words}) AS x FROM d) WHERE x IN (SELECT word FROM listed) GROUP BY r),
m AS (SELECT d.doc_id, len(w.w)::BIGINT AS n_words, length(regexp_replace(t, '[ 	-
]', '', 'g'))::BIGINT AS word_chars, ({gone('[#*$%&|<>]')})::BIGINT AS n_symbols,
  coalesce(l.n - l.u, 0)::BIGINT AS n_dup_lines, coalesce(rp.n, 0)::BIGINT AS n_repeat_words, coalesce(l.n, 0) AS n_lines, {gone('[A-Z]')} AS n_upper, {gone('[a-z]')} AS n_lower,
  (length(t) - length(replace(t, '!!', ''))) // 2 AS n_bangs, coalesce(i.n, 0) AS n_insults
  FROM d JOIN w USING (r) LEFT JOIN l USING (r) LEFT JOIN rp USING (r) LEFT JOIN i USING (r)),
f AS (SELECT *, ({bits})::BIGINT AS fail_mask FROM m)
"""


ORACLE = _ledger_sql() + f"SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_mask & {BASE} <> 0 AS base_failed, fail_mask & {POLICIES[CURRENT]} = 0 AS kept, fail_mask FROM f"
ABLATION_ORACLE = _ledger_sql() + " UNION ALL ".join(
    f"SELECT {r.bit}::INTEGER AS bit, '{r.name}' AS rule, count(*) FILTER (fail_mask & {1 << r.bit} <> 0)::BIGINT AS n_failed, count(*) FILTER (fail_mask & {POLICIES[CURRENT]} = {1 << r.bit})::BIGINT AS n_failed_alone FROM f"
    for r in RULES if POLICIES[CURRENT] >> r.bit & 1
)
POLICIES_ORACLE = _ledger_sql() + " UNION ALL ".join(
    f"SELECT '{v}' AS version, {m}::BIGINT AS mask, count(*) FILTER (fail_mask & {m} = 0)::BIGINT AS n_kept, count(*) FILTER (fail_mask & {m} <> 0)::BIGINT AS n_rejected FROM f" for v, m in POLICIES.items()
)
