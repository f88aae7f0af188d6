"""Near-duplicate lines by a deletion-neighbourhood join, in DataFrame functions only.

Lines are compared as words (lower case, split at white space). A line goes if an earlier line of
the corpus has the same words, or, for lines of at least ``min_words`` words, is one word edit away
(one word replaced, left out or put in: at five words a similarity of 0.8). Every variant of a line
with one word left out is emitted as a hashed key; lines that share a variant meet, the edit distance
is verified on their words, and the earliest stays. Lines are ordered by document id (nulls last),
the hash of the row's text, the row and the line number, so ids may be of any type and may repeat.

* Rows are written with a number of their own first; every later step reads these numbers.
* Equal lines collapse to their first place before anything is joined.
* A line of n words would emit n variants, so lines without any possible partner are set aside
  first: one edit leaves the first or the last part of a line untouched, so a line must share one of
  these parts with another line (lengths fall into overlapping classes that share part lengths).
* Variants are never paired with each other: a variant's earliest line is a grouped minimum, joined back.
  Lines that share a variant with the same place left out are one replacement apart, all of them; a
  line equal to a variant is one deletion apart from all that have it. So the minimum is enough.

Defined results
---------------
* null and empty texts have one line without words; lines without words always stay;
* repeated rows and rows with the same id or none are rows of their own: the earliest row keeps the line;
* chains: a line goes for any earlier line within one edit, also for one that goes itself, so of a
  chain of lines, each an edit from the one before, the first stays;
* very long lines emit as many variants as they have words; empty table: empty result;
* other columns are kept by ``dedup`` and ignored by the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import discard, materialize, maybe_in

def plain(low: Column) -> Column:
    """The text with white space inside a line as one space (most texts have no other and are left as they are)."""
    odd = F.lit(False)
    for c in ("  ", "\t", "\x0b", "\x0c", "\r"):
        odd = odd | F.contains(low, F.lit(c))
    return F.when(odd, F.regexp_replace(low, "[ \\t\\x0B\\f\\r]+", " ")).otherwise(low)


def numbered(docs: DataFrame) -> DataFrame:
    """The documents written with ``__row``, a number of their own."""
    return materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "lines-docs")


def raw_lines(rows: DataFrame, id_column: str, text: str) -> DataFrame:
    """One row a line with a word of ``numbered`` documents: ``at``, and ``s``, its words joined by spaces.

    ``at`` orders lines: (no id, id, hash of the row's text, row, line).
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    of = F.col(f"`{id_column}`")
    low = rows.select(of.isNull().alias("z"), of.alias("doc"), F.xxhash64(t).alias("hash"), F.col("__row").alias("row"), F.lower(t).alias("low"))
    split = low.select("z", "doc", "hash", "row", F.posexplode(F.split(plain(F.col("low")), "\n")).alias("line", "t"))
    return split.select(F.struct("z", "doc", "hash", "row", "line").alias("at"), F.btrim("t", F.lit(" ")).alias("s")).filter(F.col("s") != "")


def lines_of(raw: DataFrame) -> DataFrame:
    """``raw_lines`` with ``n``, the number of words, and two hashes of them."""
    n = F.octet_length("s") - F.octet_length(F.replace("s", F.lit(" "), F.lit(""))) + 1
    return raw.select("at", "s", n.alias("n"), F.xxhash64("s").alias("h1"), F.hash("s").alias("h2"))


def part_of(count: Column) -> Column:
    """The first words of the line, or the last ones for a negative count."""
    return F.call_function("substring_index", F.col("s"), F.lit(" "), count.cast("int"))


def ends(min_words: int, width: int = 8) -> list[Column]:
    """Hashes of the parts one of which two lines within one edit share: class of length, side, part.

    A line of n words belongs to the classes of n and n - 1, so lines of n and n + 1 words share one.
    A class's part length is under half of its shortest line: an edit touches one side only.
    """
    here, below = F.floor(F.col("n") / width), F.floor((F.col("n") - 1) / width)
    out = []
    for c, used in ((here, F.lit(True)), (below, here != below)):
        words = F.floor((F.greatest(c * width, F.lit(min_words)) - 1) / 2)
        for side in (1, -1):
            out.append(F.when(used & (F.col("n") >= min_words), F.xxhash64(c, F.lit(side), part_of(words * side))))
    return out


def without(i: Column) -> Column:
    """The words of the line but the i-th (from 1), joined by spaces."""
    return F.concat_ws(" ", F.nullif(part_of(i - 1), F.lit("")), F.nullif(part_of(i - F.col("n")), F.lit("")))


def within_one_edit(a: Column, b: Column) -> Column:
    """Word edit distance of at most one between two arrays."""
    long, short = F.when(F.size(a) >= F.size(b), a).otherwise(b), F.when(F.size(a) >= F.size(b), b).otherwise(a)
    same = F.zip_with(long, short, lambda x, y: F.coalesce(x == y, F.lit(False)))
    first = F.coalesce(F.nullif(F.array_position(same, F.lit(False)), F.lit(0)), F.size(long))
    rest = F.slice(long, first.cast("int") + 1, F.size(long))
    replaced = rest == F.slice(short, first.cast("int") + 1, F.size(long))
    left_out = rest == F.slice(short, first.cast("int"), F.size(long))
    return F.when(F.size(long) == F.size(short), replaced).when(F.size(long) == F.size(short) + 1, left_out).otherwise(F.lit(False))


def kept_lines(rows: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """``row`` and ``line`` of every line with words that stays, of ``numbered`` documents."""
    raw = raw_lines(rows, id_column, text)
    names = ["e0", "e1", "e2", "e3"]
    first = lines_of(raw).select("at", "n", "h1", "h2", *[e.alias(k) for e, k in zip(ends(min_words), names, strict=True)])
    unique = first.groupBy("h1", "h2", "n").agg(F.min("at").alias("at"), *[F.first(k).alias(k) for k in names])
    unique = materialize(unique.select("h1", "h2", "n", "at", F.xxhash64("at.row", "at.line").alias("key"), *names), "lines")

    parts = unique.filter(F.col("n") >= min_words).select("h1", "h2", "key", F.explode(F.array_compact(F.array(*names))).alias("end"))
    shared = parts.groupBy("end").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("end")
    partners = parts.join(shared, "end", "left_semi").groupBy("key", "h1", "h2").agg(F.lit(1).alias("one")).select("key", "h1", "h2")
    partners = materialize(partners, "lines-partners")
    # Only lines with a possible partner are moved with their words, each from its first place (an inner
    # join: a semi join would be pushed below the bitmap). Their order becomes one number.
    own = lines_of(raw).withColumn("key", F.xxhash64("at.row", "at.line"))
    able = maybe_in(own, partners, ["key"]).join(partners, ["key", "h1", "h2"]).select("at", "s", "n", "h1", "h2").dropDuplicates(["h1", "h2"])
    able = materialize(able.orderBy("at").select("s", "n", "h1", "h2", F.monotonically_increasing_id().alias("o")), "lines-able")
    discard(partners)

    i = F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")
    left_out = able.select("o", "n", "s", i).select("o", "i", (F.col("n") - 1).alias("m"), F.xxhash64(without(F.col("i"))).alias("v"))
    whole = able.select("o", F.lit(0).alias("i"), F.col("n").alias("m"), F.xxhash64("s").alias("v"))
    keys = materialize(left_out.unionByName(whole), "line-variants")
    again = keys.groupBy("v", "m").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("v", "m")
    again = materialize(again, "line-variants-met")
    met = materialize(maybe_in(keys, again, ["v"]).join(again, ["v", "m"]), "line-variants-able")
    discard(keys)
    discard(again)

    # i = 0: the whole line. Lines that leave out the same place are one replacement apart; a whole
    # line is one deletion apart from those that give it. So each looks at the earliest of its kind.
    earliest = met.groupBy("v", "m", "i").agg(F.min("o").alias("low"))
    longer = earliest.filter("i > 0").groupBy("v", "m").agg(F.min("low").alias("low")).withColumn("i", F.lit(0))
    shorter = earliest.filter("i = 0").drop("i")
    found = met.join(earliest.filter("i > 0").unionByName(longer), ["v", "m", "i"]).select("o", "low")
    found = found.unionByName(met.filter("i > 0").join(shorter, ["v", "m"]).select("o", "low"))
    pairs = found.filter("low < o").distinct()
    checked = pairs.join(able.select("o", "s", "h1", "h2"), "o").join(able.select(F.col("o").alias("low"), F.col("s").alias("x")), "low")
    gone = checked.filter(within_one_edit(F.split("s", " "), F.split("x", " "))).select("h1", "h2").distinct()
    return unique.join(gone, ["h1", "h2"], "left_anti").select("at.row", "at.line")


def marks(rows: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """``row`` and ``kept``: the sorted line numbers (from 0) with words that stay; rows without any are missing."""
    return kept_lines(rows, id_column, text, min_words).groupBy("row").agg(F.sort_array(F.collect_set("line")).alias("kept"))


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = 5) -> DataFrame:
    """The documents without the lines that go; columns as in ``docs``."""
    # Under names of their own, so that no column of the documents meets one of the operator.
    own = [f"c{i}__" for i in range(len(docs.columns))]
    at = {n.lower(): o for n, o in zip(docs.columns, own, strict=True)}
    rows = numbered(docs.toDF(*own))
    t = F.col(at[text.lower()])
    found = marks(rows, at[id_column.lower()], at[text.lower()], min_words)
    joined = rows.join(found, F.col("__row") == F.col("row"), "left")
    stay = F.filter(F.split(t, "\n"), lambda x, i: (F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) == "") | F.array_contains(F.coalesce("kept", F.array().cast("array<int>")), i))
    out = joined.withColumn(at[text.lower()], F.array_join(stay, "\n"))
    return out.select(*[F.col(o).alias(n) for n, o in zip(docs.columns, own, strict=True)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10: for every document its lines with words, how many go, and which stay."""
    docs = numbered(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    found = marks(docs)
    filled = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != "")
    rows = docs.select("doc_id", "__row", F.size(filled).cast("long").alias("n_lines"))
    kept = F.coalesce(F.size("kept"), F.lit(0)).cast("long")
    return rows.join(found, F.col("__row") == F.col("row"), "left").select(
        "doc_id", "n_lines", (F.col("n_lines") - kept).alias("n_removed"), F.coalesce(F.array_join("kept", ","), F.lit("")).alias("kept_lines")
    )


ORACLE = r"""
WITH l AS (SELECT doc_id d, unnest(range(len(p))) AS ln, unnest(p) AS t FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) p FROM documents)),
w AS (SELECT d, ln, regexp_extract_all(lower(t), '[^\x20\x09-\x0D]+') w FROM l),
x AS (SELECT d, ln, w, len(w) n, array_to_string(w, ' ') s FROM w WHERE len(w) > 0),
u AS (SELECT s, any_value(w) w, any_value(n) n, min(d * 1000000000 + ln) place FROM x GROUP BY s),
v AS (SELECT place, n, i, array_to_string(list_concat(w[1:i-1], w[i+1:n]), ' ') AS s FROM (SELECT *, unnest(range(1, n + 1)) i FROM u WHERE n >= 5)),
gone AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY s, n, i) low FROM v) WHERE low < place
  UNION SELECT v.place FROM v JOIN u ON u.s = v.s AND u.n = v.n - 1 AND u.n >= 5 WHERE u.place < v.place
  UNION SELECT u.place FROM v JOIN u ON u.s = v.s AND u.n = v.n - 1 AND u.n >= 5 WHERE v.place < u.place),
k AS (SELECT place // 1000000000 d, place % 1000000000 ln FROM u WHERE place NOT IN (SELECT place FROM gone)),
g AS (SELECT d, count(*) n, string_agg(CAST(ln AS VARCHAR), ',' ORDER BY ln) kept FROM k GROUP BY d),
c AS (SELECT d, count(*) n FROM x GROUP BY d)
SELECT doc_id, coalesce(c.n, 0)::BIGINT AS n_lines, (coalesce(c.n, 0) - coalesce(g.n, 0))::BIGINT AS n_removed, coalesce(g.kept, '') AS kept_lines
FROM documents LEFT JOIN c ON c.d = doc_id LEFT JOIN g ON g.d = doc_id
"""
