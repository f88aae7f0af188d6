"""Spelling variants: words one edit apart, found over reduced alphabets.

Letters are hashed to a few symbols (code point modulo their number), so a word becomes a reduced word of
the same length, and one edit of the word is at most one edit of the reduced word. For every word the full
one-edit neighbourhood of its reduced word is generated (itself, every deletion, replacement and
insertion of a symbol) and joined by equality with the reduced vocabulary; pairs that meet are
verified on the words themselves.

How many symbols words of a length get follows from how many words have that length: ``room`` reduced
words for each word. So neighbourhoods grow with the logarithm of the vocabulary, and a word meets a bounded number of others by chance at
every size. A word of length L is reduced twice: with the symbols of its own length, for words as long or shorter
by one, and with those of length L + 1, for longer ones.

Where the work is: words are counted in each task before they move; neighbourhoods are hashed in numpy batches
(64 bits by prefix and suffix sums, so a variant costs the same at any word length); a bitmap of the reduced vocabulary, sized from
its count and at most ``MOST_BITS`` bits (32 MB), lets only variants that probably meet a word move. Reduced
words that more than ``crowd`` words share are set aside and their words are paired
by the words themselves: same length by the word with one place left open, else by the word with one letter left out. Words that share an open
place are all near, so that way makes no more rows than there are near pairs. Roots are found by doubling
the steps of the chains; a form has at least twice its word's count, so chains are short. Sides that grow with the vocabulary
are joined by sorting (``sorted_join``), never sent whole through the driver.

Defined results
---------------
* null and empty texts have no words; texts are read whole; an empty table gives an empty result;
* a null id counts as an empty text in the hash; repeated rows count again;
* runs may have any length; equal counts of near words go to the smaller word in code-point order;
* columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import PART_ROWS, discard, materialize

#: Letters of words as Latin-1 bytes: A-Z in lower case, a-z, U+00C0 to U+00FF; all else parts words. Code points above U+00FF become "?" before.
LETTER_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 192 else 32 for c in range(256))
#: Distinct words that a task holds before it hands them on.
HELD_WORDS = 200_000
#: Reduced words for each word of a length; least number of symbols; lengths that are counted apart.
ROOM, LEAST_SYMBOLS, LONGEST = 256, 4, 64
#: Words that may share a reduced word before they are paired in another way.
CROWD = 1000
#: Bits of the largest bitmap of the reduced vocabulary.
MOST_BITS = 1 << 28
#: Variants that are hashed at once in a task.
AT_ONCE = 1 << 20

_BASE, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def words_of(doc_id: str, text: str, every: int = 97) -> Counter:
    """The words of one text after the planted deletions, with their counts. Words of under five letters are left out."""
    start = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    runs = Counter(w for w in text.encode("latin-1", "replace").translate(LETTER_BYTES).split() if len(w) > 4)
    for run, n in runs.items():
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        if h % every == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < 5:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = 3, every: int = 97) -> DataFrame:
    """``word`` and ``n`` of all words of five letters or more that occur ``least`` times."""
    source = docs.select(F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").cast("string").alias("text")).filter("text IS NOT NULL")

    def batch_of(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], type=pa.string()), pa.array(held.values(), type=pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for whole in batches:
            for at in range(0, whole.num_rows, PART_ROWS):
                batch = whole.slice(at, PART_ROWS)
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for w, n in words_of(i, t, every).items():
                        held[w] += n
                    if len(held) >= HELD_WORDS:
                        yield batch_of(held)
                        held = Counter()
        if held:
            yield batch_of(held)

    partial = source.mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def symbols_of(words: DataFrame, room: int = ROOM) -> dict[int, int]:
    """How many symbols words of each length get; lengths over ``LONGEST`` share one entry and have the least number."""
    counts = words.groupBy(F.least(F.length("word"), F.lit(LONGEST + 1)).alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    out = {}
    for r in counts:
        s = LEAST_SYMBOLS
        while r["size"] <= LONGEST and s ** r["size"] < room * r["n"]:
            s += 1
        out[r["size"]] = s
    return out


class Reducer:
    """Hashes of reduced words and of their neighbourhoods."""

    def __init__(self, symbols: dict[int, int]) -> None:
        self.symbols = symbols

    def reduced(self, codes: np.ndarray, size: int) -> tuple[np.ndarray, int]:
        """The symbols, from 1, that words have as words of length ``size``; and their number."""
        n = self.symbols.get(size, LEAST_SYMBOLS)
        return codes % np.uint64(n) + np.uint64(1), n

    @staticmethod
    def _sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash sums of all prefixes and suffixes, and the powers of the base."""
        m, size = x.shape
        power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size + 1, _BASE))])
        before, after = np.zeros((m, size + 1), np.uint64), np.zeros((m, size + 1), np.uint64)
        for i in range(size):
            before[:, i + 1] = before[:, i] * _BASE + x[:, i]
            after[:, size - 1 - i] = x[:, size - 1 - i] * power[i] + after[:, size - i]
        return before, after, power

    @staticmethod
    def _mixed(h: np.ndarray, alphabet: int, size: int) -> np.ndarray:
        """The sums as keys of words of a length under an alphabet."""
        h = (h ^ (h >> np.uint64(29))) * _MIX + np.uint64((alphabet << 32) + size)
        h = (h ^ (h >> np.uint64(32))) * _BASE
        return h ^ (h >> np.uint64(29))

    def own(self, codes: np.ndarray) -> np.ndarray:
        """Two keys for each word: met by words as long or shorter, and by longer ones."""
        size = codes.shape[1]
        keys = [self._mixed(self._sums(self.reduced(codes, a)[0])[0][:, size], a, size) for a in (size, size + 1)]
        return np.stack(keys, 1)

    def neighbours(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of the full neighbourhood of each reduced word, each variant once."""
        m, size = codes.shape
        x, n = self.reduced(codes, size)
        before, after, power = self._sums(x)
        full, places = before[:, size], power[size - 1 :: -1][:size]
        rows, keys = [np.arange(m)], [self._mixed(full, size, size)]
        left_out = before[:, :size] * places[None, :] + after[:, 1:]
        first = np.ones((m, size), bool)
        first[:, 1:] = x[:, 1:] != x[:, :-1]
        self._add(rows, keys, first, self._mixed(left_out, size, size - 1))
        for c in range(1, n + 1):
            put = full[:, None] + (np.uint64(c) - x) * places[None, :]
            self._add(rows, keys, x != c, self._mixed(put, size, size))
        y, n = self.reduced(codes, size + 1)
        before, after, power = self._sums(y)
        shifted = power[size + 1 : 0 : -1][: size + 1]
        places = power[size::-1][: size + 1]
        base = before * shifted[None, :] + after
        other = np.ones((m, size + 1), bool)
        for c in range(1, n + 1):
            other[:, :size] = y != c
            self._add(rows, keys, other, self._mixed(base + np.uint64(c) * places[None, :], size + 1, size + 1))
        return np.concatenate(rows), np.concatenate(keys)

    @staticmethod
    def _add(rows: list, keys: list, wanted: np.ndarray, values: np.ndarray) -> None:
        at = np.nonzero(wanted)
        rows.append(at[0])
        keys.append(values[at])

    def exact(self, codes: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
        """Keys of the words themselves: whole, with one place open, with one letter left out."""
        m, size = codes.shape
        before, after, power = self._sums(codes + np.uint64(1))
        left_out = before[:, :size] * power[size - 1 :: -1][:size][None, :] + after[:, 1:]
        rows = np.repeat(np.arange(m), size)
        opened = np.stack([self._mixed(left_out[:, i], 1 << 20, (i << 16) + size) for i in range(size)], 1)
        return {"whole": (np.arange(m), self._mixed(before[:, size], 0, size)), "open": (rows, opened.ravel()), "short": (rows, self._mixed(left_out, 0, size - 1).ravel())}


def _by_length(words: list[str], width: int) -> Iterator[tuple[list[str], np.ndarray]]:
    """Words of one length with their code points, in parts of about ``AT_ONCE`` variants."""
    groups: dict[int, list[str]] = {}
    for w in words:
        groups.setdefault(len(w), []).append(w)
    for size, same in groups.items():
        step = max(1, AT_ONCE // (width * (size + 1)))
        for at in range(0, len(same), step):
            part = same[at : at + step]
            codes = np.frombuffer("".join(part).encode("utf-32-le"), np.uint32).reshape(len(part), size)
            yield part, codes.astype(np.uint64)


def _rows(words: list[str], at: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(words, type=pa.string()).take(pa.array(at))], ["key", "word"])


def reduced_vocabulary(words: DataFrame, reducer: Reducer) -> DataFrame:
    """``key`` and ``word``: two rows for each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, codes in _by_length(batch.column(0).to_pylist(), 4):
                yield _rows(part, np.repeat(np.arange(len(part)), 2), reducer.own(codes).ravel())

    return words.select("word").mapInArrow(run, "key long, word string")


def bitmap(keys: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """The low bits of all keys as a bitmap: 16 bits for each key, a million at least and ``most_bits`` at most."""
    bits, rows = 1 << 20, keys.count()
    while bits < min(16 * rows, most_bits):
        bits *= 2
    low = keys.select((F.col("key").bitwiseAND(bits - 1)).alias("x"))
    blocks = low.groupBy(F.expr("x DIV 32768").alias("block")).agg(F.bitmap_construct_agg(F.expr("x % 32768")).alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for r in blocks.collect():
        out[r["block"] * 4096 : (r["block"] + 1) * 4096] = np.frombuffer(r["map"], np.uint8)
    return out


def sorted_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """A join of two sides that both grow with the vocabulary: each is shuffled and sorted, none is broadcast.

    Spark takes the variants of words for as large as the words' compressed file, which may lie below its broadcast limit.
    """
    return left.join(right.hint("merge"), key, how)


def neighbourhoods(words: DataFrame, reducer: Reducer, present: np.ndarray) -> DataFrame:
    """``key`` and ``word`` of all variants whose key the bitmap has (all that meet a reduced word, and few others)."""
    shared = words.sparkSession.sparkContext.broadcast(present)
    width = 2 * max(reducer.symbols.values(), default=LEAST_SYMBOLS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        mask = np.uint64(8 * len(seen) - 1)
        for batch in batches:
            for part, codes in _by_length(batch.column(0).to_pylist(), width):
                at, keys = reducer.neighbours(codes)
                low = keys & mask
                there = (seen[(low >> np.uint64(3)).astype(np.int64)] >> (low & np.uint64(7)).astype(np.uint8)) & 1 == 1
                yield _rows(part, at[there], keys[there])

    return words.select("word").mapInArrow(run, "key long, word string")


def _exact_keys(words: DataFrame, kind: str, column: str) -> DataFrame:
    """``key`` and the words of one kind of exact key."""
    reducer = Reducer({})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, codes in _by_length(batch.column(0).to_pylist(), 4):
                yield _rows(part, *reducer.exact(codes)[kind])

    return words.select(F.col(column).alias("word")).mapInArrow(run, "key long, word string").withColumnRenamed("word", column)


def near_pairs(words: DataFrame, room: int = ROOM, crowd: int = CROWD) -> DataFrame:
    """``word`` and ``near``: every ordered pair of words exactly one edit apart, once. The words must be distinct."""
    reducer = Reducer(symbols_of(words, room))
    targets = materialize(reduced_vocabulary(words, reducer).withColumnRenamed("word", "near"), "spelling-reduced")
    variants = neighbourhoods(words, reducer, bitmap(targets))
    one_edit = (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    crowded = materialize(targets.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > crowd).select("key"), "spelling-crowded")
    if crowded.isEmpty():
        pairs = sorted_join(variants, targets, "key").filter(one_edit).select("word", "near")
    else:
        pairs = sorted_join(variants, targets.join(crowded, "key", "left_anti"), "key").filter(one_edit).select("word", "near")
        # Their keys say which way a pair would have met; a pair that meets both here and there is one pair below.
        rest = targets.join(crowded, "key", "left_semi").select("near").distinct()
        there, all_words = materialize(rest, "spelling-rest"), words.select("word")
        for mine, theirs in (("open", "open"), ("whole", "short"), ("short", "whole")):
            met = sorted_join(_exact_keys(all_words, mine, "word"), _exact_keys(there, theirs, "near"), "key")
            pairs = pairs.unionByName(met.filter(one_edit).select("word", "near"))
    return pairs.distinct()


def roots(links: DataFrame) -> DataFrame:
    """``word`` and ``root``: where following ``word`` to ``form`` ends. Links must not go round."""
    step = materialize(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = step.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = materialize(sorted_join(step, ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        discard(step)
        step = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return step
        step._sensorjobs_path = longer._sensorjobs_path


def group(words: DataFrame, room: int = ROOM, crowd: int = CROWD) -> DataFrame:
    """``words`` (word, n; distinct) with form, root, n_near and form_n."""
    near = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = sorted_join(near_pairs(words, room, crowd), near, "near")
    # The largest count first, then the smallest word: strings compare by code points.
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    both = sorted_join(words, best, "word", "left").withColumn("form_n", -F.col("best.minus"))
    chosen = F.col("form_n") >= 2 * F.col("n")
    forms = materialize(
        both.select("word", F.when(chosen, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(chosen, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    found = sorted_join(forms, roots(forms.filter("form IS NOT NULL")), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the words of all documents with their spelling variants' forms and roots."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return group(materialize(word_counts(docs), "spelling-words"))
