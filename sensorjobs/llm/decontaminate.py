"""Benchmark decontamination with a generalised suffix automaton over the benchmark's words.

The automaton holds every run of words of every item. A document's words are streamed through it;
the longest run that ends at each word is tracked. Runs of at least ``window`` words (or a whole
item, if the item is shorter) are hits; the operator can cut them out.

Only stretches of words that all occur in the benchmark are streamed: a word outside its vocabulary
resets the automaton anyway.

The automaton is bounded: the benchmark is cut by hash into blocks of about ``block_words`` words,
each block is one broadcast automaton (190 MB in a Python process at a million words of skewed
frequencies, as measured) and one narrow pass over the documents; a benchmark within the bound takes a
single pass. Nothing is shuffled. A scan takes time in proportion to the words.

Defined results
---------------
* null and empty texts have no words and no hits; texts are read whole;
* items without words, and items with a null id, are no items;
* repeated items count once for each id; repeated documents each get their own row;
* empty benchmark: no hits; empty documents: empty result;
* other columns are kept if named in ``keep``; the operator's columns win on a clash.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import map_texts

#: Lower-cases A-Z and turns every byte outside words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` into a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

COLUMNS = "n_words long, n_hit long, hit_items array<string>, spans array<int>"


def words_of(text: bytes | None) -> list[bytes]:
    """Normalised words of a text."""
    return (text or b"").translate(WORD_BYTES).split()


class Automaton:
    """A generalised suffix automaton: states are sets of runs with the same occurrences in the items.

    Flat arrays: most states have one transition (``code``, ``to``); only those with several have a
    dictionary. ``window_of`` is the state of the last ``window`` words of a state's runs, or 0.
    """

    NONE, SEVERAL = -1, -2

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int) -> None:
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.code, self.to = array("i", [self.NONE]), array("i", [0])
        self.link, self.length = array("i", [-1]), array("i", [0])
        self.several: dict[int, dict[int, int]] = {}
        self.ids: list[str] = []
        ends, owners = array("i"), array("i")  # state and item of every whole-window occurrence
        shorts: list[tuple[int, int, int]] = []
        self.shortest = window
        for name, words in items:
            if not words:
                continue
            item = len(self.ids)
            self.ids.append(name)
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            last = 0
            for k, c in enumerate(codes, 1):
                last = self._extend(last, c)
                if k >= window:
                    ends.append(last)
                    owners.append(item)
            if len(codes) < window:
                shorts.append((last, item, len(codes)))
                self.shortest = min(self.shortest, len(codes))
        # Parents have shorter runs, so in order of length they come first.
        order = sorted(range(1, len(self.length)), key=self.length.__getitem__)
        self.window_of = array("i", bytes(4 * len(self.length)))
        for state in order:
            if self.length[state] >= window:
                self.window_of[state] = self.window_of[self.link[state]] or state
        # A window's item is kept at its state; further ones in a dictionary.
        self.item_of = array("i", [-1]) * len(self.length)
        self.more: dict[int, set[int]] = {}
        for state, item in zip(ends, owners, strict=True):
            w = self.window_of[state]
            if self.item_of[w] < 0:
                self.item_of[w] = item
            elif self.item_of[w] != item:
                self.more.setdefault(w, set()).add(item)
        # Short items that are a whole suffix of a state's runs: own ones and those along the suffix links.
        own: dict[int, list[tuple[int, int]]] = {}
        for state, item, size in shorts:
            own.setdefault(state, []).append((size, item))
        self.short: dict[int, tuple[tuple[int, int], ...]] = {}
        if own:
            for state in order:
                got = (*self.short.get(self.link[state], ()), *own.get(state, ()))
                if got:
                    self.short[state] = got

    def _next(self, state: int, c: int) -> int:
        only = self.code[state]
        if only == c:
            return self.to[state]
        return self.several[state].get(c, -1) if only == self.SEVERAL else -1

    def _put(self, state: int, c: int, target: int) -> None:
        only = self.code[state]
        if only in (self.NONE, c):
            self.code[state], self.to[state] = c, target
        elif only == self.SEVERAL:
            self.several[state][c] = target
        else:
            self.several[state] = {only: self.to[state], c: target}
            self.code[state] = self.SEVERAL

    def _extend(self, last: int, c: int) -> int:
        link, length = self.link, self.length
        q = self._next(last, c)
        if q >= 0:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        new = self._state(length[last] + 1, self.NONE, 0)
        p = last
        while p >= 0 and (q := self._next(p, c)) < 0:
            self._put(p, c, new)
            p = link[p]
        if p >= 0:
            link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return new

    def _state(self, length: int, code: int, to: int) -> int:
        self.code.append(code)
        self.to.append(to)
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of ``q`` for the runs no longer than the one that ``p`` leads to."""
        copy = self._state(self.length[p] + 1, self.code[q], self.to[q])
        if self.code[q] == self.SEVERAL:
            self.several[copy] = dict(self.several[q])
        self.link[copy] = self.link[q]
        self.link[q] = copy
        while p >= 0 and self._next(p, c) == q:
            self._put(p, c, copy)
            p = self.link[p]
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set[int]]:
        """Hit spans [first, end) of the word list, merged and in order, and the items that occur."""
        get = self.vocabulary.get
        codes = [get(w, -1) for w in words]
        n, spans, items = len(codes), [], set()
        at = 0
        while at < n:
            if codes[at] < 0:
                at += 1
                continue
            try:
                end = codes.index(-1, at)
            except ValueError:
                end = n
            if end - at >= self.shortest:
                self._stream(codes, at, end, spans, items)
            at = end + 1
        return spans, items

    def _stream(self, codes: list[int], at: int, end: int, spans: list[list[int]], items: set[int]) -> None:
        code, to, link, length, window, several = self.code, self.to, self.link, self.length, self.window, self.several
        state = run = 0
        found: set[int] = set()  # windows of this stretch whose items are noted
        for k in range(at, end):
            c = codes[k]
            while True:
                only = code[state]
                nxt = to[state] if only == c else several[state].get(c, -1) if only == -2 else -1
                if nxt >= 0 or not state:
                    break
                state = link[state]
                run = length[state]
            if nxt < 0:
                continue
            state = nxt
            run += 1
            size = 0
            if run >= window:
                size = run
                w = self.window_of[state]
                if w not in found:
                    found.add(w)
                    items.add(self.item_of[w])
                    items |= self.more.get(w, set())
            for short, item in self.short.get(state, ()):
                if short <= run:
                    items.add(item)
                    size = max(size, short)
            if size:
                first = k + 1 - size
                while spans and spans[-1][0] >= first:
                    spans.pop()
                if spans and spans[-1][1] >= first:
                    spans[-1][1] = k + 1
                else:
                    spans.append([first, k + 1])


def blocks(bench: DataFrame, id_column: str, text: str, block_words: int) -> list[DataFrame]:
    """The benchmark cut by hash into frames of about ``block_words`` words each."""
    words = F.length(F.coalesce(F.col(f"`{text}`"), F.lit(""))) / 2 + 1
    total = bench.agg(F.sum(words)).first()[0] or 0
    n = max(1, int(-(-total // block_words)))
    items = bench.filter(F.col(f"`{id_column}`").isNotNull()).select(F.col(f"`{id_column}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text"))
    return [items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) for k in range(n)]


def match(docs: DataFrame, bench: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, block_words: int = 1_000_000) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_hit``, ``hit_items`` (ids) and ``spans`` (flat: first, end, first, end, ...)."""
    spark: SparkSession = docs.sparkSession
    own = {c.split()[0] for c in COLUMNS.split(", ")}
    keep = [c for c in keep if c.lower() not in own]
    out = None
    for part in blocks(bench, item_id, item_text, block_words):
        # Bounded: a block holds about block_words words whatever the size of the benchmark.
        rows = [(r["id"], words_of((r["text"] or "").encode())) for r in part.orderBy("id", "text").toLocalIterator()]
        shared = spark.sparkContext.broadcast(Automaton(rows, window))

        def run(texts: list[bytes | None], shared=shared) -> dict[str, list]:
            machine: Automaton = shared.value
            got: dict[str, list] = {"n_words": [], "n_hit": [], "hit_items": [], "spans": []}
            for t in texts:
                words = words_of(t)
                spans, items = machine.scan(words)
                got["n_words"].append(len(words))
                got["n_hit"].append(sum(b - a for a, b in spans))
                got["hit_items"].append(sorted({machine.ids[i] for i in items}))
                got["spans"].append([x for s in spans for x in s])
            return got

        if out is None:
            out = map_texts(docs, [*keep, text] if text not in keep else keep, text, run, COLUMNS)
        else:
            out = _again(out, text, run)
    return out.select(*keep, "n_words", "n_hit", "hit_items", "spans")


def _again(before: DataFrame, text: str, run) -> DataFrame:
    """Another block's pass over the result of the blocks before; the hits are united row by row."""
    kept = before.columns
    renamed = before.withColumnsRenamed({"hit_items": "__items", "spans": "__spans", "n_words": "__w", "n_hit": "__h"})
    carried = [c for c in renamed.columns if c not in ("__w", "__h")]
    both = map_texts(renamed, carried, text, run, COLUMNS)
    both = both.withColumn("hit_items", F.array_sort(F.array_union("hit_items", "__items")))
    pairs = F.concat(_pairs("spans"), _pairs("__spans"))
    merged = F.aggregate(
        F.array_sort(pairs),
        F.array().cast("array<int>"),
        lambda acc, s: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1)) >= s["a"]),
                              F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.greatest(F.try_element_at(acc, F.lit(-1)), s["b"]))))
        .otherwise(F.concat(acc, F.array(s["a"], s["b"]))),
    )
    both = both.withColumn("spans", merged).withColumn("n_hit", _covered("spans"))
    return both.select(*kept)


def _pairs(spans: str):
    return F.when(F.size(spans) == 0, F.array().cast("array<struct<a:int,b:int>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(spans), F.lit(2)), F.lit(2)), lambda i: F.struct(F.element_at(spans, i).alias("a"), F.element_at(spans, i + 1).alias("b")))
    )


def _covered(spans: str):
    return F.aggregate(_pairs(spans), F.lit(0).cast("long"), lambda acc, s: acc + (s["b"] - s["a"]).cast("long"))


def cut(text: str | None, spans: list[int]) -> str | None:
    """The text without the words of the spans (flat first, end pairs) and what lies between them in a span."""
    if text is None or not spans:
        return text
    raw = text.encode()
    plain = raw.translate(WORD_BYTES)
    marks, at, k = [], 0, 0
    wanted = {x for x in spans}
    n, pos = len(plain), 0
    starts, ends = {}, {}
    while pos < n:
        while pos < n and plain[pos] == 32:
            pos += 1
        if pos >= n:
            break
        end = plain.find(b" ", pos)
        end = n if end < 0 else end
        if k in wanted:
            starts[k] = pos
        ends[k + 1] = end if k + 1 in wanted else 0
        k += 1
        pos = end
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        marks.append(raw[at : starts[a]])
        at = ends[b]
    marks.append(raw[at:])
    return b"".join(marks).decode()


def remove_spans(docs: DataFrame, bench: DataFrame, text: str = "text", window: int = 10, most_coverage: float = 0.5, **options) -> DataFrame:
    """Documents with their hit spans cut out; a document of which more than ``most_coverage`` is hit goes.

    Returns the columns of ``docs``. Documents without hits stay as they are.
    """
    names = docs.columns
    # Under names of their own, so that no column of the documents meets one of the operator.
    own = [f"c{i}__" for i in range(len(names))]
    words = own[names.index(text)]
    hit = match(docs.toDF(*own), bench, own, text=words, window=window, **options)

    @F.pandas_udf("string")
    def cut_all(texts: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut(t, list(s)) for t, s in zip(texts, spans, strict=True)], dtype="object")

    few = hit.filter(F.col("n_hit") <= most_coverage * F.col("n_words"))
    left = few.withColumn(words, F.when(F.col("n_hit") > 0, cut_all(F.col(words), F.col("spans"))).otherwise(F.col(words)))
    return left.select(*[F.col(o).alias(n) for o, n in zip(own, names, strict=True)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: words of every document hit by windows of ten benchmark words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = match(docs, bench, ["doc_id"])
    ids = F.concat_ws(",", "hit_items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE = r"""
WITH ix AS (SELECT CAST(item_id AS VARCHAR) id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT id, len(w) AS size, array_to_string(w, ' ') AS s FROM ix WHERE len(w) BETWEEN 1 AND 9
  UNION SELECT DISTINCT id, 10, array_to_string(w[k:k+9], ' ') FROM (SELECT id, w, unnest(range(1, len(w) - 8)) k FROM ix WHERE len(w) >= 10)),
dw AS (SELECT row_number() OVER () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
sizes AS (SELECT DISTINCT size FROM win),
dg AS (SELECT r, k, size, array_to_string(w[k:k+size-1], ' ') s FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) k FROM dw, sizes WHERE len(w) >= size)),
hits AS (SELECT r, k, dg.size, id FROM dg JOIN win ON dg.s = win.s AND dg.size = win.size),
pos AS (SELECT r, count(DISTINCT p) n FROM (SELECT r, unnest(range(k, k + size)) p FROM hits) GROUP BY r),
its AS (SELECT r, count(DISTINCT id) n, string_agg(DISTINCT id, ',' ORDER BY id) ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(pos.n, 0)::BIGINT AS n_hit, coalesce(its.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(pos.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN pos USING (r) LEFT JOIN its USING (r)
"""
