"""Language-model scoring with a probabilistic suffix tree over words.

A context is a state if its next-word distribution diverges from that of its parent (the context
without its first word): the gain in log-likelihood on the training tokens must exceed a price for each
next word stored. Next words seen ``least_entry`` times or more, and in ``entry_share`` of the context's tokens, are stored, their
counts discounted; what is left backs off to the parent and is normalised, so every state is a probability distribution. Only
retained states are extended, by one word to the left, up to ``reach`` words (frequent ones up to ``longest``; the query bounds all by ``reach``). Where a context is handled, in the tree or in a
bucket (below), depends on the input's size; what it must pass and what it stores does not, nor, so bounded, how long it may be. A text is scored word by word from the longest
suffix of its past that is a state.

Where the data goes
-------------------
* Texts are read once. Chunks of about ``chunk_tokens`` tokens are stored as numbers with the hashes of
  their words, and every later step reads these. The table is bucketed by chunk, so answers meet it where it lies.
* Word counts: each chunk asks with its distinct words and their counts, words meet in hash buckets
  (their number grows with the input), and answers go back to the chunks. So base scores are exact.
* Frequent contexts (over ``frequent_share`` of all tokens, or over ``most_group``) are counted level by level, until
  none passes the test or they have ``longest`` words, and sent to the tasks as one tree. They are fewer than ``1 / frequent_share`` a level (beyond
  ``most_group / frequent_share`` tokens: than tokens over ``most_group``), each has at most ``1 / entry_share`` next words.
* All other contexts are less frequent: a rare last word, or a state of the tree with another word before it. The tokens
  after such a context go, with up to ``reach`` words of their past, to the bucket of the shortest context of this kind,
  which holds the whole subtree of states under it, whatever its last word: these grow with the input without a
  bound, and no step holds more than a bucket of them. Only sums for each document come back.
* The counts of the words before each candidate of the tree are added up in the pass that counts its next words. A
  bitmap of ``ATTESTED_BITS`` bits tells which of them have ``least_context`` tokens (all that do, and few others), so that tokens
  after contexts that cannot be states stay where they are.

Defined results
---------------
* null and empty texts: one token, the end; null ids count as the id '' when texts are held out;
* repeated rows: each is learnt from and scored; empty table: empty result;
* other columns are ignored. Words with equal 64-bit hashes count as one word, in the contexts outside the
  tree those with equal first 48 bits.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import bucketed, discard, materialize, release

#: Stands for the end of a text; no word is empty.
END = b""
#: Smoothing added to each count of the base distribution (fixed by the operator's contract).
ADD = 0.1
#: Bits of the bitmap of attested longer contexts (8 MB), and of a segment of it.
ATTESTED_BITS, SEGMENT = 1 << 26, 1 << 20


@dataclass(frozen=True)
class Shape:
    """What the tree keeps, and how work is cut."""

    least_context: int = 8
    least_entry: int = 2
    price: float = 2.0
    discount: float = 0.5
    reach: int = 3
    frequent_share: float = 2e-4
    least_frequent: int = 1000
    most_group: int = 1_000_000
    entry_share: float = 2e-3
    chunk_tokens: int = 1_000_000
    bucket_tokens: int = 1_500_000
    #: Most words of a frequent context (``reach`` at least), None for no bound. With ``reach`` no result depends on which contexts are frequent.
    longest: int | None = None

    def extends(self, depth: int) -> bool:
        """Whether frequent contexts of so many words are extended."""
        return self.longest is None or depth < max(self.reach, self.longest)

    def limit(self, total: int) -> float:
        """The count from which a word is frequent."""
        return max(self.least_frequent, min(self.frequent_share * total, self.most_group))

    def least(self, tokens):
        """How often a next word must follow a context of so many tokens to be stored."""
        return np.maximum(self.least_entry, self.entry_share * tokens)


def hash_of(word: bytes) -> int:
    """The signed 64-bit hash of a word."""
    v = xxhash.xxh64_intdigest(word)
    return v - (1 << 64) if v >> 63 else v


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each pair of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return ((x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)).astype(np.int64)


def pack(*arrays: np.ndarray, level: int = 3) -> bytes:
    """Arrays as compressed bytes, byte by byte of all numbers (high bytes of small numbers are alike)."""
    head = json.dumps([(a.dtype.str, len(a)) for a in arrays]).encode()
    planes = [np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    return len(head).to_bytes(4, "little") + head + zstandard.compress(b"".join(planes), level)


def unpack(data: bytes) -> list[np.ndarray]:
    """What ``pack`` got."""
    size = int.from_bytes(data[:4], "little")
    raw, at, out = zstandard.decompress(data[4 + size :]), 0, []
    for kind, n in json.loads(data[4 : 4 + size]):
        kind = np.dtype(kind)
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += planes.size
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Sorted non-negative numbers as differences; ``np.cumsum`` undoes it."""
    return smallest(np.diff(a, prepend=a.dtype.type(0)))


def smallest(a: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the narrowest type that holds them."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def held_out(doc_id):
    """Every tenth document by the crc32 of its id's text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


# --- chunks of tokens ------------------------------------------------------------------------------


@dataclass
class Chunk:
    """Documents as numbers: ``codes`` into ``words`` (hashes), ``sizes`` and ``held`` of each document."""

    codes: np.ndarray
    words: np.ndarray
    sizes: np.ndarray
    held: np.ndarray

    @property
    def first(self) -> np.ndarray:
        """Where each document begins."""
        return np.cumsum(self.sizes, dtype=np.int64) - self.sizes

    @property
    def doc(self) -> np.ndarray:
        """The document of each token."""
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @property
    def place(self) -> np.ndarray:
        """The place of each token in its document."""
        return np.arange(len(self.codes)) - np.repeat(self.first, self.sizes)

    @property
    def train(self) -> np.ndarray:
        """Whether each token is learnt from."""
        return np.repeat(~self.held.astype(bool), self.sizes)


def chunks_of(docs: DataFrame, id_column: str, text: str, chunk_tokens: int) -> DataFrame:
    """(``chunk``, ``ids``, ``n_words``, ``n_tokens``, ``data``): the documents in chunks."""
    source = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"), held_out(F.col(f"`{id_column}`")).alias("held_out"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        local: dict[bytes, int] = {}
        codes: list[np.ndarray] = []
        ids, sizes, held = [], [], []
        total = 0

        def out() -> pa.RecordBatch:
            words = np.fromiter(map(hash_of, local), np.int64, len(local))
            data = pack(smallest(np.concatenate(codes)), words, np.array(sizes, np.int64), np.array(held, np.uint8))
            row = [pa.array([number]), pa.ListArray.from_arrays(pa.array([0, sum(map(len, ids))], pa.int32()), pa.concat_arrays(ids)), pa.array([len(local)]), pa.array([total]), pa.array([data], pa.binary())]
            for x in (local, codes, ids, sizes, held):
                x.clear()
            return pa.RecordBatch.from_arrays(row, ["chunk", "ids", "n_words", "n_tokens", "data"])

        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            flags = batch.column(2).to_pylist()
            begin = 0
            put = local.setdefault
            for k in range(batch.num_rows):
                t = texts[k].as_py()
                tokens = [put(w, len(local)) for w in (t or b"").lower().split()]
                tokens.append(put(END, len(local)))
                codes.append(np.array(tokens, np.int32))
                sizes.append(len(tokens))
                held.append(flags[k])
                total += len(tokens)
                if total >= chunk_tokens:
                    ids.append(batch.column(0).slice(begin, k + 1 - begin))
                    begin = k + 1
                    yield out()
                    number, total = number + 1, 0
            if begin < batch.num_rows:
                ids.append(batch.column(0).slice(begin))
        if sizes:
            yield out()

    return source.mapInArrow(run, f"chunk long, ids array<{kind}>, n_words long, n_tokens long, data binary")


def buckets_of(hashes: np.ndarray, n: int) -> list[np.ndarray]:
    """The positions of the hashes of each bucket, in order."""
    bucket = (hashes.view(np.uint64) % np.uint64(n)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.searchsorted(bucket[order], np.arange(1, n)))


# --- word counts -----------------------------------------------------------------------------------


def counted(chunks: DataFrame, buckets: int) -> DataFrame:
    """Answers (``chunk``, ``bucket``, ``answer``: the count of each word of the chunk that falls into the bucket)
    and, with a null chunk, each bucket's ``total``, ``distinct`` and all its words with their counts."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                c = Chunk(*unpack(data.as_py()))
                n = np.bincount(c.codes[c.train], minlength=len(c.words))
                parts = [(b, pack(c.words[at], smallest(n[at]))) for b, at in enumerate(buckets_of(c.words, buckets)) if len(at)]
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in parts], pa.int64()), pa.array([chunk] * len(parts), pa.int64()), pa.array([p for _, p in parts], pa.binary())], ["bucket", "chunk", "ask"])

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        asks = [unpack(x) for x in table.column("ask").to_pylist()]
        sizes = [len(a[0]) for a in asks]
        words, at = np.unique(np.concatenate([a[0] for a in asks]), return_inverse=True)
        n = np.bincount(at, np.concatenate([a[1] for a in asks]).astype(float), len(words)).astype(np.int64)
        got = [pack(smallest(x)) for x in np.split(n[at], np.cumsum(sizes)[:-1])]
        seen = n > 0
        rows = [*table.column("chunk").to_pylist(), None]
        return pa.table({
            "chunk": pa.array(rows, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(rows), pa.int64()), "answer": pa.array([*got, pack(words[seen], n[seen])], pa.binary()),
            "total": pa.array([0] * len(sizes) + [int(n.sum())], pa.int64()), "distinct": pa.array([0] * len(sizes) + [int(seen.sum())], pa.int64()),
        })

    asked = chunks.select("chunk", "data").mapInArrow(ask, "bucket long, chunk long, ask binary")
    return asked.groupBy("bucket").applyInArrow(answer, "chunk long, bucket long, answer binary, total long, distinct long")


def common_words(answers: DataFrame, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes and counts of the words with at least ``least`` tokens (at most all tokens over ``least``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                h, n = unpack(data.as_py())
                some = n >= least
                yield pa.RecordBatch.from_arrays([pa.array(h[some]), pa.array(n[some].astype(np.int64))], ["h", "n"])

    got = answers.filter("chunk IS NULL").select("answer").mapInArrow(run, "h long, n long").toPandas().sort_values("h")
    return got["h"].to_numpy(np.int64), got["n"].to_numpy(np.int64)


# --- the test, and the tree of frequent contexts ---------------------------------------------------


def tested(state: np.ndarray, n: np.ndarray, parent: np.ndarray, totals: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which states pass, their log10 back-off weights, and the log10 probability of each stored next word.

    Entries have a ``state``, a count ``n`` and the ``parent``'s log10 probability; ``totals`` are the states' tokens.
    """
    k = len(totals)
    p = (n - shape.discount) / totals[state]
    logp = np.log10(p)
    entries = np.bincount(state, minlength=k)
    tail = 1 - np.bincount(state, p, k)
    rest = 1 - np.bincount(state, 10.0**parent, k)
    safe = (tail > 1e-9) & (rest > 1e-9)
    back = np.log10(np.where(safe, tail, 1) / np.where(safe, rest, 1))
    gain = np.bincount(state, n * (logp - parent), k) + (totals - np.bincount(state, n, k)) * back
    return safe & (entries > 0) & (gain > shape.price * entries), back, logp


def find(table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of ``wanted`` in the sorted ``table``, -1 where absent."""
    if not len(table):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return np.where(table[at] == wanted, at, -1)


@dataclass
class Level:
    """The states of one context length: keys, back-off weights, and the stored next words.

    ``tried`` are the keys of all contexts that were tested here, ``origin`` the place of each state among them.
    """

    contexts: np.ndarray
    back: np.ndarray
    keys: np.ndarray
    logp: np.ndarray
    tried: np.ndarray
    origin: np.ndarray


class Tree:
    """States of frequent contexts. Words are positions in the sorted hashes ``known``.

    A context of k words has the key (state of its last k - 1 words) * size + its first word.
    """

    def __init__(self, known: np.ndarray, base: np.ndarray) -> None:
        self.known, self.base, self.size = known, base, max(1, len(known))
        self.levels: list[Level] = []

    def states(self, words: list[np.ndarray]) -> list[np.ndarray]:
        """The state (or -1) of each context length; ``words[j]`` are the words j places back (-1: none or unknown)."""
        out, state = [], np.zeros(len(words[0]), np.int64)
        for level, word in zip(self.levels, words, strict=False):
            here = np.flatnonzero((state >= 0) & (word >= 0))
            found = np.full(len(state), -1, np.int64)
            found[here] = find(level.contexts, state[here] * self.size + word[here])
            state = found
            out.append(state)
        return out

    def logp(self, states: list[np.ndarray], word: np.ndarray, base: np.ndarray) -> np.ndarray:
        """log10 probability of each word after its context; ``base`` is the shortest context's."""
        lp = base.copy()
        for level, state in zip(self.levels, states, strict=False):
            here = np.flatnonzero(state >= 0)
            s, w = state[here], word[here]
            entry = np.where(w >= 0, find(level.keys, s * self.size + w), -1)
            stored = level.logp[entry] if len(level.logp) else np.zeros(len(here))
            lp[here] = np.where(entry >= 0, stored, level.back[s] + lp[here])
        return lp


def past(c: Chunk, at: np.ndarray, steps: int) -> list[np.ndarray]:
    """The values ``at`` of the tokens one to ``steps`` places before each token, -1 beyond the text's begin."""
    place, out = c.place, []
    for j in range(1, steps + 1):
        before = np.full(len(at), -1, at.dtype)
        before[j:] = at[:-j]
        before[place < j] = -1
        out.append(before)
    return out


def bit_of(level: int, key: np.ndarray) -> np.ndarray:
    """The place in the bitmap of a context of ``level`` + 1 words: candidate * size + first word."""
    return (mixed(np.full(len(key), level, np.int64), key).view(np.uint64) % np.uint64(ATTESTED_BITS)).astype(np.int64)


def neighbours(chunks: DataFrame, tree: Tree, candidates: np.ndarray, least: np.ndarray, limit: float, shape: Shape) -> DataFrame:
    """What stands around each candidate of the level after the tree's last, as written rows (``kind``, ``k``, ``n``, ``data``).

    Kind 0: how often each next word follows, if the candidate's ``least`` times or more (``k``: candidate * size + word). Kind 1: how many
    tokens the candidate has with each word before it, if ``limit`` or more. Kind 2: places in the bitmap of those with ``least_context`` or more,
    by segment. Candidates of ``longest`` words are not extended, so they have no kinds 1 and 2.
    """
    sent = chunks.sparkSession.sparkContext.broadcast((tree, candidates, least))
    width, size, least_context = 1 << 24, tree.size, shape.least_context
    depth = len(tree.levels) + 1
    extended = shape.extends(depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree_, wanted, _ = sent.value
        for batch in batches:
            for data in batch.column(0):
                c = Chunk(*unpack(data.as_py()))
                at = find(tree_.known, c.words).astype(np.int32)[c.codes]
                words = past(c, at, depth + 1)
                states = tree_.states(words[:depth])
                state = states[-1] if states else np.zeros(len(at), np.int64)
                ok = np.flatnonzero(c.train & (state >= 0) & (words[depth - 1] >= 0))
                cand = find(wanted, state[ok] * tree_.size + words[depth - 1][ok])
                ok, cand = ok[cand >= 0], cand[cand >= 0]
                rows: list[tuple[int, int, bytes]] = []
                for kind, word in ((0, at[ok]), (1, words[depth][ok]))[: 1 + extended]:
                    k, n = np.unique(cand[word >= 0] * tree_.size + word[word >= 0], return_counts=True)
                    # Ranges of keys, each in one blob.
                    cuts = np.flatnonzero(np.diff(k // width)) + 1
                    rows += [(kind, int(a[0] // width), pack(steps(a), smallest(b))) for a, b in zip(np.split(k, cuts), np.split(n, cuts), strict=True) if len(a)]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())], ["kind", "bucket", "data"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpack(x) for x in table.column("data").to_pylist()]
        k, at = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.int64) for p in parts]), return_inverse=True)
        n = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
        kind = key[0].as_py()
        many = n >= (limit if kind else sent.value[2][k // size])
        rows = [(kind, *x, None) for x in zip(k[many].tolist(), n[many].tolist(), strict=True)]
        if kind:
            bits = np.unique(bit_of(depth, k[n >= least_context]))
            cuts = np.flatnonzero(np.diff(bits // SEGMENT)) + 1
            rows += [(2, int(b[0] // SEGMENT), 0, pack(steps(b % SEGMENT))) for b in np.split(bits, cuts) if len(b)]
        columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
        return pa.table({name: pa.array(x, kind_) for name, x, kind_ in zip(("kind", "k", "n", "data"), columns, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)})

    asked = chunks.select("data").mapInArrow(run, "kind int, bucket long, data binary")
    return materialize(asked.groupBy("kind", "bucket").applyInArrow(add, "kind int, k long, n long, data binary"), "lm-neighbours")


def attested(found: DataFrame, bitmap: np.ndarray) -> None:
    """Set the bits that the rows of kind 2 name. Segments are put together by Spark."""

    def join(key: tuple, table: pa.Table) -> pa.Table:
        mine = np.zeros(SEGMENT // 8, np.uint8)
        for x in table.column("data").to_pylist():
            bits = np.cumsum(unpack(x)[0], dtype=np.int64)
            np.bitwise_or.at(mine, bits >> 3, (1 << (bits & 7)).astype(np.uint8))
        return pa.table({"k": [key[0].as_py()], "data": pa.array([mine.tobytes()], pa.binary())})

    # The bitmap's size, whatever the input.
    for r in found.filter("kind = 2").groupBy("k").applyInArrow(join, "k long, data binary").collect():
        bitmap[r["k"] * SEGMENT // 8 : (r["k"] + 1) * SEGMENT // 8] |= np.frombuffer(r["data"], np.uint8)


def frequent_tree(chunks: DataFrame, answers: DataFrame, total: int, distinct: int, shape: Shape) -> tuple[Tree, np.ndarray]:
    """The tree of frequent contexts, grown until no context of a level passes or may be extended; and the bitmap of attested contexts that are one word longer."""
    known, counts = common_words(answers, shape.least(shape.limit(total)))
    tree, bitmap = Tree(known, np.log10((counts + ADD) / (total + ADD * (distinct + 1)))), np.zeros(ATTESTED_BITS // 8, np.uint8)
    limit = shape.limit(total)
    often = np.flatnonzero((counts >= limit) & (known != hash_of(END)))
    words, totals, candidates = [often], counts[often].astype(float), often
    while len(candidates) and shape.extends(len(tree.levels)):
        around = neighbours(chunks, tree, candidates, shape.least(totals), limit, shape)
        attested(around, bitmap)
        # At most 1 / entry_share rows a candidate; of the other kind 1 / frequent_share (or the tokens over most_group).
        got, left = (around.filter(F.col("kind") == kind).select("k", "n").toPandas().sort_values("k") for kind in (0, 1))
        discard(around)
        k, n = got["k"].to_numpy(np.int64), got["n"].to_numpy(np.int64).astype(float)
        state, word = k // tree.size, k % tree.size
        parent = tree.logp(tree.states([w[state] for w in words]), word, tree.base[word])
        keep, back, logp = tested(state, n, parent, totals, shape)
        number = np.cumsum(keep) - 1
        ok = keep[state]
        tree.levels.append(Level(candidates[keep], back[keep], number[state[ok]] * tree.size + word[ok], logp[ok], candidates, np.flatnonzero(keep)))
        # A state and a word that often stands before it make a longer context.
        k, n = left["k"].to_numpy(np.int64), left["n"].to_numpy(np.int64)
        suffix, first = k // tree.size, k % tree.size
        longer = keep[suffix]
        suffix, first, n = suffix[longer], first[longer], n[longer]
        key = number[suffix] * tree.size + first
        order = np.argsort(key)
        words = [*[w[suffix[order]] for w in words], first[order]]
        totals, candidates = n[order].astype(float), key[order]
    return tree, bitmap


# --- all other contexts ----------------------------------------------------------------------------


def depth_of(states: list[np.ndarray], size: int) -> np.ndarray:
    """How many words the longest state of each token has."""
    return sum(((s >= 0).astype(np.int64) for s in states), np.zeros(size, np.int64))


def open_contexts(tree: Tree, bitmap: np.ndarray, states: list[np.ndarray], at: list[np.ndarray], before: list[np.ndarray], count: np.ndarray, limit: float, shape: Shape) -> np.ndarray:
    """Of how many words the shortest context is that may be a state outside the tree, 0 for none.

    ``at`` and ``before``: the known words and the chunk's words one and more places back; ``count``: the chunk's words' tokens.
    """
    size = len(before[0])
    depth, out = depth_of(states, size), np.zeros(size, np.int64)
    last = before[0]
    out[(depth == 0) & (last >= 0) & (count[last] < limit) & (count[last] >= shape.least_context)] = 1
    for d in range(1, min(shape.reach, len(states) + 1)):
        here = np.flatnonzero((depth == d) & (before[d] >= 0))
        first, state = at[d][here].astype(np.int64), states[d - 1][here]
        some = first >= 0
        bit = bit_of(d, tree.levels[d - 1].origin[state] * tree.size + first)
        there = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
        if d < len(tree.levels):
            there &= find(tree.levels[d].tried, state * tree.size + first) < 0
        out[here[np.where(some, there, count[before[d][here]] >= shape.least_context)]] = d + 1
    return out


def records(chunks: DataFrame, answers: DataFrame, tree: Tree, bitmap: np.ndarray, total: int, distinct: int, buckets: int, shape: Shape) -> DataFrame:
    """For each chunk one row with its ``ids`` and the documents' base sums, and one row for each bucket with the
    tokens after contexts of the bucket that are not in the tree."""
    spark = chunks.sparkSession
    sent = spark.sparkContext.broadcast((tree, bitmap, shape.limit(total)))
    scale = total + ADD * (distinct + 1)
    ids_type = chunks.schema["ids"].dataType.simpleString()

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        tree_, bits, limit = sent.value
        c = Chunk(*unpack(left.column("data")[0].as_py()))
        count = np.zeros(len(c.words), np.int64)
        given = dict(zip(right.column("bucket").to_pylist(), right.column("answer").to_pylist(), strict=True))
        # The word buckets of ``counted``.
        for b, at in enumerate(buckets_of(c.words, left.column("word_buckets")[0].as_py())):
            if len(at):
                count[at] = unpack(given[b])[0]
        word_lp = np.log10((count + ADD) / scale)
        base, doc = word_lp[c.codes], c.doc
        n_docs = len(c.sizes)
        found = find(tree_.known, c.words).astype(np.int32)
        at = found[c.codes]
        known = past(c, at, max(shape.reach, len(tree_.levels)))
        states = tree_.states(known)
        lp = tree_.logp(states, at, base)
        sums = pack(np.bincount(doc, base, n_docs), np.bincount(doc, lp, n_docs), np.bincount(doc, count[c.codes] > 0, n_docs).astype(np.int64), c.sizes)
        before = past(c, c.codes.astype(np.int32), shape.reach)
        size = open_contexts(tree_, bits, states, known, before, count, limit, shape)
        rare = np.flatnonzero(size)
        # The bucket of a token: by the words of its context.
        group = c.words[before[0][rare]]
        for j in range(1, shape.reach):
            longer = size[rare] > j
            group[longer] = mixed(group[longer], c.words[before[j][rare[longer]]])
        short = (c.words.view(np.uint64) >> np.uint64(16)).astype(np.int64)
        rows: list[tuple[int, bytes]] = []
        for b, of in enumerate(buckets_of(group, buckets)):
            if not len(of):
                continue
            k = rare[of]
            # By context, so that equal words stand together.
            k = k[np.lexsort((c.codes[k], *[w[k] for w in reversed(before)]))]
            used, new = np.unique(np.concatenate([c.codes[k].astype(np.int32), *[w[k] for w in before]]), return_inverse=True)
            # The words by their position among the known, then the others by hash; none comes last.
            order = np.lexsort((np.where(found[used] < 0, short[used], found[used]), found[used] < 0, used < 0))
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            named = used[order][used[order] >= 0]
            seen, others = found[named][found[named] >= 0], named[found[named] < 0]
            new = number[new].reshape(shape.reach + 1, -1)
            rows.append((b, pack(steps(seen), steps(short[others]), smallest(count[others]), *[smallest(x) for x in new], smallest(doc[k]), c.train[k].astype(np.uint8), level=6)))
        n = len(rows)
        return pa.table({
            "bucket": pa.array([-1 - key[0].as_py(), *[b for b, _ in rows]], pa.int64()), "chunk": pa.array([key[0].as_py()] * (n + 1), pa.int64()),
            "ids": pa.concat_arrays([left.column("ids").combine_chunks().slice(0, 1), pa.nulls(n, left.schema.field("ids").type)]),
            "data": pa.array([sums, *[x for _, x in rows]], pa.binary()),
        })

    return chunks.groupBy("chunk").cogroup(answers.filter("chunk IS NOT NULL").groupBy("chunk")).applyInArrow(run, f"bucket long, chunk long, ids {ids_type}, data binary")


def subtree(words: np.ndarray, before: list[np.ndarray], train: np.ndarray, lp: np.ndarray, depth: np.ndarray, shape: Shape) -> np.ndarray:
    """log10 probability of each next word under the contexts of up to ``reach`` words, grown while states pass.

    ``words`` are non-negative hashes, ``before[j]`` the hashes j + 1 places back (-1: none). Contexts of up to ``depth`` words are
    states of the tree, which gives each word the log10 probability ``lp``.
    """
    lp = lp.copy()
    alive = np.ones(len(words), bool)
    context = np.zeros(len(words), np.int64)
    _, word = np.unique(words, return_inverse=True)
    size = int(word.max()) + 1 if len(word) else 1
    for j, past_word in enumerate(before):
        alive &= past_word >= 0
        context = mixed(context, past_word)
        at = np.flatnonzero(alive & (depth <= j))
        if not len(at):
            continue
        _, state = np.unique(context[at], return_inverse=True)
        totals = np.bincount(state, train[at]).astype(float)
        pairs, first, pair = np.unique(state * size + word[at], return_index=True, return_inverse=True)
        n = np.bincount(pair, train[at], len(pairs))
        stored = (n >= shape.least(totals[pairs // size])) & (totals[pairs // size] >= shape.least_context)
        where = np.full(len(pairs), -1)
        where[stored] = np.arange(stored.sum())
        keep, back, logp = tested(pairs[stored] // size, n[stored], lp[at][first[stored]], np.maximum(totals, 1), shape)
        entry = where[pair]
        got = np.where(entry >= 0, logp[entry] if len(logp) else 0.0, back[state] + lp[at])
        kept = keep[state]
        lp[at[kept]] = got[kept]
        alive[at[~kept]] = False
    return lp


def scored(rows: DataFrame, tree: Tree, scale: float, shape: Shape) -> DataFrame:
    """(``chunk``, ``ids``, ``data``): the base rows of ``records`` as they are, and for each bucket and chunk what the states of the bucket add to documents."""
    ids_type = rows.schema["ids"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(tree)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return table.select(["chunk", "ids", "data"])
        tree_ = sent.value
        short = (tree_.known.view(np.uint64) >> np.uint64(16)).astype(np.int64)
        parts, names, base, known = [unpack(x) for x in table.column("data").to_pylist()], [], [], []
        for p in parts:
            seen = np.cumsum(p[0], dtype=np.int64)
            names.append(np.concatenate((short[seen], np.cumsum(p[1], dtype=np.int64), [-1])))
            base.append(np.concatenate((tree_.base[seen], np.log10((p[2] + ADD) / scale), [0.0])))
            known.append(np.concatenate((seen, np.full(len(p[1]) + 1, -1))))
        sizes = [len(p[3]) for p in parts]
        take = lambda of, j: np.concatenate([x[p[3 + j]] for x, p in zip(of, parts, strict=True)])
        states = tree_.states([take(known, j) for j in range(1, shape.reach + 1)])
        lp = tree_.logp(states, take(known, 0), take(base, 0))
        train = np.concatenate([p[-1] for p in parts]).astype(float)
        add = subtree(take(names, 0), [take(names, j) for j in range(1, shape.reach + 1)], train, lp, depth_of(states, len(lp)), shape) - lp
        out = []
        for p, x in zip(parts, np.split(add, np.cumsum(sizes)[:-1]), strict=True):
            sums = np.bincount(p[-2], x)
            docs = np.flatnonzero(sums)
            out.append(pack(smallest(docs), sums[docs].astype(np.float32)))
        return pa.table({"chunk": table.column("chunk"), "ids": pa.nulls(len(out), table.schema.field("ids").type), "data": pa.array(out, pa.binary())})

    return rows.groupBy("bucket").applyInArrow(run, f"chunk long, ids {ids_type}, data binary")


def summed(rows: DataFrame, kind: str) -> DataFrame:
    """One row a document: ``doc_id``, ``n_tokens``, ``n_known``, ``base_score``, ``score``."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("ids").combine_chunks()
        at = ids.is_valid().to_pylist().index(True)
        data = [unpack(x) for x in table.column("data").to_pylist()]
        base, score, known, sizes = data[at]
        score = score.copy()
        for k, d in enumerate(data):
            if k != at:
                score[d[0]] += d[1]
        return pa.table({"doc_id": ids[at].values, "n_tokens": pa.array(sizes), "n_known": pa.array(known), "base_score": pa.array(base), "score": pa.array(score)})

    return rows.groupBy("chunk").applyInArrow(run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text", shape: Shape = Shape()) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row,
    learnt from the rows that are not held out."""
    kind = docs.schema[id_column].dataType.simpleString()
    chunks = bucketed(chunks_of(docs, id_column, text, shape.chunk_tokens), "lm-chunks", "chunk")
    words, tokens = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    word_buckets = -(-words // shape.bucket_tokens) or 1
    answers = materialize(counted(chunks, word_buckets), "lm-counts")
    total, distinct = answers.filter("chunk IS NULL").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    tree, bitmap = frequent_tree(chunks, answers, total, distinct, shape)
    release(docs.sparkSession)
    buckets = -(-tokens // shape.bucket_tokens) or 1
    rows = records(chunks.withColumn("word_buckets", F.lit(word_buckets)), answers, tree, bitmap, total, distinct, buckets, shape)
    out = summed(scored(rows, tree, total + ADD * (distinct + 1), shape), kind)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8: base and suffix-tree scores of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score(docs, shape=Shape(longest=Shape.reach))
