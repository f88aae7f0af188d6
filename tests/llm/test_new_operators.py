"""Ranked search, byte-level BPE and spelling variants against brute force, public libraries and small cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import compare
import public_tokenizers
import pytest
import tiktoken

from sensorjobs.llm import byte_bpe, ranked_search, spelling_variants

ODD = [None, "", " ", "a", "\x00\x1f", "İstanbul ﬁn", "x" * 30_000, "né né né 漢字   tail  ", "ab" + " " * 5000 + "ab\n\n"]


def odd_documents(spark):
    """Odd texts, repeated rows, null ids, and extra columns named like the operators' own."""
    rows = [(i if i % 3 else None, t, "n", 1, "w", "k", True) for i, t in enumerate(ODD)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, N string, ids int, word string, key string, n_tokens boolean")


# ranked search


def plain_ranks(docs, bench, k=10):
    """Rows (item, rank, doc, score) by the definition, one document after another."""

    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(d, Counter(w)) for d, w in ((d, terms(t)) for d, t in docs) if w]
    total, every = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    items = defaultdict(set)
    for i, t in bench:
        if i is not None:
            items[i] |= set(terms(t))
    out = set()
    for i, wanted in items.items():
        scores = []
        for d, c in held:
            m = 100 - 90 + (90 * c.total() * total) // every
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if t in c)
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out |= {(i, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)}
    return out


def found(df):
    return {(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("tile,pairs", [((64, 1024, 2048), 200_000), ((2, 7, 3), 300)])
def test_ranks_against_brute_force(spark, sf_dir, monkeypatch, tile, pairs):
    for name, size in zip(("TILE_ITEMS", "TILE_DOCS", "TILE_COLUMNS"), tile, strict=True):
        monkeypatch.setattr(ranked_search, name, size)
    docs, bench = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    want = plain_ranks([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in bench.collect()])
    assert found(ranked_search.rank(docs, bench, most_pairs=pairs)) == want


def test_ranks_sql(spark, sf_dir):
    assert compare.differences(ranked_search.query(spark, sf_dir), compare.engine(sf_dir), ranked_search.ORACLE) == ""


def test_ranks_ties_repeats_and_odd_rows(spark):
    texts = [(k, "alpha beta") for k in range(40, 0, -1)] + [(None, "alpha beta"), (7, "alpha beta"), (99, None), (98, "..."), (50, "gamma"), (51, "gamma " * 5000)]
    bench = [("a", "Alpha ALPHA"), ("b", None), (None, "beta"), ("c", "gamma"), ("c", "beta"), ("d", "absent")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in texts], "doc_id long, text string, score string").repartition(7)
    frame = spark.createDataFrame(bench, "item_id string, text string")
    assert found(ranked_search.rank(docs, frame)) == plain_ranks(texts, bench)
    assert [r["doc_id"] for r in ranked_search.rank(docs, frame, k=50).filter("item_id = 'a'").orderBy("rank").collect()] == sorted([*range(1, 41), 7]) + [None]


def test_ranks_empty(spark):
    docs, frame = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([("a", "x")], "item_id string, text string")
    assert ranked_search.rank(docs, frame).count() == 0
    assert ranked_search.rank(spark.createDataFrame([(1, "x y")], docs.schema), frame.limit(0)).count() == 0


def test_partial_sums_are_exact():
    """A stretch is no wider than its sums stay below 2^53 at."""
    import numpy as np

    weight = np.full(50, 2.0**32)
    tile = ranked_search.Tile([0], [list(range(50))], weight)
    assert all(len(part) * ranked_search.TOP_IMPACT * 2**32 < 2**53 for part, _ in tile.stretches)
    rows, terms, impact = np.zeros(50, int), np.arange(50), np.full(50, 999_999)
    assert tile.scores(1, rows, terms, impact, np.full(50, -1)).tolist() == [[50 * 999_999 * 2**32]]


# byte-level BPE


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.coder().vocabulary.ranks, special_tokens={})


@pytest.fixture(scope="module")
def machine():
    return byte_bpe.coder()


def test_tokens_of_all_documents(spark, sf_dir, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = byte_bpe.query(spark, sf_dir).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()


def made_up(chance, most):
    return "".join(chance.choice("abst re'\n\t 1-_é漢😀.　") for _ in range(chance.randint(0, most)))


def test_made_up_texts_edits_and_windows(machine, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WINDOW", 11)
    chance = random.Random(5)
    for _ in range(1500):
        old = made_up(chance, 80)
        ids = machine.encode(old)
        assert ids == library.encode_ordinary(old)
        a = chance.randint(0, len(old))
        new = old[:a] + made_up(chance, 9) + old[chance.randint(a, len(old)) :]
        assert machine.spliced(old, ids, new)[0] == library.encode_ordinary(new)


def test_every_character(machine, library):
    for at in range(0, 0x110000, 97):
        if not 0xD800 <= at < 0xE000:
            text = f"ab{chr(at)}ab {chr(at)} 1{chr(at)}!"
            assert machine.encode(text) == library.encode_ordinary(text)


def test_one_last_token_for_each_prefix(machine):
    """Brute force over all tokens that end at a place: one fits, and the table holds it."""
    v = machine.vocabulary
    for piece in (b"unbelievably", " größenwahn".encode(), b"aaaaaaaaaaa", b"-----====", "漢字漢".encode()):
        table = byte_bpe.Prefixes(v, piece)
        for end in range(1, len(piece) + 1):
            fits = [t for s in range(end) if (t := v.ranks.get(piece[s:end])) is not None and v.merged(piece[:end])[-1] == t and sum(len(v.bytes_of[i]) for i in v.merged(piece[:end])[:-1]) == s]
            assert [table.last[end]] == fits


def test_appends_and_edits_of_a_piece(machine):
    v, chance = machine.vocabulary, random.Random(3)
    piece = bytes(chance.choice(b"abcdest") for _ in range(3000))
    table = byte_bpe.Prefixes(v, piece[:1000])
    table.append(piece[1000:])
    assert table.tokens() == v.merged(piece)
    done = table.replace(1500, 1503, b"zzzz")
    assert table.tokens() == v.merged(piece[:1500] + b"zzzz" + piece[1503:])
    assert done < 500


def test_re_encode(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    stored = docs.select("doc_id", "text").join(byte_bpe.encode(docs, ["doc_id"]), "doc_id").filter("doc_id % 5 <> 0")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = [(d, t + " and an append" if d % 2 else t[:700] + " an edit " + t[705:]) for d, t in texts.items()] + [(None, "no id")]
    got = byte_bpe.re_encode(stored, spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    want = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert list(r["ids"]) == library.encode_ordinary(want[r["doc_id"]])
    long_ones = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 5 and len(r["ids"]) > 1000]
    assert long_ones and all(r["n_taken"] > len(r["ids"]) - 200 for r in long_ones)


def test_codes_of_odd_rows(spark, library):
    docs = odd_documents(spark)
    rows = byte_bpe.encode(docs, docs.columns).select("text", "ids", "n_tokens", byte_bpe.F.col("N").alias("other")).collect()
    assert len(rows) == 2 * len(ODD)
    assert all(list(r["ids"]) == library.encode_ordinary(r["text"] or "") for r in rows)
    back = byte_bpe.decode(byte_bpe.encode(docs, ["text"])).collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)
    assert byte_bpe.digests(docs, docs.columns).schema["n_tokens"].dataType.simpleString() == "bigint"
    empty = docs.limit(0)
    assert byte_bpe.encode(empty, ["doc_id"]).count() == byte_bpe.digests(empty, ["doc_id"]).count() == 0


def test_unknown_tokens_fail(spark):
    assert byte_bpe.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).select("decoded").collect() == [(None,), (bytearray(b""),)]
    for ids in ([50256], [None], [-5]):
        with pytest.raises(Exception, match="no token"):
            byte_bpe.decode(spark.createDataFrame([(ids,)], "ids array<int>")).collect()


# spelling variants


def plain_words(docs, least=3):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}


def plain_groups(words):
    """Rows of the query from the definition: words that share a word with one place open are near, and so is a word less one letter."""
    near, opened = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            opened[w[:i], w[i + 1 :]].add(w)
            if (x := w[:i] + w[i + 1 :]) in words:
                near[w].add(x)
                near[x].add(w)
    for same in opened.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def grouped(df):
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_words_and_groups_of_all_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = plain_groups(plain_words(docs))
    assert grouped(spelling_variants.query(spark, sf_dir)) == want and len(want) > 1000


def made_words(k):
    chance = random.Random(k)
    words = {"".join(chance.choice("aiqy" if k else "abcdé") for _ in range(chance.randint(5, 7))) for _ in range(500)} | {"a" * n for n in range(5, 12)}
    return {w: 2 ** chance.randint(2, 9) for w in words}


@pytest.mark.parametrize("room,crowd", [(256, 1000), (1, 1000), (1, 3), (256, 0)])
@pytest.mark.parametrize("k", [0, 1])
def test_crowded_reduced_words(spark, k, room, crowd):
    """Letters that all fall on one symbol, few symbols, and every way of pairing give the same rows."""
    words = made_words(k)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    assert grouped(spelling_variants.group(frame, room, crowd)) == plain_groups(words)


def test_full_neighbourhood_of_a_reduced_word():
    """Each variant of a word is hashed once, and as the word that it is."""
    import itertools

    import numpy as np

    reducer = spelling_variants.Reducer({4: 3, 5: 3, 6: 3})

    def key(text, alphabet):
        codes = np.array([[ord(c) for c in text]], np.uint64)
        return int(reducer._mixed(reducer._sums(reducer.reduced(codes, alphabet)[0])[0][:, len(text)], alphabet, len(text))[0])

    for word in ("".join(p) for p in itertools.product("abc", repeat=5)):
        _, keys = reducer.neighbours(np.array([[ord(c) for c in word]], np.uint64))
        same = {word[:i] + c + word[i + 1 :] for i in range(5) for c in "abc"}
        short, more = {word[:i] + word[i + 1 :] for i in range(5)}, {word[:i] + c + word[i:] for i in range(6) for c in "abc"}
        want = {key(v, 5) for v in same | short} | {key(v, 6) for v in more}
        assert sorted(keys.tolist()) == sorted(want)


def test_chains_end_at_their_roots(spark):
    words = {"aaaaa" + "b" * k: 4 * 2**k for k in range(12)}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: r["root"] for r in spelling_variants.group(frame).collect()}
    assert set(got.values()) == {"aaaaa" + "b" * 11}


@pytest.mark.parametrize("room,crowd", [(256, 1000), (1, 3)])
def test_no_side_as_large_as_the_vocabulary_is_broadcast(spark, monkeypatch, room, crowd):
    """Small files of words have many variants: whatever Spark takes their size for, they are not sent through the driver."""
    plans = []

    def noted(df, tag):
        plans.append(df)
        return materialize(df, tag)

    materialize = spelling_variants.materialize
    monkeypatch.setattr(spelling_variants, "materialize", noted)
    frame = materialize(spark.createDataFrame(list(made_words(0).items()), "word string, n long"), "test-words")
    plans.append(spelling_variants.group(frame, room, crowd))
    lines = "\n".join(p._jdf.queryExecution().executedPlan().toString() for p in plans).split("\n")
    sent = [k for k, line in enumerate(lines) if "BroadcastExchange" in line]
    # Only the crowded keys of the reduced words may be sent: the scan of one column of theirs.
    below = ["".join(lines[k + 1 : k + 6]) for k in sent]
    assert "SortMergeJoin" in "".join(lines) and (crowd == 3 or not sent)
    assert all("spelling-crowded" in b for b in below), below


def test_words_of_odd_rows(spark):
    docs = odd_documents(spark)
    extra = docs.union(docs.limit(0)).unionByName(spark.createDataFrame([(5, "naïve naïve NAÏVE naÏve " + "z" * 20_000 + " " + "z" * 19_999, "", 0, "", "", True)] * 4, docs.schema))
    want = plain_words([(r["doc_id"], r["text"]) for r in extra.collect()])
    words = spelling_variants.word_counts(extra)
    assert {r["word"]: r["n"] for r in words.collect()} == want
    assert grouped(spelling_variants.group(words)) == plain_groups(want)
    assert spelling_variants.group(spelling_variants.word_counts(docs.limit(0))).count() == 0
