"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

Every byte prefix of a piece of text has exactly one encoding, so it has exactly one last token. A
token that ends at a place is that prefix's last token if and only if it and the last token of what
lies before it, merged by the ranks alone, stay these two tokens. The table of last tokens is filled
from left to right; it is all that an append needs, and after an edit it is filled again only until it
agrees with the old table over the length of the longest token.

A text is first split by the tokenizer's pattern; a piece that is a token itself gets that token. A piece
starts at every space that stands before a character that is no white space, whatever lies around it: between two
such places a text can be encoded alone. ``re_encode`` uses this: of an edited text it encodes only
the stretch around the edit, and takes the other tokens from the stored encoding. A pattern of one's own must
share this: a space before a character that is no white space always starts a piece.

Where the work is: one narrow pass over the texts, nothing is shuffled (``re_encode``: one join by key).
The rank table is sent to the tasks; a file of more than ``MOST_RANKS`` tokens is refused. The memories of
pieces and of token pairs are bounded. Texts are split in windows
of ``WINDOW`` characters.

Defined results
---------------
* null and empty texts have no tokens; their decoded bytes are empty;
* special tokens are ordinary text; texts are encoded whole, whatever their length;
* repeated rows are encoded each for itself; an empty table gives an empty result;
* an id that the vocabulary lacks, and a null among the ids, make ``decode`` fail with a message; null ids (no list) decode to null;
* other columns are kept if named in ``keep``; the operator's columns win on a clash.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorjobs.llm.common import map_texts, spare

#: Most tokens of a rank file that is sent to the tasks (about 20 MB).
MOST_RANKS = 500_000
#: Characters of a text that are split at once.
WINDOW = 1 << 20
#: How a piece is split depends on it, on the character behind it, and on so many characters from its start (a contraction).
LOOK = 3
#: Entries of the memories of a worker process: pieces (in each of two halves, about 100 MB together), and pairs of tokens.
MOST_PIECES, MOST_PAIRS = 250_000, 500_000
#: Characters of the longest piece that is remembered.
LONGEST_KEPT = 64

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Vocabulary:
    """Tokens with their ranks, and which two tokens may stand side by side."""

    NEVER = 1 << 60

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"every single byte must be a token; {len(missing)} are not")
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.bytes_of = {i: t for t, i in ranks.items()}
        #: The tokens, read backwards, as a trie: (state, byte before) to state, and each state's token or -1.
        self.step: dict[int, int] = {}
        self.token_at = [-1]
        for token, rank in ranks.items():
            state = 0
            for byte in reversed(token):
                state = self.step.setdefault(state << 8 | byte, len(self.token_at))
                if state == len(self.token_at):
                    self.token_at.append(-1)
            self.token_at[state] = rank
        self.pairs: dict[tuple[int, int], bool] = {}
        self._edges: dict[int, tuple[list, list] | None] = {}

    def merges(self, piece: bytes) -> tuple[list[bytes], list, list]:
        """Merges the two neighbours of lowest rank, the leftmost first, again and again. For short pieces.

        Returns the parts that are left, and what stood at the left and at the right edge: (part, rank of the merge that took it).
        """
        parts, never = [piece[i : i + 1] for i in range(len(piece))], self.NEVER
        left, right = [], []
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[k] + parts[k + 1], never), k) for k in range(len(parts) - 1))
            if rank == never:
                break
            if at == 0:
                left.append((parts[0], rank))
            if at == len(parts) - 2:
                right.append((parts[-1], rank))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, [*left, (parts[0], never)], [*right, (parts[-1], never)]

    def merged(self, piece: bytes) -> list[int]:
        """The piece's encoding by merging."""
        return [self.ranks[p] for p in self.merges(piece)[0]]

    def edges(self, token: int) -> tuple[list, list] | None:
        """What stands at a token's edges while it is merged; None if merging its bytes does not give it."""
        if token not in self._edges:
            parts, left, right = self.merges(self.bytes_of[token])
            self._edges[token] = (left, right) if len(parts) == 1 else None
        return self._edges[token]

    def side_by_side(self, pair: tuple[int, int]) -> bool:
        """Whether the two tokens' bytes, merged together, stay these two tokens. With -1 on the left: whether the token's own bytes give it.

        They do unless a part at the right edge of the one and a part at the left edge of the other are both
        there when their own merge is due; of equal ranks the merge further left comes first.
        """
        if len(self.pairs) >= MOST_PAIRS:
            self.pairs.clear()
        fits = self.pairs[pair] = self.edges(pair[1]) is not None if pair[0] < 0 else self._apart(*pair)
        return fits

    def _apart(self, left: int, right: int) -> bool:
        a, b = self.edges(left), self.edges(right)
        if a is None or b is None:
            return False
        for x, x_goes in a[1]:
            for y, y_goes in b[0]:
                due = self.ranks.get(x + y)
                if due is not None and due < x_goes and due <= y_goes:
                    return False
        return True


class Prefixes:
    """The last token of every byte prefix of a piece; supports appends and edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b"") -> None:
        self.vocabulary, self.piece = vocabulary, b""
        self.last = [-1]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Bytes at the end; what is there stays as it is."""
        had = len(self.piece)
        self.piece += more
        self._fill(had + 1, len(self.piece) + 1)

    def cut(self, size: int) -> None:
        """Keep the first ``size`` bytes."""
        self.piece = self.piece[:size]
        del self.last[size + 1 :]

    def _fill(self, first: int, behind: int) -> None:
        """Add the last tokens of the prefixes of ``first`` and more bytes. Tokens that end there are met backwards, shortest first."""
        v, last, piece = self.vocabulary, self.last, self.piece
        step, token_at, known = v.step.get, v.token_at, v.pairs.get
        for end in range(first, behind):
            state = 0
            for at in range(end - 1, -1, -1):
                state = step(state << 8 | piece[at])
                if state is None:
                    raise ValueError("no token ends here: the ranks are no byte-level vocabulary")
                token = token_at[state]
                if token >= 0:
                    pair = (last[at], token)
                    fits = known(pair)
                    if fits or (fits is None and v.side_by_side(pair)):
                        last.append(token)
                        break
            else:
                raise ValueError("no token ends here: the ranks are no byte-level vocabulary")

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Bytes ``start`` to ``end`` become ``new``; returns how many prefixes were computed again."""
        old, had = self.last, len(self.piece)
        self.piece = self.piece[:start] + new + self.piece[end:]
        self.last = old[: start + 1]
        shift, same = len(self.piece) - had, 0
        for at in range(start + 1, len(self.piece) + 1):
            self._fill(at, at + 1)
            # Where the tables have agreed over the longest token's length within equal bytes, they agree for good.
            same = same + 1 if at > start + len(new) and old[at - shift] == self.last[at] else 0
            if same >= self.vocabulary.longest:
                self.last += old[at - shift + 1 :]
                return at - start
        return len(self.piece) - start

    def tokens(self) -> list[int]:
        """The piece's encoding, read backwards from its last token."""
        out, at = [], len(self.piece)
        while at:
            out.append(self.last[at])
            at -= len(self.vocabulary.bytes_of[out[-1]])
        return out[::-1]


class _Memory(dict):
    """Piece to its tokens. When full, it becomes the old half, of which only what is asked for again is kept."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.old: dict[str, tuple[int, ...]] = {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        out = self.old.get(piece)
        if out is None:
            raw = piece.encode()
            whole = self.vocabulary.ranks.get(raw)
            out = (whole,) if whole is not None else tuple(Prefixes(self.vocabulary, raw).tokens())
        return self._keep(piece, out)

    def _keep(self, piece: str, out: tuple[int, ...]) -> tuple[int, ...]:
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= MOST_PIECES:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode what is not known yet, in byte order: one table serves all, of each piece only what its forerunner lacks is filled in."""
        fresh = [p for p in set(pieces) if p not in self and p not in self.old and len(p) <= LONGEST_KEPT]
        table, ranks = Prefixes(self.vocabulary), self.vocabulary.ranks
        for raw, piece in sorted((p.encode(), p) for p in fresh):
            whole = ranks.get(raw)
            if whole is None:
                had, common = table.piece, 0
                for a, b in zip(had, raw, strict=False):
                    if a != b:
                        break
                    common += 1
                table.cut(common)
                table.append(raw[common:])
            self._keep(piece, (whole,) if whole is not None else tuple(table.tokens()))


class Coder:
    """Encodes and decodes texts by a rank table and a splitting pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.vocabulary, self.pattern = Vocabulary(ranks), pattern
        self._split = regex.compile(pattern)
        self._memory = _Memory(self.vocabulary)

    def __reduce__(self):
        return Coder, (self.vocabulary.ranks, self.pattern)

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, in lists. Of a window, the last piece and those that start in its last characters are split again."""
        at, size = 0, WINDOW
        while at < len(text):
            end = min(at + size, len(text))
            found = self._split.findall(text, at, end)
            if end < len(text):
                top = end
                while found and (end == top or end > top - LOOK):
                    end -= len(found.pop())
                if not found:
                    size *= 2
                    continue
            yield found
            at, size = end, WINDOW

    def encode(self, text: str) -> list[int]:
        take = self._memory.__getitem__
        return [t for found in self.pieces(text) for t in chain.from_iterable(map(take, found))]

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """The encodings of many texts; what is new in a group of texts is encoded in order, so that pieces share their prefixes' tables."""
        group: list[str] = []
        for text in texts:
            group.append(text)
            if len(text) > WINDOW or sum(map(len, group)) >= WINDOW:
                yield from self._group(group)
                group = []
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[list[int]]:
        split = [[] if len(t) > WINDOW else [p for found in self.pieces(t) for p in found] for t in texts]
        self._memory.learn(chain.from_iterable(split))
        take = self._memory.__getitem__
        for text, found in zip(texts, split, strict=True):
            yield self.encode(text) if len(text) > WINDOW else list(chain.from_iterable(map(take, found)))

    def decode(self, ids: list[int]) -> bytes:
        try:
            return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))
        except KeyError as e:
            raise ValueError(f"the vocabulary has no token {e.args[0]}") from None

    def spliced(self, old: str, ids: list[int], new: str) -> tuple[list[int], int]:
        """The encoding of ``new`` from that of ``old``, and how many of its tokens were taken over.

        Only what lies between the last and the first sure piece start around the differing stretch is encoded.
        """
        a, b = _common(old, new)
        start = _sure_start(old, a)
        end_old = _first_sure(old, max(len(old) - b, start))
        end_new = end_old + len(new) - len(old)
        head, tail = len(old[:start].encode()), len(old[end_old:].encode())
        sizes = [len(self.vocabulary.bytes_of[i]) for i in ids]
        first = _count(sizes, head)
        kept = _count(sizes[::-1], tail)
        out = ids[:first] + self.encode(new[start:end_new]) + (ids[len(ids) - kept :] if kept else [])
        return out, first + kept


def _common(a: str, b: str) -> tuple[int, int]:
    """Lengths of the common start, and of the common end of what the start leaves, by halving."""
    most = min(len(a), len(b))

    def longest(equal: Callable[[int], bool], top: int) -> int:
        low = 0
        while low < top:
            mid = (low + top + 1) // 2
            low, top = (mid, top) if equal(mid) else (low, mid - 1)
        return low

    head = longest(lambda n: a[:n] == b[:n], most)
    return head, longest(lambda n: n == 0 or a[-n:] == b[-n:], most - head)


#: A piece starts here whatever surrounds it.
SURE = regex.compile(r" (?=\S)")
#: Searched at once when looking for the last sure start.
STEP = 4096


def _sure_start(text: str, common: int) -> int:
    """The last sure piece start whose space and next character are among the first ``common`` characters, or 0."""
    top = common
    while top > 0:
        low = max(0, top - STEP)
        found = [m.start() for m in SURE.finditer(text, low, min(top + 1, common))]
        if found:
            return found[-1]
        top = low
    return 0


def _first_sure(text: str, at: int) -> int:
    """The first sure piece start from ``at`` on, or the end."""
    found = SURE.search(text, at)
    return found.start() if found else len(text)


def _count(sizes: list[int], total: int) -> int:
    """How many of the sizes make up the total."""
    n = got = 0
    while got < total:
        got += sizes[n]
        n += 1
    if got != total:
        raise ValueError("the stored tokens are no encoding of the stored text")
    return n


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a rank file (base64 token, blank, rank on each line). It is read on the driver."""
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
                if len(ranks) > MOST_RANKS:
                    raise ValueError(f"more than {MOST_RANKS} tokens")
    return ranks


def coder(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Coder:
    """The coder of a rank file; by default the public 50k vocabulary."""
    return Coder(read_ranks(path or public_tokenizers.path("byte_bpe_50k.tiktoken")), pattern)


def encode(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``keep`` columns and ``ids``, the tokens of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(coder(path, pattern))

    def run(texts: list[bytes | None]) -> dict[str, list]:
        return {"ids": list(shared.value.encode_all((t or b"").decode() for t in texts))}

    return map_texts(docs, [c for c in keep if c.lower() != "ids"], text, run, "ids array<int>")


def decode(encoded: DataFrame, ids: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """The rows with ``decoded``, the bytes of their tokens (binary: a cut list of tokens need not be text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(coder(path, pattern))

    @F.pandas_udf("binary")
    def bytes_of(lists: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else shared.value.decode(list(x)) for x in lists], dtype="object")

    names = [c for c in encoded.columns if c.lower() != "decoded" or c == ids]
    return encoded.select(*[f"`{c}`" for c in names], bytes_of(_as_given(encoded[f"`{ids}`"])).alias("decoded"))


def _as_given(ids: Column) -> Column:
    """Nulls inside a list become -1, which no vocabulary has, so that they fail with a message."""
    return F.transform(ids.cast("array<int>"), lambda x: F.coalesce(x, F.lit(-1)))


def re_encode(before: DataFrame, after: DataFrame, key: str, text: str = "text", ids: str = "ids", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``key``, ``ids`` and ``n_taken`` for every row of ``after``, from the stored texts and tokens of ``before``.

    Appended and edited texts are encoded near the change only; unknown and null keys are encoded whole.
    ``before`` must have each key once; repeated keys of ``after`` are rows of their own.
    """
    shared = after.sparkSession.sparkContext.broadcast(coder(path, pattern))
    old, had = spare(after, "old_text"), spare(after, "old_ids")
    stored = before.select(F.col(f"`{key}`").alias("__key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias(old), F.col(f"`{ids}`").alias(had))
    both = after.select(f"`{key}`", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__new")).join(stored, F.col(f"`{key}`") == F.col("__key"), "left")

    @F.pandas_udf("ids array<int>, n_taken long")
    def near(new: pd.Series, was: pd.Series, tokens: pd.Series) -> pd.DataFrame:
        machine: Coder = shared.value
        rows = [(machine.encode(n), 0) if t is None else machine.spliced(o, list(t), n) for n, o, t in zip(new, was, tokens, strict=True)]
        return pd.DataFrame({"ids": pd.Series([r[0] for r in rows], dtype="object"), "n_taken": [r[1] for r in rows]})

    got = both.select(F.col(f"`{key}`"), near("__new", old, had).alias("__got"))
    return got.select(f"`{key}`", "__got.ids", "__got.n_taken")


def digests(docs: DataFrame, keep: list[str], text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``keep`` columns, the number of tokens, and the hashes of the tokens and of the bytes they decode to."""
    shared = docs.sparkSession.sparkContext.broadcast(coder(path, pattern))
    names: dict[int, str] = {}

    def run(texts: list[bytes | None]) -> dict[str, list]:
        machine: Coder = shared.value
        if not names:
            names.update({i: str(i) for i in machine.vocabulary.bytes_of})
        got: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for ids in machine.encode_all((t or b"").decode() for t in texts):
            got["n_tokens"].append(len(ids))
            got["ids_sha256"].append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
            got["decoded_sha256"].append(hashlib.sha256(machine.decode(ids)).hexdigest())
        return got

    own = {c.split()[0] for c in DIGESTS.split(", ")}
    return map_texts(docs, [c for c in keep if c.lower() not in own], text, run, DIGESTS)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: tokens of every document's whole text, as hashes, with the hash of what they decode to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(docs, ["doc_id"])
