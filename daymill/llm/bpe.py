"""Byte-level BPE encoding and decoding with finite-state machines.

Encoding: of each prefix of a piece, the last token of its encoding is the longest vocabulary token that ends there
and that merges leave apart from the token before it. So a piece is read byte by byte by a transducer whose
configuration is, for every position at which a token may still begin, the tokens that lead there. Determinising adds
residual outputs: what all positions have in common is emitted at once, and the rest waits, no longer than the longest
token (the bounded lookahead). States and transitions are made when first met, and begun anew when they are too many.

Decoding: tokens' bytes go through a UTF-8 state machine whose transitions (state, token) are made lazily too, so
that characters split between tokens come out when complete; malformed bytes become U+FFFD.

Each match of the splitting pattern is encoded separately; a match that is itself in the vocabulary is that token.
A null text is empty: no ids. Nothing depends on other rows: repeated rows repeat, and an empty table gives none. What a
worker keeps is bounded in number and length (``MOST_STATES``, ``MOST_PIECES``, ``MOST_PARTS``, ``LONG``), so long texts
without spaces and tables with ever new words cost time and no memory. Other columns of the input are kept by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import small_batches, text_or_empty

#: States, pieces and pairs that are kept before a machine begins anew.
MOST_STATES = 250_000
MOST_PIECES = 500_000
MOST_PARTS = 500_000
#: Pieces and parts of this many characters or more are not kept.
LONG = 100
NEVER = 1 << 60
#: A space before other than white space, and what tells that a text also has other spaces.
BREAK = re.compile(r" (?=\S)")
UNEVEN = re.compile(r" (?!\S)").search


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file with a base64 token and its rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def merge(piece: bytes, ranks: dict[bytes, int], whole: int | None = None) -> list[bytes]:
    """The tokens of a short piece by merging, lowest rank first; whole is the piece's rank if to stop before it."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    rank = [ranks.get(a + b, NEVER) for a, b in zip(parts, parts[1:], strict=False)]
    while rank and (least := min(rank)) < NEVER and (least != whole or len(rank) > 1):
        i = rank.index(least)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del rank[i]
        if i:
            rank[i - 1] = ranks.get(parts[i - 1] + parts[i], NEVER)
        if i < len(rank):
            rank[i] = ranks.get(parts[i] + parts[i + 1], NEVER)
    return parts


def reachable(ranks: dict[bytes, int]) -> dict[bytes, tuple[int, int]]:
    """The tokens that merging their own bytes gives, with the ranks of the two that the last merge joins; only these
    come out of merges. A single byte joins none: (-1, -1)."""
    out = {}
    for t, rank in ranks.items():
        if len(t) == 1:
            out[t] = (-1, -1)
        elif len(halves := merge(t, ranks, rank)) == 2:
            out[t] = (ranks[halves[0]], ranks[halves[1]])
    return out


class State(dict):
    """A state's transitions, from a byte to (state, tokens that go out); one that is missing is made."""

    __slots__ = ("live", "machine")

    def __init__(self, machine: Transducer, live: tuple) -> None:
        self.machine, self.live = machine, live

    def __missing__(self, byte: int) -> tuple[State, tuple[int, ...]]:
        return self.machine.step(self, byte)


class Transducer:
    """Bytes to token ids, lazily determinised.

    A state is, from the longest to the shortest, the trie node of the bytes since each position at which a token may
    begin, and the tokens to there that are not out yet. There are never more than ``most`` states: the next one begins
    a new machine, in the middle of a piece too.
    """

    def __init__(self, ranks: dict[bytes, int], tokens: dict[bytes, tuple[int, int]], most: int = MOST_STATES) -> None:
        self.ranks, self.most = ranks, most
        self.bytes = {i: t for t, i in ranks.items()}
        self.halves = {ranks[t]: halves for t, halves in tokens.items() if len(t) > 1}
        self.next: dict[int, int] = {}
        self.token: list[int | None] = [None]
        self.inner = {0}
        for t in tokens:
            node = 0
            for byte in t:
                self.inner.add(node)
                node = self.next.setdefault(node << 8 | byte, len(self.token))
                if node == len(self.token):
                    self.token.append(None)
            self.token[node] = ranks[t]
        self.apart: dict[int, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.start = State(self, ((0, ()),))
        self.states = {self.start.live: self.start}
        self.apart.clear()

    def stays(self, a: int, b: int) -> bool:
        """Whether merging leaves these two tokens as they are, side by side.

        The merges inside them are undone, latest first (of two alike, the right one). Whenever what is left at the
        border on both sides would have merged before the merge that was undone last, the border falls.
        """
        key = a << 32 | b
        known = self.apart.get(key)
        if known is None:
            known, x, y, until = True, a, b, NEVER
            while True:
                if self.ranks.get(self.bytes[x] + self.bytes[y], NEVER) < until:
                    known = False
                    break
                left, right = x in self.halves, y in self.halves
                if right and (not left or y >= x):
                    until, y = y + 1, self.halves[y][0]  # the border is to the left of it: it wins a tie
                elif left:
                    until, x = x, self.halves[x][1]
                else:
                    break
            self.apart[key] = known
        return known

    def step(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        here, live, onward, inner = None, [], self.next, self.inner
        for node, tokens in state.live:
            grown = onward.get(node << 8 | byte)
            if grown is None:
                continue
            if grown in inner:
                live.append((grown, tokens))
            if here is None and (t := self.token[grown]) is not None and (not tokens or self.stays(tokens[-1], t)):
                here = (*tokens, t)
        assert here is not None, "a vocabulary must hold every single byte"
        # What all have in common goes out, but each keeps its last token, which the next must stay apart from.
        common = 0
        if not live:
            common = len(here) - 1
        elif (shortest := min([len(tokens) for _, tokens in live]) - 1) > 0:
            while common < shortest and all([tokens[common] == here[common] for _, tokens in live]):
                common += 1
        live.append((0, here))
        following = tuple([(node, tokens[common:]) for node, tokens in live]) if common else tuple(live)
        known = self.states.get(following)
        if known is None:
            if len(self.states) >= self.most:
                self.reset()
            known = self.states[following] = State(self, following)
        made = state[byte] = (known, here[:common])
        return made

    def encode(self, piece: bytes) -> list[int]:
        state, ids = self.start, []
        for byte in piece:
            state, out = state[byte]
            if out:
                ids += out
        ids += state.live[-1][1]
        return ids


class Utf8:
    """Token ids to text; what is still owed of a character is carried from token to token."""

    def __init__(self, tokens: dict[int, bytes]) -> None:
        self.tokens = tokens
        self.steps: dict[tuple[bytes, int], tuple[bytes, str]] = {}
        self.plain: dict[int, str] = {}
        for i, b in tokens.items():
            owed, text = self.read(b"", b)
            if not owed and text.encode() == b:
                self.plain[i] = text

    @staticmethod
    def read(owed: bytes, data: bytes) -> tuple[bytes, str]:
        """The state is the bytes of an unfinished character; gives the next one and the characters finished."""
        out = []
        for byte in data:
            if owed:
                first = owed[0]
                low, high = 0x80, 0xBF
                if len(owed) == 1:
                    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(first, (low, high))
                if low <= byte <= high:
                    owed += bytes([byte])
                    if len(owed) == (2 if first < 0xE0 else 3 if first < 0xF0 else 4):
                        out.append(owed.decode())
                        owed = b""
                    continue
                out.append("�")
                owed = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                owed = bytes([byte])
            else:
                out.append("�")
        return owed, "".join(out)

    def stream(self, ids: Iterator[int]) -> Iterator[str]:
        owed = b""
        for i in ids:
            if not owed and (text := self.plain.get(i)) is not None:
                yield text
                continue
            if (owed, i) not in self.steps:
                self.steps[owed, i] = self.read(owed, self.tokens[i])
            owed, text = self.steps[owed, i]
            yield text
        if owed:
            yield "�"

    def decode(self, ids: list[int]) -> str:
        try:
            return "".join(map(self.plain.__getitem__, ids))
        except KeyError:
            return "".join(self.stream(iter(ids)))


class Known(dict):
    """What was made from strings before, at most so many short ones; what is missing is made."""

    def __init__(self, make: Callable[[str], tuple[int, ...]], most: int) -> None:
        self.make, self.most = make, most

    def __missing__(self, key: str) -> tuple[int, ...]:
        made = self.make(key)
        if len(key) < LONG:
            if len(self) >= self.most:
                self.clear()
            self[key] = made
        return made


class Codec:
    """Encodes and decodes whole texts; what was met before is looked up.

    The pattern's matches must never reach over a space that stands before other than white space, unless the match
    starts with that space. So a text falls into parts at such spaces, and parts are split by the pattern on their own.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, tokens: dict[bytes, tuple[int, int]] | None = None, share: int = 1) -> None:
        """share: what is kept of states, pieces and parts is bounded by one in so many of the module's numbers."""
        self.find = regex.compile(pattern).findall
        self.machine = Transducer(ranks, tokens or reachable(ranks), MOST_STATES // share)
        self.ranks, self.text = ranks, None
        self.digits = {i: str(i) for i in ranks.values()}.__getitem__
        self.pieces = Known(self.piece, MOST_PIECES // share)
        self.parts = Known(self.part, MOST_PARTS // share)

    def piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode("utf-8", "surrogatepass")
        rank = self.ranks.get(data)
        return tuple(self.machine.encode(data)) if rank is None else (rank,)

    def part(self, part: str) -> tuple[int, ...]:
        """The ids of a part and the space before it."""
        return self.split(" " + part)

    def split(self, text: str) -> tuple[int, ...]:
        found = self.find(text)
        return self.pieces[found[0]] if len(found) == 1 else tuple(chain.from_iterable(map(self.pieces.__getitem__, found)))

    def encode(self, text: str) -> list[int]:
        first, *rest = BREAK.split(text) if UNEVEN(text) else text.split(" ")
        return [*self.split(first), *chain.from_iterable(map(self.parts.__getitem__, rest))]

    def decode(self, ids: list[int]) -> str:
        if self.text is None:
            self.text = Utf8({i: t for t, i in self.ranks.items()})
        return self.text.decode(ids)


_codecs: dict[str, Codec] = {}


def _codec(path: str, pattern: str, ranks) -> Codec:
    """One for each worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(ranks.value[0], pattern, ranks.value[1])
    return _codecs[path]


def _sent(spark: SparkSession, path: str):
    """The vocabulary, broadcast: its size has nothing to do with the input's."""
    ranks = read_ranks(path)
    return spark.sparkContext.broadcast((ranks, reachable(ranks)))


def encode_and_decode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with ids and decoded_sha256: the token ids of each text, and the digest (lowercase hex) of what they decode to.

    One worker does both, so that the vocabulary is held once. It comes after other stages, whose executors are full
    already, so it keeps less and takes smaller batches. Existing columns of these names are replaced.
    """
    small_batches(docs.sparkSession, 250, 2)
    ranks = _sent(docs.sparkSession, path)

    @F.pandas_udf("ids array<int>, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = Codec(ranks.value[0], pattern, ranks.value[1], 8)
        for texts in batches:
            ids = [codec.encode(t) for t in texts]
            digests = [hashlib.sha256(codec.decode(i).encode("utf-8", "surrogatepass")).hexdigest() for i in ids]
            yield pd.DataFrame({"ids": pd.Series(ids, dtype=object), "decoded_sha256": pd.Series(digests, dtype=object)})

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("ids", "decoded_sha256")]
    return docs.select(*kept, run(text_or_empty(text_col)).alias("__mill_coded")).select(*kept, "__mill_coded.ids", "__mill_coded.decoded_sha256")


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """docs with the token ids of each text; an existing column of that name is replaced.

    A task's machine ends with it, so that workers that go on to other stages don't hold it.
    """
    small_batches(docs.sparkSession)
    ranks = _sent(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = Codec(ranks.value[0], pattern, ranks.value[1])
        for texts in batches:
            yield pd.Series([codec.encode(t) for t in texts], dtype=object)

    return docs.withColumn(out_col, run(text_or_empty(text_col)))


def decode(docs: DataFrame, path: str, pattern: str = ".", ids_col: str = "ids", out_col: str = "text") -> DataFrame:
    """docs with the text of each row's ids; null ids give an empty text."""
    spark = docs.sparkSession
    ranks = _sent(spark, path)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(path, pattern, ranks)
        for x in batches:
            yield pd.Series([codec.decode([int(i) for i in ids]) if ids is not None else "" for ids in x], dtype=object)

    return docs.withColumn(out_col, run(F.col(ids_col)))


def _digests(codec: Codec, text: str) -> tuple[int, str, str]:
    ids = codec.encode(text)
    back = codec.decode(ids).encode("utf-8", "surrogatepass")
    return len(ids), hashlib.sha256(",".join(map(codec.digits, ids)).encode()).hexdigest(), hashlib.sha256(back).hexdigest()


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: each text is encoded, and its ids decoded."""
    small_batches(docs.sparkSession)
    ranks = _sent(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, pattern, ranks)
        for texts in batches:
            yield pd.DataFrame([_digests(codec, t) for t in texts], columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col).alias("doc_id"), run(text_or_empty(text_col)).alias("r")).select("doc_id", "r.*")
