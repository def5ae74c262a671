"""Byte-level BPE against tiktoken, and decoding against Python's codec."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from daymill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def pair():
    ranks = bpe.read_ranks(PATH)
    return bpe.Codec(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["a", " ", "the", "é", "日本", "\n", "  ", "😀", "zz", "1", "ing", "\x00", "ß", "  \t", "\x1c", "\x85", "\xa0", "'s", "²", "'", "<|endoftext|>", "　"]


def test_ids_equal_the_library(pair):
    codec, library = pair
    rnd = random.Random(1)
    for k in range(300):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randrange(300)))
        text = text.replace(" ", "") * 3 if k % 10 == 0 else text
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text
    for text in ("", "ab" * 20000 + "a" * 40000, " " * 30000, "é" * 20000):
        assert codec.encode(text) == library.encode_ordinary(text)


def test_machines_begin_anew(pair):
    codec, library = pair
    small = bpe.Transducer(codec.machine.ranks, bpe.reachable(codec.machine.ranks), most=50)
    for word in ("unbelievable", "straightforwardly", "Donaudampfschifffahrt", "xyzzy" * 30):
        assert small.encode(word.encode()) == library._encode_single_piece(word)


def test_utf8_machine_equals_python():
    rnd = random.Random(2)
    for _ in range(500):
        data = bytes(rnd.choice([0x41, 0x80, 0xBF, 0xC2, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x98, 0xED, 0xA0, 0xF4, 0x90, 0xFF]) for _ in range(10))
        owed, text = bpe.Utf8.read(b"", data)
        assert text + "�" * bool(owed) == data.decode(errors="replace")


def test_round_trip(spark, pair):
    rows = [(1, "Hello, wörld"), (2, None), (3, ""), (None, "x  y"), (1, "Hello, wörld")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, bpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for d, t in rows:
        ids = pair[1].encode_ordinary(t or "")
        want.append((d, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    coded = bpe.encode(docs, PATH, public_tokenizers.PATTERN)
    assert [r.text for r in bpe.decode(coded, PATH).orderBy("doc_id", "text").collect()] == ["x  y", "Hello, wörld", "Hello, wörld", "", ""]
    assert bpe.round_trip(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_borders_stay_as_merging_says(pair):
    machine = pair[0].machine
    rnd = random.Random(4)
    met = [machine.ranks[t] for t in bpe.reachable(machine.ranks)]
    short = [i for i in met if len(machine.bytes[i]) <= 3]
    for k in range(60_000):
        a, b = rnd.choice(short if k % 2 else met), rnd.choice(short if k % 3 else met)
        x, y = machine.bytes[a], machine.bytes[b]
        assert machine.stays(a, b) == (bpe.merge(x + y, machine.ranks) == [x, y]), (x, y)
    for unit in (b"a", b"ab", b"=", b"\n", b"aab"):
        alike = [i for i in met if not machine.bytes[i].strip(unit)]
        for a in alike:
            for b in alike:
                x, y = machine.bytes[a], machine.bytes[b]
                assert machine.stays(a, b) == (bpe.merge(x + y, machine.ranks) == [x, y]), (x, y)


def test_what_is_kept_is_bounded(pair):
    codec = bpe.Codec(pair[0].ranks, public_tokenizers.PATTERN)
    codec.machine.most, codec.pieces.most, codec.parts.most = 1000, 200, 200
    rnd = random.Random(6)
    letters = "".join(rnd.choice("日本語的中文字国人大abcxyz") for _ in range(60_000))
    for text in (letters, " ".join(letters[i : i + 7] for i in range(0, 60_000, 7)), " ".join([letters[:5000]] * 3), "。".join(letters[i : i + 9] for i in range(0, 60_000, 9))):
        assert codec.encode(text) == pair[1].encode_ordinary(text)
        assert len(codec.machine.states) <= 1000 and len(codec.pieces) <= 200 and len(codec.parts) <= 200
        assert max(map(len, [*codec.pieces, *codec.parts]), default=0) < bpe.LONG
