import base64
import hashlib
import random

import pytest
from conftest import SF_DIR

from tradewatch.llm import byte_bpe
from tradewatch.llm.queries import QUERIES

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def library():
    lines = open(byte_bpe.default_path(), "rb").read().splitlines()
    ranks = {base64.b64decode(label): int(rank) for label, rank in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def own():
    return encoding(byte_bpe.read_ranks(byte_bpe.default_path()), byte_bpe.default_pattern())


def encoding(ranks, pattern):
    return byte_bpe.Encoding(byte_bpe.vocabulary(ranks), pattern)


def odd_texts(seed, count):
    rng = random.Random(seed)
    letters = "aabbeehtinsr  '\n.0123\täé漢字🙂 ÀÿSTe_-=  \x85\x1c"
    for _ in range(count):
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 60)))
    for _ in range(count):
        yield "".join(chr(rng.choice([rng.randrange(0x800), rng.randrange(0xE000, 0x30000)])) for _ in range(12))


def test_ids_equal_the_library(own, library):
    texts = [*odd_texts(5, 4000), "a" * 5000, "ab" * 3000, " " * 999 + "x", "<|endoftext|>", "", "\x00", "-" * 300]
    texts += ["".join(random.Random(i).choice("etaoin") for _ in range(20_000)) for i in range(3)]
    for text in texts:
        ids = own.encode(text).tolist()
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_letters_are_those_of_the_library(own, library):
    """Every character of the planes in use, between a letter, a digit and a mark."""
    codes = [c for c in range(0x40000) if not 0xD800 <= c < 0xE000]
    for low in range(0, len(codes), 4096):
        text = "".join(f"a{chr(c)}1{chr(c)}!{chr(c)}" for c in codes[low : low + 4096])
        assert own.encode(text).tolist() == library.encode_ordinary(text)


def test_toy_ranks_need_backtracking():
    """The longest match abc does not suit d: bcd comes first, so abcd is a, bcd."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 256, b"bcd": 257, b"ab": 258, b"abc": 259}
    toy = encoding(ranks, r"\S+|\s+")
    assert toy.encode("abcd").tolist() == [97, 257]
    merged = lambda data: [ranks[part] for part in byte_bpe.merged(ranks, data)]
    assert merged(b"abcd") == [97, 257]
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 12)))
        whole = ranks.get(text.encode())
        assert toy.encode(text).tolist() == ([whole] if whole is not None else merged(text.encode()))


@pytest.mark.parametrize("ordered", [True, False])
def test_random_vocabularies(ordered):
    """Labels made of earlier labels, and labels in any order, against merging pair by pair."""
    rng = random.Random(8)
    for _ in range(60):
        ranks = {bytes([b]): b for b in range(256)}
        made = [b"a", b"b", b"c"]
        for _ in range(12):
            label = rng.choice(made) + rng.choice(made)
            if label not in ranks:
                ranks[label] = len(ranks)
                made.append(label)
        if not ordered:
            numbers = list(range(256, len(ranks)))
            rng.shuffle(numbers)
            ranks = {label: rank if rank < 256 else numbers[rank - 256] for label, rank in ranks.items()}
        toy = encoding(ranks, r"\S+")
        for _ in range(200):
            text = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            whole = ranks.get(text.encode())
            wanted = [ranks[part] for part in byte_bpe.merged(ranks, text.encode())]
            assert toy.encode(text).tolist() == ([whole] if whole is not None else wanted)


def test_a_long_piece_is_encoded_in_linear_time_and_not_remembered(own, library):
    piece = "".join(random.Random(3).choice("etaoinshrdlu") for _ in range(200_000))
    held = len(own.pieces)
    assert own.encode(piece).tolist() == library.encode_ordinary(piece)
    assert len(own.pieces) == held


def test_memory_is_bounded(own, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 10_000)
    own.pieces.clear()
    own.pieces.held = 0
    own.encode(" ".join(f"w{i}" for i in range(2000)))
    assert len(own.pieces) <= 10_000 // byte_bpe.ENTRY


def test_query_digests(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = QUERIES["op13_byte_bpe"](spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_awkward_rows(spark, awkward, empty):
    codec = byte_bpe.Codec(spark, byte_bpe.default_path(), byte_bpe.default_pattern())
    both = codec.decode(codec.encode(awkward)).collect()
    assert [bytes(r.decoded).decode() for r in both] == [r.text or "" for r in both]
    clash = awkward.withColumnRenamed("key", "label")
    trip = codec.round_trip(clash.select("doc_id", "text", "label", "hash")).collect()
    assert sorted(bytes(r.decoded).decode() for r in trip) == sorted(r.text or "" for r in both)
    assert codec.round_trip(empty.select("doc_id", "text")).count() == 0
    assert byte_bpe.digests(spark, empty, byte_bpe.default_path(), byte_bpe.default_pattern()).count() == 0
    odd = spark.createDataFrame([([0, None, 999_999],), (None,)], "ids array<int>")
    assert [r.decoded for r in codec.decode(odd).collect()] == [bytearray(b"!"), None]
