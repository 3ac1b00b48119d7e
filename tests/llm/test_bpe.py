import hashlib
import random

import pytest
from conftest import SF_DIR

from tradewatch.llm import bpe
from tradewatch.llm.queries import QUERIES

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_path())


@pytest.fixture(scope="module")
def automaton():
    return bpe.Automaton(bpe.read_vocabulary(bpe.default_path()))


def test_toy_merges_keep_their_order():
    labels = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab"}
    toy = bpe.Automaton(bpe.Vocabulary(labels, [(0, 0, 2), (0, 1, 3), (2, 1, 4)], {"<end>": 5}))
    for text, ids in (("aaa", [2, 0]), ("aaaa", [2, 2]), ("ab", [3]), ("aab", [4]), ("aaab", [2, 3])):
        assert toy.encode(text).tolist() == ids
    assert toy.encode("ab<end>b").tolist() == [3, 5, 1]


def test_ids_equal_the_library(automaton, library):
    rng = random.Random(5)
    letters = "aabbeehtinsr  '\n.0123\täé漢字🙂 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["a" * 5000, "ab" * 3000, " " * 999 + "x", "x<|endoftext|>y", "<|endoftext|>", "", "\x00"]
    for text in texts:
        ids = automaton.encode(text).tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert bpe.spell(automaton.labels, ids) == library.decode(ids, skip_special_tokens=False) == text


def test_query_digests(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    for r in QUERIES["op9_bpe_round_trip"](spark, SF_DIR).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_columns_of_awkward_rows(spark, awkward, empty):
    codec = bpe.Codec(spark, bpe.default_path())
    both = codec.decode(codec.encode(awkward)).collect()
    assert [r.decoded for r in both] == [r.text or "" for r in both]
    assert all(r.ids == [] for r in both if not r.text)
    trip = codec.round_trip(awkward.select("doc_id", "text")).collect()
    assert sorted(r.decoded for r in trip) == sorted(r.decoded for r in both)
    assert codec.encode(empty).count() == 0
    odd = spark.createDataFrame([([0, None, 999_999],), (None,)], "ids array<int>")
    assert [r.decoded for r in codec.decode(odd).collect()] == ["!", None]


def test_long_words_are_not_remembered(automaton, library):
    rng = random.Random(9)
    for _ in range(5):
        word = "".join(rng.choice("abcdef") for _ in range(50_000))
        held = len(automaton.words), len(automaton.pieces)
        text = f"{word} {word[:300]}"
        assert automaton.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
        assert (len(automaton.words), len(automaton.pieces)) == held
