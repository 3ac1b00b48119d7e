"""Byte-level BPE by ranks: longest matches, backtracking, memoised compatibility of neighbours.

Bytes are read as Latin-1 letters, so that an Aho-Corasick automaton over text finds the labels of a
rank file. A sequence of tokens is the BPE encoding of its bytes exactly if every two neighbours are
what their own bytes encode to: merges inside such a pair happen as they would alone until one
crosses its border. So a piece is covered by longest matches from its start; where a match does not
suit the token before it, the next shorter label is tried, and where none suits, the token before is
taken back and that place is closed for good. Every place is closed once at most, which makes the
work linear in the piece; whether two tokens suit each other is found once, by undoing their merges
along the border, and remembered.

A piece that is a label as a whole has that id, also if merges could not make it. Text is cut into
pieces by a pattern of letters and numbers as of Unicode 16.

Defined results: a null text is an empty text, which has no ids; ids that are null or unknown are left
out when decoding; null ids decode to null. Repeated rows and null ids of documents pass through, and
no other column is read, so extra columns may have any names.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REMEMBERED = 128 << 20  # bytes of pieces and of pairs, by estimate, that a process keeps of each
LONG_PIECE = 200  # longer pieces are encoded anew each time
NEVER = 1 << 62
SLICE_BYTES = 4 << 20  # of text whose ids a task holds at once; a longer text is a slice of its own
ENTRY = 240  # estimated bytes of an entry besides its text

# Letters and numbers that Unicode 16 added.
SINCE_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3),
    (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16130, 0x16139),
    (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5FA),
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Labels and ranks of a file with a base64 label and its rank on each line."""
    lines = Path(path).read_bytes().splitlines()
    return {base64.b64decode(label): int(rank) for label, rank in map(bytes.split, lines)}


def default_path() -> str:
    """The rank file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _newer_letters() -> list[tuple[int, int]]:
    """Ranges of the letters and numbers of the regex library that Unicode 16 does not have."""
    known = {code for first, last in SINCE_16 for code in range(first, last + 1)}
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    ranges: list[tuple[int, int]] = []
    for code in map(ord, regex.findall(r"[\p{L}\p{N}]", every)):
        if unicodedata.category(chr(code)) == "Cn" and code not in known:
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1] = ranges[-1][0], code
            else:
                ranges.append((code, code))
    # U+10FFFF is no character; it keeps the class from being empty.
    return [*ranges, (0x10FFFF, 0x10FFFF)]


class Splitter:
    """Cuts text into the matches of a pattern, with letters and numbers as of Unicode 16."""

    def __init__(self, pattern: str):
        ranges = _newer_letters()
        newer = "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in ranges) + "]"
        # Most texts end at this test, which is much faster than a class of many ranges.
        self._beyond = re.compile(f"[\\U{ranges[0][0]:08X}-\U0010FFFF]").search
        self._newer = re.compile(newer).search
        self._plain = regex.compile(pattern).findall
        careful = pattern
        for written, meant in (
            (r"[^\s\p{L}\p{N}]", f"[[^\\s\\p{{L}}\\p{{N}}]||{newer}]"),
            (r"\p{L}+", f"[\\p{{L}}--{newer}]+"),
            (r"\p{N}+", f"[\\p{{N}}--{newer}]+"),
        ):
            careful = careful.replace(written, meant)
        self._careful = regex.compile(careful, regex.V1).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii() or not self._beyond(text) or not self._newer(text):
            return self._plain(text)
        return self._careful(text)


class _Memory(dict):
    """Results of `make` by key, forgotten all at once when their estimated size is reached."""

    def __init__(self, make):
        super().__init__()
        self.make, self.held = make, 0

    def __missing__(self, key):
        value = self.make(key)
        size = len(key) if isinstance(key, str) else 0
        if size <= LONG_PIECE:
            self.held += ENTRY + 4 * size
            if self.held > REMEMBERED:
                self.clear()
                self.held = ENTRY + 4 * size
            self[key] = value
        return value


def merged(ranks: dict[bytes, int], data: bytes, least: int = 1) -> list[bytes]:
    """Labels by merging neighbours of least rank, leftmost first, while over `least` are left."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > least:
        pairs = [ranks.get(a + b) for a, b in zip(parts, parts[1:])]
        best = min((r for r in pairs if r is not None), default=None)
        if best is None:
            break
        at = pairs.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary(NamedTuple):
    """halves: the two labels each longer label is merged from, without labels that merges do not make.

    ordered: whether every label comes after its halves, so that merges happen in the order of ranks.
    """

    ranks: dict[bytes, int]
    halves: dict[int, tuple[int, int]]
    ordered: bool


def vocabulary(ranks: dict[bytes, int]) -> Vocabulary:
    halves, ordered = {}, True
    for label, rank in ranks.items():
        if len(label) > 1:
            parts = merged(ranks, label, least=2)
            if len(parts) == 2:
                halves[rank] = ranks[parts[0]], ranks[parts[1]]
                ordered &= all(len(part) == 1 or ranks[part] < rank for part in parts)
    return Vocabulary(ranks, halves, ordered)


class Encoding:
    """The compiled ranks. encode and decode take and give the ids of one text."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.ranks = ranks = vocabulary.ranks
        self.halves, self.ordered = vocabulary.halves, vocabulary.ordered
        self.labels = {rank: label for label, rank in ranks.items()}
        self.split = Splitter(pattern)
        self.matches = ahocorasick.Automaton()
        self.made = {label: r for label, r in ranks.items() if len(label) == 1 or r in self.halves}
        for label, rank in self.made.items():
            self.matches.add_word(label.decode("latin-1"), rank)
        self.matches.make_automaton()
        self._shift = max(self.labels).bit_length()
        self.suits = _Memory(self._suits)  # by left id << shift | right id
        self.pieces = _Memory(self._piece)
        self.shorter: dict[int, int] = {}

    def _suits(self, pair: int) -> bool:
        left, right = pair >> self._shift, pair & ((1 << self._shift) - 1)
        if not self.ordered:
            data = self.labels[left] + self.labels[right]
            return merged(self.ranks, data) == [self.labels[left], self.labels[right]]
        return self._border_holds(left, right)

    def _border_holds(self, left: int, right: int) -> bool:
        """Whether no merge crosses from the left to the right label.

        Merges happen in the order of ranks here. Undone from the last on, they show every pair of parts that
        ever meet at the border; one that is a label of its own is merged if its rank comes before the
        merges that use its parts, and the left of two equal ranks goes first.
        """
        ranks, labels, halves = self.ranks, self.labels, self.halves
        x, y = left, right
        x_used = y_used = NEVER
        while True:
            crossing = ranks.get(labels[x] + labels[y])
            if crossing is not None and crossing < x_used and crossing <= y_used:
                return False
            of_x, of_y = halves.get(x), halves.get(y)
            if of_x is not None and (of_y is None or x > y):
                x, x_used = of_x[1], x
            elif of_y is not None:
                y, y_used = of_y[0], y
            else:
                return True

    def _shorter(self, token: int) -> int:
        """The longest label that is a proper prefix of the token's label; -1 if there is none."""
        label = self.labels[token]
        found = next((r for n in range(len(label) - 1, 0, -1) if (r := self.made.get(label[:n])) is not None), -1)
        self.shorter[token] = found
        return found

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece as int32."""
        data = piece.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        letters = data.decode("latin-1")
        path = [rank for _, rank in self.matches.iter_long(letters)]
        suits, shift = self.suits, self._shift
        left = path[0]
        for place in range(1, len(path)):
            right = path[place]
            if not suits[left << shift | right]:
                path = self._backtracked(letters, path[:place], right)
                break
            left = right
        return array("i", path).tobytes()

    def _backtracked(self, letters: str, path: list[int], token: int) -> list[int]:
        """The encoding, from a beginning whose neighbours suit each other and a token to try next."""
        labels, suits, shorter, shift = self.labels, self.suits, self.shorter, self._shift
        longest = self.matches.iter_long
        size = len(letters)
        closed: set[int] = set()
        at = sum(len(labels[t]) for t in path)
        while True:
            end = at + len(labels[token])
            if end not in closed and (not path or suits[path[-1] << shift | token]):
                path.append(token)
                at = end
                if at == size:
                    return path
                token = next(longest(letters, at))[1]
                continue
            token = shorter[token] if token in shorter else self._shorter(token)
            if token < 0:
                closed.add(at)
                token = path.pop()
                at -= len(labels[token])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text, without special tokens."""
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: Iterable[int | None]) -> bytes:
        """The bytes that the labels of the ids spell."""
        try:
            return b"".join(map(self.labels.__getitem__, ids))
        except KeyError:
            return b"".join(self.labels.get(i, b"") for i in ids)


_compiled: dict[tuple[str, int, int], Encoding] = {}


class Codec:
    """Encodes and decodes columns. The ranks (about a megabyte) are broadcast."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self._sent = spark.sparkContext.broadcast(vocabulary(read_ranks(path)))
        self._pattern = pattern

    def _encoding(self):
        sent, pattern = self._sent, self._pattern

        def compiled() -> Encoding:
            ranks = sent.value.ranks
            key = (pattern, len(ranks), hash(frozenset(ranks.items())))
            if key not in _compiled:
                _compiled[key] = Encoding(sent.value, pattern)
            return _compiled[key]

        return compiled

    def encode(self, docs: DataFrame, text: str = "text", into: str = "ids") -> DataFrame:
        """Add the ids of a text column as array<int>."""
        compiled = self._encoding()

        @F.arrow_udf("array<int>")
        def ids_of(texts: pa.Array) -> pa.Array:
            encoding = compiled()
            return _lists([encoding.encode(t.as_py() or "") for t in texts])

        # So marked, it runs once per row even if its result is used several times.
        return docs.withColumn(into, ids_of.asNondeterministic()(F.col(text)))

    def decode(self, docs: DataFrame, ids: str = "ids", into: str = "decoded") -> DataFrame:
        """Add the bytes of an ids column, which need not be UTF-8."""
        compiled = self._encoding()

        @F.arrow_udf("binary")
        def bytes_of(arrays: pa.Array) -> pa.Array:
            encoding = compiled()
            return pa.array(
                [encoding.decode(a.values.to_pylist()) if a.is_valid else None for a in arrays], pa.binary()
            )

        return docs.withColumn(into, bytes_of(F.col(ids)))

    def round_trip(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Replace a text column by ids and the bytes decoded from them, in one pass."""
        compiled = self._encoding()
        others = [c for c in docs.columns if c != text]

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoding = compiled()
            for batch in batches:
                for part in _slices(batch, text):
                    found = [encoding.encode(t.as_py() or "") for t in part.column(text)]
                    decoded = [encoding.decode(ids.tolist()) for ids in found]
                    yield pa.record_batch(
                        [*[part.column(c) for c in others], _lists(found), pa.array(decoded, pa.binary())],
                        names=[*others, "ids", "decoded"],
                    )

        schema = T.StructType(docs.select(*others).schema.fields)
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", T.BinaryType())
        return docs.mapInArrow(both, schema)


def _slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of at most SLICE_BYTES of text, or one row."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(text)).fill_null(0))
    first, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and held + size > SLICE_BYTES:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += size
    if batch.num_rows:
        yield batch.slice(first)


def _lists(found: list[np.ndarray]) -> pa.Array:
    offset = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(f) for f in found], out=offset[1:])
    return pa.ListArray.from_arrays(pa.array(offset), pa.array(np.concatenate([np.zeros(0, np.int32), *found])))


def digests(spark: SparkSession, docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the space-joined ids and of the decoded bytes."""
    both = Codec(spark, path, pattern).round_trip(docs.select("doc_id", "text"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
