"""Byte-level BPE with a tokenization automaton compiled from the merges.

The automaton reads tokens; its paths spell exactly the BPE tokenizations. It starts with one state
per byte and an arc between every two of them. Each merge (u, v) -> w, in order of priority, adds a
gadget: a state for w that is entered as u is and left as v is, while the arc from u to v goes. An
arc between two tokens therefore exists if the arcs of their parts existed when the younger token
was made and no merge has taken it out since; compiling keeps, for each state, its gadget (parts and
time), and transitions are entered in a table when they are first taken.

Encoding a word walks the automaton: of the labels that go on in the word the longest is tried first,
the transition table tells whether its arc exists, and ends that lead nowhere are closed; exactly one
path spells the word. Decoding emits the labels of the arcs. Words come from the pre-split pattern of the vocabulary file's format.

Defined results: a null text is an empty text, which has no tokens; the text of a special token is
that token, as in the public library; ids that are null or unknown are left out when decoding, and
bytes that are no UTF-8 become U+FFFD.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the pre-split pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KEPT = 150_000  # words, pieces and transitions that a task remembers, each twice over at most
LONG_WORD = 200  # characters; longer words and pieces are encoded anew each time
SLICE_ROWS = 256  # rows whose ids a task holds at once
NEVER = 1 << 30


class Vocabulary(NamedTuple):
    """labels: bytes of each id; merges: (left id, right id, id) by priority; special: text to id."""

    labels: dict[int, bytes]
    merges: list[tuple[int, int, int]]
    special: dict[str, int]


def _byte_letters() -> dict[str, int]:
    """Letters that stand for bytes: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(path: str) -> Vocabulary:
    """Read a byte-level BPE file in the JSON format of the tokenizers library."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    letters = _byte_letters()
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", []) if t["special"]}
    model = spec["model"]
    ids = {token: number for token, number in model["vocab"].items() if token not in special}
    labels = {number: bytes(letters[c] for c in token) for token, number in ids.items()}
    labels |= {number: text.encode() for text, number in special.items()}
    merges = []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        merges.append((ids[left], ids[right], ids[left + right]))
    return Vocabulary(labels, merges, special)


def _later_letters() -> str:
    """Class of the characters that regex counts as letters or numbers but Unicode 15 does not know."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    ranges: list[list[int]] = []
    for code in map(ord, found):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    # NUL-free and never empty: a class needs a member; U+10FFFF is no character.
    spans = ranges or [[0x10FFFF, 0x10FFFF]]
    return "[" + "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in spans) + "]"


class _Recent(dict):
    """Remembers results of `make`; of those not used for long it forgets."""

    def __init__(self, make, kept: int):
        super().__init__()
        self.make, self.kept, self.old = make, kept, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if isinstance(key, str) and len(key) > LONG_WORD:
                return value
        if len(self) >= self.kept:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Automaton:
    """The compiled merges. encode and decode take and give the ids of one text."""

    def __init__(self, vocabulary: Vocabulary):
        self.labels = vocabulary.labels
        self.special = vocabulary.special
        self.born: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.gone: dict[int, int] = {}
        reserved = set(self.special.values())
        for number, label in self.labels.items():
            if len(label) == 1 and number not in reserved:
                self.born[number] = -1
        for time, (left, right, number) in enumerate(vocabulary.merges):
            self._gadget(time, left, right, number)
        self.ids = {self.labels[number]: number for number in self.born}
        # Longest label with given first four bytes: no longer one need be looked up.
        self.reach: dict[bytes, int] = {}
        for label in self.ids:
            self.reach[label[:4]] = max(self.reach.get(label[:4], 0), len(label))
        self.arcs = _Recent(self._arc, KEPT)
        self.words = _Recent(self._word, KEPT)
        self.pieces = _Recent(self._piece, KEPT)
        self.plain = regex.compile(PATTERN).findall
        later = _later_letters()
        self.later = regex.compile(later).search
        careful = PATTERN.replace(r"\p{L}+", f"[\\p{{L}}--{later}]+")
        careful = careful.replace(r"\p{N}+", f"[\\p{{N}}--{later}]+")
        careful = careful.replace(r"[^\s\p{L}\p{N}]+", f"[[^\\s\\p{{L}}\\p{{N}}]||{later}]+")
        self.careful = regex.compile(careful, regex.V1).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def _gadget(self, time: int, left: int, right: int, number: int) -> None:
        # Without the arc from left to right no path reaches the new state.
        if left in self.born and right in self.born and self._open(left, right, time):
            self.born[number] = time
            self.parts[number] = (left, right)
        self.gone[left << 20 | right] = time

    def _open(self, x: int, y: int, time: int) -> bool:
        """Whether x -> y is an arc before the gadget of that time."""
        born, parts, gone = self.born, self.parts, self.gone
        while gone.get(x << 20 | y, NEVER) >= time:
            of_x, of_y = born[x], born[y]
            if of_x < 0 and of_y < 0:
                return True
            if of_y > of_x:
                # y is entered as its left part is, once the arc within y has gone.
                y, time = parts[y][0], of_y + 1
            elif of_x > of_y:
                x, time = parts[x][1], of_x
            else:
                (y, x), time = parts[x], of_x
        return False

    def _arc(self, pair: int) -> bool:
        return self._open(pair >> 20, pair & 0xFFFFF, NEVER)

    def _word(self, word: str) -> bytes:
        """Ids of one pre-split word as int32.

        Walks the automaton from the word's start by the longest label with an arc. A prefix has
        one path only, so an end from which the walk cannot go on is closed for good.
        """
        data = word.encode()
        ids, arcs, reach, n = self.ids, self.arcs, self.reach, len(data)
        whole = ids.get(data)
        if whole is not None:
            return whole.to_bytes(4, "little")
        path: list[int] = []
        closed: set[int] = set()
        at, length = 0, min(n, reach.get(data[:4], 3))
        while at < n:
            while length:
                token = ids.get(data[at : at + length])
                if token is not None and at + length not in closed:
                    if not path or arcs[path[-1] << 20 | token]:
                        break
                length -= 1
            if length:
                path.append(token)
                at += length
                length = min(n - at, reach.get(data[at : at + 4], 3))
            else:
                closed.add(at)
                length = len(self.labels[path.pop()])
                at -= length
                length -= 1
        return np.array(path, "<i4").tobytes()

    def split(self, text: str) -> list[str]:
        """The pre-split words of a text."""
        if text.isascii() or not self.later(text):
            return self.plain(text)
        return self.careful(text)

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a space and the piece after it; None if more white space is next to the space."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return None
        return b"".join([self.words[w] for w in self.split(" " + piece)])

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens."""
        first, *rest = text.split(" ")
        if rest and first and not first[-1].isspace():
            # A lone space between words begins a word of the pattern, so pieces split alone.
            start = b"".join([self.words[w] for w in self.split(first)])
            ids = [self.pieces[piece] for piece in rest]
            if None not in ids:
                return start + b"".join(ids)
        return b"".join([self.words[w] for w in self.split(text)])

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if not any(mark in text for mark in self.special):
            return np.frombuffer(self._plain(text), np.int32)
        out = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(np.array([self.special[part]], np.int32).tobytes())
            else:
                out.append(self._plain(part))
        return np.frombuffer(b"".join(out), np.int32)


def spell(labels: dict[int, bytes], ids) -> str:
    """The text that the labels of the ids spell."""
    return b"".join([labels.get(i, b"") for i in ids]).decode("utf-8", "replace")


_compiled: dict[int, Automaton] = {}


def compiled(vocabulary: Vocabulary) -> Automaton:
    """Compile a vocabulary once per process."""
    key = hash((len(vocabulary.labels), tuple(vocabulary.merges), tuple(vocabulary.special.items())))
    if key not in _compiled:
        _compiled[key] = Automaton(vocabulary)
    return _compiled[key]


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    offset = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(f) for f in found], out=offset[1:])
    return pa.ListArray.from_arrays(pa.array(offset), pa.array(np.concatenate([_NONE, *found])))


class Codec:
    """Encodes and decodes columns. The vocabulary (about a megabyte) is broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        self._sent = spark.sparkContext.broadcast(read_vocabulary(path))

    def encode(self, docs: DataFrame, text: str = "text", into: str = "ids") -> DataFrame:
        """Add the ids of a text column as array<int>."""
        sent = self._sent

        @F.arrow_udf("array<int>")
        def ids_of(texts: pa.Array) -> pa.Array:
            automaton = compiled(sent.value)
            return _id_lists([automaton.encode(t.as_py() or "") for t in texts])

        # So marked, it runs once per row even if its result is used several times.
        return docs.withColumn(into, ids_of.asNondeterministic()(F.col(text)))

    def decode(self, docs: DataFrame, ids: str = "ids", into: str = "decoded") -> DataFrame:
        """Add the text of an ids column; null ids give a null text."""
        sent = self._sent

        @F.arrow_udf("string")
        def text_of(arrays: pa.Array) -> pa.Array:
            labels = sent.value.labels
            return pa.array(
                [spell(labels, a.values.to_pylist()) if a.is_valid else None for a in arrays],
                pa.string(),
            )

        return docs.withColumn(into, text_of(F.col(ids)))

    def round_trip(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Replace a text column by ids and decoded, in one pass with few rows in memory."""
        sent = self._sent
        others = [c for c in docs.columns if c != text]

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = compiled(sent.value)
            for batch in batches:
                for low in range(0, batch.num_rows, SLICE_ROWS):
                    part = batch.slice(low, SLICE_ROWS)
                    found = [automaton.encode(t.as_py() or "") for t in part.column(text)]
                    decoded = [spell(automaton.labels, ids.tolist()) for ids in found]
                    yield pa.record_batch(
                        [*[part.column(c) for c in others], _id_lists(found), pa.array(decoded, pa.string())],
                        names=[*others, "ids", "decoded"],
                    )

        kept = docs.select(*others).schema
        schema = T.StructType(kept.fields).add("ids", T.ArrayType(T.IntegerType()))
        schema = schema.add("decoded", T.StringType())
        return docs.mapInArrow(both, schema)


_NONE = np.zeros(0, np.int32)


def default_path() -> str:
    """The vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def digests(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the comma-joined ids and of the decoded text."""
    both = Codec(spark, path).round_trip(docs.select("doc_id", "text"))
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
