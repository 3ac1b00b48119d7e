"""Grouping of spelling variants with a bit-sliced position index over the vocabulary.

The index holds, for every position and letter, the set of vocabulary words with that letter there, as
one bit per word. A query word is followed letter by letter through sets of words, 64 words to a machine
word: those that agree so far without an error, those with one letter replaced, and those that have one
letter more, which are looked up one position further on. After the last letter the sets hold exactly
the words within one edit of the same length and of one letter more; words of one letter less are found
by the shorter word's query.

An edit leaves either the first or the second half of the shorter word as it is. So the vocabulary is
indexed twice, by its first and by its second halves, in slices of bounded size, and a word meets only
the slices that hold its half; a pair that shares both halves counts on the first side alone. A half of
more words than a slice holds is cut into tiles of index and query words, so that no task holds more
than a tile of each.

Defined results: a null text has no words; a null doc_id is spelled as nothing before the colon. Every
row of a repeated document counts. Ties go to the smallest word in code-point order. An empty table and
a table without frequent words give no rows. Only doc_id and text are read, so extra columns may have
any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.scratch import settle

LEAST_LENGTH = 5  # code points of a word
LEAST_COUNT = 3  # occurrences of a word
SPOILED = 97  # of the runs' checksums, one in so many loses a letter
DOMINANCE = 2  # a form is at least so many times as frequent
SLICE_WORDS = 8192  # of an index slice at most
SLICE_LETTERS = 1 << 18  # of an index slice of long words
BUCKET_WORDS = 4096  # small halves share a slice of about this size
COMMON_LENGTH = 64  # words up to here share slices by length
BATCH_BYTES = 1 << 20  # of one set for a batch of queries

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def counted_words(docs: DataFrame) -> DataFrame:
    """word and n: runs of letters of all texts, lower-cased in A-Z, some without one letter."""
    # Shorter runs cannot give words, whether or not they lose a letter.
    runs = F.regexp_extract_all(
        F.translate("text", _UPPER, _UPPER.lower()), F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0)
    )
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    exploded = docs.select(name.alias("name"), F.explode(runs).alias("run"))
    checksum = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    gap = (F.col("checksum") % F.char_length("run")).cast("int")
    spoiled = F.concat(
        F.substring("run", F.lit(1), gap), F.substring("run", gap + 2, F.char_length("run"))
    )
    word = F.when(F.col("checksum") % SPOILED == 0, spoiled).otherwise(F.col("run"))
    return (
        exploded.withColumn("checksum", checksum)
        .select(word.alias("word"))
        .where(F.char_length("word") >= LEAST_LENGTH)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= LEAST_COUNT)
    )


# Units of work ----------------------------------------------------------------------------------


def _slice_words(size: Column) -> Column:
    """Words of a half beyond which it is cut, by the length of its words."""
    by_letters = F.greatest(F.lit(64), F.floor(F.lit(SLICE_LETTERS) / size).cast("int"))
    return F.least(F.lit(SLICE_WORDS), by_letters)


def work_units(words: DataFrame) -> DataFrame:
    """Every word in the units that can hold a near word: unit, side, size, word, n, indexed, asked.

    size is the length of the shorter word of a pair: words of that length are asked, and they and
    those of one letter more are indexed.
    """
    length = F.char_length("word")
    sizes = F.when(length > LEAST_LENGTH, F.array(length, length - 1)).otherwise(F.array(length))
    half = F.floor(F.col("size") / 2).cast("int")
    members = (
        words.select("word", "n", F.explode(sizes).alias("size"))
        .select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
        .withColumn("half", F.when(F.col("side") == 0, F.left("word", half)).otherwise(F.right("word", half)))
        .withColumn("asked", F.char_length("word") == F.col("size"))
    )
    of_half = ["side", "size", "half"]
    large = (
        members.groupBy(*of_half)
        .count()
        .where(F.col("count") > _slice_words(F.col("size")))
        .select(*of_half, F.ceil(F.col("count") * 2 / _slice_words(F.col("size"))).cast("int").alias("cuts"))
    )
    # At most COMMON_LENGTH numbers.
    totals = members.where(F.col("size") <= COMMON_LENGTH).groupBy("size").count().collect()
    buckets = F.create_map(
        F.lit(0), F.lit(1), *[F.lit(v) for r in totals for v in (r["size"], -(-r["count"] // (2 * BUCKET_WORDS)))]
    )
    own = F.xxhash64(*of_half)
    shared = F.xxhash64("side", "size", F.pmod(own, F.try_element_at(buckets, F.col("size"))))
    alone = F.struct(
        F.when(F.col("size") <= COMMON_LENGTH, shared).otherwise(own).alias("unit"),
        F.lit(True).alias("indexed"),
        F.col("asked").alias("asked"),
    )
    cut = F.pmod(F.xxhash64("word", F.lit(1)), F.col("cuts"))
    others = F.sequence(F.lit(0), F.col("cuts") - 1)

    def tile(index: Column, query: Column, asked: bool) -> Column:
        return F.struct(
            F.xxhash64(*of_half, index.cast("long"), query.cast("long")).alias("unit"),
            F.lit(not asked).alias("indexed"),
            F.lit(asked).alias("asked"),
        )

    indexed = F.transform(others, lambda other: tile(cut, other, False))
    asked = F.transform(others, lambda other: tile(other, cut, True))
    tiles = F.when(F.col("cuts").isNull(), F.array(alone)).otherwise(
        F.when(F.col("asked"), F.concat(indexed, asked)).otherwise(indexed)
    )
    return members.join(large, of_half, "left").select("side", "size", "word", "n", F.inline(tiles))


# The index --------------------------------------------------------------------------------------


def _bits(rows: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of uint64, first value in the lowest bit."""
    packed = np.packbits(rows, axis=1, bitorder="little")
    padded = np.zeros((len(rows), -(-rows.shape[1] // 64) * 8), np.uint8)
    padded[:, : packed.shape[1]] = packed
    return padded.view(np.uint64)


class PositionIndex:
    """Sets of words by position and letter. letters: a row of Latin-1 codes per word, 0 after its end."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        self.keep = letters.shape[1] <= COMMON_LENGTH + 1
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(self, position: int, asked: np.ndarray) -> np.ndarray:
        """For each asked letter the set of words that have it at the position."""
        found = self.known.get(position)
        if found is None:
            present, place = np.unique(self.letters[:, position], return_inverse=True)
            sets = np.zeros((len(present) + 1, len(self.letters)), bool)
            sets[place, np.arange(len(place))] = True
            row = np.full(256, len(present))
            row[present] = np.arange(len(present))
            found = row, _bits(sets)
            if self.keep:
                self.known[position] = found
        return found[1][found[0][asked]]

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sets of words of the queries' length with one letter replaced, and with one letter more."""
        size = queries.shape[1]
        ends = self.letters[:, size] == 0
        shape = len(queries), -(-len(ends) // 64)
        exact = np.repeat(_bits(np.ones((1, len(ends)), bool)), len(queries), axis=0)
        replaced = np.zeros(shape, np.uint64)
        longer = np.zeros(shape, np.uint64)
        for position in range(size):
            letter = queries[:, position]
            same = self.at(position, letter)
            replaced = (replaced & same) | (exact & ~same)
            longer = (longer | exact) & self.at(position + 1, letter)
            exact &= same
        return replaced & _bits(ends[None]), (longer | exact) & _bits(~ends[None])


def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and word number of every bit that is set."""
    row, word = np.nonzero(sets)
    bits = np.unpackbits(sets[row, word].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, bit = np.nonzero(bits)
    return row[hit], word[hit] * 64 + bit


def near_pairs(index: np.ndarray, queries: np.ndarray, side: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Numbers of query and index words that are near and share a half of this side only by this side.

    Both are rows of Latin-1 codes, those of the index one column wider. The flag tells whether the
    index words are the longer ones.
    """
    size = queries.shape[1]
    half = size // 2
    sliced = PositionIndex(index)
    batch = max(1, BATCH_BYTES // (8 * -(-len(index) // 64)))
    for low in range(0, len(queries), batch):
        some = queries[low : low + batch]
        for sets, more in zip(sliced.near(some), (0, 1)):
            asked, found = _members(sets)
            first = (some[asked, :half] == index[found, :half]).all(axis=1)
            second = (some[asked, size - half :] == index[found, size - half + more : size + more]).all(axis=1)
            meets = first if side == 0 else second & ~first
            yield asked[meets] + low, found[meets], bool(more)


def _letters(words: list[bytes], width: int) -> np.ndarray:
    return np.array(words, f"S{width}").view(np.uint8).reshape(len(words), width)


def _fold_unit(table: pa.Table) -> pa.Table:
    """Near words of a unit, folded per word: how many, and the most frequent."""
    text = table.column("word").to_pylist()
    words = np.array([w.encode("latin-1") for w in text], object)
    count = table.column("n").to_numpy()
    side, size = table.column("side").to_numpy(), table.column("size").to_numpy()
    indexed = table.column("indexed").to_numpy(zero_copy_only=False)
    asked = table.column("asked").to_numpy(zero_copy_only=False)
    targets, others = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for one_side, one_size in sorted(set(zip(side.tolist(), size.tolist()))):
        here = (side == one_side) & (size == one_size)
        at, by = np.flatnonzero(here & indexed), np.flatnonzero(here & asked)
        if not len(at) or not len(by):
            continue
        index = _letters(words[at].tolist(), one_size + 1)
        queries = _letters(words[by].tolist(), one_size)
        for query, found, longer in near_pairs(index, queries, one_side):
            targets.append(by[query])
            others.append(at[found])
            if longer:
                # The longer word asks nothing of this one, so the pair counts for both.
                targets.append(at[found])
                others.append(by[query])
    target, other = np.concatenate(targets), np.concatenate(others)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(words, kind="stable")] = np.arange(len(words))
    order = np.lexsort((rank[other], -count[other], target))
    target, other = target[order], other[order]
    word, first, near = np.unique(target, return_index=True, return_counts=True)
    best = other[first]
    return pa.table(
        {
            "word": pa.array([text[i] for i in word.tolist()], pa.string()),
            "near": pa.array(near, pa.int64()),
            "best_n": pa.array(count[best], pa.int64()),
            "best": pa.array([text[i] for i in best.tolist()], pa.string()),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """Parts of the near words of each word: word, near, best_n, best. words: word and n, each once."""
    units = work_units(words).groupBy("unit")
    return units.applyInArrow(_fold_unit, "word string, near long, best_n long, best string")


# Forms ------------------------------------------------------------------------------------------


def with_forms(words: DataFrame) -> DataFrame:
    """Add n_near, form and form_n to each word of a vocabulary."""
    none = [F.lit(None).cast(kind).alias(name) for name, kind in (("best_n", "long"), ("best", "string"))]
    own = words.select("word", "n", F.lit(0).cast("long").alias("near"), *none)
    parts = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "near", "best_n", "best")
    best = F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("best")))
    folded = (
        own.unionByName(parts)
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), F.min(best).alias("top"))
    )
    dominant = -F.col("top.less") >= DOMINANCE * F.col("n")
    return folded.select(
        "word",
        "n",
        "n_near",
        F.when(dominant, F.col("top.best")).alias("form"),
        F.when(dominant, -F.col("top.less")).alias("form_n"),
    )


def follow(links: DataFrame, steps: int) -> DataFrame:
    """word and root: the end of each chain of links word, form of at most so many steps."""
    jumps = links.select("word", F.col("form").alias("root"))
    for _ in range(max(1, steps).bit_length()):
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        # Each round doubles the length of a jump, and would double the plan.
        jumps = settle(
            jumps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        )
    return jumps


def variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of the whole vocabulary of the texts."""
    words = settle(counted_words(docs))
    found = settle(with_forms(words))
    most = found.agg(F.max("n")).first()[0] or LEAST_COUNT
    # Each step of a chain at least doubles the count.
    steps = int(math.log2(most)) + 1
    roots = follow(found.where(F.col("form").isNotNull()), steps)
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
