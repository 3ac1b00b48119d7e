"""Passages of benchmark items in training texts: rare n-gram seeds, then Smith-Waterman alignment.

The seeds of an item are its rarest runs of GRAM words. A copy that keeps the score by replacing words
shares at least a known number t of the item's n-grams (`must_share`); of the n-grams that any document
holds, all but the t - 1 commonest are seeds, so such a copy always meets one, whatever the corpus
holds besides, and common turns of phrase pair no documents with items. Seeds and documents meet in an
equality join; filters of fixed size drop most other n-grams inside the scan first, and what they let
through by chance fails the join. Around the seeds of a document lies a passage, long enough for the
items of the seed's length class, and the words of passage and item are aligned: a match counts 1, a
mismatch or a gap -1. The score is the best local alignment over the length of the item, so edited and
paraphrased copies count by what is left. A passage that holds too few of an item's words for the
score is not aligned. A copy with so many words put in that it keeps fewer than t n-grams is found if
one of those it keeps is a seed.

A word is a run of ASCII letters, digits and non-ASCII characters, without case for A-Z.

Defined results: null texts have no words; an item of fewer than GRAM words is no evidence and
matches nothing; equal items are all reported; null ids are reported as null; documents that are
repeated are reported once for each row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm import words as W
from tradewatch.llm.bits import bit_set, may_hold
from tradewatch.llm.scratch import settle

GRAM = 3
MIN_SCORE = 0.5  # of an item's words, net of edits
MIN_WORDS = 6  # that an alignment must be worth, or the whole item if it is shorter
FILTER_BITS = 1 << 24  # 2 MB a length class, whatever the number of items


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offset = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offset[1:])
    return pa.ListArray.from_arrays(pa.array(offset), pa.array(values).cast(kind))


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            found = W.hash_words(chunk, W.PLAIN)
            first, gram = W.grams(found, GRAM)
            n = np.bincount(found.row, minlength=chunk.rows)
            of = found.row[first] if len(first) else first
            yield pa.record_batch(
                [
                    batch.column("item").slice(chunk.first, chunk.rows),
                    batch.column("item_id").slice(chunk.first, chunk.rows),
                    _lists(found.hash.view(np.int64), n, pa.int64()),
                    _lists(gram.view(np.int64), np.bincount(of, minlength=chunk.rows), pa.int64()),
                ],
                names=["item", "item_id", "words", "grams"],
            )


def items_of(benchmark: DataFrame) -> DataFrame:
    """item (a row id), item_id, and the words and n-grams of each item as hashes."""
    rows = benchmark.select("item_id", "text").withColumn("item", F.monotonically_increasing_id())
    kind = benchmark.schema["item_id"].dataType.simpleString()
    return settle(
        rows.select("item", "item_id", "text").mapInArrow(
            _item_words, f"item long, item_id {kind}, words array<long>, grams array<long>"
        )
    )


def must_share(size: Column) -> Column:
    """N-grams that a copy with replaced words has in common with an item of so many words, at least.

    e replaced words leave size - e in at most e + 1 runs, hence size - 3e - 2 n-grams, and a score of
    half the words allows a quarter of them to be replaced.
    """
    allowed = F.floor(size * (1 - MIN_SCORE) / 2)
    return F.greatest(size - GRAM * allowed - (GRAM - 1), F.lit(1)).cast("int")


def grams_held(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """gram and df: how many documents hold each of the n-grams that any of them holds.

    Tasks count what passes a filter of fixed size; an exact join removes its errors.
    """
    sent = docs.sparkSession.sparkContext.broadcast(bit_set(grams, F.col("gram"), FILTER_BITS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                found = W.hash_words(chunk, W.PLAIN)
                first, gram = W.grams(found, GRAM)
                hit = np.flatnonzero(may_hold(sent.value, gram))
                pair = np.unique(np.rec.fromarrays([gram[hit], found.row[first[hit]]]))
                value, n = np.unique(pair["f0"], return_counts=True)
                yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(n)], names=["gram", "df"])

    counts = docs.select("text").mapInArrow(count, "gram long, df long")
    return counts.groupBy("gram").agg(F.sum("df").alias("df")).join(grams, "gram", "left_semi")


def seeds_of(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item, class, gram): the rarest n-grams of every item, of those that some document holds.

    class: the power of two of words that holds the item.
    """
    size, distinct = F.size("words"), F.size(F.array_distinct("grams"))
    # A repeated n-gram counts once, so what is needed falls by the repeats.
    need = F.greatest(must_share(size) - (F.size("grams") - distinct), F.lit(1)).alias("need")
    length_class = F.ceil(F.log2(size)).cast("int").alias("class")
    each = settle(
        items.select("item", length_class, need, F.explode(F.array_distinct("grams")).alias("gram"))
    )
    held = grams_held(docs, each.select("gram").distinct())
    by_use = Window.partitionBy("item").orderBy(F.desc("df"), "gram")
    return settle(
        each.join(held, "gram")
        .withColumn("rank", F.row_number().over(by_use))
        .where(F.col("rank") >= F.col("need"))
        .select("item", "class", "gram")
    )


def passages(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Stretches of documents around seeds, by class of item length.

    Columns: passage (a row id), row, doc_id, text_key, class, start, words, grams.
    """
    # Classes are powers of two, so there are a few dozen at most.
    classes = sorted(r["class"] for r in seeds.select("class").distinct().collect())
    filters = [
        (c, bit_set(seeds.where(F.col("class") == c), F.col("gram"), FILTER_BITS)) for c in classes
    ]
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in W.chunks(batch.column("text")):
                found = W.hash_words(chunk, W.PLAIN)
                first, gram = W.grams(found, GRAM)
                for length_class, bits in sent.value:
                    hit = np.flatnonzero(may_hold(bits, gram))
                    if len(hit):
                        yield around(batch, chunk, found, first, gram, hit, length_class)

    def around(batch, chunk, found, first, gram, hit, length_class) -> pa.RecordBatch:
        """The stretches around the n-grams numbered `hit`, where a copy of the class fits on either side."""
        reach = 1 << length_class
        at, row = first[hit], found.row[first[hit]]
        new = np.concatenate([[True], (row[1:] != row[:-1]) | (at[1:] - at[:-1] > 2 * reach)])
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(at)) - 1
        bounds = np.searchsorted(found.row, [row[begin], row[begin] + 1])
        low = np.maximum(at[begin] - reach, bounds[0])
        high = np.minimum(at[last] + GRAM + reach, bounds[1])
        size = high - low
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        place = pa.array(chunk.first + row[begin])
        return pa.record_batch(
            [
                batch.column("row").take(place),
                batch.column("doc_id").take(place),
                batch.column("text_key").take(place),
                pa.array(np.full(len(begin), length_class, np.int32)),
                pa.array(low - bounds[0]),
                _lists(found.hash[np.repeat(low, size) + inner].view(np.int64), size, pa.int64()),
                _lists(gram[hit].view(np.int64), last - begin + 1, pa.int64()),
            ],
            names=["row", "doc_id", "text_key", "class", "start", "words", "grams"],
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        _text_key().alias("text_key"),
        "text",
    )
    found = rows.mapInArrow(
        cut,
        f"row long, doc_id {kind}, text_key struct<a:long,b:long>, class int, start long, "
        "words array<long>, grams array<long>",
    )
    return settle(found.withColumn("passage", F.monotonically_increasing_id()))


def _text_key():
    return F.struct(
        F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit("decontamination")).alias("b")
    )


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment: score, first and last position + 1 in the passage.

    Row by row; a gap in the item is a running maximum along the row. Ties go to the earliest end,
    then to the latest start.
    """
    n = len(passage)
    slope = np.arange(n + 1)
    score, since = np.zeros(n + 1, np.int64), np.arange(n + 1)
    best = (0, 0, 0)
    for word in item:
        step = np.where(passage == word, 1, -1)
        # Score and start in one number, so that starts follow the better path.
        take = (score[:-1] + step) * (n + 2) + since[:-1]
        drop = (score[1:] - 1) * (n + 2) + since[1:]
        here = np.maximum(take, drop)
        fresh = slope[1:]
        here = np.where(here // (n + 2) > 0, here, fresh)
        # Extending to the right costs one per word: lift, take the running maximum, lower again.
        lifted = np.maximum.accumulate(here + fresh * (n + 2)) - fresh * (n + 2)
        here = np.where(lifted // (n + 2) > 0, lifted, fresh)
        value = here // (n + 2)
        score[1:], since[1:] = value, here - value * (n + 2)
        top = int(value.argmax())
        if value[top] > best[0]:
            best = (int(value[top]), int(since[top + 1]), top + 1)
    return best


def align_if(item: np.ndarray, passage: np.ndarray, floor: float) -> tuple[int, int, int]:
    """As align, but zeros if the passage holds fewer of the item's words than the score must reach."""
    return align(item, passage) if np.isin(item, passage).sum() >= floor else (0, 0, 0)


def _aligned(items: pa.Array, texts: pa.Array, floors: pa.Array) -> pa.Array:
    found = [
        align_if(a.values.to_numpy(), b.values.to_numpy(), c.as_py())
        for a, b, c in zip(items, texts, floors, strict=True)
    ]
    return pa.array(
        [dict(zip(("score", "low", "high"), f, strict=True)) for f in found],
        pa.struct([("score", pa.int32()), ("low", pa.int32()), ("high", pa.int32())]),
    )


def matches(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """row, doc_id, text_key, item_id, score (0 to 1), start and end (word positions) of each copy.

    One row per document row and item, at its best passage (the first of equals).
    """
    items = items_of(benchmark)
    seeds = seeds_of(docs, items)
    found = passages(docs, seeds)
    pairs = (
        found.select("passage", "class", F.explode(F.array_distinct("grams")).alias("gram"))
        .join(seeds, ["gram", "class"])
        .select("passage", "item")
        .distinct()
    )
    aligned = F.arrow_udf(_aligned, "struct<score:int,low:int,high:int>")
    size = F.size("item_words")
    floor = F.greatest(min_score * size, F.least(size, F.lit(MIN_WORDS))).cast("double")
    best = F.max_by(F.struct("score", "start", "end"), F.struct("score", -F.col("start")))
    return (
        pairs.join(found.drop("grams", "class"), "passage")
        .join(items.select("item", "item_id", F.col("words").alias("item_words")), "item")
        .withColumn("at", aligned("item_words", "words", floor))
        .filter(F.col("at.score") >= floor)
        .select(
            "row",
            "doc_id",
            "text_key",
            "item",
            "item_id",
            (F.col("at.score") / size).alias("score"),
            (F.col("start") + F.col("at.low")).alias("start"),
            (F.col("start") + F.col("at.high")).alias("end"),
        )
        .groupBy("row", "item")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("text_key").alias("text_key"),
            F.first("item_id").alias("item_id"),
            best.alias("best"),
        )
        .select("row", "doc_id", "text_key", "item_id", "best.*")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs whose text holds no copy of an item, with their columns."""
    dirty = settle(matches(docs, benchmark, min_score).select("text_key").distinct())
    keyed = docs.withColumn("__key", _text_key())
    return keyed.join(dirty, keyed["__key"] == dirty["text_key"], "left_anti").drop("__key")
