"""Near copies of five-word similarity 0.8: SimHash with deletion variants of several segments.

Two fingerprints describe a text. One of its distinct words finds candidates: a replaced word is one
word there but five shingles, so texts of similarity 0.8 differ in few of its bits. It is cut into
SEGMENTS segments of SEGMENT_BITS bits, and each is indexed as it is and under its variants with one
bit taken out, so that texts meet which differ in at most one bit of some segment. The other one, of
256 bits, is of the distinct five-word shingles and verifies: for sets of similarity s two bits differ
with probability acos(2s / (1 + s)) / pi, 0.15 at 0.8. Pairs link up to MAX_SHARE of differing bits;
the margin above 0.15 keeps nine in ten pairs of exactly 0.8 and also lets in pairs of 0.7 to 0.8.

Only a spanning forest of the links of a key leaves its task. A key with very many texts is split into
blocks, every two of which meet in a task of their own. Equal texts are one node.

Defined results: null and empty texts and texts of white space only are near copies of each other; a
text of fewer than five words has one shingle, all of it; null ids come last in a class and never beat
another; repeated rows are near copies, and of rows alike in all columns one stays; other columns pass
through under any names that do not begin with two underscores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import words as W
from tradewatch.llm.scratch import settle, stored
from tradewatch.llm.simhash import components

SHINGLE = 5
SEGMENTS = 4
SEGMENT_BITS = 24
LANES = 4  # of 64 bits in the fingerprint of shingles
MAX_SHARE = 0.185  # of its bits that may differ
BLOCK_ROWS = 8192  # texts of one key that a task compares at once
SMALL_RUN = 48  # up to here all pairs of a run are compared by shifting the columns

_PRINTS = [f"s{i}" for i in range(LANES)]
_VALUES = [f"v{i}" for i in range(SEGMENTS)]
_LANE = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % (1 << 64)) for i in range(max(LANES, 2))]


def _majority(value: np.ndarray, row: np.ndarray, rows: int, lanes: int) -> np.ndarray:
    """Fingerprints of `lanes` uint64 per row, of the distinct values of each row."""
    out = np.zeros((rows, lanes), np.uint64)
    if not len(value):
        return out
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.concatenate([[True], (value[1:] != value[:-1]) | (row[1:] != row[:-1])])
    value, row = value[fresh], row[fresh]
    start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    size = np.diff(np.append(start, len(row)))
    for lane in range(lanes):
        hashed = W.mix(value ^ _LANE[lane])
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count = np.add.reduceat(bits, start, axis=0, dtype=np.int32)
        out[row[start], lane] = np.packbits(count * 2 > size[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(chunk: W.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Per text of a chunk: the segments of its word fingerprint, and the lanes of its shingle one."""
    found = W.hash_words(chunk, W.SPACED)
    count = np.bincount(found.row, minlength=chunk.rows)
    values, rows = [], []
    for n in range(1, SHINGLE + 1):
        first, gram = W.grams(found, n)
        row = found.row[first] if len(first) else first
        # Texts of fewer words have one shingle of all of them.
        meant = count[row] >= n if n == SHINGLE else count[row] == n
        values.append(gram[meant])
        rows.append(row[meant])
    shingles = _majority(np.concatenate(values), np.concatenate(rows), chunk.rows, LANES)
    low, high = _majority(found.hash, found.row, chunk.rows, 2).T
    # 24 bits at 0 and 24 of the first number, and the same of the second.
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    segments = [(part >> np.uint64(at)) & mask for part in (low, high) for at in (0, SEGMENT_BITS)]
    return np.stack(segments, axis=1), shingles


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for chunk in W.chunks(batch.column("text")):
            segments, shingles = fingerprints(chunk)
            kept = batch.slice(chunk.first, chunk.rows)
            columns = [*segments.view(np.int64).T, *shingles.view(np.int64).T]
            yield pa.record_batch(
                [*[kept.column(c) for c in ("rank", "key")], *[pa.array(np.ascontiguousarray(c)) for c in columns]],
                names=["rank", "key", *_VALUES, *_PRINTS],
            )


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per text, segment and variant."""
    bits = np.concatenate([np.zeros(1, np.int64), 1 << np.arange(SEGMENT_BITS)])
    tag = np.arange(SEGMENTS * (SEGMENT_BITS + 1)) << SEGMENT_BITS
    for batch in batches:
        for low in range(0, batch.num_rows, 2048):
            part = batch.slice(low, 2048)
            value = np.stack([part.column(v).to_numpy() for v in _VALUES], axis=1)
            masked = (value[:, :, None] & ~bits).reshape(part.num_rows, -1) | tag
            place = pa.array(np.repeat(np.arange(part.num_rows), masked.shape[1]))
            yield pa.record_batch(
                [pa.array(masked.reshape(-1)), *[part.column(c).take(place) for c in ("node", *_PRINTS)]],
                names=["key", "node", *_PRINTS],
            )


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) <= MAX_SHARE * 64 * LANES


def _forest(nodes: np.ndarray, prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A spanning forest of the links of one run, found breadth first."""
    left, right = [], []
    rest = np.arange(len(nodes))
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = _close(prints[rest], prints[node])
            found, rest = rest[near], rest[~near]
            front.extend(found)
            left.append(np.full(len(found), nodes[node]))
            right.append(nodes[found])
    return left, right


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (key, block) of rows sorted by them."""

    def link(key, block, node, prints) -> pa.RecordBatch:
        same = (key[1:] == key[:-1]) & (block[1:] == block[:-1])
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        length = np.diff(np.append(start, len(key)))
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        run = np.repeat(np.arange(len(start)), length)
        small = np.flatnonzero((length[run] > 1) & (length[run] <= SMALL_RUN))
        run, few, marks = run[small], node[small], prints[small]
        for shift in range(1, int(length[length <= SMALL_RUN].max(initial=1))):
            together = np.flatnonzero(run[shift:] == run[:-shift])
            hit = together[_close(marks[together + shift], marks[together])]
            left.append(few[hit])
            right.append(few[hit + shift])
        for k in np.flatnonzero(length > SMALL_RUN):
            some = slice(start[k], start[k] + length[k])
            a, b = _forest(node[some], prints[some])
            left += a
            right += b
        a, b = np.concatenate(left), np.concatenate(right)
        pairs = np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1)
        both = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
        return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    held = None
    for batch in batches:
        now = [batch.column(c).to_numpy() for c in ("key", "block", "node")]
        now.append(np.stack([batch.column(c).to_numpy() for c in _PRINTS], axis=1).view(np.uint64))
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now)]
        if not len(now[0]):
            continue
        # The last run may go on in the next batch.
        ends = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
        cut = int(ends[-1]) + 1 if len(ends) else 0
        held = [x[cut:] for x in now]
        if cut:
            yield link(*[x[:cut] for x in now])
    if held is not None and len(held[0]):
        yield link(*held)


def links(texts: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v), u < v, that connect the nodes of near texts as all links do."""
    prints = ", ".join(f"{c} long" for c in _PRINTS)
    spread = texts.select("node", *_VALUES, *_PRINTS).repartition("node")
    rows = spread.mapInArrow(_variants, f"key long, node long, {prints}")
    each = SEGMENT_BITS + 1
    tagged = [F.struct(F.lit(s).alias("s"), F.col(v).alias("value")) for s, v in enumerate(_VALUES)]
    hot = (
        texts.select(F.inline(F.array(*tagged)))
        .groupBy("s", "value")
        .count()
        .where(F.col("count") * 2 > block_rows)
    )
    variant = F.sequence(F.lit(0), F.lit(SEGMENT_BITS))
    taken = F.when(F.col("k") == 0, F.lit(0)).otherwise(F.call_function("shiftleft", F.lit(1), F.col("k") - 1))
    key = F.col("value").bitwiseAND(F.bitwise_not(taken.cast("long"))).bitwiseOR(
        F.call_function("shiftleft", (F.col("s") * each + F.col("k")).cast("long"), F.lit(SEGMENT_BITS))
    )
    # A variant key holds the texts of two values; both count in full, or one is at most half a block.
    # Read from files, the sizes of the few large keys are known to be small, and the variants, a hundred
    # of every text, need no shuffle to meet them.
    sizes = stored(
        hot.select("*", F.explode(variant).alias("k"))
        .groupBy(key.alias("key"))
        .agg(F.ceil((F.sum("count") + block_rows / 2) * 2 / block_rows).cast("long").alias("n")),
        "sizes",
    )
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    dealt = (
        rows.join(sizes, "key", "left")
        .withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("n")))
        .withColumn("other", other)
        .withColumn("block", F.least("own", "other") * F.col("n") + F.greatest("own", "other"))
    )
    return (
        dealt.select("key", "block", "node", *_PRINTS)
        .repartition("key", "block")
        .sortWithinPartitions("key", "block")
        .mapInArrow(_links, "u long, v long")
        .distinct()
    )


def classes(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """rank and class of every row: rank is (no id, id, hash of all columns), class a number."""
    rank = F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64(*docs.columns).alias("hash")
    )
    key = F.struct(F.xxhash64("text").alias("a"), F.xxhash64("text", F.lit("near copies")).alias("b"))
    brief = docs.select(rank.alias("rank"), key.alias("key"), "text")
    kinds = {c: brief.schema[c].dataType.simpleString() for c in ("rank", "key")}
    numbers = ", ".join(f"{c} long" for c in (*_VALUES, *_PRINTS))
    rows = settle(
        brief.mapInArrow(_described, f"rank {kinds['rank']}, key {kinds['key']}, {numbers}")
    )
    one = [F.min(c).alias(c) for c in (*_VALUES, *_PRINTS)]  # equal in all rows of a text
    texts = settle(
        rows.groupBy("key").agg(*one).withColumn("node", F.monotonically_increasing_id())
    )
    known = components(links(texts, block_rows))
    named = texts.join(known, "node", "left").select("key", F.coalesce("root", "node").alias("class"))
    return rows.select("rank", "key").join(named, "key").select("rank", "class")


def keep_one(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row of each class of near copies, all columns: that of smallest doc_id, null ids last."""
    columns = docs.columns
    least = settle(classes(docs, block_rows).groupBy("class").agg(F.min("rank").alias("__rank")))
    rank = least.select(F.col("__rank.doc_id").alias("__id"), F.col("__rank.hash").alias("__kept"))
    marked = docs.withColumn("__hash", F.xxhash64(*columns))
    # The ids are compared behind the join on the hash alone, so that the texts, once dealt by their
    # hash, lie right for the last step too.
    known = F.col("doc_id").isNotNull() & F.col("__id").isNotNull()
    same = F.when(known, F.col("doc_id") == F.col("__id")).otherwise(
        F.col("doc_id").isNull() & F.col("__id").isNull()
    )
    found = marked.join(rank, (F.col("__hash") == F.col("__kept")) & same, "left_semi")
    # Of rows alike in all columns one stays; they share the hash, so they lie in one task already.
    return found.dropDuplicates(["__hash", *columns]).select(*columns)
