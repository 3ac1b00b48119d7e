"""Near copies by SimHash fingerprints and deletion-variant signatures.

A fingerprint has 64 bits. Two of them that differ in at most three bits are cut into two segments
of 32 bits; by the pigeonhole principle one segment differs in at most one bit. So each fingerprint
is indexed under each segment as it is and under the segment's 32 variants with one bit taken out.
Equal keys bring together all pairs that can link, and each pair is then verified on all 64 bits.

Only a spanning forest of the links of a key leaves its task, never all its pairs: a group of n
copies gives n - 1 rows. A key with very many fingerprints is split into blocks, every two of which
meet in a task of their own. Components come from alternating star operations on the links.

Defined results: a null text is an empty text; texts without words have fingerprint zero and link
like any other; documents with a null doc_id take part but never name a component (a component of
null ids only has a null name); repeated rows stay repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm.scratch import settle

SHINGLE = 3
SEED = 42
MAX_DISTANCE = 3
SEGMENT_BITS = 32
BLOCK_ROWS = 8192  # fingerprints of one key that a task compares at once
SMALL_RUN = 48  # up to here all pairs of a run are compared by shifting the column


def text_fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text in UTF-8."""
    # split() without argument cuts at exactly the bytes 09-0D and 20.
    found = text.lower().split()
    if not found:
        return 0
    plain = b" ".join(found)
    if len(found) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(plain, SEED)], ">u8")
    else:
        start = np.zeros(len(found) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1, out=start[1:])
        parts = [plain[a:b] for a, b in zip(start[:-shingle].tolist(), (start[shingle:] - 1).tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), ">u8", len(parts))
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
    # Blocks of 255 rows are summed in bytes, which cannot overflow.
    counts = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0, dtype=np.uint8)
    majority = counts.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int.from_bytes(np.packbits(majority).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", into: str = "fp") -> DataFrame:
    """Add the fingerprint as a signed long."""

    @F.arrow_udf("long")
    def fingerprint(texts: pa.Array) -> pa.Array:
        values = [text_fingerprint(t.as_buffer().to_pybytes()) if t.is_valid else 0 for t in texts]
        return pa.array(np.array(values, np.uint64).view(np.int64))

    return docs.withColumn(into, fingerprint(F.col(text)))


def _keys(fps: np.ndarray) -> np.ndarray:
    """The index keys of each fingerprint, one row each: segment, variant and masked value."""
    columns = []
    for segment in range(64 // SEGMENT_BITS):
        value = (fps >> np.uint64(segment * SEGMENT_BITS)) & np.uint64((1 << SEGMENT_BITS) - 1)
        tag = segment * (SEGMENT_BITS + 1)
        columns.append(value | np.uint64(tag << SEGMENT_BITS))
        for bit in range(SEGMENT_BITS):
            masked = value & ~np.uint64(1 << bit)
            columns.append(masked | np.uint64((tag + 1 + bit) << SEGMENT_BITS))
    return np.stack(columns, axis=1)


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for low in range(0, len(fps), 4096):
            part = fps[low : low + 4096]
            keys = _keys(part.view(np.uint64))
            yield pa.record_batch(
                [
                    pa.array(keys.reshape(-1).view(np.int64)),
                    pa.array(np.repeat(part, keys.shape[1])),
                ],
                names=["key", "fp"],
            )


def _close(a: np.ndarray, b: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Whether fingerprints link, and differ at the bit taken out, if the key has one."""
    differing = a ^ b
    return (np.bitwise_count(differing) <= MAX_DISTANCE) & ((mask == 0) | (differing & mask != 0))


def _mask_of(key: np.ndarray) -> np.ndarray:
    """The bit that a key takes out, 0 for a key that keeps its segment."""
    tag = key.astype(np.uint64) >> np.uint64(SEGMENT_BITS)
    segment, variant = np.divmod(tag, np.uint64(SEGMENT_BITS + 1))
    shift = segment * np.uint64(SEGMENT_BITS) + np.maximum(variant, np.uint64(1)) - np.uint64(1)
    return np.where(variant == 0, np.uint64(0), np.uint64(1) << shift)


def _forest(fps: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within one key, found breadth first."""
    left, right = [], []
    rest = fps
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            node = front.pop()
            near = _close(rest, node, np.full(1, mask))
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                left.append(np.full(len(found), node))
                right.append(found)
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (key, block) of rows sorted by them."""

    def link(key: np.ndarray, block: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        same = (key[1:] == key[:-1]) & (block[1:] == block[:-1])
        start = np.flatnonzero(np.concatenate([[True], ~same]))
        length = np.diff(np.append(start, len(key)))
        left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        run = np.repeat(np.arange(len(start)), length)
        small = np.flatnonzero((length[run] > 1) & (length[run] <= SMALL_RUN))
        run, few, mask = run[small], fps[small], _mask_of(key[small])
        for shift in range(1, int(length[length <= SMALL_RUN].max(initial=1))):
            hit = (run[shift:] == run[:-shift]) & _close(few[shift:], few[:-shift], mask[shift:])
            left.append(few[:-shift][hit])
            right.append(few[shift:][hit])
        for k in np.flatnonzero(length > SMALL_RUN):
            own = np.unique(fps[start[k] : start[k] + length[k]])
            a, b = _forest(own, _mask_of(key[start[k] : start[k] + 1])[0])
            left.append(a)
            right.append(b)
        a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.record_batch([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        now[2] = now[2].view(np.uint64)
        if held is not None:
            now = [np.concatenate(pair) for pair in zip(held, now, strict=True)]
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


def _key_column(segment: int, variant: int, value: Column) -> Column:
    tag = segment * (SEGMENT_BITS + 1) + variant
    return value.bitwiseOR(F.lit(tag << SEGMENT_BITS))


def links(fps: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (u, v), u < v, that connect the distinct fingerprints of column fp as all links do."""
    rows = fps.mapInArrow(_variants, "key long, fp long")
    segment_of = [
        F.shiftrightunsigned("fp", s * SEGMENT_BITS).bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
        for s in range(64 // SEGMENT_BITS)
    ]
    # A variant key holds the fingerprints of two segment values; it is large only if one is.
    segments = F.array(
        *[
            F.struct(F.lit(s).alias("s"), value.alias("value"))
            for s, value in enumerate(segment_of)
        ]
    )
    hot = settle(
        fps.select(F.inline(segments))
        .groupBy("s", "value")
        .count()
        .filter(F.col("count") * 2 > block_rows)
    )
    if hot.isEmpty():
        rows = rows.withColumn("block", F.lit(0).cast("long"))
    else:
        rows = _in_blocks(rows, hot, block_rows)
    return (
        rows.select("key", "block", "fp")
        .repartition("key", "block")
        .sortWithinPartitions("key", "block")
        .mapInArrow(_links, "u long, v long")
        .distinct()
    )


def _in_blocks(rows: DataFrame, hot: DataFrame, block_rows: int) -> DataFrame:
    """Deal the rows of large keys to pairs of blocks of at most about block_rows rows."""
    variants = F.array(
        *[
            F.struct(
                _key_column(s, v, F.col("value") if v == 0 else _without(v - 1)).alias("key"),
            )
            for s in range(64 // SEGMENT_BITS)
            for v in range(SEGMENT_BITS + 1)
        ]
    )
    each = SEGMENT_BITS + 1
    own = F.slice(variants, F.col("s") * each + 1, each)
    # Both values of a variant count in full, or one does and the other is at most half a block.
    sizes = (
        hot.select("count", F.inline(own))
        .groupBy("key")
        .agg(F.ceil((F.sum("count") + block_rows / 2) * 2 / block_rows).cast("long").alias("n"))
    )
    block = F.pmod(F.xxhash64("fp"), F.col("n"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))
    return (
        rows.join(sizes, "key", "left")
        .withColumn("n", F.coalesce("n", F.lit(1).cast("long")))
        .withColumn("own", block)
        .withColumn("other", other)
        .select(
            "key",
            "fp",
            (F.least("own", "other") * F.col("n") + F.greatest("own", "other")).alias("block"),
        )
    )


def _without(bit: int) -> Column:
    return F.col("value").bitwiseAND(F.lit(((1 << SEGMENT_BITS) - 1) & ~(1 << bit)))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v); root is the smallest node of its component.

    Large stars link every larger neighbour of a node to the smallest one, small stars every
    smaller one; they alternate until the edges stay as they are. Hubs are folded by min() before
    their shuffle and joined, never gathered.
    """
    # Of a link the larger end is kept in u.
    now = settle(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    for _ in range(rounds):
        before = _state(now)
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = (
            both.join(low, "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .filter("u != v")
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        now = settle(
            small.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(small.select("u", F.col("low").alias("v")))
            .filter("u != v")
            .distinct()
        )
        if _state(now) == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(now.select(F.col("u").alias("node"), F.col("v").alias("root")))


def _state(edges: DataFrame):
    # xor of hashes: order does not matter and nothing overflows.
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def near_copies(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, fp, class_fp (smallest fingerprint of the class) and component_id of each row."""
    rows = settle(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"))
    return classes(rows, block_rows)


def classes(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add class_fp and component_id to rows with doc_id and fp."""
    first = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    known = components(links(first.select("fp"), block_rows))
    named = first.join(known, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("class_fp")
    )
    smallest = named.groupBy("class_fp").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "class_fp").select("fp", "class_fp", "component_id")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row of each class of near copies, all columns: that of smallest doc_id, null ids last.

    Rows that agree in id and text settle their tie by the hash of all columns.
    """
    columns = docs.columns
    marked = with_fingerprint(docs, into="__fp").withColumn("__hash", F.xxhash64(*columns))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__hash").alias("hash"))
    brief = settle(
        marked.select("doc_id", F.col("__fp").alias("fp"), "__hash").withColumn("rank", rank)
    )
    named = classes(brief.select("doc_id", "fp", "rank"), block_rows)
    least = named.groupBy("class_fp").agg(F.min("rank").alias("rank"))
    # How many rows of a class are alike in id and all columns; only those need a further step.
    alike = named.select("rank").join(least, "rank").groupBy("rank").count()
    keys = settle(
        alike.select(
            F.col("rank.doc_id").alias("__id"),
            F.col("rank.hash").alias("__kept"),
            (F.col("count") > 1).alias("__alike"),
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__kept"))
    found = docs.withColumn("__hash", F.xxhash64(*columns))
    kept = found.join(keys.filter("not __alike"), same).select(*columns)
    repeated = keys.filter("__alike")
    if not repeated.isEmpty():
        kept = kept.unionByName(found.join(repeated, same).select(*columns).dropDuplicates())
    return kept
