"""Repeated byte strings across and within documents by suffix arrays.

Every string of LENGTH bytes is a window. A window is named by the smallest hash among the GRAM-byte
strings in it, so equal windows have equal names; neighbouring windows that owe their name to the
same place form a segment.
Segments meet by name in a shuffle. Names seen once need no more work; of equal segments all but the
first are repeats as a whole, most of them recognised before the shuffle. Only where one name has
different segments the bytes decide: their windows are put into a suffix array.

The suffix array is built in two stages: suffixes smaller than their successors are sorted directly,
the others are induced from them by a scan over the buckets of first bytes. Neighbours in it with a
common prefix of LENGTH bytes are equal windows, and all but the earliest are repeats. The order is
only needed up to LENGTH bytes, so sorting stops there.

A name with very many segments is cut into its windows, which are dealt to parts by content; each task
first folds the equal ones it has, so neither a name nor a window that many texts share fills a part.
Segments count as equal if a 64-bit hash of their bytes and their length agree and they have the same
name, a 64-bit hash of a string in them; the bytes of those are not compared again. Texts are shuffled only for documents with segments to compare or bytes
to remove; a bit set of bounded size drops the others in the scan.

Defined results: a null text is an empty text; documents are ordered by doc_id, null last, then by
text; rows alike in both are one document and get the same result; documents of fewer than LENGTH
bytes lose nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import words as W
from tradewatch.llm.bits import MANY, bit_set, may_hold
from tradewatch.llm.scratch import settle

LENGTH = 100
GRAM = 48
SPAN = LENGTH - GRAM + 1  # strings of GRAM bytes in a window
HELD_ROWS = 1 << 20  # segments that a task compares before it sends them on
ARRAY_BYTES = 1 << 22  # of text in one suffix array
SPLIT_ROWS = 1 << 12  # segments, or windows, of one name that one task takes
HELD_WINDOWS = 1 << 16  # windows of names in parts that a task folds at once


# Windows and segments ---------------------------------------------------------------------------


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Minimum of every `span` neighbouring values."""
    now, width = values, 1
    while width * 2 <= span:
        now = np.minimum(now[:-width], now[width:])
        width *= 2
    rest = span - width
    return np.minimum(now[:-rest], now[rest:]) if rest else now


def segments(chunk: W.Chunk) -> tuple[np.ndarray, ...]:
    """name, content hash, row, start and number of windows of each segment of a chunk."""
    n = len(chunk.data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    # A NUL byte must count, so bytes are taken as 1 to 256.
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((chunk.data.astype(np.uint64) + np.uint64(1)) * W.powers(n), out=total[1:])
    back = W.powers(n, W._UNBASE)
    grams = W.mix((total[GRAM:] - total[:-GRAM]) * back[: n - GRAM + 1])
    name = _smallest(grams, SPAN)
    # Windows lie within one text.
    inside = np.zeros(len(name) + 1, np.int32)
    long = chunk.offset[1:] - chunk.offset[:-1] >= LENGTH
    np.add.at(inside, chunk.offset[:-1][long], 1)
    np.add.at(inside, chunk.offset[1:][long] - LENGTH + 1, -1)
    valid = np.cumsum(inside)[:-1] > 0
    row_start = np.zeros(len(name) + 1, bool)
    row_start[chunk.offset[:-1][long]] = True
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (valid[1:] != valid[:-1]) | row_start[1:-1]
    # Past a place of the smallest string the next one counts, in periodic text an equal one.
    new[1:] |= grams[: len(name) - 1] == name[:-1]
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(name)))
    begin, count = begin[valid[begin]], count[valid[begin]]
    size = count + LENGTH - 1
    content = W.mix((total[begin + size] - total[begin]) * back[begin]) ^ count.astype(np.uint64)
    row = np.searchsorted(chunk.offset, begin, side="right") - 1
    return name[begin], W.mix(content), row, begin - chunk.offset[row], count


_SEGMENT = "name long, content long, doc long, start long, count int, again boolean"


def _segment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[list[np.ndarray]] = []

    def flush() -> pa.RecordBatch:
        name, content, doc, start, count = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        order = np.lexsort((start, doc, content, name))
        name, content, doc, start, count = (x[order] for x in (name, content, doc, start, count))
        again = np.zeros(len(name), bool)
        again[1:] = (name[1:] == name[:-1]) & (content[1:] == content[:-1])
        return pa.record_batch(
            [
                pa.array(name.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc),
                pa.array(start), pa.array(count.astype(np.int32)), pa.array(again),
            ],
            names=["name", "content", "doc", "start", "count", "again"],
        )

    rows = 0
    for batch in batches:
        ids = batch.column("doc").to_numpy(zero_copy_only=False)
        for chunk in W.chunks(batch.column("text")):
            name, content, row, start, count = segments(chunk)
            held.append([name, content, ids[chunk.first + row], start, count])
            rows += len(name)
            if rows >= HELD_ROWS:
                yield flush()
                rows = 0
    if held:
        yield flush()


_FOUND = "name long, doc long, start long, count int, repeat boolean"


def _found(name, doc, start, count, repeat) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
    columns = (name, doc, start, count, repeat)
    return pa.record_batch(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
        names=["name", "doc", "start", "count", "repeat"],
    )


def _classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows in order of name, lane, content, doc and start: repeats, and firsts to compare.

    A row is a repeat if the row before has its name and content. The others are firsts; a first is
    to be compared if a neighbouring first has its name. The last first waits for the next one.
    """
    before = None  # name and content of the last row
    waiting, sent = None, True  # the last first, and whether it has gone out
    for batch in batches:
        if not batch.num_rows:
            continue
        name, content, doc, start, count, again = (
            c.to_numpy(zero_copy_only=False) for c in batch.columns
        )
        repeat = again.astype(bool)
        repeat[1:] |= (name[1:] == name[:-1]) & (content[1:] == content[:-1])
        repeat[0] |= before == (name[0], content[0])
        before = (name[-1], content[-1])
        first = np.flatnonzero(~repeat)
        keep = repeat.copy()
        if len(first):
            names = name[first] if waiting is None else np.append(waiting[0], name[first])
            alike = np.zeros(len(names) + 1, bool)
            alike[1:-1] = names[1:] == names[:-1]
            shared = alike[:-1] | alike[1:]
            if waiting is not None:
                if shared[0] and not sent:
                    yield _found(*[[x] for x in waiting], [False])
                shared = shared[1:]
            keep[first[shared]] = True
            at = first[-1]
            waiting, sent = (name[at], doc[at], start[at], count[at]), bool(shared[-1])
        yield _found(name[keep], doc[keep], start[keep], count[keep], repeat[keep])


# Suffix arrays ----------------------------------------------------------------------------------


def _words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as a big-endian number; zeros after the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[k : k + len(text)]
    return out


def _sort_direct(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their suffixes, as far as the first `depth` bytes tell."""
    n = len(words)
    group = np.zeros(len(at), np.int64)
    order = np.arange(len(at))
    open_ = np.arange(len(at))  # places in the order that are still tied
    for offset in range(0, depth, 8):
        if not len(open_):
            break
        where = at[order[open_]] + offset
        key = np.where(where < n, words[np.minimum(where, n - 1)], 0)
        turn = np.lexsort((key, group[open_]))
        order[open_] = order[open_][turn]
        key, old = key[turn], group[open_][turn]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
        # A group is named by the place of its first member.
        group[open_] = open_[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        tied = np.zeros(len(key), bool)
        tied[:-1] |= ~new[1:]
        tied |= ~new
        open_ = open_[tied]
    return at[order]


def suffix_array(text: np.ndarray, wanted: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The wanted positions of a text in order of their suffixes' first `depth` bytes.

    Stage one sorts the suffixes that are smaller than their successors. Stage two goes through the
    buckets of first bytes in rising order; each suffix, once placed, places the one that starts a
    byte earlier, if that is the larger, at the front of its bucket. Suffixes that nothing wanted is
    induced from are left out.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # Type by the next differing byte; the last run counts as larger than its end.
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[-1] = -1
    index = np.where(step != 0, np.arange(n), n - 1)
    smaller = step[np.minimum.accumulate(index[::-1])[::-1]] > 0
    # A larger suffix needs its successors up to the next smaller one.
    next_smaller = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
    needed = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(wanted)
    np.add.at(needed, at, 1)
    np.add.at(needed, next_smaller[at] + 1, -1)
    needed = np.cumsum(needed)[:-1] > 0

    sizes = np.bincount(text[needed], minlength=256)
    head = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.full(int(sizes.sum()), -1, np.int64)
    direct = _sort_direct(np.flatnonzero(needed & smaller), _words_at(text), depth)
    # Within a bucket the smaller type comes last.
    ends = head + sizes
    counts = np.bincount(text[direct], minlength=256)
    front = ends - counts
    out[np.repeat(front, counts) + np.arange(len(direct)) - np.repeat(np.cumsum(counts) - counts, counts)] = direct
    fill = head.copy()

    def induce(placed: np.ndarray) -> None:
        before = placed[placed > 0] - 1
        before = before[needed[before] & ~smaller[before]]
        if len(before):
            byte = text[before]
            turn = np.argsort(byte, kind="stable")
            byte, before = byte[turn], before[turn]
            many = np.bincount(byte, minlength=256)
            out[fill[byte] + np.arange(len(byte)) - (np.cumsum(many) - many)[byte]] = before
            fill[:] += many

    if needed[-1] and not smaller[-1]:
        # The text's end, the smallest suffix of all, comes before the first bucket.
        out[fill[text[-1]]] = n - 1
        fill[text[-1]] += 1
    for byte in range(256):
        low = head[byte]
        while low < fill[byte]:
            high = fill[byte]
            induce(out[low:high])
            low = high
        induce(out[front[byte] : ends[byte]])
    return out[wanted[out]]


def common_prefix(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Whether each suffix and the one before it in the order share their first `length` bytes."""
    same = np.ones(max(len(order) - 1, 0), bool)
    words = _words_at(text)
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        left = np.flatnonzero(same)
        same[left] = words[order[left] + offset] == words[order[left + 1] + offset]
    return same


def repeated_windows(texts: list[bytes], doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """doc and start of the windows in the texts that an earlier window equals."""
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.cumsum(size + 1) - size - 1
    text = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    windows = np.maximum(size - LENGTH + 1, 0)
    wanted = np.zeros(len(text) + 1, np.int32)
    np.add.at(wanted, begin, 1)
    np.add.at(wanted, begin + windows, -1)
    order = suffix_array(text, np.cumsum(wanted)[:-1] > 0)
    run = np.zeros(len(order), np.int64)
    run[1:] = np.cumsum(~common_prefix(text, order))
    source = np.searchsorted(begin, order, side="right") - 1
    of, at = doc[source], start[source] + order - begin[source]
    turn = np.lexsort((at, of, run))
    run, of, at = run[turn], of[turn], at[turn]
    first = np.ones(len(run), bool)
    first[1:] = run[1:] != run[:-1]
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(run) else run
    later = (of != of[head]) | (at != at[head])
    return of[later], at[later]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows among segments; rows of one (name, part) come together."""
    held: list[pa.RecordBatch] = []
    size = 0

    def flush(table: pa.Table) -> pa.RecordBatch:
        doc, start = repeated_windows(
            table.column("bytes").to_pylist(),
            table.column("doc").to_numpy(),
            table.column("start").to_numpy(),
        )
        return pa.record_batch([pa.array(doc), pa.array(start)], names=["doc", "start"])

    for batch in batches:
        held.append(batch)
        size += batch.column("bytes").nbytes
        if size < ARRAY_BYTES:
            continue
        table = pa.Table.from_batches(held)
        name, part = table.column("name").to_numpy(), table.column("part").to_numpy()
        ends = np.flatnonzero((name != name[-1]) | (part != part[-1]))
        if len(ends):
            cut = int(ends[-1]) + 1
            yield flush(table.slice(0, cut))
            table = table.slice(cut)
        held, size = table.to_batches(), sum(b.column("bytes").nbytes for b in table.to_batches())
    if held:
        yield flush(pa.Table.from_batches(held))


# The operator -----------------------------------------------------------------------------------


def _numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """docs as doc (a long in the documents' order) and text; whether doc is doc_id itself."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    odd = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if dict(docs.dtypes)["doc_id"] in ("bigint", "int", "smallint", "tinyint") and odd.isEmpty():
        return rows.select(F.col("doc_id").cast("long").alias("doc"), "text"), True
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_key").asc()]
    keyed = rows.withColumn("text_key", F.sha2("text", 256))
    # Ranges are in order and so are the ids made within them.
    numbers = settle(
        keyed.select("doc_id", "text_key")
        .distinct()
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("doc", F.monotonically_increasing_id())
    )
    same = keyed["doc_id"].eqNullSafe(numbers["doc_id"]) & (keyed["text_key"] == numbers["text_key"])
    return keyed.join(numbers, same).select("doc", "text", keyed["doc_id"]), False


def _touched(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of docs (doc, text) that may have a partner in marks (doc)."""
    sent = docs.sparkSession.sparkContext.broadcast(bit_set(marks, F.xxhash64("doc"), MANY))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = may_hold(sent.value, batch.column("hash").to_numpy())
            yield batch.filter(pa.array(may)).select(["doc", "text"])

    hashed = docs.select("doc", "text", F.xxhash64("doc").alias("hash"))
    return hashed.mapInArrow(kept, "doc long, text string")


def _part_of(data: bytes, parts: int) -> np.ndarray:
    """The part, by content, of each window in a segment's bytes."""
    size = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    total = np.zeros(len(size) + 1, np.uint64)
    np.cumsum(size * W.powers(len(size)), out=total[1:])
    hashed = W.mix((total[LENGTH:] - total[:-LENGTH]) * W.powers(len(size), W._UNBASE)[: len(size) - LENGTH + 1])
    return (hashed % np.uint64(parts)).astype(np.int64)


_CUT = "name long, part long, doc long, start long, bytes binary, repeat boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of segments listed with each text; of names in parts, the single windows.

    Of equal windows of such a name a task sends the earliest on and marks the others as repeats, so a
    window that many segments share is one row per task and HELD_WINDOWS windows.
    """
    rows: list[tuple] = []
    earliest: dict[tuple[int, int, bytes], tuple[int, int]] = {}

    def flush(windows: bool) -> pa.RecordBatch:
        if windows:
            rows.extend((*key[:2], *place, key[2], False) for key, place in earliest.items())
            earliest.clear()
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.bool_())
        names = ["name", "part", "doc", "start", "bytes", "repeat"]
        columns = zip(*rows) if rows else ([] for _ in names)
        out = pa.record_batch([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)
        rows.clear()
        return out

    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            for row in batch.slice(low, 512).to_pylist():
                text, doc = row["text"].encode(), row["doc"]
                for s in row["segments"]:
                    begin = s["start"]
                    piece = text[begin : begin + s["count"] + LENGTH - 1]
                    if s["parts"] <= 1:
                        rows.append((s["name"], 0, doc, begin, piece, False))
                        continue
                    for at, part in enumerate(_part_of(piece, s["parts"]).tolist()):
                        key, here = (s["name"], part, piece[at : at + LENGTH]), (doc, begin + at)
                        known = earliest.setdefault(key, here)
                        if known != here:
                            earliest[key], later = min(known, here), max(known, here)
                            rows.append((s["name"], part, *later, None, True))
            yield flush(len(earliest) >= HELD_WINDOWS)
    yield flush(True)


def _repeats(rows: DataFrame, split_rows: int) -> DataFrame:
    """(doc, start, count): runs of windows of rows (doc, text) that are repeats."""
    segmented = rows.mapInArrow(_segment_batches, _SEGMENT)
    # Known repeats need no company; they are dealt out apart from the firsts of their name.
    lane = F.when(F.col("again"), F.pmod(F.xxhash64("doc", "start"), F.lit(1 << 20))).otherwise(-1)
    found = settle(
        segmented.withColumn("lane", lane)
        .repartition("name", "lane")
        .sortWithinPartitions("name", "lane", "content", "doc", "start")
        .select(*segmented.columns)
        .mapInArrow(_classify, _FOUND)
    )
    open_ = found.filter("not repeat")
    large = settle(
        open_.groupBy("name")
        # A segment of one name has at most SPAN windows.
        .agg(F.count("*").alias("count"))
        .filter(F.col("count") > split_rows)
        .select("name", F.ceil(F.col("count") * SPAN / split_rows).cast("int").alias("parts"))
    )
    listed = (
        open_.join(large, "name", "left")
        .select("doc", F.struct("name", "start", "count", F.coalesce("parts", F.lit(1)).alias("parts")).alias("s"))
        .groupBy("doc")
        .agg(F.collect_list("s").alias("segments"))
    )
    # One document's segments: bounded by its length.
    cut = settle(_touched(rows, open_).join(listed, "doc").mapInArrow(_cut, _CUT))
    windows = (
        cut.filter("not repeat")
        .drop("repeat")
        .repartition("name", "part")
        .sortWithinPartitions("name", "part")
        .mapInArrow(_compare, "doc long, start long")
        .unionByName(cut.filter("repeat").select("doc", "start"))
        .distinct()
    )
    whole = found.filter("repeat").select("doc", "start", "count")
    return whole.unionByName(windows.withColumn("count", F.lit(1)))


def merged(starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal byte runs (start, end) that runs of windows cover."""
    order = np.argsort(starts, kind="stable")
    low, high = starts[order], (starts + counts + LENGTH - 1)[order]
    reach = np.maximum.accumulate(high)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > reach[:-1]
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(low)) - 1
    return list(zip(low[begin].tolist(), reach[last].tolist(), strict=True))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans and remaining bytes of each text with its runs of repeated windows."""
    spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        for low in range(0, batch.num_rows, 512):
            part = batch.slice(low, 512)
            spans, kept = [], []
            for text, starts, counts in zip(
                part.column("text").to_pylist(), part.column("starts"), part.column("counts"), strict=True
            ):
                data, at, rest = text.encode(), 0, []
                runs = merged(starts.values.to_numpy(), counts.values.to_numpy())
                for a, b in runs:
                    rest.append(data[at:a])
                    at = b
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join([*rest, data[at:]]))
            yield pa.record_batch(
                [part.column("doc"), pa.array(spans, spans_kind), pa.array(kept, pa.binary())],
                names=["doc", "spans", "kept"],
            )


def without_repeats(docs: DataFrame, split_rows: int = SPLIT_ROWS) -> tuple[DataFrame, DataFrame]:
    """All documents as (doc, doc_id, text), and (doc, spans, kept) of those that lose bytes.

    spans: maximal removed byte runs; kept: the remaining bytes.
    """
    numbered, plain = _numbered(docs)
    rows = numbered.select("doc", "text") if plain else numbered.dropDuplicates(["doc"]).select("doc", "text")
    runs = settle(
        _repeats(rows, split_rows)
        .groupBy("doc")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("count").alias("counts"))
    )
    cleaned = (
        _touched(rows, runs)
        .join(runs, "doc")
        .mapInArrow(_clean, "doc long, spans array<struct<start:long,end:long>>, kept binary")
    )
    every = numbered.withColumn("doc_id", F.col("doc")) if plain else numbered
    return every, cleaned


def digests(docs: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    every, cleaned = without_repeats(docs, split_rows)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    lost = cleaned.select(
        "doc", removed.alias("removed"), F.size("spans").alias("many"), F.sha2("kept", 256).alias("rest")
    )
    brief = every.select(
        "doc", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("all")
    )
    return brief.join(lost, "doc", "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("many", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("rest", "all").alias("kept_sha256"),
    )
