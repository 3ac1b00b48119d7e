"""Text quality by a factorisation machine.

Features of a text: its words, hashed into 2**14 slots and weighted by log counts at unit length;
statistics of its structure; and the recorded length as metadata. A second-order factorisation
machine adds to a linear score an interaction of every two features, <v_i, v_j> x_i x_j with factors
of low rank; the sum over all pairs is half of |sum v_i x_i|^2 - sum |v_i x_i|^2 and so takes time
linear in the features of the text.

The model is fitted with logistic loss on a bounded sample of labelled rows (SAMPLE_ROWS, chosen by
the hash of the id) and is a few hundred kilobytes whatever the corpus. Scoring is one scan.

Defined results: a null text is an empty text and empty texts get a score like all others; a null
n_chars counts as the text's own length; labels that are null or neither 0 nor 1 are ignored, and
contradicting labels of one id are averaged and rounded up; if no usable label is left, or all are
alike, the model is the constant share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewatch.llm import words as W

SLOTS = 1 << 14
RANK = 6
SAMPLE_ROWS = 12_000
THRESHOLD = 0.3
EPOCHS = 8
MIN_STEPS = 800  # batches; few rows are gone through more often
STATISTICS = (
    "chars", "words", "word_length", "upper", "digit", "symbol", "mark", "high", "space", "lines",
    "line_length", "same_lines", "distinct", "top", "repeats", "ends_symbol", "short", "recorded",
)
FEATURES = SLOTS + len(STATISTICS)

_CLASS = np.zeros(256, np.uint8)
_CLASS[65:91] = 1  # upper case
_CLASS[48:58] = 2  # digits
_CLASS[np.frombuffer(b"#$%&*+/<=>@\\^_`{|}~[]", np.uint8)] = 3  # symbols
_CLASS[np.frombuffer(b"!\"'(),-.:;?", np.uint8)] = 4  # marks
_CLASS[128:] = 5
_CLASS[np.frombuffer(W.SPACES, np.uint8)] = 6
_SPLIT = W.fold_table(W.SPACES, lower=True)


class Features(NamedTuple):
    """Sparse rows: row r has entries offset[r] .. offset[r + 1] of index and value."""

    offset: np.ndarray
    index: np.ndarray
    value: np.ndarray


class Model(NamedTuple):
    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _extract(chunk: W.Chunk, recorded: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, slot and weight of the word features, and the matrix of raw statistics."""
    rows, size = chunk.rows, np.diff(chunk.offset).astype(float)
    found = W.hash_words(chunk, _SPLIT)
    kinds = _CLASS[chunk.data]
    upper, digit, symbol, mark, high, space = (W.per_row(chunk, kinds == k) for k in range(1, 7))
    n_words = np.bincount(found.row, minlength=rows).astype(float)
    length = found.end - found.start
    letters = np.bincount(found.row, length, rows)

    slot = (found.hash >> np.uint64(40)).astype(np.int64) % SLOTS
    pair, count = np.unique(found.row * SLOTS + slot, return_counts=True)
    row, slot = np.divmod(pair, SLOTS)
    weight = np.log1p(count)
    norm = np.sqrt(np.bincount(row, weight**2, rows))
    weight = weight / np.maximum(norm[row], 1e-9)
    kinds_of_words = np.bincount(row, minlength=rows)
    top = np.zeros(rows)
    np.maximum.at(top, row, count)

    follows = (found.hash[1:] == found.hash[:-1]) & (found.row[1:] == found.row[:-1])
    repeats = np.bincount(found.row[1:][follows], minlength=rows)
    last = kinds[found.end - 1] if len(found.end) else found.end
    ends = np.bincount(found.row[last == 3], minlength=rows)
    short = np.bincount(found.row[length <= 3], minlength=rows)

    lines = W.hash_words(chunk, W.LINES)
    n_lines = np.bincount(lines.row, minlength=rows).astype(float)
    order = np.lexsort((lines.hash, lines.row))
    again = (lines.hash[order][1:] == lines.hash[order][:-1]) & (
        lines.row[order][1:] == lines.row[order][:-1]
    )
    same = np.bincount(lines.row[order][1:][again], minlength=rows)
    recorded = np.where(np.isfinite(recorded) & (recorded >= 0), recorded, size)
    statistics = np.stack(
        [
            np.log1p(size), np.log1p(n_words), _share(letters, n_words), _share(upper, size),
            _share(digit, size), _share(symbol, size), _share(mark, size), _share(high, size),
            _share(space, size), np.log1p(n_lines), np.log1p(_share(size, n_lines)),
            _share(same, n_lines), _share(kinds_of_words, n_words), _share(top, n_words),
            _share(repeats, n_words), _share(ends, n_words), _share(short, n_words),
            np.log1p(recorded),
        ],
        axis=1,
    )
    return row, slot, weight, statistics


def _rows(row, slot, weight, statistics: np.ndarray) -> Features:
    """Word entries first, then all statistics of each row."""
    n, width = statistics.shape
    every = np.concatenate([row, np.repeat(np.arange(n), width)])
    order = np.argsort(every, kind="stable")
    index = np.concatenate([slot, np.tile(SLOTS + np.arange(width), n)])[order]
    value = np.concatenate([weight, statistics.ravel()])[order]
    offset = np.zeros(n + 1, np.int64)
    np.cumsum(np.bincount(every, minlength=n), out=offset[1:])
    return Features(offset, index, value)


def _scores(model: Model, x: Features) -> np.ndarray:
    """Raw scores; every row has at least the statistics, so no row is empty."""
    v = model.factors[x.index] * x.value[:, None]
    start = x.offset[:-1]
    total = np.add.reduceat(v, start, axis=0)
    squares = np.add.reduceat((v * v).sum(axis=1), start)
    linear = np.add.reduceat(model.linear[x.index] * x.value, start)
    return model.bias + linear + ((total**2).sum(axis=1) - squares) / 2


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _standard(statistics: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    # Bounded, so that one odd text cannot outweigh all words, and small beside unit-length words.
    return np.clip((statistics - mean) / scale, -4, 4) / 4


def fit(word_rows: list, statistics: np.ndarray, labels: np.ndarray, seed: int = 7) -> Model:
    """Fit by Adagrad on batches of 64 rows. word_rows: (slots, weights) of each labelled row."""
    share = float(labels.mean()) if len(labels) else 0.5
    mean = statistics.mean(axis=0) if len(labels) else np.zeros(len(STATISTICS))
    scale = statistics.std(axis=0) + 1e-6 if len(labels) else np.ones(len(STATISTICS))
    random = np.random.default_rng(seed)
    bias, linear = 0.0, np.zeros(FEATURES)
    factors = random.normal(0, 0.05, (FEATURES, RANK))
    if share in (0.0, 1.0) or len(labels) < 2:
        # The constant, short of certainty.
        share = min(max(share, 1e-3), 1 - 1e-3)
        return Model(float(np.log(share / (1 - share))), linear, factors * 0, mean, scale)
    bias = float(np.log(share / (1 - share)))
    scaled = _standard(statistics, mean, scale)
    grown_bias, grown_linear, grown_factors = 1.0, np.full(FEATURES, 1e-2), np.full((FEATURES, RANK), 1e-2)
    rate, decay, own = 0.08, 1e-5, SLOTS + np.arange(len(STATISTICS))
    for _ in range(max(EPOCHS, -(-MIN_STEPS * 64 // len(labels)))):
        order = random.permutation(len(labels))
        for low in range(0, len(order), 64):
            batch = order[low : low + 64]
            row = np.repeat(np.arange(len(batch)), [len(word_rows[i][0]) for i in batch])
            x = _rows(
                row,
                np.concatenate([word_rows[i][0] for i in batch]),
                np.concatenate([word_rows[i][1] for i in batch]),
                scaled[batch],
            )
            model = Model(bias, linear, factors, mean, scale)
            error = (_sigmoid(_scores(model, x)) - labels[batch]) / len(batch)
            of = np.repeat(np.arange(len(batch)), np.diff(x.offset))
            v = factors[x.index]
            total = np.add.reduceat(v * x.value[:, None], x.offset[:-1], axis=0)
            push = error[of] * x.value
            slope = push[:, None] * (total[of] - v * x.value[:, None])
            touched, where = np.unique(x.index, return_inverse=True)
            by_feature = np.argsort(where, kind="stable")
            begin = np.searchsorted(where[by_feature], np.arange(len(touched)))
            g = np.add.reduceat(push[by_feature], begin) + decay * linear[touched]
            h = np.add.reduceat(slope[by_feature], begin, axis=0) + decay * factors[touched]
            grown_linear[touched] += g * g
            grown_factors[touched] += h * h
            linear[touched] -= rate * g / np.sqrt(grown_linear[touched])
            factors[touched] -= rate * h / np.sqrt(grown_factors[touched])
            grown_bias += float(error.sum()) ** 2
            bias -= rate * float(error.sum()) / grown_bias**0.5
    assert len(own) == len(STATISTICS)
    return Model(bias, linear, factors, mean, scale)


def _recorded(column: pa.Array, n: int) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(-1.0).to_numpy(zero_copy_only=False)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        recorded = _recorded(batch.column("n_chars"), batch.num_rows)
        for chunk in W.chunks(batch.column("text")):
            last = chunk.first + chunk.rows
            row, slot, weight, statistics = _extract(chunk, recorded[chunk.first : last])
            offset = np.zeros(chunk.rows + 1, np.int32)
            np.cumsum(np.bincount(row, minlength=chunk.rows), out=offset[1:])
            width = statistics.shape[1]
            yield pa.record_batch(
                [
                    batch.column("label").slice(chunk.first, chunk.rows),
                    pa.ListArray.from_arrays(pa.array(offset), pa.array(slot.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(offset), pa.array(weight.astype(np.float32))),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(chunk.rows + 1, dtype=np.int32) * width),
                        pa.array(statistics.ravel()),
                    ),
                ],
                names=["label", "slots", "weights", "statistics"],
            )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text divisible by 5; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most sample_rows labelled ids outside the held-out fifth, one row of each.

    Of the rows of an id that of the smallest text hash counts.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.round(F.avg("quality")).cast("int").alias("label"))
        .orderBy(F.xxhash64(F.lit("quality"), "doc_id"), "doc_id")
        .limit(sample_rows)
    )
    # At most sample_rows ids: safe to broadcast.
    # Folded in each task before the shuffle, so an id sends one row per task.
    least = F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "n_chars", "label"))
    rows = (
        docs.select("doc_id", "text", "n_chars")
        .join(F.broadcast(known), "doc_id")
        .groupBy("doc_id")
        .agg(least.alias("least"))
        .select("least.*")
    )
    table = (
        rows.select("label", "text", "n_chars")
        .mapInArrow(
            _feature_batches,
            "label int, slots array<int>, weights array<float>, statistics array<double>",
        )
        .toArrow()
    )
    y = table.column("label").to_numpy().astype(float)
    statistics = np.zeros((len(y), len(STATISTICS)))
    word_rows = []
    if len(y):
        statistics = np.stack(table.column("statistics").to_numpy())
        slots, weights = table.column("slots").to_numpy(), table.column("weights").to_numpy()
        word_rows = list(zip(slots, weights, strict=True))
    # The order of rows depends on task order; learning must not.
    order = np.lexsort((y, *statistics.T)) if len(y) else np.zeros(0, int)
    return fit([word_rows[i] for i in order], statistics[order], y[order])


def with_score(docs: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """Add the score, the probability of label 1 in 0 to 1."""
    small = Model(
        model.bias,
        model.linear.astype(np.float32),
        model.factors.astype(np.float32),
        model.mean,
        model.scale,
    )

    @F.arrow_udf("double")
    def score(texts: pa.Array, n_chars: pa.Array) -> pa.Array:
        recorded = _recorded(n_chars, len(texts))
        parts = [np.zeros(0)]
        for chunk in W.chunks(texts):
            last = chunk.first + chunk.rows
            row, slot, weight, statistics = _extract(chunk, recorded[chunk.first : last])
            scaled = _standard(statistics, small.mean, small.scale)
            parts.append(_sigmoid(_scores(small, _rows(row, slot, weight, scaled))))
        return pa.array(np.concatenate(parts))

    return docs.withColumn(into, score(F.col("text"), F.col("n_chars")))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """All rows and columns of docs with held_out, score and predicted (0 or 1)."""
    scored = with_score(docs, train(docs, labels))
    return scored.withColumn("held_out", held_out(F.col("doc_id"))).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows predicted to be of quality 1, with their columns."""
    scored = with_score(docs, train(docs, labels), into="__score")
    return scored.filter(F.col("__score") >= threshold).drop("__score")
