"""Nearest neighbours by inner product with learned partitions.

A bounded sample is joined to its neighbours in a graph; the graph is cut into parts of equal size
with few edges between them; a small classifier learns the part of a vector. It assigns every
vector to a part and routes a query to the parts it finds most probable, where exact scores rank
the candidates. How many parts are asked is set on sampled vectors that the classifier did not learn,
so that their neighbours are found with a wanted recall.

Every row is indexed. A part is dealt to blocks of bounded size, as are the queries routed to it, so
that no task holds a whole part, however many equal vectors it has, and only the k best of a query
leave a block.

Defined results: vectors that are null, empty, zero, or have null or non-finite components, take no
part, nor do vectors of another length than the most frequent one (the smaller of equals); a null
vec_id takes no part; each row of a repeated query id is a query with its own list, and all rows but
that one are its candidates; equal scores go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewatch.llm.scratch import settle

K = 20
QUERY_EVERY = 20
SAMPLE_ROWS = 8192  # of vectors for the partition and the router, at least
MOST_SAMPLE_ROWS = 65536  # and at most; in between with the square root of the rows
ROWS_PER_PART = 4096  # of a large table
MAX_PARTS = 1024
FEW_PARTS = 12  # of a small table, of at least FEW_ROWS rows each
FEW_ROWS = 200
HELD_OUT = 8  # one sampled vector in so many is kept from the router, to set how many parts are asked
GRAPH_DEGREE = 10
WANTED_RECALL = 0.94
BLOCK_ROWS = 8192
BLOCK_QUERIES = 2048


class Router(NamedTuple):
    """A classifier with one hidden layer and the number of parts a query is sent to."""

    scale: float
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.outer_bias)

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(x / self.scale @ self.inner + self.inner_bias, 0)
        return hidden @ self.outer + self.outer_bias


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """The nearest rows of each row by inner product, its own left out."""
    out = np.zeros((len(x), degree), np.int64)
    for low in range(0, len(x), 512):
        scores = x[low : low + 512] @ x.T
        scores[np.arange(len(scores)), np.arange(low, low + len(scores))] = -np.inf
        out[low : low + 512] = np.argpartition(-scores, degree - 1, axis=1)[:, :degree]
    return out


def cut_graph(x: np.ndarray, near: np.ndarray, parts: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Balanced parts with few graph edges between them.

    Starts from halving along the direction of largest spread, then moves vertices to the part of
    most of their neighbours while sizes stay within a twentieth of each other.
    """
    n = len(x)
    label = np.zeros(n, np.int64)

    def halve(rows: np.ndarray, first: int, count: int) -> None:
        if count == 1:
            label[rows] = first
            return
        centred = x[rows] - x[rows].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = rows[np.argsort(centred @ direction, kind="stable")]
        left = count // 2
        middle = len(rows) * left // count
        halve(order[:middle], first, left)
        halve(order[middle:], first + left, count - left)

    halve(np.arange(n), 0, parts)
    # Edges count in both directions.
    source = np.concatenate([np.repeat(np.arange(n), near.shape[1]), near.ravel()])
    target = np.concatenate([near.ravel(), np.repeat(np.arange(n), near.shape[1])])
    most = int(np.ceil(1.05 * n / parts))
    size = np.bincount(label, minlength=parts)
    random = np.random.default_rng(seed)
    for _ in range(rounds):
        pull = np.zeros((n, parts), np.int32)
        np.add.at(pull, (source, label[target]), 1)
        gain = pull.max(axis=1) - pull[np.arange(n), label]
        moved = 0
        for v in np.lexsort((random.random(n), -gain)):
            if gain[v] <= 0:
                break
            to = int(pull[v].argmax())
            if size[to] < most and size[label[v]] > 1:
                size[label[v]] -= 1
                size[to] += 1
                label[v] = to
                moved += 1
        if moved < n // 500 + 1:
            break
    return label


def learn_router(x: np.ndarray, label: np.ndarray, parts: int, seed: int, epochs: int = 15) -> Router:
    """Softmax classifier with one hidden layer, Adam on batches of 256 rows."""
    random = np.random.default_rng(seed)
    width = 128
    scale = float(np.sqrt((x**2).mean())) or 1.0
    weights = [
        random.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], width)), np.zeros(width),
        random.normal(0, np.sqrt(1 / width), (width, parts)), np.zeros(parts),
    ]
    first, second, step = [0 * w for w in weights], [0 * w for w in weights], 0
    for _ in range(epochs):
        order = random.permutation(len(x))
        for low in range(0, len(x), 256):
            rows = order[low : low + 256]
            inputs = x[rows] / scale
            hidden = np.maximum(inputs @ weights[0] + weights[1], 0)
            logits = hidden @ weights[2] + weights[3]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), label[rows]] -= 1
            p /= len(rows)
            back = (p @ weights[2].T) * (hidden > 0)
            slopes = [inputs.T @ back, back.sum(0), hidden.T @ p, p.sum(0)]
            step += 1
            for k, slope in enumerate(slopes):
                slope = slope + 1e-4 * weights[k]
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                weights[k] -= 3e-3 * (first[k] / (1 - 0.9**step)) / (
                    np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                )
    return Router(scale, *weights, probes=parts)


def parts_for(rows: int, sampled: int) -> int:
    """Parts of a table: FEW_PARTS or by ROWS_PER_PART, none so small that the sample cannot tell it."""
    wanted = max(rows // ROWS_PER_PART, min(FEW_PARTS, rows // FEW_ROWS))
    return int(max(1, min(MAX_PARTS, wanted, sampled // 64)))


def learn(x: np.ndarray, rows: int, wanted: float = WANTED_RECALL, seed: int = 11) -> Router:
    """Partition and router from a sample x of `rows` vectors in all."""
    parts = parts_for(rows, len(x))
    if parts == 1:
        width = x.shape[1] if x.ndim == 2 else 0
        return Router(1.0, np.zeros((width, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)
    held_out = np.arange(len(x)) % HELD_OUT == 0
    learned = x[~held_out]
    near = neighbour_graph(learned, min(GRAPH_DEGREE, len(learned) - 1))
    router = learn_router(learned, cut_graph(learned, near, parts, seed), parts, seed)
    # Parts are asked in order of probability until the neighbours of vectors not learned are found.
    asked = np.flatnonzero(held_out)[:1024]
    logits = router.logits(x)
    home = logits.argmax(axis=1)
    place = np.argsort(np.argsort(-logits[asked], axis=1), axis=1)
    true = nearest_of(x, asked, min(K, len(x) - 1))
    needed = np.take_along_axis(place, home[true], axis=1)
    probes = next(m for m in range(1, parts + 1) if (needed < m).mean() >= wanted)
    return router._replace(probes=probes)


def nearest_of(x: np.ndarray, asked: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows by inner product of the rows numbered `asked`, their own left out."""
    scored = x[asked] @ x.T
    scored[np.arange(len(asked)), asked] = -np.inf
    return np.argpartition(-scored, k - 1, axis=1)[:, :k]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part."""
    wide = F.col("embedding").cast("array<double>")
    good = F.forall(
        wide, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    ) & F.exists(wide, lambda v: v != 0)
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.coalesce(good, F.lit(False))).select(
        "vec_id", wide.alias("embedding")
    )
    sizes = rows.groupBy(F.size("embedding").alias("width")).count()
    top = sizes.orderBy(F.desc("count"), "width").first()
    return rows.filter(F.size("embedding") == (top["width"] if top else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, summed component by component: equal vectors get equal scores."""
    total = np.zeros((len(queries), len(rows)))
    for q, r in zip(queries.T, np.ascontiguousarray(rows.T), strict=True):
        total += q[:, None] * r[None, :]
    return total


def best(queries, query_rows, rows, row_ids, row_rows, k: int):
    """(query_row, vec_id, score) of the k best rows of each query but its own."""
    out = []
    for low in range(0, len(queries), 32):
        part = scores(queries[low : low + 32], rows)
        for i, line in enumerate(part):
            line = np.where(row_rows == query_rows[low + i], -np.inf, line)
            limit = np.partition(line, -k)[-k] if len(line) > k else -np.inf
            found = np.flatnonzero((line >= limit) & (line > -np.inf))
            found = found[np.lexsort((row_ids[found], -line[found]))][:k]
            out.append((np.full(len(found), query_rows[low + i]), row_ids[found], line[found]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(vectors: DataFrame, every: int = QUERY_EVERY, k: int = K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of every row whose id `every` divides."""
    rows = usable(vectors)
    count = rows.count()
    # A bounded sample, the same whatever the order of rows.
    size = int(min(MOST_SAMPLE_ROWS, max(SAMPLE_ROWS, 64 * count**0.5)))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).toArrow()
    x = _matrix(sample.column("embedding").combine_chunks())
    router = learn(x, count)
    sent = rows.sparkSession.sparkContext.broadcast(router)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            logits = sent.value.logits(_matrix(batch.column("embedding")))
            order = np.argsort(-logits, axis=1, kind="stable")[:, : sent.value.probes].astype(np.int32)
            parts = pa.ListArray.from_arrays(
                pa.array(np.arange(len(order) + 1, dtype=np.int32) * order.shape[1]),
                pa.array(order.ravel()),
            )
            yield pa.record_batch([*batch.columns, parts], names=[*batch.schema.names, "parts"])

    # Ids may repeat, so rows are numbered.
    routed = settle(
        rows.mapInArrow(route, "vec_id long, embedding array<double>, parts array<int>").withColumn(
            "row", F.monotonically_increasing_id()
        )
    )
    asks = routed.filter(F.col("vec_id") % every == 0).select(
        "row", "vec_id", "embedding", F.explode("parts").alias("part")
    )
    held = routed.withColumn("part", F.col("parts")[0]).drop("parts")
    # A row for each part: at most MAX_PARTS.
    blocks = held.groupBy("part").agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("row_blocks")
    )
    turns = asks.groupBy("part").agg(
        F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks")
    )
    plan = F.broadcast(settle(blocks.join(turns, "part")))
    own_row = F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).cast("int")
    own_query = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.col("query_blocks")).cast("int")
    left = (
        asks.join(plan, "part")
        .withColumn("query_block", own_query)
        .withColumn("row_block", F.explode(F.sequence(F.lit(0), F.col("row_blocks") - 1)))
    )
    right = (
        held.join(plan, "part")
        .withColumn("row_block", own_row)
        .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.col("query_blocks") - 1)))
    )
    keys = ["part", "row_block", "query_block"]

    def rank(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        names = ["query_row", "vec_id", "score"]
        if not queries.num_rows or not candidates.num_rows:
            kinds = [pa.int64(), pa.int64(), pa.float64()]
            return pa.table([pa.array([], kind) for kind in kinds], names=names)
        found = best(
            _matrix(queries.column("query").combine_chunks()),
            queries.column("query_row").to_numpy(),
            _matrix(candidates.column("embedding").combine_chunks()),
            candidates.column("vec_id").to_numpy(),
            candidates.column("row").to_numpy(),
            k,
        )
        return pa.table([pa.array(f) for f in found], names=names)

    found = (
        left.select(*keys, F.col("row").alias("query_row"), F.col("embedding").alias("query"))
        .groupBy(*keys)
        .cogroup(right.select(*keys, "row", "vec_id", "embedding").groupBy(*keys))
        .applyInArrow(rank, "query_row long, vec_id long, score double")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ids = routed.select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .join(ids, "query_row")
        .select("query_id", "rank", "vec_id", "score")
    )
