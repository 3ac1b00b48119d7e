"""Whitening of embeddings from the exact characteristic polynomial of their integer scatter.

Entries become integers, so the scatter of the distinct vectors is an integer matrix. Tasks sum its
parts exactly; its characteristic polynomial comes from Hessenberg forms modulo many primes, spread
over tasks, and Chinese remaindering. All its roots are real, so by Descartes' rule the sign changes of
the shifted polynomial count exactly the roots above a number, repeated ones included, and bisection
finds the largest ones to any precision. Components are null vectors of scatter minus root, found by
inverse iteration in long decimal arithmetic.

Only sums of dim * (dim + 3) / 2 numbers, residues of dim + 1 coefficients and the components pass
through the driver; their size does not depend on the number of rows. The steps on the polynomial grow
with the fourth power of dim and suit vectors of up to a few hundred entries.

Defined results: vectors that are null or empty, hold null or non-finite entries, entries of 2**55 or
more, or have another length than the commonest (ties: the longer one) take no part. Repeated rows and
null ids give rows of their own. Components of zero variance are left out, so equal vectors, a single
vector and an empty table give no rows. A deviation beyond a long is null. Only the id and vector
columns are read, so extra columns may have any names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Context, Decimal, localcontext
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewatch.llm.scratch import settle

SCALE = 256
LARGEST = float(1 << 55)
COMPONENTS = 4
ROOT_BITS = 128  # significant bits of a root
DIGITS = 90  # of the arithmetic for components
LIMB = 40  # bits of the parts in which exact sums travel
LIMBS = 4
FACTOR_BITS = 20  # of the parts of entries that are multiplied as doubles
BLOCK_ROWS = 1 << 13  # so many products of two such parts have an exact sum in a double


class Whitening(NamedTuple):
    """n: vectors of the fit list; sums: their exact sum; components: columns of unit length."""

    n: int
    sums: list[int]
    variances: list[float]
    explained: list[float]
    components: np.ndarray


def scaled(embeddings: DataFrame, vector: str = "embedding", into: str = "x") -> DataFrame:
    """The rows that take part, with their vectors as integers floor(SCALE * entry)."""
    fine = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    rows = embeddings.where(F.col(vector).isNotNull() & fine & (F.size(vector) > 0))
    size = F.size(vector).alias("size")
    commonest = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("size")).first()
    dim = commonest["size"] if commonest else 0
    return rows.where(F.size(vector) == dim).withColumn(into, whole)


def _matrix(lists: pa.Array) -> np.ndarray:
    """Lists of one length as rows of int64."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def _parts(x: np.ndarray) -> list[np.ndarray]:
    """Doubles whose sum, the k-th times 2**(FACTOR_BITS * k), is x; the last one has the sign."""
    parts = []
    while len(x) and max(int(x.max()), -int(x.min())) > 1 << FACTOR_BITS:
        parts.append((x & ((1 << FACTOR_BITS) - 1)).astype(np.float64))
        x = x >> FACTOR_BITS
    return [*parts, x.astype(np.float64)]


def exact_sums(x: np.ndarray) -> np.ndarray:
    """Upper triangle of x'x, row by row, and the column sums, as Python integers."""
    dim = x.shape[1]
    upper = np.triu_indices(dim)
    total = np.zeros(len(upper[0]) + dim, object)
    for low in range(0, len(x), BLOCK_ROWS):
        parts = _parts(x[low : low + BLOCK_ROWS])
        for k, left in enumerate(parts):
            total[-dim:] += left.sum(axis=0).astype(np.int64).astype(object) << (FACTOR_BITS * k)
            for other, right in enumerate(parts):
                product = (left.T @ right)[upper].astype(np.int64).astype(object)
                total[:-dim] += product << (FACTOR_BITS * (k + other))
    return total


def _scatter_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task as limbs, one row per number."""
    total = 0
    for batch in batches:
        if batch.num_rows:
            total = total + exact_sums(_matrix(batch.column(0)))
    if isinstance(total, int):
        return
    limbs = []
    for _ in range(LIMBS - 1):
        limbs.append(total & ((1 << LIMB) - 1))
        total = total >> LIMB
    columns = [pa.array(limb.tolist(), pa.int64()) for limb in [*limbs, total]]
    at = pa.array(np.arange(len(total), dtype=np.int32))
    yield pa.record_batch([at, *columns], names=["at", *[f"limb{k}" for k in range(LIMBS)]])


def scatter(fit: DataFrame) -> tuple[list[list[int]], list[int]]:
    """x'x and the sum of x over all rows of a column x, exactly."""
    limbs = [f"limb{k}" for k in range(LIMBS)]
    schema = "at int, " + ", ".join(f"{limb} long" for limb in limbs)
    sums = fit.select("x").mapInArrow(_scatter_parts, schema).groupBy("at")
    rows = sums.agg(*[F.sum(limb).alias(limb) for limb in limbs]).collect()
    value = {r["at"]: sum(r[limb] << (LIMB * k) for k, limb in enumerate(limbs)) for r in rows}
    dim = (math.isqrt(9 + 8 * len(value)) - 3) // 2
    product = [[0] * dim for _ in range(dim)]
    for at, (i, j) in enumerate(zip(*map(np.ndarray.tolist, np.triu_indices(dim)))):
        product[i][j] = product[j][i] = value[at]
    first = dim * (dim + 1) // 2
    return product, [value[first + i] for i in range(dim)]


# Characteristic polynomial ----------------------------------------------------------------------


def primes(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product exceeds the bound."""
    found, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        # These four bases decide every number below 3 * 10**9.
        if all(_strong(candidate, base) for base in (2, 3, 5, 7)):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def _strong(n: int, base: int) -> bool:
    """Whether n passes the Miller-Rabin test to a base."""
    odd = n - 1
    twos = (odd & -odd).bit_length() - 1
    x = pow(base, odd >> twos, n)
    return x in (1, n - 1) or any(pow(x, 1 << k, n) == n - 1 for k in range(1, twos))


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(y - matrix) modulo a prime below 2**31, constant first."""
    h = matrix.copy()
    dim = len(h)
    for k in range(1, dim - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + int(below[0])
        if pivot != k:
            h[[k, pivot]] = h[[pivot, k]]
            h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    # Row m: the polynomial of the leading block of m rows.
    leading = np.zeros((dim + 1, dim + 1), np.int64)
    leading[0, 0] = 1
    for m in range(dim):
        row = -h[m, m] * leading[m] % p
        row[1:] += leading[m, :-1]
        if m:
            # Entries of the column above, each times the subdiagonal from its row down to here.
            down = np.ones(m, np.int64)
            for i in range(m - 1, -1, -1):
                down[i] = h[i + 1, i] * (down[i + 1] if i + 1 < m else 1) % p
            weight = down * h[:m, m] % p
            row -= (weight[:, None] * leading[:m] % p).sum(axis=0)
        leading[m + 1] = row % p
    return leading[dim]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(y - matrix) of a positive semidefinite integer matrix, constant first."""
    dim = len(matrix)
    trace = sum(matrix[i][i] for i in range(dim))
    # Elementary symmetric functions of roots that sum to the trace are largest if all are equal.
    bound = max(math.comb(dim, k) * trace**k // dim**k + 1 for k in range(dim + 1))
    chosen = primes(2 * bound)
    sent = spark.sparkContext.broadcast((chosen, matrix))

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moduli, entries = sent.value
        for batch in batches:
            for at in batch.column(0).to_pylist():
                p = moduli[at]
                reduced = np.array([[entry % p for entry in row] for row in entries], np.int64)
                row = polynomial_modulo(reduced, p).tolist()
                yield pa.record_batch([pa.array([at]), pa.array([row])], names=["id", "row"])

    tasks = min(len(chosen), spark.sparkContext.defaultParallelism)
    # dim + 1 residues per prime, and primes by the length of the coefficients.
    rows = spark.range(0, len(chosen), 1, tasks).mapInArrow(residues, "id long, row array<long>").collect()
    value, modulus = [0] * (dim + 1), 1
    for r in rows:
        p = chosen[r["id"]]
        inverse = pow(modulus, -1, p)
        value = [v + modulus * ((int(c) - v) * inverse % p) for v, c in zip(value, r["row"])]
        modulus *= p
    return [v - modulus if 2 * v > modulus else v for v in value]


# Roots ------------------------------------------------------------------------------------------


def roots_above(polynomial: list[int], number: int, shift: int) -> int:
    """How many roots of a monic polynomial with only real roots exceed number / 2**shift."""
    dim = len(polynomial) - 1
    c = [value << (shift * (dim - k)) for k, value in enumerate(polynomial)]
    for low in range(dim):
        for k in range(dim - 1, low - 1, -1):
            c[k] += number * c[k + 1]
    signs = [value > 0 for value in c if value]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], count: int) -> list[tuple[int, int]]:
    """The largest positive roots, repeated ones repeated, as (a, shift): within a .. a + 1 over 2**shift."""
    highest = -polynomial[-2] + 1  # the sum of all roots, none of which is negative
    known: dict[tuple[int, int], int] = {}

    def above(number: int, shift: int) -> int:
        if (number, shift) not in known:
            known[number, shift] = roots_above(polynomial, number, shift)
        return known[number, shift]

    found = []
    for rank in range(1, count + 1):
        if above(0, 0) < rank:
            break
        low, high, shift = 0, highest, 0
        while low.bit_length() < ROOT_BITS or high - low > 1:
            if high - low == 1:
                low, high, shift = low << 32, high << 32, shift + 32
            middle = (low + high) >> 1
            if above(middle, shift) >= rank:
                low = middle
            else:
                high = middle
        found.append((low, shift))
    return found


# Components -------------------------------------------------------------------------------------


def null_vector(matrix: list[list[int]], root: Decimal, others: list[list[Decimal]]) -> list[Decimal]:
    """Unit vector that matrix - root takes to nearly zero, at right angles to the others."""
    dim = len(matrix)
    rows = [[Decimal(entry) for entry in row] for row in matrix]
    for i in range(dim):
        rows[i][i] -= root
    tiny = max(root, Decimal(1)).scaleb(-DIGITS + 5)
    order = list(range(dim))
    for k in range(dim):
        pivot = max(range(k, dim), key=lambda i: abs(rows[i][k]))
        rows[k], rows[pivot] = rows[pivot], rows[k]
        order[k], order[pivot] = order[pivot], order[k]
        top = rows[k]
        if abs(top[k]) < tiny:
            top[k] = tiny
        for i in range(k + 1, dim):
            row = rows[i]
            if row[k]:
                factor = row[k] / top[k]
                row[k:] = [factor, *[a - factor * b for a, b in zip(row[k + 1 :], top[k + 1 :])]]
    vector = _upright([Decimal(i + 2).sqrt() for i in range(dim)], others)
    for _ in range(5):
        solved = [vector[i] for i in order]
        for i in range(dim):
            solved[i] -= sum((a * b for a, b in zip(rows[i][:i], solved[:i])), Decimal(0))
        for i in range(dim - 1, -1, -1):
            rest = sum((a * b for a, b in zip(rows[i][i + 1 :], solved[i + 1 :])), Decimal(0))
            solved[i] = (solved[i] - rest) / rows[i][i]
        vector = _upright(solved, others)
    return vector


def _upright(vector: list[Decimal], others: list[list[Decimal]]) -> list[Decimal]:
    """The vector without its parts along the others, at unit length."""
    for _ in range(2):
        for other in others:
            along = sum((a * b for a, b in zip(vector, other)), Decimal(0))
            vector = [a - along * b for a, b in zip(vector, other)]
        length = sum((a * a for a in vector), Decimal(0)).sqrt()
        vector = [a / length for a in vector]
    return vector


def fit_whitening(fit: DataFrame, count: int = COMPONENTS) -> Whitening | None:
    """Mean, variances and components of the vectors in column x; None if nothing varies."""
    n = fit.count()
    if not n:
        return None
    product, sums = scatter(fit)
    dim = len(sums)
    # n * n times the covariance.
    matrix = [[n * product[i][j] - sums[i] * sums[j] for j in range(dim)] for i in range(dim)]
    trace = sum(matrix[i][i] for i in range(dim))
    if not trace:
        return None
    polynomial = characteristic_polynomial(fit.sparkSession, matrix)
    found: list[list[Decimal]] = []
    variances, explained = [], []
    with localcontext(Context(prec=DIGITS, Emin=-999_999, Emax=999_999)):
        for low, shift in largest_roots(polynomial, min(count, dim)):
            root = Decimal(2 * low + 1) / Decimal(1 << (shift + 1))
            found.append(null_vector(matrix, root, found))
            variances.append(float(root / (n * n)))
            explained.append(float(root / trace))
        components = np.array([[float(entry) for entry in vector] for vector in found]).T
    return Whitening(n, sums, variances, explained, components)


class _Projection:
    """Applies a fit to batches of integer vectors."""

    def __init__(self, fit: Whitening):
        self.fit = fit
        self.mean = np.array([s / fit.n for s in fit.sums])
        self.weights = fit.components / np.sqrt(fit.variances)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums)**2 over the entries, exactly; None beyond a long."""
        n, sums = self.fit.n, self.fit.sums
        most = n * max(int(x.max()), -int(x.min())) + max(map(abs, sums)) if len(x) else 0
        kind = np.int64 if most * most * len(sums) < 1 << 63 else object
        gap = n * x.astype(kind) - np.array(sums, kind)
        total = (gap * gap).sum(axis=1).tolist()
        return [t if t < 1 << 63 else None for t in total]


def identity_error(fit: DataFrame, whitening: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    projection = _Projection(whitening)
    names = [f"w{k}" for k in range(len(whitening.variances))]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                columns = projection.whitened(_matrix(batch.column(0))).T
                yield pa.record_batch([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    rows = fit.select("x").mapInArrow(project, ", ".join(f"{name} double" for name in names))
    gaps = [
        F.abs(F.covar_pop(a, b) - (1.0 if a == b else 0.0)) for i, a in enumerate(names) for b in names[i:]
    ]
    return max(rows.agg(*gaps).first())


def transform(rows: DataFrame, whitening: Whitening, key: str = "vec_id") -> DataFrame:
    """A row per vector and component: the key, component, deviation, whitened and explained."""
    projection = _Projection(whitening)
    count = len(whitening.variances)
    kept = rows.select(F.col(key), "x")

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            each = np.repeat(np.arange(len(x)), count)
            deviation = pa.array(projection.deviations(x), pa.int64())
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                    deviation.take(pa.array(each)),
                    pa.array(projection.whitened(x).ravel()),
                    pa.array(np.tile(np.array(whitening.explained), len(x))),
                ],
                names=[key, "component", "deviation", "whitened", "explained"],
            )

    kind = kept.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, deviation long, whitened double, explained double"
    return kept.mapInArrow(project, schema)


def whiten(embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Fit on the distinct vectors and transform all rows; adds n and identity_error."""
    rows = scaled(embeddings.select(F.col(key), F.col(vector)), vector)
    fit = settle(rows.select("x").distinct())
    whitening = fit_whitening(fit)
    if whitening is None:
        kind = embeddings.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, component int, deviation long, whitened double, explained double"
        out = embeddings.sparkSession.createDataFrame([], schema)
        n, error = 0, None
    else:
        out = transform(rows, whitening, key)
        n, error = whitening.n, identity_error(fit, whitening)
    return out.withColumn("n", F.lit(n).cast("long")).withColumn(
        "identity_error", F.lit(error).cast("double")
    )
