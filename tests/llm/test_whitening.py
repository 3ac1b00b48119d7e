import math
import random

import numpy as np
import pytest
from conftest import SF_DIR

from tradewatch.llm import whitening
from tradewatch.llm.queries import QUERIES

DDL = "vec_id long, embedding array<double>"


def brute(vectors):
    """Sums, deviations and covariance in Python integers, components by numpy's solver."""
    x = {i: [math.floor(256 * c) for c in v] for i, v in vectors.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, dim = len(fit), len(fit[0])
    sums = [sum(v[k] for v in fit) for k in range(dim)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums)) for i, v in x.items()}
    centred = np.array(fit, float) - np.array(sums) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, deviation, values[::-1], components[:, ::-1]


def compare(rows, vectors):
    x, n, sums, deviation, values, components = brute(vectors)
    count = min(4, int((values > 1e-9 * values[0]).sum()))
    assert sorted((r.vec_id, r.component) for r in rows) == sorted((i, k + 1) for i in x for k in range(count))
    signs = {}
    for r in rows:
        k = r.component - 1
        gap = np.array(x[r.vec_id], float) - np.array(sums) / n
        wanted = gap @ components[:, k] / math.sqrt(values[k])
        if k not in signs and abs(wanted) > 1e-3:
            signs[k] = math.copysign(1, wanted * r.whitened)
        assert r.whitened == pytest.approx(signs.get(k, 1) * wanted, rel=1e-6, abs=1e-6)
        assert r.n == n and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_equals_brute_force(spark):
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    compare(QUERIES["op12_whitening"](spark, SF_DIR).collect(), {r.vec_id: r.embedding for r in given})


def test_polynomial_equals_exact_elimination(spark):
    rng = random.Random(4)
    for dim in (1, 2, 3, 7):
        rows = [[rng.randint(-(10**12), 10**12) for _ in range(dim)] for _ in range(dim + 2)]
        matrix = [[sum(r[i] * r[j] for r in rows) for j in range(dim)] for i in range(dim)]
        found = whitening.characteristic_polynomial(spark, matrix)
        # Faddeev and Leverrier, exact in integers.
        wanted, power = [1], [[0] * dim for _ in range(dim)]
        for k in range(1, dim + 1):
            power = [
                [sum(matrix[i][t] * power[t][j] for t in range(dim)) + (wanted[-1] if i == j else 0) for j in range(dim)]
                for i in range(dim)
            ]
            trace = sum(matrix[i][t] * power[t][i] for i in range(dim) for t in range(dim))
            wanted.append(-trace // k)
        assert found[::-1] == wanted


def test_roots_are_counted_with_their_multiplicity():
    polynomial = [1]
    for root in (3, 3, 3, 7, 0):
        polynomial = [a - root * b for a, b in zip([0, *polynomial], [*polynomial, 0])]
    assert [whitening.roots_above(polynomial, t, 0) for t in (-1, 0, 2, 3, 6, 7)] == [5, 4, 4, 1, 1, 0]
    found = [low / 2**shift for low, shift in whitening.largest_roots(polynomial, 5)]
    assert found == pytest.approx([7, 3, 3, 3])


def test_exact_sums_of_large_entries():
    rng = random.Random(2)
    x = np.array([[rng.randint(-(2**62), 2**62) for _ in range(3)] for _ in range(50)], np.int64)
    rows = x.tolist()
    wanted = [sum(r[i] * r[j] for r in rows) for i in range(3) for j in range(i, 3)]
    assert whitening.exact_sums(x).tolist() == wanted + [sum(r[i] for r in rows) for i in range(3)]


def test_repeated_variances_give_orthogonal_components(spark):
    corners = [[a, b, c, 0.25] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    rows = whitening.whiten(spark.createDataFrame(list(enumerate(corners)), DDL)).collect()
    assert {r.component for r in rows} == {1, 2, 3}  # the constant entry has no variance
    assert all(r.explained == pytest.approx(1 / 3) and r.identity_error < 1e-12 for r in rows)
    table = np.zeros((8, 3))
    for r in rows:
        table[r.vec_id, r.component - 1] = r.whitened
    assert np.allclose(table.T @ table / 8, np.eye(3))


def test_awkward_rows(spark):
    rng = random.Random(7)
    good = {i: [rng.gauss(0, 1) for _ in range(5)] for i in range(40)}
    good[40] = good[3]
    good[41] = [9.0, -7.5, 0.0, -0.0, 3.0]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0], [math.nan] * 5, [math.inf] * 5, [1e300] * 5, [1.0, 2.0]]
    rows = [(i, v) for i, v in good.items()] + [(100 + k, v) for k, v in enumerate(bad)]
    frame = spark.createDataFrame(rows, DDL)
    for name in ("x", "n", "component", "limb0", "whitened"):
        frame = frame.selectExpr("*", f"'clash' as {name}")
    compare(whitening.whiten(frame).collect(), good)
    repeated = spark.createDataFrame([(1, good[0]), (1, good[0]), (None, good[1])], DDL)
    found = whitening.whiten(repeated).collect()
    assert sorted((r.vec_id is None, r.component) for r in found) == [(False, 1), (False, 1), (True, 1)]
    assert {r.n for r in found} == {2}


def test_nothing_varies(spark):
    assert whitening.whiten(spark.createDataFrame([], DDL)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], DDL)).count() == 0


def test_a_deviation_beyond_a_long_is_null(spark):
    frame = spark.createDataFrame([(1, [1e14, 0.0]), (2, [-1e14, 1.0])], DDL)
    assert {r.deviation for r in whitening.whiten(frame).collect()} == {None}
