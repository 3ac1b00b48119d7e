import numpy as np

from tradewatch.llm import neighbours

KIND = "vec_id long, embedding array<float>, label int"


def brute(ids, x, every, k):
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        scores = x @ x[i]
        rows = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in rows]
    return out


def found_by(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score, r.rank))
    return out


def test_small_table_is_exact_with_ties_and_blocks(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-2, 3, (300, 6)).astype(float)
    x[::7] = x[0] = [1, 2, 0, 1, 0, 1]
    ids = rng.permutation(1000)[:300]
    rows = [(int(i), v.tolist(), 0) for i, v in zip(ids, x, strict=True)]
    found = found_by(neighbours.search(spark.createDataFrame(rows, KIND), block_rows=40))
    expected = brute(ids, x, 20, 20)
    assert {q: [v for v, _, _ in f] for q, f in found.items()} == {
        q: [v for v, _ in e] for q, e in expected.items()
    }
    assert all([r for _, _, r in f] == list(range(1, 21)) for f in found.values())


def test_recall_with_parts(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_PART", 150)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 16))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    router = neighbours.learn(x, len(x))
    assert router.parts > 8 and router.probes < router.parts
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found, expected = found_by(neighbours.search(df)), brute(np.arange(3000), x, 20, 20)
    hits = sum(len({v for v, _, _ in found[q]} & {v for v, _ in e}) for q, e in expected.items())
    assert hits / (20 * len(expected)) >= 0.9


def test_recall_on_the_given_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "ROWS_PER_PART", 250)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    found, expected = found_by(neighbours.search(df)), brute(ids, x, 20, 20)
    hits = sum(len({v for v, _, _ in found[q]} & {v for v, _ in e}) for q, e in expected.items())
    assert hits / (20 * len(expected)) >= 0.9


def test_parts_are_balanced():
    x = np.random.default_rng(1).normal(size=(1000, 8))
    label = neighbours.cut_graph(x, neighbours.neighbour_graph(x, 10), 8, 1)
    assert np.bincount(label).max() <= 1.05 * 1000 / 8 + 1


def test_unusable_vectors_and_empty_table(spark):
    rows = [
        (0, [1.0, 0.0], 1), (20, [0.5, 0.5], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1),
        (4, [1.0, None], 1), (5, [float("nan"), 1.0], 1), (6, [float("inf"), 1.0], 1),
        (7, [1.0, 2.0, 3.0], 1), (None, [1.0, 1.0], 1), (0, [1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, KIND)
    found = neighbours.search(df).collect()
    # Two rows have id 0: each is a query, and a candidate of the other.
    of_zero = [(0, 1, 0, 1.0), (0, 2, 20, 0.5)]
    of_twenty = [(20, 1, 0, 0.5), (20, 2, 0, 0.5)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == sorted([*of_zero, *of_zero, *of_twenty])
    assert neighbours.search(df.filter("false")).count() == 0


def test_parts_at_every_size():
    assert [neighbours.parts_for(n, min(n, 8192)) for n in (0, 1, 300, 500, 2000, 50_000)] == [1, 1, 1, 2, 10, 12]
    assert neighbours.parts_for(10**7, 65_536) == 1024


def test_recall_of_production_parameters(spark):
    """The whole given table, 10 parts, against brute force."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.collect()
    x, ids = np.array([r.embedding for r in rows], float), np.array([r.vec_id for r in rows])
    assert neighbours.parts_for(len(x), len(x)) == 10
    found, expected = found_by(neighbours.search(df)), brute(ids, x, 20, 20)
    hits = sum(len({v for v, _, _ in found[q]} & {v for v, _ in e}) for q, e in expected.items())
    assert hits / (20 * len(expected)) >= 0.9
