import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR

from tradewatch.llm import spelling
from tradewatch.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words_of(texts):
    """The vocabulary with counts, by the plain rule."""
    n = Counter()
    for doc_id, text in texts:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= 3}


def near(a, b):
    """Whether exactly one code point is inserted, deleted or replaced."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


def brute(n):
    partners = {w: [] for w in n}
    by_gap = {}
    for w in n:
        for i in range(len(w)):
            by_gap.setdefault(w[:i] + w[i + 1 :], set()).add(w)
        by_gap.setdefault(w, set()).add(w)
    for group in by_gap.values():
        for a in group:
            partners[a] += [b for b in group if near(a, b)]
    partners = {w: set(p) for w, p in partners.items()}
    form = {}
    for w in n:
        best = min(partners[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(partners[w]), n[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def rows_of(df):
    return sorted([(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()], key=str)


def test_query_equals_brute_force(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = rows_of(QUERIES["op11_spelling_variants"](spark, SF_DIR))
    assert found == brute(words_of(texts))
    assert any(f for _, f, *_ in found)


def vocabulary(seed, letters, size, lengths):
    rng = random.Random(seed)
    words = {"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(size)}
    return {w: rng.choice([3, 4, 6, 9, 40, 500]) for w in words}


@pytest.mark.parametrize("small", [False, True])
def test_dense_vocabulary(spark, monkeypatch, small):
    """Few letters, so that words have many near ones; small slices cut halves into tiles."""
    if small:
        monkeypatch.setattr(spelling, "SLICE_WORDS", 16)
        monkeypatch.setattr(spelling, "BUCKET_WORDS", 40)
    n = vocabulary(1, "abé", 1500, [5, 6, 7, 8, 9]) | vocabulary(2, "az", 200, [66, 67])
    n |= {"x" * 300: 5, "x" * 301: 50, "x" * 299 + "y": 3}
    frame = spark.createDataFrame(list(n.items()), "word string, n long")
    units = spelling.work_units(frame)
    if small:
        assert units.groupBy("unit").agg({"*": "count"}).agg({"count(1)": "max"}).first()[0] < 400
    found = spelling.with_forms(frame).collect()
    wanted = {w: (form, near, form_n) for w, form, _, _, near, form_n in brute(n)}
    assert {r.word: (r.form, r.n_near, r.form_n) for r in found} == wanted


def test_sets_of_one_error():
    index = spelling._letters([b"abcde", b"abxde", b"abcdef", b"zabcde", b"edcba"], 6)
    sets = spelling.PositionIndex(index).near(spelling._letters([b"abcde"], 5))
    assert [spelling._members(s)[1].tolist() for s in sets] == [[1], [2, 3]]
    assert np.array_equal(spelling._members(np.array([[1 << 63]], np.uint64))[1], [63])


def test_chain_is_followed_to_its_end(spark):
    chain = [f"w{i:02d}" for i in range(40)]
    links = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    assert {r.root for r in spelling.follow(links, 40).collect()} == {chain[-1]}


def test_awkward_rows(spark, awkward, empty):
    found = rows_of(spelling.variants(awkward))
    assert found == brute(words_of([(r.doc_id, r.text) for r in awkward.collect()]))
    assert spelling.variants(empty).count() == 0
    clash = awkward.selectExpr("*", "1 as word", "2 as n", "3 as run", "4 as checksum", "5 as name")
    assert rows_of(spelling.variants(clash)) == found


def test_very_long_run(spark, make_docs):
    long = "q" * 40_000
    found = rows_of(spelling.variants(make_docs(*[(i, f"{long} {long}r") for i in range(8)])))
    assert [(r[0][-2:], r[4]) for r in found] == [("qq", 1), ("qr", 1)]
