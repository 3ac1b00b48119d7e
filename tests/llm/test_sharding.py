import itertools
import zlib

import numpy as np
from conftest import SF_DIR

from tradewatch.llm import sharding
from tradewatch.llm.queries import QUERIES


def test_differencing_of_two_parts_by_hand():
    # 8-7=1, 6-5=1, 4-1=3 ... the textbook case: 8 7 6 5 4 leaves a difference of 2.
    part = sharding.difference(np.array([8, 7, 6, 5, 4]), 2)
    sums = np.bincount(part, [8, 7, 6, 5, 4])
    assert abs(sums[0] - sums[1]) == 2


def test_differencing_is_never_far_from_the_best():
    rng = np.random.default_rng(4)
    for _ in range(20):
        weights = rng.integers(1, 50, 7)
        part = sharding.difference(weights, 3)
        spread = np.ptp(np.bincount(part, weights, 3))
        best = min(
            np.ptp(np.bincount(p, weights, 3)) for p in itertools.product(range(3), repeat=7)
        )
        assert spread <= best + weights.max()
    assert len(sharding.difference(np.zeros(0), 3)) == 0
    assert set(sharding.difference(np.zeros(5, int), 1)) == {0}


def check(rows, texts, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts
    )
    for s in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert 0 <= s < shards and slots == list(range(len(slots)))
    of_text = {}
    for r in rows:
        assert of_text.setdefault((r.text_crc32, r.size), r.shard) == r.shard


def test_query_is_balanced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    rows = QUERIES["op1_kk_sharding"](spark, "/root/testdata/sf0.1").collect()
    check(rows, [tuple(r) for r in docs.collect()], 40)
    sizes = np.bincount([r.shard for r in rows], [r.size for r in rows], 40)
    assert np.ptp(sizes) <= 64


def test_light_groups_are_bundled_and_slots_dealt(spark, make_docs):
    texts = [(i, f"text {i % 700} " * (1 + i % 13)) for i in range(2000)]
    texts += [(5000 + i, "hot " * 300) for i in range(900)]
    placed = sharding.shard(make_docs(*texts), shards=5, fineness=4)
    rows = placed.collect()
    check(rows, texts, 5)
    numbered = sharding.with_slots(placed.drop("slot"), len(rows), 5, slot_rows=7).collect()
    check(numbered, texts, 5)
    sizes = sorted(np.bincount([r.shard for r in rows], [r.size for r in rows], 5))
    # The hot group is alone; the others share the rest.
    assert sizes[-1] == 900 * (1200 + 16) and sizes[3] - sizes[0] < sizes[3] / 4


def test_awkward_and_empty(awkward, empty):
    texts = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    check(sharding.shard(awkward).collect(), texts, 40)
    assert sharding.shard(empty).count() == 0


def test_law_columns(spark):
    df = QUERIES["op1_kk_sharding"](spark, SF_DIR)
    assert dict(df.dtypes)["grown_shard"] == "int" and dict(df.dtypes)["slot"] == "bigint"
