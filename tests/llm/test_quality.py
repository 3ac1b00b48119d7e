import zlib

import numpy as np
from conftest import SF_DIR

from tradewatch.llm import quality
from tradewatch.llm.queries import QUERIES


def test_linear_time_scores_equal_all_pairs():
    rng = np.random.default_rng(1)
    model = quality.Model(
        0.3, rng.normal(size=quality.FEATURES), rng.normal(size=(quality.FEATURES, 4)), None, None
    )
    offset = np.array([0, 3, 7])
    index = np.array([1, 5, 9, 0, 2, 5, quality.SLOTS])
    value = rng.normal(size=7)
    found = quality._scores(model, quality.Features(offset, index, value))
    for row in range(2):
        at = range(offset[row], offset[row + 1])
        plain = model.bias + sum(model.linear[index[i]] * value[i] for i in at)
        for i in at:
            for j in at:
                if i < j:
                    plain += model.factors[index[i]] @ model.factors[index[j]] * value[i] * value[j]
        assert abs(found[row] - plain) < 1e-9


def test_held_out_accuracy(spark):
    scored = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = scored.join(labels, "doc_id").filter("held_out").select("predicted", "quality").collect()
    assert len(rows) > 500
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.97


def test_held_out_rows_and_range(spark):
    rows = QUERIES["op2_quality_classifier"](spark, SF_DIR).collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_labels_are_never_learned(spark, awkward):
    rows = [(i, 1, 0) for i in range(1, 9)] + [(None, 0, 0), (3, None, 0), (4, 7, 0)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    first = quality.classify(awkward, labels).collect()
    turned = labels.selectExpr(
        "doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) quality"
    )
    again = quality.classify(awkward, turned).collect()
    key = lambda r: (str(r.doc_id), str(r.text))
    assert [r.score for r in sorted(first, key=key)] == [r.score for r in sorted(again, key=key)]
    assert len(first) == awkward.count() and all(0 <= r.score <= 1 for r in first)


def test_without_labels_or_documents(spark, awkward, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.classify(awkward, labels).collect()} == {0.5}
    assert quality.classify(empty, labels).count() == 0
    assert quality.keep_good(awkward, labels).columns == awkward.columns


def test_a_repeated_id_is_learned_once(spark, make_docs, monkeypatch):
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda rows, statistics, y: fitted.append((len(rows), statistics.tolist(), y.tolist())))
    docs = [(i, f"text number {i} of some") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    quality.train(make_docs(*docs), labels)
    quality.train(make_docs(*docs, *[(3, "text number 3 of some")] * 200), labels)
    quality.train(make_docs(*docs, *[(1 + i % 2, f"other text {i}") for i in range(100)]), labels)
    assert 0 < fitted[0][0] < 40 and fitted[1] == fitted[0] and fitted[2][0] == fitted[0][0]
