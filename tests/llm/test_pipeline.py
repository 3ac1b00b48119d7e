import corpus_pipeline

from tradewatch.llm import decontam, near, pii, quality

SF_DIR = "/root/testdata/sf0.01"


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR).cache()
        assert after.columns == columns, name
        rows = (after.count(), before.count())
        assert rows[0] == rows[1] if name == "personal_data" else rows[0] < rows[1], name
        before = after
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    bad = labels.filter("quality = 0").join(before, "doc_id").count()
    assert bad <= 0.05 * labels.filter("quality = 0").count()
    rows = before.collect()
    assert not any(pii.base_spans(r.text) for r in rows)
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontam.matches(before, bench).count() == 0


def test_run_gives_tokens_that_decode(spark):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_awkward_and_empty_rows(spark, awkward, empty):
    for docs in (awkward, empty):
        now = docs
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, SF_DIR)
            if name != "tokens":
                assert now.columns == docs.columns
        now.collect()


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = quality.keep_good(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert near.keep_one(good).count() >= 0.9 * good.select("text").distinct().count()
