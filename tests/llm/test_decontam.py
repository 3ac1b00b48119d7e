import random
import re

import numpy as np
from conftest import SF_DIR

from tradewatch.llm import decontam
from tradewatch.llm.queries import QUERIES


def words(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain_score(item, passage):
    """Smith-Waterman, cell by cell."""
    best, above = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage):
            row.append(max(0, above[j] + (1 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best, above = max(best, *row), row
    return best


def test_alignment_equals_plain_one():
    rng = random.Random(2)
    for _ in range(300):
        item = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
        passage = [rng.randrange(4) for _ in range(rng.randint(1, 20))]
        score, low, high = decontam.align(np.array(item), np.array(passage))
        assert score == plain_score(item, passage)
        assert plain_score(item, passage[low:high]) == score


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    expected = set()
    for d in docs:
        text = words(d.text)
        grams = {tuple(text[i : i + 3]) for i in range(len(text) - 2)}
        for b in items:
            item = words(b.text)
            # Half of an item cannot align without a run of three.
            if any(tuple(item[i : i + 3]) in grams for i in range(len(item) - 2)):
                if plain_score(item, text) >= max(0.5 * len(item), min(6, len(item))):
                    expected.add((d.doc_id, b.item_id))
    found = QUERIES["op10_decontamination"](spark, SF_DIR).collect()
    assert expected and {(r.doc_id, r.item_id) for r in found} == expected
    assert len(found) == len(expected)


ITEM = "which of the seven hidden rivers flows under the old glass tower before it meets the northern sea"


def test_edited_copies_are_found_and_others_left_alone(spark, make_docs):
    filler = " ".join(f"filler{i} text{i % 7}" for i in range(200))
    edited = ITEM.replace("seven hidden", "seven secret").replace("old glass", "old shining glass")
    docs = make_docs(
        (1, f"{filler} {ITEM.upper()} {filler}"), (2, f"{filler} {edited}, {filler}"),
        (3, filler), (4, "which of the seven"), (None, ITEM), (5, None), (6, ""), (1, f"{filler} {ITEM.upper()} {filler}"),
    )
    bench = spark.createDataFrame(
        [(7, ITEM), (7, ITEM), (8, None), (9, ""), (None, "two words"), (10, "a b c")], "item_id long, text string"
    )
    found = decontam.matches(docs, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == sorted(
        [("1", 7), ("1", 7), ("1", 7), ("1", 7), ("2", 7), ("2", 7), ("None", 7), ("None", 7)]
    )
    exact = [r for r in found if r.doc_id == 1]
    assert {(r.score, r.start, r.end) for r in exact} == {(1.0, 400, 418)}
    kept = decontam.keep_clean(docs, bench)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "5", "6"]
    assert kept.columns == docs.columns


def every(item, step, first=0):
    """The item with every step-th word replaced."""
    return " ".join(f"new{i}" if i % step == first else w for i, w in enumerate(item.split()))


def test_copies_are_found_without_an_exact_one_elsewhere(spark, make_docs):
    filler = " ".join(f"filler{i}" for i in range(80))
    items = [(k, " ".join(f"w{k}x{i}" for i in range(15 + k))) for k in range(45)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    fifth = [(k, f"{filler} {every(item, 5, 4)} {filler}") for k, item in items]
    # Copies that kept different words, and many documents with the first three words.
    sixth = [(100 + k, f"{filler} {every(item, 6, k % 6)}") for k, item in items]
    common = [(200 + i, f"{filler} w7x0 w7x1 w7x2") for i in range(20)]
    found = {(r.doc_id, r.item_id) for r in decontam.matches(make_docs(*fifth), bench).collect()}
    assert found == {(k, k) for k, _ in items}
    found = {(r.doc_id, r.item_id) for r in decontam.matches(make_docs(*fifth, *sixth, *common), bench).collect()}
    assert found == {(k, k) for k, _ in items} | {(100 + k, k) for k, _ in items}


def seeded_pairs(docs, bench):
    """Pairs of passages and items that seeds make, and the words of all passages."""
    items = decontam.items_of(bench)
    seeds = decontam.seeds_of(docs, items)
    found = decontam.passages(docs, seeds)
    pairs = found.selectExpr("passage", "class", "explode(grams) as gram").join(seeds, ["gram", "class"])
    return pairs.select("passage", "item").distinct().count(), found.selectExpr("sum(size(words))").first()[0] or 0


def test_a_common_phrase_pairs_no_documents_with_items(spark, make_docs):
    docs = make_docs(*[(i, f"doc{i} starts here one of the places{i} ends") for i in range(3000)])
    items = [(k, " ".join(f"q{k}w{i}" for i in range(10)) + f" one of the last{k} " + " ".join(f"r{k}w{i}" for i in range(10))) for k in range(200)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    copies = make_docs(*[(10_000 + k, f"intro {every(item, 5, 4)} outro") for k, item in items])
    assert seeded_pairs(docs, bench)[0] == 0
    pairs, _ = seeded_pairs(docs.unionByName(copies), bench)
    assert pairs <= 3 * len(items)
    found = {(r.doc_id, r.item_id) for r in decontam.matches(docs.unionByName(copies), bench).collect()}
    assert found == {(10_000 + k, k) for k, _ in items}


def test_a_long_item_does_not_widen_other_passages(spark, make_docs):
    filler = " ".join(f"filler{i}" for i in range(15_000))
    docs = make_docs(*[(i, f"{filler} {ITEM} {filler}") for i in range(5)])
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    long = " ".join(f"long{i}" for i in range(10_000))
    both = bench.union(spark.createDataFrame([(2, long)], "item_id long, text string"))
    assert seeded_pairs(docs, both) == seeded_pairs(docs, bench)
    assert seeded_pairs(docs, bench)[1] <= 5 * 3 * 32
    assert {(r.doc_id, r.item_id) for r in decontam.matches(docs, both).collect()} == {(i, 1) for i in range(5)}


def test_words_in_common_bound_the_score():
    rng = random.Random(4)
    for _ in range(300):
        item = np.array([rng.randrange(9) for _ in range(rng.randint(1, 12))])
        passage = np.array([rng.randrange(9) for _ in range(rng.randint(1, 20))])
        score = decontam.align(item, passage)
        assert decontam.align_if(item, passage, score[0]) == score


def test_awkward_and_empty(spark, awkward, empty):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    none = bench.filter("false")
    assert decontam.matches(awkward, bench).count() == 0
    assert decontam.keep_clean(awkward, bench).count() == awkward.count()
    assert decontam.matches(awkward, none).count() == 0
    assert decontam.matches(empty, bench).count() == 0
