import numpy as np

from tradewatch.llm import licences

FILE = "doc_id long, path string, text string, notice string, found int"


def files(spark, *rows):
    return spark.createDataFrame([(*r, None, 1) for r in rows], FILE)


def test_templates_name_themselves_and_prose_does_not(spark):
    rows = [(i, f"d{i}/f", f"some prose\n{t}\nmore prose") for i, t in enumerate(licences.TEMPLATES.values())]
    rows += [(100 + i, f"e{i}/f", "The license of the poet is under the version of the public, released.") for i in range(40)]
    found = {r.doc_id: r for r in licences.scan(files(spark, *rows)).collect()}
    for i, name in enumerate(licences.TEMPLATES):
        assert (found[i].licence, found[i].origin, found[i].line) == (name, "own", 2)
        assert abs(found[i].cosine - 1) < 1e-6
    assert {found[100 + i].licence for i in range(40)} == {None}


def test_nearest_ancestor_wins(spark):
    mit, gpl, cc = (licences.TEMPLATES[n] for n in ("MIT", "GPL-3.0", "CC-BY-NC-4.0"))
    rows = [
        (1, "a/LICENSE", mit), (2, "a/b/c/LICENSE", gpl), (3, "a/b/x.txt", "plain"),
        (4, "a/b/c/d/y.txt", "plain"), (5, "a/b/c/own.txt", f"plain\n{cc}\nplain"), (6, "z/q.txt", "plain"),
        (7, "top.txt", "plain"), (8, None, "plain"), (9, "a/b/none.txt", None), (9, "a/b/none.txt", None),
        (10, None, mit), (11, "ab/x", "plain"),
    ]
    rows += [(20 + i, f"w{i}/x", "license") for i in range(30)]
    found = licences.scan(files(spark, *rows))
    assert found.count() == len(rows)
    got = {r.doc_id: (r.licence, r.origin, r.licence_path) for r in found.collect()}
    assert got[3] == got[9] == ("MIT", "inherited", "a/LICENSE")
    assert got[4] == ("GPL-3.0", "inherited", "a/b/c/LICENSE")
    assert got[5] == ("CC-BY-NC-4.0", "own", "a/b/c/own.txt")
    assert got[6] == got[7] == got[8] == got[11] == (None, "none", None)
    assert got[10] == ("MIT", "own", None)


def test_root_licence_and_empty_table(spark, awkward, empty):
    rows = [(1, "LICENSE", licences.TEMPLATES["MIT"]), (2, "a/b/x", "plain")]
    rows += [(3 + i, "c/y", "plain") for i in range(8)]
    got = {r.doc_id: r.origin for r in licences.scan(files(spark, *rows)).collect()}
    assert got[2] == got[5] == "inherited"
    path = awkward.selectExpr("*", "source as path")
    assert licences.scan(path).count() == awkward.count()
    assert licences.scan(empty.selectExpr("*", "source as path")).count() == 0


def test_common_notices_and_small_tables_count(spark):
    mit = licences.TEMPLATES["MIT"]
    rows = [(i, f"d{i % 9}/f{i}", mit if i % 3 == 0 else f"plain{i}") for i in range(90)]
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scan(files(spark, *rows)).collect()}
    assert {got[i] for i in range(0, 90, 3)} == {("MIT", "own")}
    assert {got[i][0] for i in range(90) if i % 9 in (1, 2)} == {None}
    pair = [(1, "a/LICENSE", mit), (2, "a/b/x", "plain")]
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scan(files(spark, *pair)).collect()}
    assert got == {1: ("MIT", "own"), 2: ("MIT", "inherited")}
    assert [r.licence for r in licences.scan(files(spark, *pair[:1])).collect()] == ["MIT"]


def test_wrapped_notices_in_texts_of_every_length(spark):
    prose = "\n".join(f"words{i} of the{i} story told{i}" for i in range(600))
    head = "# Licensed\n# under the\n#\n# Apache License,\n# Version 2.0."
    rows = [(1, "a/x", f"{head}\n{prose}"), (2, "b/x", f"{prose}\n{head}\n{prose}"), (3, "c/x", f"{head}"), (4, "d/x", prose)]
    # One word on each line, and as one text with another notice.
    words = "\n".join(licences.TEMPLATES["LGPL-3.0"].split())
    rows += [(5, "e/x", f"{prose}\n{words}"), (6, "e/y", "plain")]
    got = {r.doc_id: r for r in licences.scan(files(spark, *rows)).collect()}
    assert [got[i].licence for i in (1, 2, 3)] == ["Apache-2.0"] * 3 and got[4].licence is None
    assert got[1].line == 1 and got[2].line == 601 and min(got[i].cosine for i in (1, 2, 3)) > 0.99
    assert (got[5].licence, got[6].licence, got[6].origin) == ("LGPL-3.0", "LGPL-3.0", "inherited")


def test_whole_licence_files_name_themselves(spark):
    full = licences.full_texts()
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "MIT"} <= set(full) <= set(licences.TEMPLATES)
    # Without line ends, so that no line alone is a notice.
    rows = [(i, f"{name}/LICENSE", " ".join(text.split())) for i, (name, text) in enumerate(full.items())]
    rows += [(100, "GPL-3.0/a/b.txt", "plain")] + [(101 + i, f"z{i}/p", f"some other words{i} of the story") for i in range(50)]
    got = {r.doc_id: r.licence for r in licences.scan(files(spark, *rows)).collect()}
    assert [got[i] for i in range(len(full))] == list(full)
    assert got[100] == "GPL-3.0" and {got[101 + i] for i in range(50)} == {None}


def test_no_unit_is_passed_over_that_reaches_the_cosine(monkeypatch):
    rng = np.random.default_rng(3)
    terms = licences.terms_of(licences.TEMPLATES)
    weights = licences.weigh(terms, 1000, rng.integers(1, 900, len(terms.words)))
    pool = np.append(terms.words[terms.counts[:, 0] > 0], np.arange(3, dtype=np.uint64))
    unit = np.sort(rng.integers(0, 3000, 30000))
    hashes = pool[np.minimum(rng.integers(0, len(pool) + 4, len(unit)), len(pool) - 1)]
    best, cosine = licences.best_match(weights, unit, hashes, 3000)
    monkeypatch.setattr(licences, "may_match", lambda weights, known, others: known > 0)
    all_best, all_cosine = licences.best_match(weights, unit, hashes, 3000)
    high = all_cosine >= licences.MIN_COSINE
    assert high.sum() > 20 and (cosine[high] == all_cosine[high]).all() and (best[high] == all_best[high]).all()


def test_slices_of_runs_give_what_one_comparison_gives(monkeypatch):
    short = licences.terms_of(licences.TEMPLATES)
    weights = licences.weigh(short, 50, np.ones(len(short.words)))
    rng = np.random.default_rng(3)
    hashes = np.where(rng.random(4000) < 0.7, rng.choice(short.words, 4000), rng.integers(1, 99, 4000).astype(np.uint64))
    begin = np.sort(rng.integers(0, 3900, 600))
    end = begin + rng.integers(1, 40, 600)
    unit = np.repeat(np.arange(600), end - begin)
    inner = np.concatenate([np.arange(a, b) for a, b in zip(begin, end)])
    best, cosine = licences.best_match(weights, unit, hashes[inner], 600)
    for size in (1, 50, 10**6):
        monkeypatch.setattr(licences, "SLICE_WORDS", size)
        parts = list(licences._matched(weights, hashes, begin, end))
        hit = np.concatenate([p[0] for p in parts])
        assert hit.tolist() == np.flatnonzero(cosine >= licences.MIN_COSINE).tolist() and len(hit)
        assert np.concatenate([p[1] for p in parts]).tolist() == best[hit].tolist()
        assert np.allclose(np.concatenate([p[2] for p in parts]), cosine[hit])


def test_long_texts_of_notices(spark):
    """Half a million words, each line a notice; the runs of lines must not be held at once."""
    mit = licences.TEMPLATES["MIT"]
    rows = [(1, "a/x", f"{mit}\n" * 100_000), (2, "b/y", "plain\n" * 50_000 + mit), (3, "c/z", "plain")]
    got = {r.doc_id: (r.licence, r.line) for r in licences.scan(files(spark, *rows)).collect()}
    assert got == {1: ("MIT", 1), 2: ("MIT", 50_001), 3: (None, None)}


def test_words_of_a_long_text_hash_as_those_of_a_short_one():
    from tradewatch.llm import words as W

    rng = np.random.default_rng(5)
    text = b" ".join(b"w%d" % i for i in rng.integers(0, 500, 600_000)) + b" " + b"q" * 3_000_000
    whole = W.Chunk(0, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    found = W.hash_words(whole, W.SPACED)
    short = W.hash_words(licences._chunk([" ".join(f"w{i}" for i in range(500))]), W.SPACED)
    long = W.hash_words(licences._chunk(["q" * 3_000_000]), W.SPACED)
    known = {f"w{i}": h for i, h in enumerate(short.hash.tolist())} | {"q" * 3_000_000: long.hash[0]}
    assert [known[w] for w in text.decode().split(" ")] == found.hash.tolist()
