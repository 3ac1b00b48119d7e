import random
from itertools import combinations

from tradewatch.llm import near
from tradewatch.llm import words as W

import pyarrow as pa


def shingles(text):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else {()}


def similarity(a, b):
    return len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))


def families(seed, count, members):
    """Texts and edited copies of them: words replaced, put in, and parts cut off the end."""
    rng = random.Random(seed)
    texts = []
    for f in range(count):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(60, 400))]
        for m in range(members):
            copy = list(base)
            for _ in range(rng.randint(1, max(1, len(base) // 60))):
                at = rng.randrange(len(copy))
                copy[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(10**6)}"]
            if m % 3 == 2:
                copy = copy[: int(len(copy) * 0.93)]
            texts.append((f * members + m, " ".join(copy)))
    return texts


def class_of(frame, **more):
    return {r["rank"].doc_id: r["class"] for r in near.classes(frame, **more).collect()}


def test_recall_and_precision_against_brute_force(make_docs):
    texts = families(3, 80, 3)
    found = class_of(make_docs(*texts))
    alike = [(a, b) for (a, s), (b, t) in combinations(texts, 2) if similarity(s, t) >= 0.8]
    hit = sum(found[a] == found[b] for a, b in alike)
    assert len(alike) > 80 and hit >= 0.9 * len(alike)
    assert all(found[a] != found[b] for (a, s), (b, t) in combinations(texts, 2) if similarity(s, t) < 0.3)


def test_blocks_of_large_keys_give_the_same_classes(make_docs):
    base = " ".join(f"w{i}" for i in range(300))
    texts = [(i, f"{base} tail{i}") for i in range(150)] + families(4, 10, 2)[:20]
    texts = [(i, t) for i, (_, t) in enumerate(texts)]
    whole, cut = class_of(make_docs(*texts)), class_of(make_docs(*texts), block_rows=16)
    groups = lambda found: {frozenset(i for i in found if found[i] == c) for c in set(found.values())}
    assert groups(whole) == groups(cut)
    assert any(len(g) >= 150 for g in groups(whole))


def test_fingerprints_are_majorities():
    text = "One two three four five six one two three four five SEVEN"
    (chunk,) = W.chunks(pa.array([text, "a b", None]))
    segments, prints = near.fingerprints(chunk)
    found = W.hash_words(chunk, W.SPACED)
    first, gram = W.grams(found, 5)
    distinct = sorted(set(gram[found.row[first] == 0].tolist()))
    lane = W.mix(W.np.array(distinct, W.np.uint64) ^ near._LANE[0])
    bits = [sum(int(v) >> b & 1 for v in lane) * 2 > len(lane) for b in range(64)]
    assert int(prints[0, 0]) == sum(1 << b for b in range(64) if bits[b])
    assert prints[1].any() and not prints[2].any() and not segments[2].any()


def test_keep_one(spark, make_docs, awkward, empty):
    base = " ".join(f"w{i}" for i in range(200))
    docs = make_docs((5, base), (3, base + " more"), (None, base), (9, "else"), (9, "else"), (7, None), (8, " "))
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9]
    assert near.keep_one(empty).count() == 0
    again = near.keep_one(awkward)
    assert again.columns == awkward.columns
    assert sorted(r.doc_id for r in again.collect()) == [1, 3, 6, 7, 8]


def test_texts_are_shuffled_once_to_keep_one(make_docs):
    docs = make_docs((1, "a b c d e f"), (2, "a b c d e f"), (3, "other"))
    plan = near.keep_one(docs)._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2 and all("__hash" in line or "__kept" in line for line in shuffles)


def test_variants_are_not_shuffled_to_meet_sizes(spark, make_docs, monkeypatch):
    plans = []

    def record(links):
        plans.append(links._jdf.queryExecution().executedPlan().toString())
        return components(links)

    components = near.components
    monkeypatch.setattr(near, "components", record)
    near.classes(make_docs((1, "a b c"), (2, "a b c"), (3, "other"))).collect()
    assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" not in plans[0]
