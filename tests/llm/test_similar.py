"""Near-duplicates of the pipeline against brute force over all pairs."""

import random

import pytest

import corpus_pipeline
from logledger.llm import prefixes, simhash, similar
from llm.test_simhash import brute_fingerprint, roots


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus():
    """Texts with changed words in the middle, so that pairs lie on both sides of 0.8."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(base))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(1, max(2, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    chain = [rng.choice(words) for _ in range(150)]
    for _ in range(10):
        texts.append(" ".join(chain))
        chain = chain[8:] + [rng.choice(words) for _ in range(8)]
    return texts + [None, "", "one two", "One TWO", texts[0]]


def test_stage_keeps_one_of_each_component_at_four_fifths(spark):
    texts = corpus()
    order = list(range(len(texts)))
    random.Random(1).shuffle(order)
    rows = [(i, texts[k], "x") for i, k in enumerate(order)] + [(None, texts[0], "y")]
    sets = [shingles(texts[k]) for k in order]
    n = len(sets)
    near = [(i, j) for i in range(n) for j in range(i + 1, n) if jaccard(sets[i], sets[j]) >= 0.8]
    expected = roots(range(n), near)
    prints = [brute_fingerprint(texts[k]) for k in order]
    within_two_bits = [p for p in near if bin(prints[p[0]] ^ prints[p[1]]).count("1") <= 2]
    assert len(within_two_bits) < len(near) / 2
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, own string")
    got = {r.doc_id: r.component_id for r in similar.similar_documents(docs).collect() if r.doc_id is not None}
    assert got == expected
    kept = corpus_pipeline.near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values()))
    assert ids.count(None) == 1
    assert similar.similar_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("words,similarity", [(3, 0.5), (5, 0.95)])
def test_size_and_bound_are_parameters(spark, words, similarity):
    texts = [" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in [*range(37), 90, 91, 92])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ids = {r.component_id for r in similar.similar_documents(docs, words, similarity).collect()}
    assert len(ids) == (1 if similarity == 0.5 else 2)


def test_simhash_links_come_first_and_are_verified(spark, monkeypatch):
    """Without a round of MinHash, what SimHash finds by itself: sets whose fingerprints are at most
    two bits apart, if they are similar enough."""
    monkeypatch.setattr(similar, "ROUNDS", -1)
    texts = corpus()[:60] + [None]
    hashes = [similar.shingle_set(t) for t in texts]
    prints = [simhash.majority(h) for h in hashes]
    within = [(i, j) for i in range(61) for j in range(i + 1, 61) if bin(prints[i] ^ prints[j]).count("1") <= 2]
    near = [(i, j) for i, j in within if similar.similar_enough(hashes[i], hashes[j], 0.8)]
    assert near
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in similar.similar_documents(docs).collect()}
    assert got == roots(range(61), near)


@pytest.mark.parametrize("rounds", [0, 1])
def test_rounds_change_no_component(spark, monkeypatch, rounds):
    """All that pivots leave open is found by comparing those outside the largest component."""
    docs = spark.createDataFrame(list(enumerate(corpus())), "doc_id bigint, text string")
    usual = {tuple(r) for r in similar.similar_documents(docs).collect()}
    monkeypatch.setattr(similar, "ROUNDS", rounds)
    assert {tuple(r) for r in similar.similar_documents(docs).collect()} == usual


def many_variants():
    """One text in many variants: most are too different from each other, some in groups of
    their own, so that a large bucket stays in many components."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(120)]
    texts = []
    for _ in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 8)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        texts.append(" ".join(copy))
        if rng.random() < 0.3:
            texts.append(" ".join(copy[: len(copy) - rng.randint(1, 12)]))
    return texts


@pytest.mark.parametrize("similarity", [0.6, 0.8, 0.95])
def test_prefixes_bring_every_pair_within_the_bound(spark, similarity):
    sets = sorted({similar.shingle_set(t).tobytes() for t in [*many_variants(), *corpus(), "a b"]})
    sizes = [len(s) // 8 for s in sets]
    rows = [(bytes([k // 256, k % 256]), sizes[k], s) for k, s in enumerate(sets)]
    hashes = spark.createDataFrame(rows, "own binary, n int, hashes binary")
    # Every third set is inside; each is its own root but for the first five.
    where = [(r[0], r[1], rows[0][0] if k < 5 else r[0], k % 3 > 0) for k, r in enumerate(rows)]
    open_sets = spark.createDataFrame(where, "own binary, n int, root binary, outside boolean")
    found = prefixes.possible_pairs(open_sets, hashes, similarity).collect()
    got = {tuple(sorted((bytes(r.a), bytes(r.b)))) for r in found}
    assert len(got) == len(found)
    wanted = set()
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            apart = where[i][2] != where[j][2] and (where[i][3] or where[j][3])
            if apart and similar.similar_enough(sets[i], sets[j], similarity):
                wanted.add((rows[i][0], rows[j][0]))
    assert wanted and wanted <= got
    assert len(got) < len(rows) ** 2 / 8
    assert prefixes.possible_pairs(open_sets.limit(0), hashes, similarity).count() == 0


@pytest.mark.parametrize("rounds,direct", [(0, 1), (1, 1), (3, 32)])
def test_large_buckets_lose_no_link(spark, monkeypatch, rounds, direct):
    texts = many_variants()
    sets = [shingles(t) for t in texts]
    n = len(sets)
    near = [(i, j) for i in range(n) for j in range(i + 1, n) if jaccard(sets[i], sets[j]) >= 0.8]
    expected = roots(range(n), near)
    assert len(set(expected.values())) > 10
    monkeypatch.setattr(similar, "ROUNDS", rounds)
    monkeypatch.setattr(similar, "DIRECT", direct)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in similar.similar_documents(docs).collect()} == expected
