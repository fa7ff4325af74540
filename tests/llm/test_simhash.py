import random

import numpy as np
import pytest
import xxhash

from logledger.llm import golay, simhash
from logledger.llm.components import components


def brute_fingerprint(text):
    words = bytes(
        b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()
    ).translate(bytes(32 if 9 <= b <= 13 else b for b in range(256))).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_golay_keys_meet_within_two_bits_and_are_few():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    other = words.copy()
    for _ in range(2):
        other ^= 1 << rng.integers(0, 23, len(words))
    mine, theirs = {}, {}
    for found, into in ((golay.keys(words), mine), (golay.keys(other), theirs)):
        for row, key in zip(*found, strict=True):
            into.setdefault(int(row), set()).add(int(key))
    assert all(mine[i] & theirs[i] for i in range(len(words)))
    assert {len(k) for k in mine.values()} <= {1, 6}


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "one TWO", "É a B c d", "a b c " * 50, "x\x00y z w v"]
)
def test_fingerprint(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_of_a_very_long_text():
    rng = random.Random(3)
    text = " ".join(rng.choice("abcdefghij") for _ in range(70_000))
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("paired", [64, 2])
def test_links_connect_what_is_within_two_bits(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(12):
            x = base
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            values.add(signed(x))
    values |= {0, -1, signed(1 << 63), signed((1 << 63) | 1)}
    frame = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = simhash.links(frame)
    near = [(a, b) for a in values for b in values if a < b and (a ^ b & -1) is not None
            and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2]
    got = {(r.a, r.b) for r in found.collect()}
    assert got <= set(near)
    assert roots(values, got) == roots(values, near)
    reached = {r.node: r.root for r in components(found).collect()}
    expected = {n: r for n, r in roots(values, near).items() if n != r}
    assert reached == expected


def test_components_of_a_long_chain_and_a_star(spark):
    order = list(range(60))
    random.Random(2).shuffle(order)
    pairs = list(zip(order, order[1:], strict=False)) + [(100, 100 + k) for k in range(1, 40)]
    frame = spark.createDataFrame(pairs + pairs + [(7, 7), (None, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {n: 0 for n in range(1, 60)} | {100 + k: 100 for k in range(1, 40)}
    assert components(frame.limit(0)).count() == 0


def test_documents(spark):
    rng = random.Random(9)
    long = [" ".join(rng.choice(["the", "of", "ab", "cd", "ef"]) + str(rng.randrange(40)) for _ in range(300)) for _ in range(4)]
    texts = [None, "", "Hi", "hi", long[0], long[0].upper(), long[0] + " end", long[1], long[2], long[3]]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(4, long[0], "x"), (None, long[1], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp string")
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    prints = [(i, brute_fingerprint(t)) for i, t, _ in rows]
    expected = []
    for i, f in prints:
        group, grew = {f}, True
        while grew:
            more = {g for _, g in prints if any(bin(g ^ x).count("1") <= 2 for x in group)}
            grew, group = not more <= group, group | more
        expected.append((i, f"{f:016x}", min(j for j, g in prints if g in group and j is not None)))
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(expected, key=key)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in expected})
    assert ids.count(None) == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
