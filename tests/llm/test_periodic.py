"""Periodic runs against brute force, and extensions from the grammar against direct comparison."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logledger.llm import grammar, periodic

SF = "/root/testdata/sf0.001"


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs: each period's stretches by direct comparison."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start
            while end + q < n and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(6, 4 * q):
                best.setdefault((start, end + q - start), q)
            start = end + 1
    return sorted(((s, size, q) for (s, size), q in best.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id: int | None, text: str | None) -> tuple:
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, size, q in found for i in range(s + q, s + size)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, kept)]
    best = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *best, *digests)


def rows(frame) -> list[tuple]:
    columns = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=str)


def test_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = sorted((brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()), key=str)
    assert rows(periodic.periodic_digest(docs)) == expected
    assert sum(r[1] for r in expected) > 10


def test_edges(spark):
    texts = [
        (None, "a a a a a a a"),
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "x y " * 4),
        (4, "x y " * 4),
        (5, "x y x y x y x"),
        (6, "a a a a a"),
        (7, "a " * 6 + "b b b b b b"),
        (8, "a\x1cb c " * 9),
        (9, "p q r " * 200),
        # ids the contract repeats, with many words and with one
        *((i, " ".join(f"v{j}" for j in range(i % 97 + 1))) for i in range(20, 220)),
    ]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    docs = docs.selectExpr("doc_id", "text", "'other' AS runs", "1 AS words", "2 AS n", "3 AS collapsed")
    assert rows(periodic.periodic_digest(docs)) == sorted((brute_row(*t) for t in texts), key=str)
    assert rows(periodic.periodic_digest(docs.limit(0))) == []


def test_very_long_texts(spark):
    rare = [f"w{i}" for i in range(300_000)]
    texts = [(1, "p q r " * 100_000), (2, " ".join(rare)), (3, " ".join(rare * 4))]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    assert {i: [tuple(x) for x in r.runs] for i, r in got.items()} == {
        1: [(0, 300_000, 3)],
        2: [],
        3: [(0, 1_200_000, 300_000)],
    }
    assert got[1].collapsed == "p q r" and got[2].collapsed == got[3].collapsed == " ".join(rare)


def test_general_output(spark):
    docs = spark.createDataFrame([(1, "s a b a b a b a b e")], "doc_id int, text string")
    row = periodic.periodic_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 8, 2)] and row.collapsed == "s a b e"


WORDS = st.one_of(
    st.lists(st.integers(0, 2), max_size=40),
    st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9), st.integers(0, 30)).map(
        lambda t: [*range(t[2] % 4), *(t[0] * t[1])[: max(1, t[2])], 9]
    ),
)


@settings(max_examples=200, deadline=None)
@given(st.lists(WORDS, min_size=1, max_size=5))
def test_runs(documents):
    got = [[] for _ in documents]
    for document, *run in zip(*(x.tolist() for x in periodic.runs(documents)), strict=True):
        got[document].append(tuple(run))
    assert got == [brute_runs(d) for d in documents]


@pytest.mark.parametrize("pairs", [1, 7])
def test_grid_in_parts(monkeypatch, pairs):
    document = [*"abcabcabcabcabcabc", *"xxxxxxxxx", *"abab"]
    whole = [x.tolist() for x in periodic.runs([document])]
    monkeypatch.setattr(periodic, "PAIRS", pairs)
    assert [x.tolist() for x in periodic.runs([document])] == whole


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40), st.booleans())
def test_extensions(symbols, turned):
    sequence = np.array([8, *symbols, 9])
    rounds = grammar.compress(sequence)
    if turned:
        rounds, sequence = grammar.mirrored(rounds), sequence[::-1]
    pairs = [(i, j) for i in range(1, len(sequence)) for j in range(i + 1, len(sequence))]
    one, other = np.array(pairs).T if pairs else (np.zeros(0, int),) * 2

    def direct(i: int, j: int) -> int:
        size = 0
        while j + size < len(sequence) and sequence[i + size] == sequence[j + size]:
            size += 1
        return size

    assert grammar.Extensions(rounds).of(one, other).tolist() == [direct(i, j) for i, j in pairs]
