"""Token counts against the untouched library."""

from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

from logledger.llm import token_counts as tc

SF = "/root/testdata/sf0.001"

ODD = [
    "",
    " ",
    "a",
    "It's we'RE I'LL 'sun 's't!!'s...",
    "<|endoftext|>",
    "hi<|endoftext|>there <|startoftext|> <|ENDOFTEXT|> <|endoftext",
    "a" * 3000,
    "abcdabcd" * 500 + " " + "x" * 50,
    "ab " * 200_000,
    "éé é İ ǅ x y K ſ ßẞ Σς ﬁ ŉ",
    "123 4²½ ٣",
    "中文 \U0001f600\U0001f469‍\U0001f469‍\U0001f467",
    "a\x00b\x01\x85\x1c\x1dq ᠎​﻿",
    "\tA\tB\r\nC\x0bD E",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tc.default_path())


def expected(library, doc_id, text) -> tuple:
    n = len(library.encode(text or "", add_special_tokens=False).ids)
    return doc_id, len((text or "").encode()), n, n > 2048


def rows(frame) -> list[tuple]:
    return sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in frame.collect()), key=str)


def test_given_table(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = [expected(library, r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(tc.token_counts(docs)) == sorted(want, key=str)


def test_odd_texts_and_edges(spark, library):
    texts = [*enumerate(ODD), (None, "a b"), (3, None), (4, "same"), (4, "same")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    docs = docs.selectExpr("doc_id", "text", "1 AS n_bytes", "'x' AS n_tokens")
    assert rows(tc.token_counts(docs)) == sorted((expected(library, *t) for t in texts), key=str)
    assert rows(tc.token_counts(docs.limit(0))) == []
    assert {r[3] for r in rows(tc.token_counts(docs, limit=0))} == {True, False}


def test_random_texts(library):
    pick = random.Random(12)
    ranges = [(32, 127), (32, 127), (0, 0x250), (0x2000, 0x2100), (0, 0xD800), (0x1F300, 0x1F700)]
    texts = ["".join(chr(pick.randrange(*pick.choice(ranges))) for _ in range(pick.randrange(40))) for _ in range(1500)]
    texts += ["".join(pick.choice("abct's' \n!é1") for _ in range(pick.randrange(60))) for _ in range(1500)]
    counts = tc.Counter(tc.default_path())
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counts.of(texts) == want


def test_bounded_memory_changes_nothing(monkeypatch, library):
    text = "one two <|endoftext|>three 中 four's 12 " * 30
    want = len(library.encode(text, add_special_tokens=False).ids)
    for name, value in (("BLOCK", 7), ("WAITING", 20), ("REMEMBERED", 2)):
        monkeypatch.setattr(tc, name, value)
    monkeypatch.setattr(tc.blocks, "__defaults__", (7,))
    assert tc.Counter(tc.default_path()).of([text, None, text]) == [want, 0, want]


def test_a_symbol_of_two_merges_is_refused(tmp_path):
    import json

    held = json.load(open(tc.default_path(), encoding="utf-8"))
    held["model"]["merges"] = [*held["model"]["merges"], held["model"]["merges"][0]]
    path = tmp_path / "two.json"
    path.write_text(json.dumps(held))
    with pytest.raises(ValueError):
        tc.Merges(str(path))
