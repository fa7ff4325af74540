import hashlib
import random

import numpy as np
import pytest

from logledger.llm import repeats as R


def brute(rows):
    """rows: (doc_id, text) with distinct ids -> expected result by doc_id."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            window = data[i : i + 100]
            if window in seen:
                gone[i : i + 100] = True
            seen.add(window)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc_id] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdé fgh") for _ in range(n))
    shared, other = text(130), text(400)
    texts = [text(rng.randint(0, 600)) for _ in range(8)]
    texts += [text(rng.randint(0, 90)) + shared + text(rng.randint(0, 90)) for _ in range(12)]
    texts += [text(50) + other[k : k + 150] + text(30) for k in range(0, 250, 20)]
    texts += [shared[:99], shared[:100], other, other, other + "x" + other, "", None, "a" * 450, "ab" * 300]
    texts += ["a" * 99, "a" * 100, "a" * 101, "xyz" * 70 + text(40) + "xyz" * 70, "é" * 120]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts, strict=True))


@pytest.mark.parametrize("batch", [20_000, 3])
def test_against_brute_force(spark, monkeypatch, batch):
    monkeypatch.setattr(R, "BATCH", batch)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id bigint, text string, doc int, key string")
    got = {r.doc_id: tuple(r)[1:] for r in R.repeats_digest(docs.repartition(3)).collect()}
    expected = brute(rows)
    for doc_id, row in expected.items():
        assert got[doc_id] == row, (doc_id, dict(rows)[doc_id])
    assert len(got) == len(rows)


def test_repeated_rows_and_missing_ids(spark):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(300))
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (0, None)], "doc_id bigint, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_removed) for r in R.repeats_digest(docs).collect())
    assert got == [(False, 0, 0), (False, 1, 0), (False, 1, 0), (True, None, 300)]
    assert R.repeats_digest(docs.limit(0)).count() == 0


def test_steps_of_a_long_text_make_no_difference(monkeypatch):
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcd") for _ in range(5000))
    windows = lambda found: [
        (int(k), int(a), s) for k, a, f, n in zip(*found, strict=True) for s in range(f, f + n)
    ]
    whole = windows(R.segments(text))
    assert [w[2] for w in whole] == list(range(len(text) - 99))
    monkeypatch.setattr(R, "STEP", 700)
    assert windows(R.segments(text)) == whole
