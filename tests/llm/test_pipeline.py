"""The pipeline against its operators' brute force, on a small corpus with planted cases."""

import random
import zlib

import pytest

import corpus_pipeline
from logledger.llm import packing, tokens
from llm.test_edges import brute_hits, brute_stats
from llm.test_secrets import base_spans
from llm.test_similar import jaccard, shingles
from llm.test_simhash import roots


@pytest.fixture
def sf_dir(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["th", "er", "on", "an", "re", "ti"]) for _ in range(rng.randint(1, 5)))
    texts = [" ".join(word() for _ in range(rng.randint(25, 200))) for _ in range(40)]
    items = [(i, " ".join(word() for _ in range(14))) for i in range(5)]
    texts[3] += " " + items[2][1]
    texts[7] = texts[5] + " " + word()
    texts[8] = texts[5]
    texts[11] = "too short"
    texts[12] = "again and again " * 40
    texts[14] += " token=abcdefghijkl0123 and more"
    texts[20] = None
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    out = f"file:{tmp_path}"
    spark.createDataFrame(rows, schema).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{out}/benchmark.parquet")
    labels = [(i, int(i not in (11, 12)), 0) for i in range(0, 40, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out, rows, items


def test_pipeline(spark, sf_dir):
    folder, rows, items = sf_dir
    left = {}
    for doc_id, text, *_ in rows:
        n, *_, repeated = brute_stats(text)
        if n >= 20 and 100 * repeated <= 30 * n:
            left[doc_id] = text
    assert 11 not in left and 12 not in left and 20 not in left
    sets = {i: shingles(t) for i, t in left.items()}
    near = [(i, j) for i in left for j in left if i < j and jaccard(sets[i], sets[j]) >= 0.8]
    root = roots(left, near)
    left = {i: t for i, t in left.items() if root[i] == i}
    assert 5 in left and 7 not in left and 8 not in left
    left = {i: t for i, t in left.items() if not brute_hits(t, items)[1]}
    assert 3 not in left
    library = tokens.encoder(tokens.default_path()).library
    expected = {}
    for i, text in left.items():
        for start, _, end in reversed(base_spans(text)):
            text = text[:start] + "[SECRET]" + text[end:]
        ids = library.encode(text, add_special_tokens=False).ids + [0]
        raw = b"".join(x.to_bytes(4, "little") for x in ids)
        for start in range(0, len(ids), packing.CAPACITY):
            piece = raw[4 * start : 4 * (start + packing.CAPACITY)]
            expected[i, start] = (len(piece) // 4, zlib.crc32(piece), len(ids))
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id, r.start): (r.length, r.ids_crc32, r.doc_tokens) for r in got} == expected
    assert len(got) == len(expected)


def test_stages_keep_the_columns_and_take_empty_tables(spark, sf_dir):
    folder, *_ = sf_dir
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs.limit(0), folder)
        assert out.count() == 0
        assert number == 4 or out.columns == docs.columns
