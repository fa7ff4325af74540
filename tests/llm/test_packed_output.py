"""The pipeline's output holds the tokens, from which the training sequences follow."""

import numpy as np
import pytest

import corpus_pipeline
from logledger.llm import packing, tokens

pytest.importorskip("public_tokenizers")


def test_packed_pieces_hold_their_ids(spark):
    texts = [None, "Hello world.", "word " * 1500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = corpus_pipeline.packing(spark, docs, "")
    pieces = {i: b"" for i in range(len(texts))}
    for r in sorted(out.collect(), key=lambda r: r.start):
        pieces[r.doc_id] += bytes(r.ids)
    encoder = tokens.encoder(tokens.default_path())
    assert pieces == {i: tokens.document_ids(t, encoder) for i, t in enumerate(texts)}
    whole = packing.sequences(out).collect()
    assert sum(r.n_tokens for r in whole) == sum(len(np.frombuffer(p, "<u4")) for p in pieces.values())
