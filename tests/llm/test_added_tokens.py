"""Token ids against the library as its file leaves it."""

import random

import numpy as np
import pytest

from logledger.llm import tokens

pytest.importorskip("public_tokenizers")
PARTS = ["a ", " the", ".", "\n", "<|endoftext|>", "<|endoftext|", "é", "  "]


def test_ids_equal_an_untouched_library():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_path())
    pieces = tokens.encoder(tokens.default_path())
    rng = random.Random(2)
    for text in ["<|endoftext|>", "x <|endoftext|> y"] + ["".join(rng.choices(PARTS, k=12)) for _ in range(500)]:
        own = np.frombuffer(tokens.document_ids(text, pieces), "<u4").tolist()
        assert own == library.encode(text, add_special_tokens=False).ids + [tokens.END], text
    assert 50256 in np.frombuffer(pieces.ids("<|endoftext|>"), "<u4")


def test_special_tokens_as_text_is_a_parameter():
    pieces = tokens.Pieces(tokens.default_path(), special_as_text=True)
    ids = np.frombuffer(pieces.ids("<|endoftext|>"), "<u4").tolist()
    assert 50256 not in ids and pieces.library.decode(ids) == "<|endoftext|>"
