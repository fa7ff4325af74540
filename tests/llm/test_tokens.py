import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from logledger.llm import packing, token_files, tokens

pytest.importorskip("public_tokenizers")
TEXTS = [
    None, "", "a", "Hello world.", "x  y\n\nz \n", "<|endoftext|> it's ß 中文 !", "word " * 5000,
    " ".join(str(i) for i in range(3000)), "same", "same",
]


def whole(text):
    library = tokens.encoder(tokens.default_path()).library
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def test_pieces_equal_whole_texts():
    pieces = tokens.Pieces(tokens.default_path())
    rng = random.Random(4)
    parts = list("ab 's\n.,!'\t é²ß1_  \0中") + ["'ll", " the", "<|endoftext|>", "\r\n", "ſ", "Ω", "_x"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert tokens.document_ids(text, pieces) == whole(text).tobytes(), ascii(text)


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    pieces = tokens.Pieces(tokens.default_path())
    for text in TEXTS * 2:
        assert tokens.document_ids(text, pieces) == whole(text).tobytes()


def naive_best_fit(lengths, capacity):
    room = []
    for x in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(room) if r >= x]
        if fits:
            room[min(fits)[1]] -= x
        else:
            room.append(capacity - x)
    return room


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 16, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
    counts = {x: lengths.count(x) for x in set(lengths)}
    table = packing.plan(counts, capacity)
    fill = {}
    for length, n in counts.items():
        rows = table[table["length"] == length].sort_values("rank").to_dict("records")
        for rank in range(n):
            row = [r for r in rows if r["rank"] <= rank][-1]
            window, inside = divmod(rank - row["rank"], row["each"])
            fill.setdefault(row["sequence"] + window, []).append(
                (row["offset"] + inside * length, length)
            )
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(capacity - sum(x for _, x in p) for p in fill.values()) == sorted(
        naive_best_fit(lengths, capacity)
    )
    assert sorted(fill) == list(range(len(fill)))


def docs_frame(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, "Hello world.", "x", 1), (None, "b", None, 2)]
    schema = "doc_id bigint, text string, length string, part int"
    return rows, spark.createDataFrame(rows, schema)


def test_packing(spark):
    rows, docs = docs_frame(spark)
    packed = packing.pack(docs)
    got = packed.collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append((r.start, bytes(r.ids), r.length, r.doc_tokens))
    for doc_id in {r[0] for r in rows}:
        texts = [r[1] for r in rows if r[0] == doc_id]
        ids = whole(texts[0]).tobytes()
        own = sorted(pieces[doc_id])[:: len(texts)]
        assert b"".join(p[1] for p in own) == ids
        assert all(p[3] == len(ids) // 4 and 4 * p[2] == len(p[1]) for p in own)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    made = packing.sequences(packed).collect()
    assert sorted(r.sequence_id for r in made) == sorted(by_sequence)
    for r in made:
        n = r.n_tokens
        assert len(r.ids) == 4 * (n if n & (n - 1) == 0 else 1024)
    assert packing.packing_digest(docs.limit(0)).count() == 0


def test_codec_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = rng.integers(0, 1 << 32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)
        control, data = token_files.encode(values)
        assert len(control) == -(-n // 4)
        assert (token_files.decode(control, data, n) == values).all()


def test_blocks_of_bounded_size(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 10)
    rng = np.random.default_rng(2)
    own = [(k if k % 3 else None, rng.integers(0, 500, rng.integers(1, 45))) for k in range(40)]
    out = io.BytesIO()
    writer = token_files.Writer(out)
    for doc_id, ranks in own:
        writer.add(doc_id, ranks)
    writer.flush()
    out.seek(0)
    assert max(len(b[3]) for b in token_files.blocks(out)) <= 10
    out.seek(0)
    by_rank = np.arange(500, dtype=np.uint32)
    read = [(d, np.concatenate(p).tolist()) for d, p in token_files.documents(out, by_rank)]
    assert read == [(d, r.tolist()) for d, r in own]


def test_token_files(spark):
    rows, docs = docs_frame(spark)
    got = sorted(token_files.token_file_digest(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, 0, 1, 2, 3, 3, 4, 5, 6, 7, 8, 9]
    texts = {r[0]: r[1] for r in rows}
    at = 0
    for r in got:
        ids = whole(texts[r.doc_id])
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert token_files.token_file_digest(docs.limit(0)).count() == 0


def test_ids_are_counted_once_a_batch(monkeypatch):
    """Not once a document: each count is as long as the vocabulary."""
    calls, bincount = [], np.bincount
    monkeypatch.setattr(token_files.np, "bincount", lambda ids: calls.append(len(ids)) or bincount(ids))
    docs = [[7, 7, 0], [0], [50_000, 7, 0]]
    column = pa.array([np.array(d, "<u4").tobytes() for d in docs], pa.binary())
    batches = iter([pa.RecordBatch.from_arrays([column], ["ids"])] * 2)
    (found,) = token_files._count_task(batches)
    assert found.to_pydict() == {"id": [0, 7, 50_000], "n": [6, 6, 2]}
    assert calls == [7, 7]
