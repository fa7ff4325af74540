"""Token ids in binary files, small for frequent ids.

Ids are counted over all documents and replaced by their frequency rank. Ranks are written in
one to four bytes; the lengths of four ranks share one control byte, and control bytes lie
apart from data bytes, so that decoding is numpy table lookup without a branch per id.

A file is a row of blocks of bounded size:

    magic "TKB1", documents in the block u32, ids u32, data bytes u32
    doc_id i64 each; flags u8 each (1: no doc_id, 2: goes on a document of the block before)
    number of ids u32 each; control bytes; data bytes

Documents lie in ascending doc_id order over all files; those without an id come first, ties
by a hash of the text. Null and empty texts are the end id alone.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logledger.llm import blobs
from logledger.llm.staging import stored, text_batches
from logledger.llm.tokens import encoded
from logledger.sources.files import shared_folder

MAGIC = b"TKB1"
#: Ids in a block at most.
BLOCK = 1 << 18
_HEAD = struct.Struct("<4sIII")
_NO_ID, _CONTINUED = 1, 2
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def encode(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of an array of numbers below 2^32."""
    values = ranks.astype("<u4")
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    more = codes[: len(values)]
    more += values > 0xFF
    more += values > 0xFFFF
    more += values > 0xFFFFFF
    of_four = codes.reshape(-1, 4)
    control = of_four[:, 0] | of_four[:, 1] << 2 | of_four[:, 2] << 4 | of_four[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= more[:, None]
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode(control: bytes, data: bytes, count: int) -> np.ndarray:
    size = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:count]
    ends = np.cumsum(size)
    source = np.frombuffer(data + b"\0\0\0", np.uint8)
    starts = ends - size
    values = source[starts].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        values[more] |= source[starts[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


class Writer:
    """Collects documents and writes a block whenever one is full."""

    def __init__(self, out: BinaryIO):
        self.out = out
        self.docs: list[tuple[int, int, int]] = []
        self.ranks: list[np.ndarray] = []
        self.held = 0
        self.n_docs = self.n_ids = 0

    def add(self, doc_id: int | None, ranks: np.ndarray) -> None:
        self.n_docs += 1
        self.n_ids += len(ranks)
        flags = 0 if doc_id is not None else _NO_ID
        while True:
            part, ranks = ranks[: BLOCK - self.held], ranks[BLOCK - self.held :]
            self.docs.append((doc_id or 0, flags, len(part)))
            self.ranks.append(part)
            self.held += len(part)
            if self.held == BLOCK:
                self.flush()
            if not len(ranks):
                return
            flags |= _CONTINUED

    def flush(self) -> None:
        if not self.docs:
            return
        control, data = encode(np.concatenate(self.ranks))
        ids, flags, counts = (np.array(x) for x in zip(*self.docs, strict=True))
        self.out.write(_HEAD.pack(MAGIC, len(self.docs), self.held, len(data)))
        self.out.write(ids.astype("<i8").tobytes() + flags.astype(np.uint8).tobytes())
        self.out.write(counts.astype("<u4").tobytes() + control)
        self.out.write(data)
        self.docs, self.ranks, self.held = [], [], 0


def blocks(source: BinaryIO) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, flags, counts, ranks) of each block."""
    while head := source.read(_HEAD.size):
        magic, n_docs, n_ids, n_data = _HEAD.unpack(head)
        if magic != MAGIC:
            raise ValueError("not a block of token ids")
        ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        flags = np.frombuffer(source.read(n_docs), np.uint8)
        counts = np.frombuffer(source.read(4 * n_docs), "<u4").astype(np.int64)
        control = source.read(-(-n_ids // 4))
        yield ids, flags, counts, decode(control, source.read(n_data), n_ids)


def documents(source: BinaryIO, by_rank: np.ndarray) -> Iterator[tuple[int | None, Iterable[np.ndarray]]]:
    """(doc_id, its ids in pieces) in file order; pieces must be used up in turn."""
    waiting = None
    for ids, flags, counts, ranks in blocks(source):
        found = by_rank[ranks].astype("<u4")
        ends = np.cumsum(counts)
        for k in range(len(ids)):
            piece = found[ends[k] - counts[k] : ends[k]]
            if flags[k] & _CONTINUED:
                waiting[1].append(piece)
                continue
            if waiting:
                yield waiting
            waiting = (None if flags[k] & _NO_ID else int(ids[k]), [piece])
    if waiting:
        yield waiting


_ENCODED = "part int, nth bigint, doc_id bigint, ids binary"
_FILES = "part int, nth bigint, path string, n_docs bigint, n_ids bigint"


def _encode_task(path: str | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, nth = TaskContext.get().partitionId(), 0
    for batch, found in encoded(path, batches):
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, part, np.int32)),
                pa.array(np.arange(nth, nth + n)),
                batch["doc_id"],
                pa.array(found, pa.binary()),
            ],
            ["part", "nth", "doc_id", "ids"],
        )
        nth += n


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for batch in batches:
        # The ids of all documents of a batch lie one after the other.
        own = np.bincount(np.frombuffer(b"".join(batch["ids"].to_pylist()), "<u4"))
        if len(own) > len(total):
            own[: len(total)] += total
            total = own
        else:
            total[: len(own)] += own
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])


def _write_task(folder: str, rank_of: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A file per unbroken run of documents: a task may get several parts, or half of one."""
    now, last = None, (None, None)

    def close() -> pa.RecordBatch:
        out, writer, path, first = now
        writer.flush()
        out.close()
        row = [*first, path, writer.n_docs, writer.n_ids]
        names = [c.split()[0] for c in _FILES.split(", ")]
        kinds = [pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("part", "nth", "doc_id"))
        for part, nth, doc_id, ids in zip(*columns, batch["ids"], strict=True):
            if (part, nth) != (last[0], (last[1] or 0) + 1) or now is None:
                if now:
                    yield close()
                path = blobs.new_name(folder, "tokens")
                out = blobs.create(path)
                now = (out, Writer(out), path, (part, nth))
            now[1].add(doc_id, rank_of[np.frombuffer(ids.as_buffer(), "<u4")])
            last = (part, nth)
    if now:
        yield close()


def write_token_files(docs: DataFrame, tokenizer: str | None = None) -> tuple[DataFrame, np.ndarray]:
    """Writes the files; returns their list (part, nth, path, n_docs, n_ids, start), in the
    order of (part, nth), and the table of ids by rank (as long as the vocabulary)."""
    spark = docs.sparkSession
    text_batches(spark)
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("tie"))
    # The range cuts ties by the hash too: rows without an id spread over many tasks.
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ids = stored(
        rows.select("doc_id", "text").mapInArrow(partial(_encode_task, tokenizer), _ENCODED), "ids"
    )
    counts = ids.select("ids").mapInArrow(_count_task, "id bigint, n bigint")
    counts = counts.groupBy("id").agg(F.sum("n").alias("n")).collect()
    by_rank = np.array([r.id for r in sorted(counts, key=lambda r: (-r.n, r.id))], np.uint32)
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    folder = shared_folder(spark, "token-files")
    files = stored(ids.mapInArrow(partial(_write_task, folder, rank_of), _FILES), "token-list")
    # One row per file: a single task adds them up.
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    return stored(files.select("*", start), "token-list"), by_rank


_READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def _read_task(by_rank: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
            rows: tuple[list, ...] = ([], [], [], [])
            with blobs.read(path) as source:
                for doc_id, pieces in documents(source, by_rank):
                    crc, n = 0, 0
                    for piece in pieces:
                        crc, n = zlib.crc32(piece.tobytes(), crc), n + len(piece)
                    for column, value in zip(rows, (doc_id, start, n, crc), strict=True):
                        column.append(value)
                    start += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in rows], [c.split()[0] for c in _READ.split(", ")]
            )


def read_token_files(files: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """Per document, from the files: doc_id, start (ids before it), n_tokens, ids_crc32."""
    # As many tasks as files, within reason: sizes of the list say nothing of the files'.
    tasks = min(max(1, files.count()), 10_000)
    spread = files.select("path", "start").repartition(tasks, "path")
    return spread.mapInArrow(partial(_read_task, by_rank), _READ)


def token_file_digest(docs: DataFrame) -> DataFrame:
    return read_token_files(*write_token_files(docs))
