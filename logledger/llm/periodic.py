"""Periodic runs of words: stretches whose words repeat with a period, four times or more.

A run is a stretch with smallest period q (words q apart are the same) of at least
``max(6, 4 * q)`` words that no neighbouring word extends. Runs are found without suffix arrays:

1. The words of a batch of documents, each between marks found nowhere else, are compressed to
   a run-length grammar by recompression (``grammar``).
2. A run with period q is at least 4q long, so of the places 0, 3q, 6q, ... one has itself and its
   partner q further on inside the run. These places for all q are a harmonic grid: n/3 * ln(n)
   pairs for n words. Pairs of unequal words are left out.
3. Extensions to both sides, read from the grammar, give the whole stretch around a pair. A
   stretch is found with multiples of its period too; the smallest is its period.

Each document is judged by itself in its task, with no shuffle. Memory is some 100 bytes a word
of a batch, or of one document longer than a batch.

Null and empty texts have no words and no runs. Repeated rows are judged each, ids may be null,
other columns are not looked at; an empty table gives an empty result. Runs of equal length are
all kept, in order of start, then period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.grammar import Extensions, compress, mirrored
from logledger.llm.staging import text_batches

LEAST, TIMES = 6, 4
#: Words compressed together; pairs of places looked at together.
BATCH_WORDS = 1 << 18
PAIRS = 1 << 21


def _grid(sizes: np.ndarray, bases: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of (place, period) of all documents, ``PAIRS`` or one document's period at a time."""
    periods = sizes // TIMES
    period = np.arange(periods.sum()) - np.repeat(np.cumsum(periods) - periods, periods) + 1
    size, base = np.repeat(sizes, periods), np.repeat(bases, periods)
    step = (TIMES - 1) * period
    counts = -(-(size - period) // step)
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        before = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
        own = counts[at:to]
        turn = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield np.repeat(base[at:to], own) + turn * np.repeat(step[at:to], own), np.repeat(period[at:to], own)
        at = to


def runs(documents: list[list]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start, period. Documents are
    lists of words of any kind."""
    names: dict = defaultdict()
    names.default_factory = names.__len__
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    bases = np.cumsum(sizes + 1) - sizes
    sequence = np.empty(int(sizes.sum()) + len(documents) + 1, np.int64)
    for words, base in zip(documents, bases.tolist(), strict=True):
        sequence[base : base + len(words)] = [names[w] for w in words]
    marks = np.append(bases - 1, len(sequence) - 1)
    sequence[marks] = len(names) + np.arange(len(marks))
    rounds = compress(sequence)
    ahead, back = Extensions(rounds), Extensions(mirrored(rounds))
    found = [np.zeros((0, 3), np.int64)]
    for place, period in _grid(sizes, bases):
        equal = sequence[place] == sequence[place + period]
        place, period = place[equal], period[equal]
        # In the mirror the places before them, and what follows there.
        start = place - back.of(len(sequence) - place, len(sequence) - place - period)
        end = place + period + ahead.of(place, place + period)
        long = end - start >= np.maximum(LEAST, TIMES * period)
        found.append(np.stack([start[long], end[long], period[long]], axis=1))
    start, end, period = np.concatenate(found).T
    order = np.lexsort([period, end, start])
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort([period, start])
    start, end, period = start[order], end[order], period[order]
    document = np.searchsorted(bases, start, "right") - 1
    return document, start - bases[document], end - start, period


def collapsed(words: list, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list:
    """The words without those that a run holds after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, kept.tolist(), strict=True) if k]


_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUNS = f"doc_id bigint, runs array<{_RUN}>, collapsed string"


def _settled(ids: list, documents: list[list[bytes]]) -> pa.RecordBatch:
    document, start, length, period = runs(documents)
    first = np.searchsorted(document, np.arange(len(documents) + 1))
    texts = []
    for k, words in enumerate(documents):
        own = slice(first[k], first[k + 1])
        if first[k] < first[k + 1]:
            words = collapsed(words, start[own], length[own], period[own])
        texts.append(b" ".join(words).decode())
    each = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), each)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), lists, pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"]
    )


def _runs_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids: list = []
        documents: list[list[bytes]] = []
        held = 0
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            # Bytes are split at the six white-space characters of ASCII, and at no others.
            words = (text or "").encode().split()
            if ids and held + len(words) > BATCH_WORDS:
                yield _settled(ids, documents)
                ids, documents, held = [], [], 0
            ids.append(doc_id)
            documents.append(words)
            held += len(words)
        yield _settled(ids, documents)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed) of every document: its runs by start, then period, and its words,
    joined by spaces, without the repetitions."""
    text_batches(docs.sparkSession)
    return docs.selectExpr("cast(doc_id AS bigint) AS doc_id", "text").mapInArrow(_runs_task, _RUNS)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the contract's input. In a document with h % 10 = 0, where h is the CRC-32
    of its id, the words from number a on repeat with period p."""
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", (h % 10 == 0).alias("chosen"), F.floor(h / 10).alias("g"))
    own = own.withColumn("words", F.when(F.col("chosen"), words))
    own = own.withColumn("n", F.size("words").cast("bigint"))
    own = own.withColumn("a", F.expr("if(n > 0, g % n, 0)"))
    own = own.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))

    def at(i: Column) -> Column:
        place = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get(F.col("words"), place.cast("int"))

    repeated = F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), at))
    return own.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def periodic_digest(docs: DataFrame) -> DataFrame:
    found = periodic_runs(planted(docs))
    best = F.array_max(F.expr("transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period))"))
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
