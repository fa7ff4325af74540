"""Packing of documents into training sequences by best-fit decreasing.

Documents are cut into full windows and a rest. Best-fit decreasing treats pieces of equal
length alike, so what it does to the whole corpus follows from one number per length: a
histogram of at most ``capacity`` rows, however many pieces there are. ``plan`` runs the
algorithm on that histogram: open windows of equal remaining capacity form groups, and a
segment tree over the remaining capacities finds the tightest group a length fits in. The
result says for each length which ranks go where; each piece then looks up its own place by
its rank among the pieces of its length. Ranks come from counts per written part, so nothing
is sorted or shuffled but counts, and a length that very many pieces share is no hot key.

Null and empty texts are documents of the end id alone. Repeated rows are packed once each;
ids may be null. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logledger.llm.staging import stored, text_batches
from logledger.llm.tokens import encoded

CAPACITY = 1024
#: A count table of up to this many rows (checked) is broadcast.
BROADCAST_ROWS = 1_000_000
_PIECES = "doc_id bigint, start bigint, length int, doc_tokens bigint, ids binary, part int, nth bigint"
_BATCH_BYTES = 8 << 20


def _cut(
    capacity: int, path: str | None, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    rows: list[tuple] = []
    held = 0

    def flush() -> pa.RecordBatch:
        names = [c.split()[0] for c in _PIECES.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )

    for batch, found in encoded(path, batches):
        for doc_id, ids in zip(batch["doc_id"].to_pylist(), found, strict=True):
            total = len(ids) // 4
            for start in range(0, total, capacity):
                length = min(capacity, total - start)
                own = ids[4 * start : 4 * (start + length)]
                rows.append((doc_id, start, length, total, own, part, int(seen[length])))
                seen[length] += 1
                held += len(own)
                if held > _BATCH_BYTES:
                    yield flush()
                    rows, held = [], 0
    if rows:
        yield flush()


class TightestFit:
    """Segment tree over remaining capacities 0..capacity: which of them have open windows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = np.zeros(2 * self.leaves, np.int64)

    def change(self, remaining: int, by: int) -> None:
        node = self.leaves + remaining
        while node:
            self.open[node] += by
            node >>= 1

    def at_least(self, length: int) -> int | None:
        """Smallest remaining capacity >= length with an open window."""
        node = self.leaves + length
        if self.open[node]:
            return length
        while node > 1:
            if not node & 1 and self.open[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node + (not self.open[2 * node])
                return node - self.leaves
            node >>= 1
        return None


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Best-fit decreasing over ``counts`` (pieces by length). A row says: of this length, the
    pieces from rank ``rank`` on go to windows ``sequence``, ``sequence + 1`` ..., ``each`` to
    a window, the first of them at ``offset``."""
    tree = TightestFit(capacity)
    groups: dict[int, list[tuple[int, int]]] = {}  # remaining -> (first sequence, how many)
    rows: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(remaining: int, first: int, many: int) -> None:
        if many:
            groups.setdefault(remaining, []).append((first, many))
            tree.change(remaining, 1)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            remaining = tree.at_least(length)
            if remaining is None:
                remaining = capacity
                many = -(-left // (capacity // length))
                first, opened = opened, opened + many
            else:
                first, many = groups[remaining].pop()
                tree.change(remaining, -1)
            # The window just used is the tightest for the next piece while one fits.
            each = remaining // length
            used = min(many, -(-left // each))
            placed = min(left, used * each)
            rows.append((length, rank, first, each, capacity - remaining))
            full, rest = divmod(placed, each)
            put(remaining - each * length, first, full)
            if rest:
                put(remaining - rest * length, first + full, 1)
            put(remaining, first + used, many - used)
            rank, left = rank + placed, left - placed
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "each", "offset"])


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, ids (little-endian 32-bit),
    sequence_id, offset."""
    text_batches(docs.sparkSession)
    pieces = stored(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
            partial(_cut, capacity, tokenizer), _PIECES
        ),
        "pieces",
    )
    by_part = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r[0]: r[1] for r in by_part.groupBy("length").agg(F.sum("n")).collect()}
    table = plan(counts, capacity)
    # Length and rank as one rising number; ranks of a length stay below 2^48.
    key = (table["length"].to_numpy(np.int64) << 48) + table["rank"].to_numpy(np.int64)
    order = np.argsort(key)
    key, rank, sequence, each, offset = (
        x[order] for x in (key, *(table[c].to_numpy(np.int64) for c in ("rank", "sequence", "each", "offset")))
    )

    @F.pandas_udf("sequence_id bigint, offset bigint")
    def place(length: pd.Series, own: pd.Series) -> pd.DataFrame:
        size, own = length.to_numpy(np.int64), own.to_numpy(np.int64)
        row = np.searchsorted(key, (size << 48) + own, "right") - 1
        window, inside = np.divmod(own - rank[row], each[row])
        return pd.DataFrame(
            {"sequence_id": sequence[row] + window, "offset": offset[row] + inside * size}
        )

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if by_part.count() <= BROADCAST_ROWS:
        starts = F.broadcast(starts)
    placed = pieces.join(starts, ["length", "part"]).withColumn(
        "at", place("length", F.col("before") + F.col("nth"))
    )
    return placed.select(
        "doc_id",
        "start",
        F.col("length").cast("bigint").alias("length"),
        "doc_tokens",
        "ids",
        F.col("at.sequence_id").alias("sequence_id"),
        F.col("at.offset").alias("offset"),
    )


def sequences(packed: DataFrame, capacity: int = CAPACITY, padding: int = 0) -> DataFrame:
    """The windows themselves: sequence_id, n_tokens, ids. Padded to ``capacity``, except where
    the tokens fill a power of two. A window holds at most ``capacity`` pieces."""
    rows = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"),
    )
    joined = F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    pad = F.lit(padding.to_bytes(4, "little").hex())
    whole = F.bit_count("n_tokens") == 1
    missing = F.when(whole, F.lit(0)).otherwise(capacity - F.col("n_tokens")).cast("int")
    return rows.select(
        "sequence_id", "n_tokens", F.concat(joined, F.unhex(F.repeat(pad, missing))).alias("ids")
    )


def packing_digest(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )
