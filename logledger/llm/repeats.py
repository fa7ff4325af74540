"""Exact repeated passages: bytes covered by a string of 100 bytes that also starts earlier.

The method is the column-wise construction of a collection's Burrows-Wheeler order: all strings
get one symbol per round, from the right; the order of their suffixes and the common prefixes
of neighbours are updated from those of the round before. Rounds are as many as the longest
string has symbols, and each goes over the whole collection, so on whole documents it would
take hundreds of thousands of passes. Here the collection is the set of *segments* that can
matter, 160 columns at most, and it is built batch by batch from a sorted table on disk.

1. Each window of 100 bytes is given to the smallest hash among its runs of 40 bytes, its
   anchor. Equal windows have equal anchors at equal places. Consecutive windows of one anchor
   are a segment.
2. Anchors that occur once in the corpus have no repeats. The others are marked in a bitmap of
   fixed size; a false mark costs work, not correctness.
3. Equal segments become one class with its earliest place. Classes of an anchor, aligned at
   it, go through the column-wise construction: windows are equal where neighbours in suffix
   order share 100 symbols. An anchor with more classes than a batch holds is resolved by
   grouping its windows by content instead, which splits over any number of tasks.
4. Windows of later places are removed; overlapping ones join to spans.

Order is by doc_id, then place. Null and empty texts have no bytes. Rows without an id come
last, rows that share one are ordered by a hash of the text, and rows that repeat both are one
document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import stored, text_batches

WINDOW = 100
ANCHOR = 40
#: Window starts an anchor can serve.
REACH = WINDOW - ANCHOR + 1
COLUMNS = REACH - 1 + WINDOW
#: Bits of the map of repeated anchors.
MAP_BITS = 27
#: Segments the construction takes at once; anchors with more classes are grouped by content.
BATCH = 20_000
#: Bytes of a text looked at in one step.
STEP = 1 << 20
BROADCAST_SPANS = 500_000
_PLACE = np.uint64((1 << 24) - 1)
_NONE = np.uint16(256)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random values of the bytes, powers of an odd base and of its inverse, modulo 2^64."""
    base = 0x9E3779B97F4A7C15
    n = STEP + WINDOW
    powers = [np.full(n, b, np.uint64) for b in (base, pow(base, -1, 1 << 64))]
    for p in powers:
        p[0] = 1
    values = np.random.default_rng(100).integers(0, 1 << 64, 256, np.uint64)
    return values, *(np.cumprod(p, dtype=np.uint64) for p in powers)


def _anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of each run of ANCHOR bytes."""
    values, power, inverse = _tables()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * power[: len(data)], out=sums[1:])
    found = (sums[ANCHOR:] - sums[:-ANCHOR]) * inverse[: len(data) - ANCHOR + 1]
    found ^= found >> np.uint64(33)
    found *= np.uint64(0xFF51AFD7ED558CCD)
    return found ^ found >> np.uint64(29)


def segments(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, anchor place, first window, number of windows) of each segment."""
    data = np.frombuffer(text, np.uint8)
    parts = []
    for base in range(0, len(data) - WINDOW + 1, STEP):
        hashes = _anchor_hashes(data[base : base + STEP + WINDOW - 1])
        # Of equal hashes the last one: its place counts down.
        least = (hashes & ~_PLACE) | (_PLACE - np.arange(len(hashes), dtype=np.uint64))
        have = 1
        while 2 * have <= REACH:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        if have < REACH:
            least = np.minimum(least[: have - REACH], least[REACH - have :])
        place = (_PLACE - (least & _PLACE)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        many = np.diff(first, append=len(place))
        at = place[first]
        parts.append((hashes[at].view(np.int64), at + base, first + base, many))
    if not parts:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _keys_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each anchor of a document; twice if it occurs more than once there."""
    for batch in batches:
        found = []
        for text in batch["text"].to_pylist():
            keys, counts = np.unique(segments((text or "").encode())[0], return_counts=True)
            found += [keys, keys[counts > 1]]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], ["key"])


def _map_of(keys: DataFrame) -> np.ndarray:
    """Bitmap of distinct keys: at most 2^MAP_BITS bits reach the driver."""
    bit = F.col("key").bitwiseAND((1 << MAP_BITS) - 1)
    words = keys.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")
    )
    table = words.toArrow()
    found = np.zeros(1 << (MAP_BITS - 6), np.uint64)
    found[table["word"].to_numpy()] = table["bits"].to_numpy().view(np.uint64)
    return found


#: ``place`` holds the anchor's place, the windows before it and their number (7 bits each).
_SEGMENTS = "key bigint, class bigint, place bigint, doc bigint, tie bigint"


def _segments_task(
    marked, with_content: bool, batches: Iterator[pa.RecordBatch]
) -> Iterator[pa.RecordBatch]:
    bitmap = marked.value
    names = [c.split()[0] for c in _SEGMENTS.split(", ")]
    kinds = [pa.int64()] * 5
    if with_content:
        names, kinds = [*names, "content"], [*kinds, pa.binary()]
    for batch in batches:
        rows: list[tuple] = []
        held = 0
        columns = (batch[c].to_pylist() for c in ("doc", "tie", "text"))
        for doc, tie, text in zip(*columns, strict=True):
            data = (text or "").encode()
            keys, place, first, many = segments(data)
            bits = keys.view(np.uint64) & np.uint64((1 << MAP_BITS) - 1)
            hit = bitmap[bits >> np.uint64(6)] >> (bits & np.uint64(63)) & np.uint64(1) > 0
            for key, at, start, n in zip(*(x[hit].tolist() for x in (keys, place, first, many)), strict=True):
                content = data[start : start + n - 1 + WINDOW]
                digest = hashlib.blake2b(bytes([at - start]) + content, digest_size=8).digest()
                name = int.from_bytes(digest, "little", signed=True)
                row = (key, name, at << 14 | (at - start) << 7 | n, doc, tie)
                rows.append((*row, content) if with_content else row)
                held += len(content)
                if held > 16 << 20:
                    yield _batch(rows, names, kinds)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, names, kinds)


def _batch(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low..high], ends included."""
    level = np.frexp(high - low + 1)[1] - 1
    found = np.empty(len(low), values.dtype)
    table, width = values, 1
    for k in range(int(level.max(initial=0)) + 1):
        if k:
            table, width = np.minimum(table[:-width], table[width:]), 2 * width
        own = level == k
        found[own] = np.minimum(table[low[own]], table[high[own] - width + 1])
    return found


def later_windows(group: np.ndarray, rel: np.ndarray, rank: np.ndarray, contents: list[bytes]) -> np.ndarray:
    """Column-wise construction over segments, sorted by group and aligned at their anchors.
    Per segment a bit for each of its windows that a segment of lower rank in its group has
    too."""
    size = len(contents)
    lengths = np.fromiter(map(len, contents), np.int64, size)
    left = REACH - 1 - rel.astype(np.int64)
    table = np.full((COLUMNS, size), _NONE, np.uint16)
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(size), lengths)
    column = np.arange(ends[-1]) - np.repeat(ends - lengths - left, lengths)
    table[column, row] = np.frombuffer(b"".join(contents), np.uint8)
    order = np.arange(size)
    common = np.zeros(size, np.int64)  # prefix shared with the neighbour before
    found = np.zeros(size, np.int64)
    family = group.astype(np.int64) * 257
    for number in range(COLUMNS - 1, -1, -1):
        # Insert one symbol of every segment: a stable sort by it keeps the order of the rest.
        symbol = table[number][order]
        key = family + symbol
        moved = np.argsort(key, kind="stable")
        before, after = moved[:-1], moved[1:]
        same = (key[before] == key[after]) & (symbol[after] != _NONE)
        shared = np.zeros(size, np.int64)
        shared[1:][same] = 1 + _range_minimum(common, before[same] + 1, after[same])
        order, common = order[moved], shared
        if number < REACH:
            new = common < WINDOW
            first = np.flatnonzero(new)
            own = rank[order]
            least = np.minimum.reduceat(own, first)[np.cumsum(new) - 1]
            late = order[own > least]
            found[late] |= np.int64(1) << (number - left[late])
    return found


_MASKS = "key bigint, class bigint, mask bigint"


def _masks_of(rows: list[tuple]) -> pa.RecordBatch:
    keys, names, rel, at, doc, tie, contents = zip(*rows, strict=True)
    group = np.cumsum(np.diff(np.array(keys, np.int64), prepend=keys[0]) != 0)
    rank = np.empty(len(rows), np.int64)
    rank[np.lexsort([np.array(x, np.int64) for x in (at, tie, doc)])] = np.arange(len(rows))
    masks = later_windows(group, np.array(rel), rank, list(contents))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(names, pa.int64()), pa.array(masks)], ["key", "class", "mask"]
    )


def _masks_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by anchor; whole anchors are taken until a batch is full."""
    rows: list[tuple] = []
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("key", "class", "rel", "at", "doc", "tie", "content"))
        for row in zip(*columns, strict=True):
            if len(rows) >= BATCH and row[0] != rows[-1][0]:
                yield _masks_of(rows)
                rows = []
            rows.append(row)
    if rows:
        yield _masks_of(rows)


_WINDOWS = "key bigint, class bigint, turn int, place int, window binary, doc bigint, tie bigint, at bigint"


def _windows_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _WINDOWS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = []
        columns = (batch[c].to_pylist() for c in ("key", "class", "rel", "at", "doc", "tie", "content"))
        for key, name, rel, at, doc, tie, content in zip(*columns, strict=True):
            for turn in range(len(content) - WINDOW + 1):
                window = hashlib.blake2b(content[turn : turn + WINDOW], digest_size=16).digest()
                rows.append((key, name, turn, turn - rel, window, doc, tie, at))
            if len(rows) > 50_000:
                yield _batch(rows, names, kinds)
                rows = []
        if rows:
            yield _batch(rows, names, kinds)


def _crowded_masks(classes: DataFrame) -> DataFrame:
    """The same masks by grouping windows of equal place and content."""
    windows = stored(classes.mapInArrow(_windows_task, _WINDOWS), "windows")
    first = windows.groupBy("key", "place", "window").agg(F.min(F.struct("doc", "tie", "at")).alias("least"))
    late = windows.join(first, ["key", "place", "window"]).filter(F.struct("doc", "tie", "at") > F.col("least"))
    return late.groupBy("key", "class").agg(F.bit_or(F.expr("shiftleft(1L, turn)")).alias("mask"))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, tie, text): doc and tie are never null and give the order. The tie is a
    hash of the text, and 0 if all ids are there and differ."""
    last = (1 << 63) - 1
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    plain = ids.groupBy("doc_id").count().filter("count > 1 OR doc_id IS NULL").isEmpty()
    doc_id = F.col("doc_id").cast("bigint")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(last)).alias("doc"),
        (F.lit(0).cast("bigint") if plain else F.xxhash64("text")).alias("tie"),
        "text",
    )


def _segments_of(rows: DataFrame, bitmap: np.ndarray, with_content: bool) -> DataFrame:
    marked = rows.sparkSession.sparkContext.broadcast(bitmap)
    schema = _SEGMENTS + ", content binary" * with_content
    texts = rows.select("doc", "tie", "text")
    return texts.mapInArrow(partial(_segments_task, marked, with_content), schema)


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc, tie, spans): maximal runs of bytes to remove, for documents that have any.
    ``rows`` comes from ``_identified``. The text is read three times, since that is cheaper
    than to shuffle it: bytes travel only for anchors with more than one class."""
    text_batches(rows.sparkSession)
    keys = rows.select("text").mapInArrow(_keys_task, "key bigint")
    twice = keys.groupBy("key").count().filter("count > 1")
    found = stored(_segments_of(rows, _map_of(twice), False), "segments")
    own = F.struct("doc", "tie", "place")
    classes = found.groupBy("key", "class").agg(F.min(own).alias("first"), F.count("*").alias("n"))
    classes = stored(classes, "classes")
    size = classes.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1")
    size = stored(size, "sizes")
    contents = _segments_of(rows, _map_of(size), True)
    contents = contents.groupBy("key", "class").agg(
        F.min(own).alias("first"), F.first("content").alias("content")
    )
    many = stored(
        contents.join(size, "key").select(
            "key",
            "class",
            F.expr("cast(shiftright(first.place, 7) & 127 as int)").alias("rel"),
            F.shiftright("first.place", 14).alias("at"),
            "first.doc",
            "first.tie",
            "content",
            "size",
        ),
        "contents",
    )
    few = many.filter(F.col("size") <= BATCH).repartition("key").sortWithinPartitions("key")
    masks = few.mapInArrow(_masks_task, _MASKS).unionByName(_crowded_masks(many.filter(F.col("size") > BATCH)))
    masks = stored(masks.filter("mask <> 0"), "masks")
    places = classes.filter("n > 1").select("key", "class", "first").join(masks, ["key", "class"], "full")
    # A class with one place and no mask has nothing to remove and is not in the table.
    marks = found.join(places, ["key", "class"]).select(
        "*",
        F.expr("shiftright(place, 14) - (shiftright(place, 7) & 127)").alias("start"),
        F.expr("cast(place & 127 as int)").alias("many"),
    )
    later = marks.filter(own > F.col("first")).select(
        "doc", "tie", "start", (F.col("start") + F.col("many") - 1 + WINDOW).alias("end")
    )
    bits = F.expr("filter(sequence(0, many - 1), i -> shiftright(mask, i) & 1 = 1)")
    earliest = marks.filter("mask IS NOT NULL").filter(F.col("first").isNull() | (own <= F.col("first"))).select(
        "doc", "tie", "start", F.explode(bits).alias("turn")
    )
    earliest = earliest.select("doc", "tie", (F.col("start") + F.col("turn")).alias("start"), (F.col("start") + F.col("turn") + WINDOW).alias("end"))
    joined = F.aggregate(
        F.sort_array(F.collect_set(F.struct("start", "end"))),
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda a, s: F.when(
            (F.size(a) > 0) & (s["start"] <= F.element_at(a, -1)["end"]),
            F.concat(
                F.slice(a, 1, F.size(a) - 1),
                F.array(
                    F.struct(
                        F.element_at(a, -1)["start"].alias("start"),
                        F.greatest(F.element_at(a, -1)["end"], s["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(a, F.array(s))),
    )
    return later.unionByName(earliest).groupBy("doc", "tie").agg(joined.alias("spans"))


_KEPT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _kept(text: str | None, spans: list[dict] | None) -> tuple[bytes, int]:
    data, at, parts = (text or "").encode(), 0, []
    for span in spans or ():
        parts.append(data[at : span["start"]])
        at = span["end"]
    return b"".join([*parts, data[at:]]), len(data)


def _kept_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        columns = (batch[c].to_pylist() for c in ("doc_id", "text", "spans"))
        for doc_id, text, spans in zip(*columns, strict=True):
            kept, size = _kept(text, spans)
            rows.append((doc_id, size, size - len(kept), len(spans or ()), hashlib.sha256(kept).hexdigest()))
        names = [c.split()[0] for c in _KEPT.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield _batch(rows, names, kinds) if rows else pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names)


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text, spans): every document with what is to be removed from it."""
    rows = _identified(docs)
    spans = stored(repeated_spans(rows), "spans")
    total = spans.agg(F.coalesce(F.sum(F.size("spans") + 1), F.lit(0))).first()[0]
    if total <= BROADCAST_SPANS:
        spans = F.broadcast(spans)
    return rows.join(spans, ["doc", "tie"], "left").select("doc_id", "text", "spans")


def repeats_digest(docs: DataFrame) -> DataFrame:
    return with_spans(docs).mapInArrow(_kept_task, _KEPT)
