"""Near-duplicates by SimHash: fingerprints of 64 bits, linked at two or fewer differing bits.

Candidates come from Golay-code fuzzy hashing. A fingerprint is cut into segments of 23, 23
and 18 bits. Of three segments with two differing bits at most one has none, and in any other
segment the bits differ in two places at most, where Golay keys always meet. So each
fingerprint gets keys (exact segment, Golay key of another one), at most 18, and linked
fingerprints share at least one.

Only distinct fingerprints are compared; copies join their class by its fingerprint. Buckets
of up to ``PAIRED`` fingerprints are compared pair by pair. Larger ones are resolved through
midpoints, also exactly: fingerprints are at most 2 bits apart if and only if some word is
within 1 bit of both. Each fingerprint names the 65 words within 1 bit of it; no more than 65
distinct fingerprints can name the same word, so no group is large, however many copies.

Null and empty texts have fingerprint zero and are linked like any other. Rows without doc_id
take part and get the component of their fingerprint. Repeated rows are copies.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logledger.llm import golay
from logledger.llm.components import components
from logledger.llm.staging import discard, free_name, if_small, stored, text_batches

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Up to this many fingerprints a bucket is compared pair by pair; beyond, by midpoints.
PAIRED = 64
_STEP = 65_536
_BIT = np.arange(64, dtype=np.uint64)


def fingerprint(text: str | None) -> int:
    """SimHash of the lower-cased text's word shingles, as an unsigned number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles: Iterable[bytes] = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(SHINGLE)], strict=False))
    return majority(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the 64-bit hashes have, as an unsigned number."""
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), _STEP):
        block = hashes[start : start + _STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((1 << _BIT[2 * ones > len(hashes)]).sum(dtype=np.uint64))


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t) for t in batch["text"].to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(found.view(np.int64))], ["doc_id", "fp"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""
    text_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_fingerprints, "doc_id bigint, fp bigint")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signed = batch["fp"].to_numpy()
        fps = signed.view(np.uint64)
        mask = np.uint64((1 << 23) - 1)
        first, second, third = fps & mask, fps >> np.uint64(23) & mask, fps >> np.uint64(46)
        for family, (exact, fuzzy) in enumerate(
            ((first, second), (second, first), (third, first))
        ):
            rows, code = golay.keys(fuzzy)
            key = (family << 60) | (exact[rows].astype(np.int64) << 12) | code.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(signed[rows])], ["key", "fp"])


def links(distinct: DataFrame) -> DataFrame:
    """(a, b) for distinct fingerprints ``fp``: enough links at MAX_BITS bits or fewer to
    connect all that are connected. In small buckets it is every such pair."""
    keyed = stored(distinct.mapInArrow(_keys, "key bigint, fp bigint"), "keys")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    both = keyed.join(shared, "key")
    bucket = both.filter(F.col("n") <= PAIRED).groupBy("key").agg(F.collect_list("fp").alias("f"))
    pairs = (
        bucket.select(F.explode("f").alias("a"), "f")
        .select("a", F.explode("f").alias("b"))
        .filter("a < b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
    )
    flips = [0] + [1 << i for i in range(63)] + [-(1 << 63)]
    near = F.array(*[F.lit(x).cast("bigint") for x in flips])
    crowded = both.filter(F.col("n") > PAIRED).select("fp").distinct()
    named = crowded.select("fp", F.explode(near).alias("flip")).select(
        F.col("fp").bitwiseXOR(F.col("flip")).alias("middle"), "fp"
    )
    first = named.groupBy("middle").agg(
        F.min("fp").alias("a"), F.collect_list("fp").alias("all"), F.count("*").alias("n")
    )
    through = first.filter("n > 1").select("a", F.explode("all").alias("b")).filter("a <> b")
    found = stored(pairs.unionByName(through).distinct(), "fingerprint-links")
    discard(keyed)
    return found


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (16 hex digits), component_id (smallest
    doc_id reachable over links, itself included) and its own number of copies."""
    rows = stored(fingerprints(docs), "fingerprints")
    classes = stored(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies")),
        "classes",
    )
    roots = components(links(classes.select("fp")))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", "n_copies", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    placed = stored(placed.join(smallest, "root").select("fp", "n_copies", "component_id"), "placed")
    # fp is unique on the right: a fingerprint that very many rows share is split freely.
    return rows.join(placed, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        "n_copies",
    )


def one_of_each(docs: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """The documents whose id is the smallest of their component, with all columns. Of rows
    that repeat such an id one stays; documents without an id cannot be named and all stay.
    ``found`` (doc_id, component_id) may come from another rule than the fingerprints'."""
    found = near_duplicates(docs) if found is None else found
    first = found.filter(F.col("doc_id") == F.col("component_id")).groupBy("doc_id")
    keep = stored(first.agg((F.count("*") > 1).alias("again")), "keep")
    with_id = docs.filter(F.col("doc_id").isNotNull())
    kept = with_id.join(if_small(keep.select("doc_id")), "doc_id", "left_semi")
    again = keep.filter("again").select("doc_id")
    if not again.isEmpty():
        # Only rows of repeated ids are put in order.
        place = free_name(docs, "_place")
        one = (
            kept.join(again, "doc_id", "left_semi")
            .withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy("text")))
            .filter(F.col(place) == 1)
            .select(*docs.columns)
        )
        kept = kept.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    return kept.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))
