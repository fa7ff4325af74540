"""Near-duplicates by the word shingles texts share: Jaccard similarity of a given least value.

Texts are linked in two steps, both verified on all shingles, so nothing below the bound is linked.
First by SimHash: the fingerprints of the shingle sets meet by Golay keys within ``simhash.MAX_BITS``
bits (``simhash.links``). At a similarity of 0.8 fingerprints differ in about 10 of 64 bits, give or
take 3, and unrelated ones already meet within the 17 or so that all such pairs would need, so
farther ones are reached by MinHash: texts whose ``ROWS`` minima agree in one of ``BANDS`` bands are
candidates, which two texts at 0.8 miss once in 9,000 times. What SimHash has connected is not
compared again. Only distinct shingle sets are compared; copies join the class of their set.

Candidates of the bands are judged in two steps. Signatures, 8 bits of each minimum, estimate the
similarity of a pair to 0.03; pairs whose estimate is more than ``SLACK`` (five times that) too low
are left out. All others are verified.

A bucket's members are not compared all with each other. In each of ``ROUNDS`` rounds every
bucket that is still in several components has one pivot, another one in each bucket a set lies
in, and each set is verified with the most similar of its pivots that it is not connected with.
So near copies cost one verification a round for each of them. What is then still in several
components is finished exactly. In buckets of up to ``DIRECT`` members all sets outside the
largest component are compared with the whole bucket, joined by cells of size, as similar sets
differ in size by the bound at most. In larger ones they meet by their rarest shingles
(``prefixes``), so a large group of near copies that are not similar to each other does not
bring all its pairs; sets that do meet there are pairs that can be similar.

Null and empty texts have one common set. Repeated rows are copies; ids may be null. Ties for a
pivot or a largest component are broken by hash and change no result. An empty table gives an
empty result; columns other than doc_id and text are not looked at. Texts of any length are one
set each, so memory grows with the longest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm.components import components
from logledger.llm.prefixes import possible_pairs
from logledger.llm.simhash import links as fingerprint_links
from logledger.llm.simhash import majority
from logledger.llm.staging import discard, if_small, stored, text_batches

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 30, 6
ROUNDS = 3
DIRECT = 32
SLACK = 0.15
SEED = 42
_STEP = 1_024
_random = np.random.default_rng(SEED)
_FACTORS = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _random.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)
_SETS = "doc_id bigint, own binary, fp bigint, n int, hashes binary, signature binary, bands array<bigint>"


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted hashes of the lower-cased text's word shingles, each once. A shorter text is one
    shingle, a text without words has none."""
    own = (text or "").encode("utf-8", "replace").lower().split()
    if not own:
        return np.zeros(0, np.uint64)
    if len(own) < words:
        shingles: Iterator[bytes] = iter([b" ".join(own)])
    else:
        shingles = map(b" ".join, zip(*[own[k:] for k in range(words)], strict=False))
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), np.uint64))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of BANDS * ROWS random functions of the set."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _STEP):
        mixed = hashes[start : start + _STEP] * _FACTORS + _ADDED
        np.minimum(least, mixed.min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> list[int]:
    """One key for each band of minima; equal sets have equal keys."""
    found = [xxhash.xxh64_intdigest(b.tobytes(), seed=k) for k, b in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(found, np.uint64).view(np.int64).tolist()


def _sets(words: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in _SETS.split(", ")]
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
            hashes = shingle_set(text, words)
            raw = hashes.tobytes()
            least = minima(hashes)
            signature = (least >> np.uint64(23)).astype(np.uint8).tobytes()
            fp = int(np.uint64(majority(hashes)).view(np.int64))
            rows.append((doc_id, xxhash.xxh3_128_digest(raw), fp, len(hashes), raw, signature, band_keys(least)))
        columns = zip(*rows, strict=True) if rows else [[] for _ in names]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
        )


def similar_enough(one, other, similarity: float) -> bool:
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    # The slack only takes up the rounding of the product.
    return shared >= similarity * (len(a) + len(b) - shared) - 1e-9


def _own(sets: DataFrame, name: str, size: str, signature: str) -> DataFrame:
    return sets.select("own", "n", "signature").toDF(name, size, signature)


def _estimated(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b), with b's size m and signature y, whose sizes and signatures allow the
    bound, with the estimate."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, BANDS * ROWS) for c in "xy"
            )
            # Of unequal minima one in 256 agrees in 8 bits.
            estimate = pa.array(((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256))
            held = pa.RecordBatch.from_arrays([batch["a"], batch["b"], estimate], ["a", "b", "estimate"])
            yield held.filter(pa.array(estimate.to_numpy() >= similarity - SLACK))

    both = (
        pairs.join(_own(sets, "a", "n", "x"), "a")
        .filter(F.least("n", "m") >= similarity * F.greatest("n", "m") - 1e-9)
        .select("a", "b", "x", "y")
    )
    return both.mapInArrow(check, "a binary, b binary, estimate double")


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough. A pair carries one set's hashes through
    the shuffle, the other's meet it there."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = zip(batch["x"], batch["y"], strict=True)
            good = [similar_enough(x.as_buffer(), y.as_buffer(), similarity) for x, y in hashes]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    hashes = sets.select("own", "hashes")
    both = pairs.join(hashes.toDF("a", "x"), "a").join(hashes.toDF("b", "y"), "b")
    return both.mapInArrow(check, "a binary, b binary")


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """The members, with their root, of buckets that are in several components."""
    placed = members.join(roots, F.col("own") == F.col("node"), "left")
    placed = placed.select(*members.columns, F.coalesce("root", "own").alias("root"))
    placed = stored(placed, "placed")
    ends = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    return placed.join(ends.filter("low <> high").select("key"), "key", "left_semi")


def _by_fingerprint(classes: DataFrame) -> DataFrame:
    """(a, b): sets whose SimHash fingerprints are linked, enough of them to connect all such.
    Of sets with one fingerprint the smallest stands for all."""
    first = stored(classes.groupBy("fp").agg(F.min("own").alias("first")), "fingerprints")
    same = classes.join(first, "fp").select(F.col("own").alias("a"), F.col("first").alias("b"))
    near = (
        fingerprint_links(first.select("fp"))
        .join(first.toDF("a", "x"), "a")
        .join(first.toDF("b", "y"), "b")
        .select(F.col("x").alias("a"), F.col("y").alias("b"))
    )
    return same.filter("a <> b").union(near)


def _with_pivot(apart: DataFrame, sets: DataFrame, number: int) -> DataFrame:
    """(a, b, m, y): each member with its buckets' pivots, if they are not connected yet. A
    pivot's signature is fetched once for its bucket, not for each of the members."""
    order = F.struct(F.xxhash64("own", "key", F.lit(number)), "own")
    pivots = apart.groupBy("key").agg(F.min_by(F.struct("own", "root"), order).alias("pivot"))
    pivots = pivots.select("key", F.col("pivot.own").alias("b"), F.col("pivot.root").alias("r"))
    pivots = pivots.join(_own(sets, "b", "m", "y"), "b")
    pairs = apart.join(pivots, "key").filter(F.col("root") != F.col("r"))
    return pairs.select(F.col("own").alias("a"), "b", "m", "y").distinct()


def _outsiders(apart: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """(a, b): each member outside a bucket's largest component with the members that it is not
    connected with: in buckets of up to DIRECT members those of about its size, in larger ones
    those whose rare shingles allow the bound."""
    # Sizes whose ratio is within the bound are in the same cell or in neighbouring ones.
    cell = F.floor(F.log(F.greatest("n", F.lit(1)).cast("double")) / float(-np.log(similarity))).cast("int")
    counted = apart.groupBy("key", "root").agg(F.count("*").alias("size"))
    largest = counted.groupBy("key").agg(
        F.max_by("root", F.struct("size", "root")).alias("largest"), F.sum("size").alias("members")
    )
    known = apart.join(largest, "key").withColumn("outside", F.col("root") != F.col("largest"))
    columns = ["key", "cell", "own", "n", "root", "outside", "members"]
    known = stored(known.withColumn("cell", cell).select(*columns), "known")
    few = known.filter(F.col("members") <= DIRECT)
    near = F.explode(F.array(F.col("cell") - 1, F.col("cell"), F.col("cell") + 1))
    ones = few.filter("outside").select("key", near.alias("cell"), F.col("own").alias("a"), F.col("root").alias("r"))
    pairs = ones.join(few, ["key", "cell"]).filter(
        (F.col("r") != F.col("root")) & (~F.col("outside") | (F.col("a") < F.col("own")))
    )
    many = known.filter(F.col("members") > DIRECT).groupBy("own", "n", "root")
    many = stored(many.agg(F.max("outside").alias("outside")), "open-sets")
    pairs = pairs.select("a", F.col("own").alias("b"))
    return pairs.union(possible_pairs(many, sets, similarity)).distinct()


def similar_documents(
    docs: DataFrame, words: int = WORDS, similarity: float = SIMILARITY
) -> DataFrame:
    """One row per document: doc_id and component_id, the smallest doc_id reachable over pairs
    that share at least ``similarity`` of their shingles of ``words`` words, itself included."""
    text_batches(docs.sparkSession)
    rows = stored(
        docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(partial(_sets, words), _SETS),
        "shingle-sets",
    )
    classes = rows.groupBy("own", "fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"))
    classes = stored(classes, "set-classes")
    near = stored(_by_fingerprint(classes), "near")
    keyed = rows.select("own", "n", F.explode("bands").alias("key")).distinct()
    keyed = stored(keyed, "bands")
    shared = keyed.groupBy("key").agg(F.min("own").alias("low"), F.max("own").alias("high")).filter("low <> high")
    members = stored(keyed.join(shared.select("key"), "key", "left_semi"), "buckets")
    wanted = members.select("own").union(near.select("a")).union(near.select("b"))
    wanted = stored(wanted.distinct(), "wanted")
    sets = rows.select("own", "n", "hashes", "signature").join(if_small(wanted), "own", "left_semi")
    sets = stored(sets.dropDuplicates(["own"]), "sets")
    named = stored(rows.select("doc_id", "own"), "named")
    discard(rows, keyed)
    links = stored(_verified(near, sets, similarity), "verified")
    roots = components(links)
    discard(near)
    for number in range(ROUNDS + 1):
        apart = _apart(members, roots)
        if number < ROUNDS:
            near = _estimated(_with_pivot(apart, sets, number), sets, similarity)
            near = near.groupBy("a").agg(F.max_by("b", F.struct("estimate", "b")).alias("b"))
        else:
            pairs = _outsiders(apart, sets, similarity).join(_own(sets, "b", "m", "y"), "b")
            near = _estimated(pairs, sets, similarity)
        near = stored(near.select("a", "b"), "near")
        links = links.unionByName(stored(_verified(near, sets, similarity), "verified"))
        roots = components(links)
        discard(near)
    joined = classes.join(roots, F.col("own") == F.col("node"), "left").select(
        "own", "first_id", F.coalesce("root", "own").alias("root")
    )
    smallest = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = stored(joined.join(smallest, "root").select("own", "component_id"), "similar")
    discard(sets, members)
    return named.join(joined, "own").select("doc_id", "component_id")
