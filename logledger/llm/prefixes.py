"""Pairs of sets that can be similar, found by the rare elements they share.

Sets of n and m elements with a Jaccard similarity of t or more share at least
``t / (1 + t) * (n + m)`` of them. With the elements of all sets in one order, the first shared
one has no more than ``n - i`` elements left in the one set and ``m - j`` in the other, counted
from its places i and j, so both places lie in a prefix. The order is by the number of sets that
hold an element, the rarest first: near copies that were changed a lot begin with what is theirs
alone and meet nobody. Elements of one set only are counted for the places and then left out.

Prefixes are shorter the larger the partner, so they are cut for each cell of partners' sizes
(``STEP`` apart) and meet by element and both cells. Nothing is missed; found pairs still have
to be verified. An element's rows are an inner join's, which may be split over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import if_small, stored

#: Ratio of sizes that share a cell.
STEP = 1.06
#: Takes up the rounding of sizes.
_LESS, _MORE = 1 - 1e-9, 1 + 1e-9


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = batch["hashes"].to_pylist()
        places = np.repeat(np.arange(len(hashes)), [len(h) // 8 for h in hashes])
        elements = pa.array(np.frombuffer(b"".join(hashes), np.int64))
        yield pa.RecordBatch.from_arrays([batch["own"].take(pa.array(places)), elements], ["own", "element"])


def _cell(size: Column) -> Column:
    return F.floor(F.log(size) / float(np.log(STEP))).cast("int")


def _shared(n: Column, m: Column, similarity: float) -> Column:
    """The elements that sets of these sizes share at least."""
    return F.ceil((n + m) * (similarity / (1 + similarity)) - 1e-6)


def _ranked(open_sets: DataFrame, sets: DataFrame) -> DataFrame:
    """Each open set with its elements that other open sets have too, the rarest first."""
    hashes = sets.select("own", "hashes").join(if_small(open_sets.select("own")), "own")
    elements = stored(hashes.mapInArrow(_elements, "own binary, element bigint"), "elements")
    counts = elements.groupBy("element").agg(F.count("*").alias("holders")).filter("holders > 1")
    common = elements.join(counts, "element").groupBy("own")
    return common.agg(F.array_sort(F.collect_list(F.struct("holders", "element"))).alias("ranked"))


def possible_pairs(open_sets: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """``open_sets`` (own, n, root, outside), stored, one row a set, and ``sets`` with their
    hashes -> (a, b): every pair of open sets of different roots, a outside, whose similarity is
    the bound or more, among others. Of two outside sets a is the smaller. Empty sets have no
    partner; without open sets there are no pairs."""
    low, high = F.col("n") * similarity * _LESS, F.col("n") / similarity * _MORE
    met = _ranked(open_sets, sets).join(if_small(open_sets), "own")
    cut = met.withColumn("mine", _cell(F.col("n"))).withColumn(
        "theirs", F.explode(F.sequence(_cell(low), _cell(high)))
    )
    least = F.greatest(F.exp(F.col("theirs") * float(np.log(STEP))) * _LESS, low)
    length = F.size("ranked") - _shared(F.col("n"), least, similarity) + 1
    prefix = F.expr("slice(ranked, 1, cast(greatest(length, 0L) as int))")
    before = F.col("n") - F.size("ranked")
    entries = (
        cut.withColumn("length", length)
        .filter("length > 0")
        .select("own", "n", "root", "outside", "mine", "theirs", before.alias("before"), F.posexplode(prefix))
        .withColumn("left", F.col("n") - F.col("before") - F.col("pos"))
        .select("own", "n", "root", "outside", "mine", "theirs", "left", F.col("col.element").alias("element"))
    )
    entries = stored(entries, "prefixes")
    ones = entries.filter("outside").select(
        F.col("own").alias("a"),
        F.col("n").alias("m"),
        F.col("root").alias("r"),
        F.col("left").alias("rest"),
        F.col("mine").alias("theirs"),
        F.col("theirs").alias("mine"),
        "element",
    )
    pairs = ones.join(entries, ["element", "mine", "theirs"]).filter(
        (F.col("r") != F.col("root"))
        & (~F.col("outside") | (F.col("a") < F.col("own")))
        & (F.least("left", "rest") >= _shared(F.col("n"), F.col("m"), similarity))
    )
    return pairs.select("a", F.col("own").alias("b")).distinct()
