"""Connected components of a graph given as a table of links, by star contraction.

Each round links every node to the smallest node it knows (large star: neighbours above it;
small star: itself and neighbours below). Rounds grow with the logarithm of the longest
chain. A round is two aggregations to one minimum per node and two joins with that unique
side, so a node with very many links is pre-aggregated and its rows may be split over tasks;
no list of neighbours is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import discard, stored


def _minimum(links: DataFrame, node: str, other: str) -> DataFrame:
    """Per node the smallest of itself and its partners."""
    return links.groupBy(F.col(node).alias("n")).agg(
        F.least(F.min(other), F.first(node)).alias("m")
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b) -> (node, root): root is the smallest node reachable. Nodes without a
    link do not appear; nulls and self-links say nothing."""
    proper = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stored(proper.distinct(), "links")
    state = _fingerprint(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _minimum(both, "a", "b")
        large = (
            both.filter("b > a")
            .join(low, F.col("a") == F.col("n"))
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = _minimum(large, "a", "b")
        known = large.join(low, F.col("a") == F.col("n"))
        small = (
            known.select("b", "m")
            .union(low.select("n", "m"))
            .toDF("a", "b")
            .filter("a <> b")
            .distinct()
        )
        held, now = now, stored(small, "links")
        before, state = state, _fingerprint(now)
        discard(held, shuffles=False)
        if before == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _fingerprint(links: DataFrame) -> tuple:
    """Number of links and two sums over them: equal only if a round changed nothing."""
    mixed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(
        links.agg(F.count("*"), F.sum(mixed), F.sum(F.hash("a", "b").cast("bigint"))).first()
    )
