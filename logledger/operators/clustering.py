"""A space-filling order: rows that are near in every one of several columns come near each
other, so that the minima and maxima of files and row groups narrow each column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ranks have 6 bits: 64 ranges a column, 4,096 cells for two columns.
BITS = 6
# Rows looked at to find the ranges. They only shape the files, never a result.
SAMPLE_ROWS = 50_000
SEED = 7


def range_bounds(rows: DataFrame, columns: Sequence[str]) -> dict[str, list[Any]]:
    """Upper bounds of ranges with about as many rows each, per column, from a bounded sample;
    fewer where values repeat, none for a column without values."""
    count = rows.count()
    sample = rows.select(*columns)
    if count > SAMPLE_ROWS:
        sample = sample.sample(SAMPLE_ROWS / count, SEED)
    drawn = sample.limit(2 * SAMPLE_ROWS).collect()
    bounds = {}
    for column in columns:
        values = sorted(r[column] for r in drawn if r[column] is not None)
        places = (len(values) * i >> BITS for i in range(1, 1 << BITS))
        bounds[column] = sorted({values[p] for p in places}) if values else []
    return bounds


def _rank(value: Column, bounds: Sequence[Any]) -> Column:
    """How many bounds are at or below the value; 0 for NULL."""
    if not bounds:
        return F.lit(0)
    below = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= value)
    return F.when(value.isNull(), 0).otherwise(F.size(below))


def curve_place(bounds: Mapping[str, Sequence[Any]]) -> Column:
    """Place of a row on the curve: the bits of its ranks, interleaved, highest first."""
    place = F.lit(0).cast("bigint")
    for number, (column, values) in enumerate(bounds.items()):
        rank = _rank(F.col(column), values)
        for bit in range(BITS):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1)).cast("bigint")
            to = bit * len(bounds) + len(bounds) - 1 - number
            place = place.bitwiseOR(F.shiftleft(one, to))
    return place


def in_curve_order(
    rows: DataFrame, columns: Sequence[str], first: Sequence[str], ties: Sequence[str]
) -> DataFrame:
    """Rows in ranges of (``first``, place on the curve), sorted within them. Spark samples the
    ranges and AQE joins small ones to size, so a hot value of ``first`` is cut along the curve;
    ``ties`` (columns that tell all rows apart) cut a cell that holds many rows."""
    names = rows.columns
    placed = rows.withColumn("_place", curve_place(range_bounds(rows, columns)))
    placed = placed.withColumn("_tie", F.xxhash64(*ties))
    order = [*first, "_place", "_tie"]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(*names)
