"""Duplicate rows: against history, within a batch, and in the base table itself.

Equal rows may make up any share of the data, so keys are reduced map-side before they are
shuffled: distinct keys by partial aggregation, "keep the first" by the partial group limit
Spark puts below a ``row_number() == 1`` window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A hundred bytes each in a broadcast: at most about 10 MB through the driver. A backlog is
# loaded in many waves or triggers, and the broadcasts of all of them add up to its keys.
BROADCAST_KEYS = 100_000


def with_event_date(rows: DataFrame) -> DataFrame:
    return rows.withColumn("event_date", F.to_date("event_dt"))


def _keys(rows: DataFrame, by_date: bool, prefix: str) -> DataFrame:
    mark = F.col("hash_fingerprint").alias(prefix + "mark")
    date = [F.col("event_date").alias(prefix + "date")] if by_date else []
    return rows.filter(F.col("hash_fingerprint").isNotNull()).select(*date, mark)


def _distinct_keys(rows: DataFrame, by_date: bool, prefix: str) -> DataFrame:
    return _keys(rows, by_date, prefix).distinct()


def _equal(left: tuple[str, str], right: tuple[str, str], by_date: bool) -> Column:
    """Equal (date, mark) columns; rows without a date match each other."""
    same = F.col(left[1]) == F.col(right[1])
    return same & F.col(left[0]).eqNullSafe(F.col(right[0])) if by_date else same


def seen_keys(
    batch: DataFrame, history: DataFrame, by_date: bool = True, small_batch: bool = False
) -> DataFrame:
    """Fingerprints that batch and history share, as (seen_date, seen_mark), each once. Both
    inputs need only ``event_date`` and ``hash_fingerprint``.

    small_batch: the caller has checked that the batch has at most BROADCAST_KEYS rows. Its
    keys are broadcast then and history is only scanned. Otherwise distinct keys of both
    sides are shuffled, each once per task however often it occurs.
    """
    mine = _distinct_keys(batch, by_date, "seen_")
    same = _equal(("seen_date", "seen_mark"), ("old_date", "old_mark"), by_date)
    if not small_batch:
        return mine.join(_distinct_keys(history, by_date, "old_"), same, "left_semi")
    old = _keys(history, by_date, "old_").join(F.broadcast(mine), same, "left_semi")
    names = {"old_mark": "seen_mark"} | ({"old_date": "seen_date"} if by_date else {})
    return old.distinct().withColumnsRenamed(names).select(*mine.columns)


def drop_seen(batch: DataFrame, seen: DataFrame, by_date: bool = True) -> DataFrame:
    """Rows of the batch without a seen key. The right side has each key once, so a hot key
    is a hot left partition only, which AQE can split."""
    same = _equal(("event_date", "hash_fingerprint"), ("seen_date", "seen_mark"), by_date)
    return batch.join(seen, same, "left_anti")


def drop_history(
    batch: DataFrame, history: DataFrame, scratch: str, by_date: bool = True
) -> DataFrame:
    """Rows of the batch whose fingerprint is not in history. Copies inside the batch stay.
    The shared keys are kept as a table in the folder ``scratch``: read from there, they
    leave AQE free to broadcast them or to split a hot key of the batch."""
    seen = stored(seen_keys(batch, history, by_date), scratch)
    return drop_seen(batch, seen, by_date)


def stored(rows: DataFrame, folder: str) -> DataFrame:
    """The rows as a run-scoped table: computed once, and safe from lost executors."""
    rows.write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _first_per_key(rows: DataFrame, key: list, order: list) -> DataFrame:
    # Every column breaks ties, so the same row wins on every run.
    window = Window.partitionBy(*key).orderBy(*order, *[c for c in rows.columns if c not in order])
    return rows.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def first_in_batch(batch: DataFrame) -> DataFrame:
    """One row per fingerprint; rows without a fingerprint all stay."""
    marked = batch.filter(F.col("hash_fingerprint").isNotNull())
    rest = batch.filter(F.col("hash_fingerprint").isNull())
    return _first_per_key(marked, ["hash_fingerprint"], ["gcs_uri"]).unionByName(rest)


def base_key():
    """File and row hash; the fingerprint stands in for a missing row hash."""
    row = F.coalesce(F.col("hash_code").cast("string"), F.col("hash_fingerprint"))
    return [F.col("gcs_uri"), row]


def dedup_base(base: DataFrame) -> DataFrame:
    """Earliest loaded row per file and row hash; rows with neither hash nor fingerprint
    cannot be compared and all stay. Parquet statistics rule out nearly all data for those,
    so reading them apart costs no second scan."""
    none = F.col("hash_code").isNull() & F.col("hash_fingerprint").isNull()
    kept = _first_per_key(base.filter(~none), base_key(), ["load_time_dt"])
    return kept.unionByName(base.filter(none))


def first_addresses(rows: DataFrame, address: Sequence[str]) -> DataFrame:
    """Of each file and row hash that more than one row has: where the earliest loaded row lies,
    as (uri, row, *address). Equal load times: the smallest address. Rows are counted map-side,
    so a hot key sends one row per task; only the key, the load time and the address travel."""
    uri, row = base_key()
    place = F.struct("load_time_dt", *address)
    narrow = rows.select(uri.alias("uri"), row.alias("row"), place.alias("place"))
    first = narrow.filter("row IS NOT NULL").groupBy("uri", "row").agg(
        F.min("place").alias("place"), F.count("*").alias("n")
    )
    return first.filter("n > 1").select("uri", "row", *[f"place.{a}" for a in address])


def keep_addressed(
    rows: DataFrame, first: DataFrame, address: Sequence[str], broadcast: bool = False
) -> DataFrame:
    """Rows but those whose key ``first`` places elsewhere. The right side has each key once: a
    hot key is a hot left partition only, which AQE can split. ``broadcast``: the caller has
    checked that ``first`` is small; the rows, texts and all, are then not shuffled here."""
    uri, row = base_key()
    names = {a: f"kept{a}" for a in address}
    first = first.withColumnsRenamed(names | {"uri": "key_uri", "row": "key_row"})
    same = uri.eqNullSafe(F.col("key_uri")) & (row == F.col("key_row"))
    found = rows.join(F.broadcast(first) if broadcast else first, same, "left")
    here = F.lit(True)
    for a, b in names.items():
        here = here & (F.col(a) == F.col(b))
    kept = found.filter(F.col("key_row").isNull() | here)
    return kept.select(*[c for c in rows.columns if c not in address])


def folders_with_copies(base: DataFrame, folder: list[str]) -> DataFrame:
    """Folders (the columns ``folder``) that hold a row some other row equals in file and
    row hash. Rows are counted per key and folder first, so even a key that a third of all
    rows share brings the window over a key no more rows than there are folders."""
    uri, row = base_key()
    keyed = base.select(*folder, uri.alias("uri"), row.alias("row")).filter("row IS NOT NULL")
    counted = keyed.groupBy(*folder, "uri", "row").agg(F.count("*").alias("n"))
    copies = F.sum("n").over(Window.partitionBy("uri", "row"))
    return counted.withColumn("copies", copies).filter("copies > 1").select(*folder).distinct()
