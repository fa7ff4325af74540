"""Benchmark decontamination: which documents contain windows of benchmark items.

An item's windows are its runs of ten words (shorter items: the whole item). Finding them is a
set join under full containment, so one token of a window is prefix enough: a window's
shingles are ordered by rarity, counted over all documents, and only the rarest one is
joined. Its place in the window gives the only start a match can have; starts before the
first word or windows longer than the rest of the document are out before anything is
compared. What is left is verified word by word against the document.

Everything is DataFrame work. Per document only one 32-bit hash per word is stored between the
passes; the text is read again for documents with candidates alone. Documents are named by a
digest of their text, so copies meet in one row, and ids may be null or repeated.

Null and empty texts have no words and are never hit. Repeated items share windows and are all
listed. Items without an id mark words as hit but are not listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import free_name, stored, with_fixed

WINDOW = 10
SHINGLE = 3
#: Tables of up to this many rows (checked by a count) are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: The same for candidates, counted by windows (about a hundred bytes each).
BROADCAST_WINDOWS = 500_000
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_list(text: Column) -> Column:
    """Words of the text after lower-casing A-Z only."""
    text = F.coalesce(text, F.lit(""))
    plain = F.octet_length(text) == F.length(text)
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.filter(F.split(lowered, _GAPS), lambda w: w != "")


def _grams(words: str, size: int, make) -> Column:
    """One value per run of ``size`` words: make(list of the words' columns)."""
    n = F.size(words)
    starts = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: make([F.get(F.col(words), i + k) for k in range(size)]))


def _phrase(words: list[Column]) -> Column:
    return F.concat_ws(" ", *words)


def windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, length, window): the windows of each item, each once."""
    items = benchmark.select("item_id", word_list(F.col("text")).alias("w")).filter(
        F.size("w") > 0
    )
    long = items.filter(F.size("w") >= WINDOW).select(
        "item_id",
        F.lit(WINDOW).alias("length"),
        F.explode(_grams("w", WINDOW, _phrase)).alias("window"),
    )
    short = items.filter(F.size("w") < WINDOW).select(
        "item_id", F.size("w").alias("length"), F.concat_ws(" ", "w").alias("window")
    )
    return long.unionByName(short).distinct()


def _small(frame: DataFrame) -> DataFrame:
    return F.broadcast(frame) if frame.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else frame


def _with_hashes(frame: DataFrame, words: str, sizes: list[int]) -> DataFrame:
    """Adds h<size>: a 32-bit hash of each run of that many words."""
    frame = frame.withColumn("wh", F.transform(words, lambda w: F.hash(w)))
    hashes = [_grams("wh", s, lambda ws: F.hash(*ws)).alias(f"h{s}") for s in sizes]
    return frame.select("*", *hashes).drop("wh")


def matches(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two tables: documents (doc_id, digest, n_words), and by digest what was found
    (digest, n_hit, item_ids) for texts with at least one window."""
    own = stored(windows(benchmark), "windows")
    distinct = own.select("length", "window").distinct()
    sizes = sorted(
        {min(SHINGLE, r[0]) for r in own.select("length").distinct().collect()}
    ) or [SHINGLE]
    base = docs.select(
        "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), word_list(F.col("text")).alias("w")
    )
    base = _with_hashes(base, "w", sizes).select(
        "doc_id", "digest", F.size("w").cast("bigint").alias("n_words"), *[f"h{s}" for s in sizes]
    )
    base = stored(base, "shingles")

    tokens = _with_hashes(distinct.withColumn("w", F.split("window", " ")), "w", sizes)
    size_of = F.least(F.lit(SHINGLE), F.col("length"))
    case = F.when(size_of == sizes[0], F.col(f"h{sizes[0]}"))
    for s in sizes[1:]:
        case = case.when(size_of == s, F.col(f"h{s}"))
    tokens = tokens.select(
        "length", "window", size_of.alias("size"), F.posexplode(case).alias("offset", "h")
    )
    seen = _small(stored(tokens.select("size", "h").distinct(), "tokens"))

    def spread(*columns: str) -> DataFrame:
        parts = [
            base.select(*columns, F.lit(s).alias("size"), F.posexplode(f"h{s}").alias("pos", "h"))
            for s in sizes
        ]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    rarity = spread().join(seen, ["size", "h"], "left_semi").groupBy("size", "h").count()
    # A token that no document has is the rarest and ends its window's search at once.
    ranked = tokens.join(stored(rarity, "rarity"), ["size", "h"], "left").fillna(0, ["count"])
    prefix = ranked.groupBy("length", "window").agg(
        F.min(F.struct("count", "h", "offset", "size")).alias("t")
    )
    prefix = prefix.filter("t.count > 0").select(
        "length", "window", "t.h", "t.offset", "t.size"
    )
    candidates = (
        spread("digest", "n_words")
        .join(_small(stored(prefix, "prefix")), ["size", "h"])
        .withColumn("start", F.col("pos") - F.col("offset"))
        .filter("start >= 0 AND start + length <= n_words")
        .select("digest", "start", "length", "window")
        .distinct()
    )
    candidates = candidates.groupBy("digest").agg(
        F.sort_array(F.collect_list(F.struct("start", "length", "window"))).alias("found")
    )
    candidates = stored(candidates, "candidates")
    entries = candidates.agg(F.coalesce(F.sum(F.size("found")), F.lit(0))).first()[0]
    if entries <= BROADCAST_WINDOWS:
        candidates = F.broadcast(candidates)
    texts = docs.select(F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "text")
    rows = texts.join(candidates, "digest").select(
        "digest", word_list(F.col("text")).alias("w"), "found"
    )
    same = lambda c: F.exists(
        F.array(
            *[
                (c["length"] == n)
                & (_phrase([F.get(F.col("w"), c["start"] + k) for k in range(n)]) == c["window"])
                for n in range(1, WINDOW + 1)
            ]
        ),
        lambda x: x,
    )
    # Lengths other than the usual one are rare: they are compared only where they occur.
    usual = lambda c: F.when(
        c["length"] == WINDOW,
        _phrase([F.get(F.col("w"), c["start"] + k) for k in range(WINDOW)]) == c["window"],
    ).otherwise(same(c))
    rows = with_fixed(rows, "real", F.filter("found", usual)).select(
        "digest", F.col("real").alias("found")
    )
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("end")),
        lambda a, c: F.struct(
            (
                a["n"]
                + F.greatest(
                    F.lit(0).cast("bigint"),
                    c["start"] + c["length"] - F.greatest(a["end"], c["start"].cast("bigint")),
                )
            ).alias("n"),
            F.greatest(a["end"], (c["start"] + c["length"]).cast("bigint")).alias("end"),
        ),
        lambda a: a["n"],
    )
    rows = rows.filter(F.size("found") > 0).select(
        "digest",
        covered.alias("n_hit"),
        F.array_distinct(F.transform("found", lambda c: c["window"])).alias("windows"),
    )
    # Copies of a text agree: one row is enough.
    rows = stored(rows.groupBy("digest").agg(F.first("n_hit").alias("n_hit"), F.first("windows").alias("windows")), "hits")
    listed = (
        rows.select("digest", F.explode("windows").alias("window"))
        .join(own.filter("item_id IS NOT NULL").select("window", "item_id"), "window")
        .groupBy("digest")
        .agg(F.collect_set("item_id").alias("item_ids"))
    )
    hits = rows.select("digest", "n_hit").join(listed, "digest", "left")
    return base.select("doc_id", "digest", "n_words"), hits


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated and
    the list item_ids."""
    rows, hits = matches(docs, benchmark)
    names = F.sort_array(F.transform("item_ids", lambda x: x.cast("string")))
    return (
        rows.join(hits, "digest", "left")
        .withColumn("item_ids", F.coalesce("item_ids", F.array().cast("array<bigint>")))
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.size("item_ids").cast("bigint").alias("n_items"),
            F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            "item_ids",
        )
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a benchmark window, with all their columns."""
    _, hits = matches(docs, benchmark)
    own = free_name(docs, "_digest")
    rows = docs.withColumn(own, F.md5(F.coalesce("text", F.lit(""))))
    hit = _small(stored(hits.select(F.col("digest").alias(own)), "contaminated"))
    return rows.join(hit, own, "left_anti").select(*docs.columns)


SQL = r"""
WITH cut AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM cut CROSS JOIN (SELECT DISTINCT size FROM wins) WHERE len(w) >= size)),
found AS (SELECT doc_id, i, p.size, item_id FROM places p JOIN wins v USING (size, win)),
words AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS at FROM found),
hit AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM cut LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
