"""Secrets in texts: fixed patterns, and a battery of randomness tests for the rest.

Patterns give the base spans. Every other long run of code-like characters is a candidate: its
encoding is inferred (digits, hex, base32, letters, base64), and three tests ask whether it
looks uniformly random in that alphabet: chi-squared against uniform use of the symbols, runs
about the middle of the alphabet, and serial correlation of neighbours. A candidate that
passes could still be ordinary text too short to tell. So a null model says how likely ordinary
text writes it: letters follow each other as in the plain words of the corpus, of every length,
or have their usual frequencies (whichever makes it likelier; the latter alone without words),
and kinds of characters (lower, upper, digit, sign) change as seldom as in names and paths. How
much likelier uniform use of the candidate's own alphabet makes it bounds its p-value: text of
the null reaches a ratio of x at most once in x times, whatever its alphabet and length.
Benjamini-Hochberg control within each encoding and class of lengths keeps the expected share of
ordinary text among what is reported at ``FALSE_SHARE``. Its table is a histogram of bounded
size, counted over all distinct candidates.

Spans are code point offsets, end exclusive. Null and empty texts have none. Texts are judged
inside their rows, so ids may be null or repeated. Base spans stay as they are; they are cut out
of a candidate, and each piece left that is long enough is tested.
"""

from __future__ import annotations

from functools import reduce
from math import log10

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logledger.llm.staging import SMALL_KEYS, discard, free_name, stored, text_digest, with_fixed

#: Kind -> pattern, group whose length counts, least length. Fixed order of kinds.
PATTERNS = {
    "assign": (
        r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    # A run long enough is found whole by its least length: these need no second look.
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
RANDOM = "random"
KINDS = (*PATTERNS, RANDOM)
LEAST = 20
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: What joins a piece of a candidate to the base span beside it.
JOINTS = r"[=/_+-]+"
#: Each test refuses one random string in a thousand.
TEST_LIMIT = 3.29
FALSE_SHARE = 0.01
LENGTH_CLASSES = (32, 48, 80)
#: Probabilities are counted in steps of a tenth of a power of ten.
BINS = 300
_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
#: Encoding -> pattern and alphabet; the first that fits.
ENCODINGS = {
    "digits": ("^[0-9]+$", _DIGITS),
    "hex": ("^[0-9a-f]+$", _DIGITS + "abcdef"),
    "upper hex": ("^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    "lower": ("^[a-z]+$", _LOWER),
    "upper": ("^[A-Z]+$", _UPPER),
    "base32": ("^[A-Z2-7]+$", _UPPER + "234567"),
    "letters": ("^[A-Za-z]+$", _UPPER + _LOWER),
    "base64": ("", _UPPER + _LOWER + _DIGITS + "+/"),
}
_ALL = ENCODINGS["base64"][1]
PLAIN = r"(?<![\p{L}\p{N}])[A-Z]?[a-z]+(?![\p{L}\p{N}])"
#: Letters in a hundred of usual text: the null model where there are no words, and its weight.
USUAL = dict(zip(_LOWER, (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.15, 2.0, 0.1), strict=True))
USUAL_WEIGHT = 1000.0
#: Weight of a letter's own frequency against its frequency after another one.
ALONE_WEIGHT = 20.0
#: How often kinds follow each other in names, paths and numbers of ordinary text.
KIND_SYMBOLS = {"lower": _LOWER, "upper": _UPPER, "digit": _DIGITS, "sign": "+/"}
KIND_STARTS = {"lower": 0.4, "upper": 0.3, "digit": 0.2, "sign": 0.1}
KIND_STEPS = {
    "lower": {"lower": 0.80, "upper": 0.10, "digit": 0.05, "sign": 0.05},
    "upper": {"lower": 0.25, "upper": 0.65, "digit": 0.06, "sign": 0.04},
    "digit": {"lower": 0.08, "upper": 0.08, "digit": 0.75, "sign": 0.09},
    "sign": {"lower": 0.40, "upper": 0.25, "digit": 0.25, "sign": 0.10},
}


def _sums(numbers: Column) -> Column:
    """Running sums of an array, by doubling steps."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(numbers), F.lit(1)))).cast("int"))
    return F.aggregate(
        steps,
        numbers,
        lambda a, k: F.transform(
            a, lambda x, i: x + F.coalesce(F.get(a, i - F.pow(F.lit(2), k).cast("int")), F.lit(0))
        ),
    )


def _add_matches(rows: DataFrame, text: str, pattern: str, group: int, into: str) -> DataFrame:
    """Adds array<struct<start, end, value>> of the pattern's matches, left to right."""
    parts, ends = free_name(rows, "_parts"), free_name(rows, "_ends")
    has = F.col(text).rlike(pattern)
    matches = lambda g: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(g))
    cut = F.struct(
        F.split(text, pattern, -1).alias("pieces"),
        matches(0).alias("found"),
        (matches(group) if group else F.array().cast("array<string>")).alias("values"),
    )
    # Computed once a row, not once a match: see with_fixed.
    rows = with_fixed(rows, parts, F.when(has, cut))
    p = F.col(parts)
    found, values = p["found"], p["values"] if group else p["found"]
    lengths = F.transform(found, lambda x, i: F.length(x) + F.length(F.get(p["pieces"], i)))
    rows = with_fixed(rows, ends, _sums(lengths))
    spans = F.transform(
        found,
        lambda x, i: F.struct(
            (F.get(F.col(ends), i) - F.length(x)).alias("start"),
            F.get(F.col(ends), i).alias("end"),
            F.get(values, i).alias("value"),
        ),
    )
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return rows.withColumn(into, F.coalesce(spans, empty)).drop(parts, ends)


def _span(s: Column, kind: int) -> Column:
    return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"))


def _spans_of(matches: str, least: int, kind: int) -> Column:
    """Spans of the matches whose value is long enough."""
    good = F.filter(matches, lambda s: F.length(s["value"]) >= least)
    return F.transform(good, lambda s: _span(s, kind))


def _of_kind(spans: str, kind: int) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def letter_pairs(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """How often one letter follows another in the corpus' plain words, each distinct word once."""
    words = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(PLAIN), F.lit(0))).alias("w"))
    words = words.select(F.lower("w").alias("w")).distinct()
    places = F.sequence(F.lit(1), F.length("w") - 1)
    pairs = words.filter(F.length("w") > 1).select(
        F.explode(F.transform(places, lambda i: F.substring(F.col("w"), i, F.lit(2)))).alias("pair")
    )
    return dict(pairs.groupBy("pair").agg(F.count("*")).collect())


def null_logs(pairs: dict[str, int]) -> list[float]:
    """Logarithms of the null's probabilities: of each base64 symbol as the first one, then of
    each after each other."""
    usual = {x: n / sum(USUAL.values()) for x, n in USUAL.items()}
    ends = {b: sum(pairs.get(a + b, 0) for a in _LOWER) for b in _LOWER}
    seen = sum(ends.values())
    alone = {b: (ends[b] + USUAL_WEIGHT * usual[b]) / (seen + USUAL_WEIGHT) for b in _LOWER}
    total = {a: sum(pairs.get(a + b, 0) for b in _LOWER) for a in _LOWER}
    kind = {x: k for k, symbols in KIND_SYMBOLS.items() for x in symbols}

    def of_kind(x: str, after: str = "") -> float:
        a, b = after.lower(), x.lower()
        if b not in alone:
            return 1 / len(KIND_SYMBOLS[kind[x]])
        if a not in alone:
            return alone[b]
        return (pairs.get(a + b, 0) + ALONE_WEIGHT * alone[b]) / (total[a] + ALONE_WEIGHT)

    starts = [log10(KIND_STARTS[kind[x]] * of_kind(x)) for x in _ALL]
    steps = [log10(KIND_STEPS[kind[a]][kind[x]] * of_kind(x, a)) for a in _ALL for x in _ALL]
    return starts + steps


def null_model(docs: DataFrame) -> Column:
    """The null of a corpus and that of usual letters: one literal, not one expression a number."""
    logs = [[round(x, 6) for x in null_logs(pairs)] for pairs in (letter_pairs(docs), {})]
    return F.from_json(F.lit(str(logs)), "array<array<double>>")


def _tests(token: Column, model: Column) -> Column:
    """What the battery says of one candidate."""
    bare = F.regexp_replace(F.translate(token, "-_", "+/"), "=+", "")
    case = reduce(
        lambda a, e: a.when(bare.rlike(ENCODINGS[e][0]), F.lit(ENCODINGS[e][1])),
        list(ENCODINGS)[1:-1],
        F.when(bare.rlike(ENCODINGS["digits"][0]), F.lit(ENCODINGS["digits"][1])),
    ).otherwise(F.lit(ENCODINGS["base64"][1]))
    # Nested one-element transforms name a value once, for many uses.
    let = lambda value, use: F.element_at(F.transform(F.array(value), use), 1)

    # The null's probability of the candidate against that of uniform use of its alphabet.
    places = F.transform(F.filter(F.split(bare, ""), lambda c: c != ""), lambda c: F.instr(F.lit(_ALL), c) - 1)
    null = let(
        places,
        lambda own: F.array_max(
            F.transform(
                model,
                lambda m: F.aggregate(
                    F.transform(
                        own,
                        lambda c, i: F.get(m, c + F.when(i == 0, 0).otherwise(len(_ALL) * (1 + F.get(own, i - 1)))),
                    ),
                    F.lit(0.0),
                    lambda a, x: a + x,
                ),
            )
        ),
    )

    def judge(alphabet: Column, codes: Column) -> Column:
        n, k = F.size(codes).cast("double"), F.length(alphabet).cast("double")
        squares = F.aggregate(
            F.array_distinct(codes),
            F.lit(0.0),
            lambda a, d: a + F.pow(F.size(F.filter(codes, lambda c: c == d)), F.lit(2.0)),
        )
        high = F.size(F.filter(codes, lambda c: c >= k / 2)).cast("double")
        changes = F.size(
            F.filter(codes, lambda c, i: (i > 0) & ((c >= k / 2) != (F.get(codes, i - 1) >= k / 2)))
        ).cast("double")
        middle = (k - 1) / 2
        products = F.aggregate(
            F.transform(
                codes, lambda c, i: F.coalesce((c - middle) * (F.get(codes, i - 1) - middle), F.lit(0.0))
            ),
            F.lit(0.0),
            lambda a, x: a + x,
        )
        mean_runs = 2 * high * (n - high) / F.greatest(n, F.lit(1.0)) + 1
        var_runs = (mean_runs - 1) * (mean_runs - 2) / F.greatest(n - 1, F.lit(1.0))
        z_runs = F.when(var_runs > 0, F.abs(changes + 1 - mean_runs) / F.sqrt(var_runs)).otherwise(99.0)
        z_serial = F.abs(products / ((k * k - 1) / 12)) / F.sqrt(F.greatest(n - 1, F.lit(1.0)))
        return let(
            squares,
            lambda s: F.struct(
                n.cast("int").alias("n"),
                F.array_position(F.array(*[F.lit(a) for _, a in ENCODINGS.values()]), alphabet)
                .cast("int")
                .alias("encoding"),
                # At most BINS; the p-value is at most 10 ** (-bin / 10).
                F.greatest(
                    F.lit(0), F.least(F.lit(BINS), F.floor(-10 * (null + n * F.log10(k))))
                ).cast("int").alias("bin"),
                (
                    (n >= 2)
                    & (
                        k * s / F.greatest(n, F.lit(1.0)) - n - (k - 1)
                        <= TEST_LIMIT * F.sqrt(2 * (k - 1) * (n - 1) / F.greatest(n, F.lit(1.0)))
                    )
                    & (z_runs <= TEST_LIMIT)
                    & (z_serial <= TEST_LIMIT)
                ).alias("random"),
                F.xxhash64(token).alias("token"),
            ),
        )

    return let(
        case,
        lambda alphabet: let(
            F.transform(
                F.filter(F.split(bare, ""), lambda c: c != ""), lambda c: F.instr(alphabet, c) - 1
            ),
            lambda codes: judge(alphabet, codes),
        ),
    )


def _without(run: Column, base: str) -> Column:
    """What is left of a run (start, end, value) beside the base spans, in pieces as long as a
    candidate. Ends where a span was cut out lose what joined them to it."""
    piece = "array<struct<start:int,end:int>>"
    inside = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

    def gap(start: Column, end: Column) -> Column:
        return F.when(
            end > start, F.array(F.struct(start.alias("start"), end.alias("end")))
        ).otherwise(F.array().cast(piece))

    def named(at: Column, out: Column) -> Column:
        return F.struct(at.cast("int").alias("at"), out.cast(piece).alias("out"))

    def trimmed(p: Column) -> Column:
        value = F.substring(run["value"], p["start"] - run["start"] + 1, p["end"] - p["start"])
        left = F.when(p["start"] > run["start"], F.regexp_replace(value, "^" + JOINTS, "")).otherwise(value)
        both = F.when(p["end"] < run["end"], F.regexp_replace(left, JOINTS + "$", "")).otherwise(left)
        start = p["start"] + F.length(value) - F.length(left)
        return F.struct(
            start.cast("int").alias("start"), (start + F.length(both)).cast("int").alias("end"), both.alias("value")
        )

    gaps = F.aggregate(
        inside,
        named(run["start"], F.array()),
        lambda a, b: named(F.greatest(a["at"], b["end"]), F.concat(a["out"], gap(a["at"], b["start"]))),
        lambda a: F.concat(a["out"], gap(a["at"], run["end"])),
    )
    return F.filter(F.transform(gaps, trimmed), lambda p: F.length(p["value"]) >= LEAST)


def scanned(docs: DataFrame, base: str, candidates: str, model: Column, text: str = "text") -> DataFrame:
    """Adds ``base`` (array of start, end, kind number) and ``candidates`` (array of start, end
    and test results)."""
    own = free_name(docs, "_text")
    rows = docs.withColumn(own, F.coalesce(F.col(text), F.lit("")))
    columns = []
    for kind, (pattern, group, _) in PATTERNS.items():
        columns.append(free_name(rows, f"_{kind}"))
        rows = _add_matches(rows, own, pattern, group, columns[-1])
    spans = [
        _spans_of(column, least, number)
        for number, (column, (_, _, least)) in enumerate(
            zip(columns, PATTERNS.values(), strict=True)
        )
    ]
    long = free_name(rows, "_long")
    rows = _add_matches(rows, own, CANDIDATE, 0, long)
    rows = rows.withColumn(base, F.sort_array(F.concat(*spans))).drop(*columns)
    pieces = free_name(rows, "_pieces")
    rows = with_fixed(rows, pieces, F.flatten(F.transform(long, lambda s: _without(s, base))))
    tested = F.transform(
        pieces,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), _tests(s["value"], model).alias("t")),
    )
    return rows.withColumn(candidates, tested).drop(long, pieces, own)


def _length_class(n: Column) -> Column:
    return sum(((n >= x).cast("int") for x in LENGTH_CLASSES), F.lit(0))


def thresholds(candidates: DataFrame):
    """From all candidates (column ``t``) the test ``t -> is a secret``, as a function."""
    tokens = candidates.select("t.*").filter("n >= 2")
    # A token that many copies of a document share is one observation.
    tokens = tokens.groupBy("token").agg(*[F.first(c).alias(c) for c in ("n", "encoding", "bin", "random")])
    group = F.col("encoding") * (len(LENGTH_CLASSES) + 1) + _length_class(F.col("n"))
    table = (
        tokens.select(group.alias("c"), F.when(F.col("random"), F.col("bin")).otherwise(0).alias("b"))
        .groupBy("c", "b")
        .agg(F.count("*").alias("n"))
    )
    # At most (encodings x classes x bins) rows from here on.
    lower = Window.partitionBy("c").orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = table.select("c", "b", F.sum("n").over(lower).alias("r"), F.sum("n").over(Window.partitionBy("c")).alias("m"))
    first = ranked.filter(F.pow(F.lit(10.0), -F.col("b") / 10) * F.col("m") <= FALSE_SHARE * F.col("r"))
    least = {r[0]: r[1] for r in first.groupBy("c").agg(F.min("b")).collect()}

    def secret(t: Column) -> Column:
        count = len(LENGTH_CLASSES) + 1
        limits = F.array(*[F.lit(least.get(c, BINS + 1)) for c in range(count * (len(ENCODINGS) + 1))])
        return t["random"] & (t["bin"] >= F.get(limits, t["encoding"] * count + _length_class(t["n"])))

    return secret


def _all_spans(base: str, candidates: str, secret) -> Column:
    more = F.transform(
        F.filter(candidates, lambda c: secret(c["t"])), lambda c: _span(c, len(PATTERNS))
    )
    return F.sort_array(F.concat(F.col(base), more))


def _joined(spans: str) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text) and
    span_list (start, end, kind)."""
    model = null_model(docs)
    rows = stored(
        scanned(docs.select("doc_id", "text"), "base", "candidates", model).drop("text"), "scanned"
    )
    secret = thresholds(rows.select(F.explode("candidates.t").alias("t")))
    rows = rows.withColumn("found", _all_spans("base", "candidates", secret))
    counts = [
        F.size(_of_kind("base", number)).cast("bigint").alias(f"n_{kind}")
        for number, kind in enumerate(PATTERNS)
    ]
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("found").alias("spans"),
        F.transform(
            "found",
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.get(kinds, s["kind"]).alias("kind"),
            ),
        ).alias("span_list"),
    )


def redacted(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced, all columns kept; n_chars, where there is such a
    column, follows the new text. Overlapping spans become one mark."""
    spans, cuts, own = (free_name(docs, f"_{n}") for n in ("spans", "cuts", "digest"))
    model = null_model(docs.select("text"))
    # Texts are scanned once; the spans of the few that have any come back by their digests.
    seen = scanned(docs.select("text"), "base", "candidates", model).withColumn("digest", text_digest())
    seen = stored(seen.select("digest", "base", "candidates"), "candidates")
    secret = thresholds(seen.select(F.explode("candidates.t").alias("t")))
    found = seen.select(F.col("digest").alias(own), _all_spans("base", "candidates", secret).alias(spans))
    found = stored(found.filter(F.size(spans) > 0).dropDuplicates([own]), "spans")
    rows, total = found.agg(F.count("*"), F.coalesce(F.sum(F.size(spans)), F.lit(0))).first()
    discard(seen)
    if rows + total <= SMALL_KEYS:
        found = F.broadcast(found)
    rows = docs.withColumn(own, text_digest()).join(found, own, "left")
    rows = rows.withColumn(spans, F.coalesce(spans, F.array().cast(found.schema[spans].dataType)))
    # A span that starts before an earlier one ends adds to it and opens no mark of its own.
    rows = rows.withColumn(
        cuts,
        F.aggregate(
            spans,
            F.struct(
                F.lit(0).alias("end"),
                F.lit("").alias("text"),
            ),
            lambda a, s: F.struct(
                F.greatest(a["end"], s["end"]).alias("end"),
                F.when(s["start"] < a["end"], a["text"])
                .otherwise(
                    F.concat(
                        a["text"],
                        F.substring(F.col("text"), a["end"] + 1, s["start"] - a["end"]),
                        F.lit(mark),
                    )
                )
                .alias("text"),
            ),
        ),
    )
    cut = F.col(cuts)
    rest = F.substring(F.col("text"), cut["end"] + 1, F.length("text"))
    text = F.when(F.size(spans) == 0, F.col("text")).otherwise(F.concat(cut["text"], rest))
    rows = rows.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = F.when(F.size(spans) == 0, F.col("n_chars")).otherwise(F.length("text"))
        rows = rows.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)
