"""Quality rules: a learned decision list over countable properties of a text.

``stats`` counts, ``learn`` grows and prunes rules on labelled rows by sequential covering,
``DecisionList.verdict`` is the list as one ordered CASE expression. All work is DataFrame
aggregation: a step of the search is one small histogram of every feature over the rows that
the rule in hand still covers, so it sees all labelled rows at any size.

Null texts count as empty. Rows are judged on their own, so repeated rows and ties get equal
verdicts; columns beside the text are never read. Without labels the list is empty and only
the base rule rejects.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logledger.llm.staging import discard, free_name, if_small, stored, text_digest

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Further counts that only the learned rules use.
EXTRA = ("n_lines", "n_upper", "n_marks")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def with_stats(docs: DataFrame, text: str = "text", into: str = "stats") -> DataFrame:
    """Adds one struct column with the counts. Everything is computed inside the row."""
    t, words, lines, hashes, grams, spots = (
        free_name(docs, n) for n in ("_t", "_words", "_lines", "_hashes", "_grams", "_spots")
    )
    col = F.col
    rows = docs.withColumn(t, F.coalesce(col(text), F.lit("")))
    rows = rows.withColumn(words, word_list(col(t))).withColumn(
        lines, F.filter(F.split(col(t), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    size = F.size(words)
    starts = F.when(size >= WINDOW, F.sequence(F.lit(0), size - WINDOW))
    rows = rows.withColumn(hashes, F.transform(words, lambda w: F.xxhash64(w)))
    rows = rows.withColumn(
        hashes,
        F.transform(
            starts, lambda i: F.xxhash64(*[F.get(col(hashes), i + k) for k in range(WINDOW)])
        ),
    )
    # Different hashes prove different windows. Only texts with equal hashes (few) go on to
    # compare the windows themselves: sorted, equal ones are neighbours.
    again = F.size(F.array_distinct(hashes)) < F.size(hashes)
    # (slice() would copy the whole array for each window.)
    gram = lambda i: F.struct(
        F.concat_ws(" ", *[F.get(col(words), i + k) for k in range(WINDOW)]).alias("g"),
        i.alias("i"),
    )
    rows = rows.withColumn(grams, F.when(again, F.sort_array(F.transform(starts, gram))))
    same = lambda x, k: F.coalesce(F.get(col(grams), k)["g"] == x["g"], F.lit(False))
    rows = rows.withColumn(
        spots,
        F.sort_array(
            F.transform(
                F.filter(grams, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]
            )
        ),
    )
    covered = F.aggregate(
        F.transform(
            spots,
            lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(col(spots), k + 1) - i, F.lit(WINDOW))),
        ),
        F.lit(0).cast("bigint"),
        lambda a, x: a + x,
    )
    stats = F.struct(
        size.cast("bigint").alias("n_words"),
        F.length(F.concat_ws("", col(words))).cast("bigint").alias("word_chars"),
        _count(col(t), SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        F.size(lines).cast("bigint").alias("n_lines"),
        _count(col(t), "[A-Z]").alias("n_upper"),
        _count(col(t), "[!?]").alias("n_marks"),
    )
    return rows.withColumn(into, stats).drop(t, words, lines, hashes, grams, spots)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < MIN_WORDS) | (
        100 * s["n_repeat_words"] > MAX_REPEATED_PERCENT * s["n_words"]
    )


def features(s: Column) -> dict[str, Column]:
    per_word = lambda c: s[c] / F.greatest(s["n_words"], F.lit(1))
    return {
        "chars_per_word": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "repeated_share": per_word("n_repeat_words"),
        "duplicate_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "words_per_line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)),
        "upper_share": s["n_upper"] / F.greatest(s["word_chars"], F.lit(1)),
        "marks_per_word": per_word("n_marks"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def test(self, value: Column) -> Column:
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]

    def test(self, values: dict[str, Column]) -> Column:
        return reduce(lambda a, b: a & b, [c.test(values[c.feature]) for c in self.conditions])

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


@dataclass
class DecisionList:
    """Rules in order; the first that fits rejects the text, and else it is kept."""

    rules: list[Rule] = field(default_factory=list)

    def number(self, values: dict[str, Column]) -> Column:
        """1 for the first rule, 2 for the second ...; 0 if none fits."""
        case = F.lit(0)
        for i, rule in reversed(list(enumerate(self.rules, 1))):
            case = F.when(rule.test(values), F.lit(i)).otherwise(case)
        return case

    def __str__(self) -> str:
        return "\n".join(f"{i}. reject if {r}" for i, r in enumerate(self.rules, 1)) or "no rule"


@dataclass(frozen=True)
class LearnOptions:
    """
    bins            quantile bins of a feature, from which thresholds are taken
    max_rules, max_conditions
    min_precision   share of bad rows among those a rule covers in the held-out third
    min_covered     bad rows a rule covers there at least
    """

    bins: int = 64
    max_rules: int = 12
    max_conditions: int = 3
    min_precision: float = 0.97
    min_covered: int = 3


def learn(labelled: DataFrame, options: LearnOptions = LearnOptions()) -> DecisionList:
    """``labelled``: column ``stats`` and ``bad`` (boolean). Two thirds of the rows grow the
    rules, one third prunes and judges them; the split is by a hash of the row."""
    values = features(F.col("stats"))
    names = list(values)
    rows = labelled.filter(F.col("bad").isNotNull() & ~base_failed(F.col("stats"))).select(
        *[v.alias(n) for n, v in values.items()],
        F.col("bad").cast("int").alias("bad"),
        (F.pmod(F.xxhash64("stats", *[c for c in labelled.columns if c == "doc_id"]), F.lit(3)) > 0)
        .alias("grow"),
    )
    rows = stored(rows, "labelled")
    quantiles = [i / options.bins for i in range(1, options.bins)]
    cuts = rows.agg(*[F.percentile_approx(n, quantiles, 10_000).alias(n) for n in names]).first()
    if cuts[0] is None:
        return DecisionList()
    edges = {n: sorted(set(cuts[n])) for n in names}

    def bin_of(name: str) -> Column:
        below = F.array(*[F.lit(float(x)) for x in edges[name]])
        return F.size(F.filter(below, lambda x: x < F.col(name)))

    rows = stored(rows.select("*", *[bin_of(n).alias(f"bin_{n}") for n in names]), "binned")
    own = {n: F.col(n) for n in names}
    found = DecisionList()
    while len(found.rules) < options.max_rules:
        left = rows.filter(found.number(own) == 0)
        conditions = _grow(left.filter("grow"), names, own, options)
        kept = _prune(left.filter("NOT grow"), conditions, own, options)
        if not kept:
            break
        found.rules.append(kept)
    return found


def _grow(rows: DataFrame, names: list[str], own: dict, options: LearnOptions) -> list[Condition]:
    """Adds the condition of most information gain until no good row is covered."""
    conditions: list[Condition] = []
    while len(conditions) < options.max_conditions:
        covered = rows.filter(Rule(tuple(conditions)).test(own)) if conditions else rows
        cells = covered.select(
            "bad",
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(n).alias("feature"),
                            F.col(f"bin_{n}").alias("bin"),
                            F.col(n).alias("value"),
                        )
                        for n in names
                    ]
                )
            ).alias("x"),
        )
        # At most (features x bins) rows, however many are labelled.
        table = (
            cells.groupBy("x.feature", "x.bin")
            .agg(F.sum("bad"), F.sum(1 - F.col("bad")), F.min("x.value"), F.max("x.value"))
            .collect()
        )
        best = _best(sorted(map(tuple, table)), names)
        if best is None:
            break
        conditions.append(best[0])
        if best[1] == 0:
            break
    return conditions


def _best(table: list[tuple], names: list[str]) -> tuple[Condition, int] | None:
    """The condition of most gain and the good rows it covers; thresholds lie halfway between
    the values of neighbouring bins."""
    best, most = None, 1e-9
    for name in names:
        bins = [t for t in table if t[0] == name]
        bad, good = sum(t[2] for t in bins), sum(t[3] for t in bins)
        if not bad or not good:
            return None
        before = math.log2(bad / (bad + good))
        p = n = 0
        for left, right in zip(bins, bins[1:], strict=False):
            p, n = p + left[2], n + left[3]
            threshold = (left[5] + right[4]) / 2
            for above, a, b in ((False, p, n), (True, bad - p, good - n)):
                gain = a * (math.log2(a / (a + b)) - before) if a else 0
                if gain > most:
                    best, most = (Condition(name, above, threshold), b), gain
    return best


def _prune(
    rows: DataFrame, conditions: list[Condition], own: dict, options: LearnOptions
) -> Rule | None:
    """Cuts last conditions while that serves the held-out rows; None if no form is good."""
    if not conditions:
        return None
    forms = [Rule(tuple(conditions[:k])) for k in range(1, len(conditions) + 1)]
    counts = rows.agg(
        *[
            F.coalesce(F.sum(F.when(form.test(own), x)), F.lit(0))
            for form in forms
            for x in (F.col("bad"), 1 - F.col("bad"))
        ]
    ).first()
    best, most = None, -2.0
    for k, form in enumerate(forms):
        p, n = counts[2 * k], counts[2 * k + 1]
        if p < options.min_covered or p < options.min_precision * (p + n):
            continue
        if (p - n) / (p + n) > most:
            best, most = form, (p - n) / (p + n)
    return best


def label_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Joins counts (doc_id, stats) with labels (doc_id, quality: 1 good, 0 bad). A document
    with contradicting labels counts as good; one without a label teaches nothing."""
    once = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.max("quality") == 0).alias("bad"))
    )
    return stats.select("doc_id", "stats").join(once, "doc_id")


def judged(stats: DataFrame, rules: DecisionList, into: str = "rule_number") -> DataFrame:
    """Adds the number of the rule that rejects the row: -1 the base rule, 0 none."""
    s = F.col("stats")
    return stats.withColumn(
        into, F.when(base_failed(s), F.lit(-1)).otherwise(rules.number(features(s)))
    )


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: its counts, ``base_failed``, ``rule_number`` and ``kept``."""
    stats = stored(with_stats(docs.select("doc_id", "text")).select("doc_id", "stats"), "stats")
    rules = learn(label_rows(stats, labels))
    return judged(stats, rules).select(
        "doc_id",
        *[F.col(f"stats.{c}").alias(c) for c in COUNTS],
        base_failed(F.col("stats")).alias("base_failed"),
        "rule_number",
        (F.col("rule_number") == 0).alias("kept"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that no rule rejects, with all their columns."""
    # Texts are counted once; verdicts come back by the texts' digests.
    counted = with_stats(docs.select("doc_id", "text")).withColumn("digest", text_digest())
    stats = stored(counted.select("doc_id", "digest", "stats"), "stats")
    rules = learn(label_rows(stats, labels))
    number = judged(stats, rules).filter("rule_number <> 0")
    own = free_name(docs, "_digest")
    rejected = stored(number.select(F.col("digest").alias(own)).distinct(), "rejected")
    discard(stats)
    # A null text has no words: the base rule rejects it.
    rows = docs.filter(F.col("text").isNotNull()).withColumn(own, text_digest())
    return rows.join(if_small(rejected), own, "left_anti").drop(own)
