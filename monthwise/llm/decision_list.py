"""Quality rules: text statistics and a decision list learned by sequential covering.

Everything is DataFrame functions. Statistics are expressions on the text. Learning sees labelled
statistics only as counts by feature and threshold; its result is an ordered list of conjunctions that
becomes one conditional expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import GAP, WHITE, whole
from monthwise.session import materialise

SYMBOLS = r"[#*$%&|<>]"
LEVELS = 24


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def text_statistics(docs: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """``<ident>`` and counts of each whole text; null and empty texts count 0 of everything.

    ``n_repeat_words``: words in windows of three that occur twice or more in the text.
    """
    body = whole(F.col(text))
    rows = docs.select(F.col(ident), body.alias("_text")).select(
        F.col(ident),
        "_text",
        F.filter(F.split("_text", GAP), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias("_lines"),
    )
    n = F.size("_words")
    words = F.col("_words")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("*", windows.alias("_windows"))
    rows = rows.select("*", F.size(F.array_distinct("_windows")).alias("_different"))

    def starts(order: Column) -> Column:
        """Where a window begins that has an equal beside it in the sorted order."""
        def repeated(x: Column, i: Column) -> Column:
            return (x["h"] == F.get(order, i - 1)["h"]) | (x["h"] == F.get(order, i + 1)["h"])

        return F.transform(F.filter(order, repeated), lambda x: x["i"])

    numbered = F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    covered = _let(
        F.sort_array(numbered),
        lambda order: F.size(
            F.array_distinct(
                F.flatten(F.transform(starts(order), lambda i: F.array(i, i + 1, i + 2)))
            )
        ),
    )
    repeat = F.when(F.col("_different") == F.size("_windows"), 0).otherwise(covered)
    long = "bigint"
    return rows.select(
        F.col(ident),
        n.cast(long).alias("n_words"),
        F.length(F.array_join("_words", "")).cast(long).alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast(long).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast(long).alias("n_dup_lines"),
        repeat.cast(long).alias("n_repeat_words"),
        F.size("_lines").cast(long).alias("n_lines"),
        F.size(F.array_distinct("_words")).cast(long).alias("n_different"),
        F.regexp_count("_text", F.lit("[A-Z]")).cast(long).alias("n_capitals"),
        F.regexp_count("_text", F.lit("[!?]")).cast(long).alias("n_shouts"),
        F.regexp_count("_text", F.lit("[.,;:]")).cast(long).alias("n_points"),
        F.regexp_count("_text", F.lit("[0-9]")).cast(long).alias("n_digits"),
    )


def rates() -> dict[str, Column]:
    """What rules look at: shares that don't depend on the length of a text, never null."""
    def per(top: str, bottom: str) -> Column:
        return F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom)), F.lit(0.0))

    return {
        "word_length": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "duplicate_lines": per("n_dup_lines", "n_lines"),
        "repeated_words": per("n_repeat_words", "n_words"),
        "different_words": per("n_different", "n_words"),
        "capitals": per("n_capitals", "word_chars"),
        "shouts_per_word": per("n_shouts", "n_words"),
        "points_per_word": per("n_points", "n_words"),
        "digits": per("n_digits", "word_chars"),
        "words_per_line": per("n_words", "n_lines"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """All conditions hold. ``wrong`` of the ``hits`` on the pruning rows were good texts."""

    conditions: tuple[Condition, ...]
    hits: int
    wrong: int

    def column(self) -> Column:
        out = F.lit(True)
        for condition in self.conditions:
            out = out & condition.column()
        return out


def verdict(rules: Sequence[Rule]) -> Column:
    """The list as one conditional expression on the rates: true keeps the text."""
    out = F.lit(True)
    for rule in reversed(rules):
        out = F.when(rule.column(), False).otherwise(out)
    return out


def learn_rules(
    labelled: DataFrame,
    precision: float = 0.98,
    max_rules: int = 12,
    max_conditions: int = 3,
    min_share: float = 0.005,
) -> list[Rule]:
    """Rules for rejecting, from rows with the rates, ``_id`` and ``_label`` (0 is to be rejected).

    Rows are split by a hash of the id: two thirds to grow, one third to prune. Growing adds the
    condition with the largest gain of information until no good text is hit, pruning drops last
    conditions while that doesn't lower the share of bad texts among those hit. A rule must reach
    ``precision`` on both parts and cover ``min_share`` of the bad texts, else learning ends. Candidate
    thresholds are quantiles of the bad and of the good texts. Without labels there are no rules.
    """
    names = list(rates())
    rows = materialise(
        labelled.select(
            "_id", (F.col("_label") == 0).cast("int").alias("_bad"),
            (F.pmod(F.xxhash64("_id"), F.lit(3)) == 0).alias("_prune"), *names
        ),
        "rule-rows",
    )
    parts = [k / LEVELS for k in range(LEVELS + 1)]
    cuts = rows.groupBy("_bad").agg(*[F.percentile_approx(n, parts, 20000).alias(n) for n in names])
    levels: dict[str, list[float]] = {n: [] for n in names}
    for row in cuts.collect():  # two rows
        for n in names:
            levels[n] = sorted({*levels[n], *row[n]})
    bad_all = rows.agg(F.sum("_bad")).first()[0] or 0
    if not bad_all or len(levels[names[0]]) == 0:
        return []

    def binned(name: str) -> Column:
        marks = F.array(*[F.lit(float(x)) for x in levels[name]])
        return F.size(F.filter(marks, lambda m: m < F.col(name)))

    boxes = rows.withColumn(
        "_boxes",
        F.array(*[F.struct(F.lit(n).alias("feature"), binned(n).alias("bin")) for n in names]),
    )
    boxes = materialise(boxes, "rule-bins")

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        growing = boxes.where(left & ~F.col("_prune"))
        conditions: list[Condition] = []
        hit = F.lit(True)
        while len(conditions) < max_conditions:
            table = (
                growing.where(hit).select("_bad", F.explode("_boxes").alias("_b"))
                .groupBy("_b.feature", "_b.bin")
                .agg(F.sum("_bad").alias("bad"), F.count("*").alias("n"))
                .collect()  # features times levels
            )
            best = _best_condition(table, levels)
            if best is None:
                break
            condition, good_hit = best
            conditions.append(condition)
            hit = hit & condition.column()
            if good_hit == 0:
                break
        if not conditions:
            break
        sums, prefix = [], F.lit(True)
        for condition in conditions:
            prefix = prefix & condition.column()
            for part in (F.col("_prune"), ~F.col("_prune")):
                sums += [F.sum((prefix & part).cast("int") * F.col("_bad")),
                         F.sum((prefix & part).cast("int"))]
        counted = [int(x or 0) for x in boxes.where(left).agg(*sums).first()]
        measured = [counted[4 * k : 4 * k + 4] for k in range(len(conditions))]
        keep = len(conditions)
        while keep > 1 and _share(*measured[keep - 2][:2]) >= _share(*measured[keep - 1][:2]):
            keep -= 1
        bad_p, n_p, bad_g, n_g = measured[keep - 1]
        enough = bad_p + bad_g >= max(3, min_share * bad_all)
        if not enough or bad_p + bad_g < precision * (n_p + n_g) or bad_p < precision * n_p:
            break
        rule = Rule(tuple(conditions[:keep]), n_p, n_p - bad_p)
        rules.append(rule)
        left = left & ~rule.column()
    return rules


def _share(bad: int, n: int) -> float:
    return (bad + 0.5) / (n + 1)


def _best_condition(table, levels) -> tuple[Condition, int] | None:
    """The condition with the largest gain of information, and how many good texts it leaves."""
    from math import log2

    features: dict[str, list[tuple[int, int, int]]] = {}
    for row in table:
        features.setdefault(row["feature"], []).append((row["bin"], row["bad"], row["n"]))
    best, chosen = 1e-9, None
    for feature, bins in sorted(features.items()):
        bins.sort()
        all_bad, all_n = sum(b[1] for b in bins), sum(b[2] for b in bins)
        if not all_bad:
            return None
        bad = n = 0
        marks = levels[feature]
        for at, more_bad, more_n in bins[:-1]:
            bad, n = bad + more_bad, n + more_n
            if at >= len(marks):
                continue
            for above, b, m in ((False, bad, n), (True, all_bad - bad, all_n - n)):
                if not b:
                    continue
                gain = b * (log2(_share(b, m)) - log2(_share(all_bad, all_n)))
                if gain > best:
                    # Bin ``at`` holds values above mark at-1 and up to mark ``at``.
                    best, chosen = gain, (Condition(feature, above, marks[at]), m - b)
    return chosen


def base_failed() -> Column:
    """Too short, or more than half of the words repeated."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(
    docs: DataFrame, labels: DataFrame, text: str = "text", ident: str = "doc_id", **settings
) -> tuple[DataFrame, list[Rule]]:
    """Statistics, rates, ``base_failed`` and ``kept`` of each row, and the rules learned.

    Labels that are null, or of ids that are null or not in ``docs``, teach nothing; of several
    labels of an id the largest counts. Without usable labels the base rules alone decide. Repeated
    rows are judged alike; an empty table stays empty.
    """
    stats = materialise(text_statistics(docs, text, ident).withColumns(rates()), "text-statistics")
    known = (
        labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id").agg(F.max("_label").alias("_label"))
    )
    labelled = stats.withColumn("_id", F.col(ident)).join(known, "_id").where(~base_failed())
    rules = learn_rules(labelled, **settings)
    kept = ~base_failed() & verdict(rules)
    return stats.withColumns({"base_failed": base_failed(), "kept": kept}), rules
