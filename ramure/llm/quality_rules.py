"""Quality rules: text statistics as column expressions, and a decision list learned from labelled statistics by sequential covering."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ramure.llm.common import stored, words_of

# Characters counted as symbols, and the base rule's bounds.
SYMBOLS = "#*$%&|<>"
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30

#: Statistics that conditions may test, all whole numbers; counts are given per thousand.
FEATURES = ("n_words", "word_length", "symbols", "dup_lines", "repeated", "distinct", "capitals", "marks", "digits")


def text_statistics(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row (key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, features of FEATURES) of the whole text.

    Null and blank texts have no words and zeros everywhere. A window of eight words is told by a 64-bit hash of its words' hashes;
    repeated ones are neighbours after sorting, so no list of windows is searched. All of it stays inside the row: no shuffle.
    """
    words = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("words", words_of(F.col("t")))

    def chars(pattern: str) -> Column:
        return F.length("t") - F.length(F.regexp_replace("t", pattern, ""))

    lines = words.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    counted = lines.select(
        key, F.size("words").alias("n_words"), F.length(F.array_join("words", "")).alias("word_chars"),
        chars(f"[{SYMBOLS}]+").alias("n_symbols"), chars("[A-Z]+").alias("n_capitals"), chars("[!?]+").alias("n_marks"),
        chars("[0-9]+").alias("n_digits"), F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"))
    windows = counted.withColumn("n_distinct", F.size(F.array_distinct("hashes"))).withColumn("sorted", F.when(
        F.col("n_words") > WINDOW,
        F.array_sort(F.transform(F.sequence(F.lit(0), F.col("n_words") - WINDOW), lambda i: F.struct(
            F.xxhash64(*[F.get("hashes", i + n) for n in range(WINDOW)]).alias("h"), i.alias("i"))))))
    starts = windows.drop("hashes").withColumn("starts", F.array_sort(F.filter(
        F.transform("sorted", lambda entry, k: F.when(
            (entry["h"] == F.get("sorted", k + 1)["h"]) | (entry["h"] == F.get("sorted", k - 1)["h"]), entry["i"])),
        lambda i: i.isNotNull())))
    # every start covers eight words, less what the start before it has covered
    covered = F.aggregate("starts", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), lambda all_, i: F.struct(
        (all_["n"] + F.least(F.lit(WINDOW), i - all_["last"])).alias("n"), i.alias("last")))["n"]
    done = starts.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)))

    def per_thousand(count: str, of: str = "n_words", scale: int = 1000) -> Column:
        return F.floor(F.col(count) * F.lit(scale) / F.greatest(F.col(of), F.lit(1))).cast("long")

    return done.select(
        key, *[F.col(name).cast("long").alias(name) for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        per_thousand("word_chars", scale=100).alias("word_length"), per_thousand("n_symbols").alias("symbols"),
        per_thousand("n_dup_lines", "n_lines").alias("dup_lines"), per_thousand("n_repeat_words").alias("repeated"),
        per_thousand("n_distinct").alias("distinct"), per_thousand("n_capitals", "word_chars").alias("capitals"),
        per_thousand("n_marks").alias("marks"), per_thousand("n_digits", "word_chars").alias("digits"))


def base_failed() -> Column:
    """The base rule: too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """`feature` above `cut`, or at most `cut`."""

    feature: str
    above: bool
    cut: int

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut}"


@dataclass
class DecisionList:
    """Rules in order, each a conjunction that rejects what it covers; what none covers is kept."""

    rules: list[tuple[Condition, ...]] = field(default_factory=list)

    def verdict(self) -> Column:
        """The list as a conditional expression: true for rows to be kept."""
        verdict = None
        for rule in self.rules:
            verdict = (F if verdict is None else verdict).when(_all(rule), F.lit(False))
        return F.lit(True) if verdict is None else verdict.otherwise(F.lit(True))

    def __str__(self) -> str:
        return "\n".join([*("reject if " + " and ".join(map(str, rule)) for rule in self.rules), "keep"])


def _all(rule: Sequence[Condition]) -> Column:
    column = F.lit(True)
    for condition in rule:
        column = column & F.coalesce(condition.column(), F.lit(False))
    return column


def _best(rows: DataFrame, features: Sequence[str], held: tuple[int, int]) -> tuple[Condition, tuple[int, int], float] | None:
    """The condition of most information gain about the bad rows that stay covered, with the bad and good rows that meet it and the gain.

    Every value that occurs is a cut: rows are counted by feature and value, and running sums over those counts give both sides of all cuts.
    """
    values = F.array(*[F.struct(F.lit(n).alias("f"), F.col(name).cast("long").alias("v")) for n, name in enumerate(features)])
    counts = (rows.select("bad", F.explode(values).alias("s")).where("s.v IS NOT NULL").groupBy("s.f", "s.v")
              .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")))
    upto = Window.partitionBy("f").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("f")
    sums = counts.select("f", "v", *[F.sum(name).over(window).alias(f"{side}_{name}") for name in ("p", "n") for side, window in (("low", upto), ("all", whole))])
    sides = sums.select("f", "v", F.explode(F.array(*[
        F.struct(F.lit(above).alias("above"), *[(F.col(f"all_{name}") - F.col(f"low_{name}") if above else F.col(f"low_{name}")).alias(name)
                                                for name in ("p", "n")]) for above in (False, True)])).alias("side")).select("f", "v", "side.*")
    share = math.log2(held[0] / sum(held))
    gained = sides.where("p > 0").withColumn("gain", F.round(F.col("p") * (F.log2(F.col("p") / (F.col("p") + F.col("n"))) - F.lit(share)), 6))
    first = gained.orderBy(F.desc("gain"), "f", "v", "above").first()
    return first and (Condition(features[first["f"]], first["above"], first["v"]), (first["p"], first["n"]), first["gain"])


def learn_decision_list(labelled: DataFrame, label: str = "quality", key: str = "doc_id", features: Sequence[str] = FEATURES,
                        most_rules: int | None = None, precision: float = 0.98, least_covered: int = 5) -> DecisionList:
    """Learn a list that rejects rows with label 0, by sequential covering over all labelled rows.

    Each rule is grown on two thirds of the rows left, by the condition of most information gain at a time, and pruned from its end on
    the last third. It joins the list if, of what it covers there, at least `precision` is bad; else learning ends, or with `most_rules`
    rules where that is given. What a rule covers is then left out. Every step is one aggregation in Spark, over all values of all features;
    rows with a null label or key are ignored. No rows, no bad rows or features that don't differ give the empty list, which keeps
    everything. Ties go to the earlier feature and the smaller cut.
    """
    rows = stored(labelled.where(F.col(label).isNotNull() & F.col(key).isNotNull())
                  .select(*features, (F.col(label) == 0).cast("long").alias("bad"),
                          (F.pmod(F.xxhash64(key, F.lit("grow")), F.lit(3)) > 0).alias("grow")), "labelled")
    learned = DecisionList()
    left = rows
    while most_rules is None or len(learned.rules) < most_rules:
        rule = _grown(left.where("grow"), features)
        rule = _pruned(left.where("NOT grow"), rule, precision, least_covered)
        if not rule:
            break
        learned.rules.append(rule)
        left = left.where(~_all(rule))
    return learned


def _grown(rows: DataFrame, features: Sequence[str]) -> tuple[Condition, ...]:
    rule: tuple[Condition, ...] = ()
    start = rows.agg(F.coalesce(F.sum("bad"), F.lit(0)), F.coalesce(F.sum(1 - F.col("bad")), F.lit(0))).first()
    held = (start[0], start[1])
    while held[0] and held[1]:
        best = _best(rows.where(_all(rule)), features, held)
        if not best or best[2] <= 0:
            break
        rule, held = (*rule, best[0]), best[1]
    return rule


def _pruned(rows: DataFrame, rule: tuple[Condition, ...], precision: float, least: int) -> tuple[Condition, ...]:
    if not rule:
        return ()
    sums = []
    for n in range(1, len(rule) + 1):
        inside = _all(rule[:n])
        sums += [F.coalesce(F.sum(F.when(inside, F.col("bad"))), F.lit(0)), F.coalesce(F.sum(F.when(inside, 1 - F.col("bad"))), F.lit(0))]
    found = rows.agg(*sums).first()
    held = [(found[2 * n], found[2 * n + 1]) for n in range(len(rule))]
    worth = [(p - n) / (p + n) if p + n else -1.0 for p, n in held]
    best = max(range(len(rule)), key=lambda n: (worth[n], -n))
    p, n = held[best]
    return rule[:best + 1] if p >= least and p >= precision * (p + n) else ()


def judge(statistics: DataFrame, learned: DecisionList) -> DataFrame:
    """`statistics` with base_failed, and kept: false where the base rule fails, else the list's verdict."""
    return statistics.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & learned.verdict())


def quality_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", **settings) -> tuple[DataFrame, DecisionList]:
    """Statistics, base rule and verdict of every document, and the list learned from `labels` (key, quality).

    Statistics are computed once and written to the shared folder; learning and verdicts read them there. Documents that repeat keep
    their rows; of a repeated label the smaller counts.
    """
    statistics = stored(text_statistics(docs, key=key), "statistics")
    quality = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("quality"))
    learned = learn_decision_list(statistics.join(quality, key), key=key, **settings)
    return judge(statistics, learned), learned
