"""Quality rules as a decision list learned by sequential covering, in DataFrame functions only.

Text statistics are native expressions. Labelled documents are reduced to the bins of their statistics and counted, so
that growing a rule reads a small table: each step counts the labels in every bin of every statistic among the rows
that the rule covers so far, and adds the threshold with the largest information gain. A finished rule is pruned on
the third of the rows it was not grown on, and kept if it stays precise there; the rows it covers leave, and the next
rule is grown. The result is an ordered list of conjunctions that becomes one CASE expression.

Defined results: null and empty texts have zero in every statistic; without labels the list is empty and everything is
kept; of several labels of a document the smallest counts; labels of documents that are not there, and null labels,
are ignored; repeated rows are counted as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import stage

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_distinct", "n_marks"]
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# What the rules may test: a count divided by another, so that long and short texts compare.
RATIOS = {
    "symbols_per_word": ("n_symbols", "n_words"),
    "chars_per_word": ("word_chars", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "distinct_share": ("n_distinct", "n_words"),
    "marks_per_word": ("n_marks", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def _count_of(text: str, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def statistics(documents: DataFrame) -> DataFrame:
    """doc_id and the counts of every whole text."""
    words = F.array_remove(F.split("_t", r"[ \t-\r]+"), "")
    size = F.size("_w")
    grams = F.transform("_w", lambda x, i: F.xxhash64(x, F.get("_w", i + 1), F.get("_w", i + 2)))
    by_hash = F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(p: Column, i: Column) -> Column:
        before, after = F.get("_s", i - 1)["h"], F.get("_s", i + 1)["h"]
        return F.coalesce(before == p["h"], F.lit(False)) | F.coalesce(after == p["h"], F.lit(False))

    places = F.sort_array(F.transform(F.filter("_s", again), lambda p: p["i"]))
    # a repeated window adds its three words, less those that the next one holds as well
    added = F.transform("_p", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("_p", i + 1) - p, F.lit(3))))
    return (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_t"))
        .withColumns({"_w": words, "_l": F.filter(F.split("_t", "\n"), lambda line: F.translate(line, BLANKS, "") != "")})
        .withColumn("_g", F.when(size >= 3, F.slice(grams, 1, size - 2)).otherwise(F.array().cast("array<long>")))
        .withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), by_hash).otherwise(F.array().cast("array<struct<h:long,i:int>>")))
        .withColumn("_p", places)
        .select(
            "doc_id",
            size.cast("long").alias("n_words"),
            F.char_length(F.translate("_t", BLANKS, "")).cast("long").alias("word_chars"),
            _count_of("_t", SYMBOLS).alias("n_symbols"),
            (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
            F.aggregate(added, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"),
            F.size("_l").cast("long").alias("n_lines"),
            _count_of("_t", CAPITALS).alias("n_capitals"),
            F.size(F.array_distinct("_w")).cast("long").alias("n_distinct"),
            _count_of("_t", "!?.,;:").alias("n_marks"),
        )
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def ratio(name: str) -> Column:
    above, below = RATIOS[name]
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


@dataclass(frozen=True)
class Condition:
    """A statistic is at least a threshold, or below it."""

    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = ratio(self.statistic)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass(frozen=True)
class Rule:
    """A conjunction that rejects what it covers."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " AND ".join(map(str, self.conditions)) + " -> reject"


def _bin(name: str, cuts: list[float]) -> Column:
    """How many of the cut points a statistic has reached."""
    return F.size(F.filter(F.lit(cuts).cast("array<double>"), lambda cut: cut <= F.col(name))) if cuts else F.lit(0)


Step = tuple[int, bool, int]  # statistic, at least, bin


def _holds(steps: list[Step]) -> Column:
    out = F.lit(True)
    for f, at_least, b in steps:
        out = out & (F.col("bins")[f] >= b if at_least else F.col("bins")[f] < b)
    return out


def learn(
    stats: DataFrame, labels: DataFrame, *, levels: int = 32, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.8
) -> list[Rule]:
    """The ordered rejecting rules for `labels` (doc_id, quality: 1 is good). Only cut points and counts per bin, as
    many as statistics times levels, reach the driver."""
    names = list(RATIOS)
    marked = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    rows = stats.select("doc_id", *[ratio(n).alias(n) for n in names]).join(marked, "doc_id")
    shares = [i / levels for i in range(1, levels)]
    found = rows.agg(*[F.percentile_approx(n, shares, 10_000).alias(n) for n in names]).first()
    cuts = [sorted(set(found[n] or [])) for n in names]
    bins = F.array(*[_bin(n, c) for n, c in zip(names, cuts, strict=True)])
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0
    left = stage(
        rows.groupBy(bins.alias("bins"), part.alias("prune"), (F.col("quality") == 0).alias("bad")).agg(F.count("*").alias("n")),
        "decision-bins",
    )
    bad, total = (left.agg(F.sum(F.when(F.col("bad"), F.col("n"))), F.sum("n")).first()) if any(cuts) else (0, 0)
    if not bad or bad == total:
        return []

    rules: list[Rule] = []
    taken = F.lit(False)
    while len(rules) < max_rules:
        rest = left.where(~taken)
        steps = _prune(rest, _grow(rest.where("NOT prune"), cuts, max_conditions), precision)
        if not steps:
            break
        taken = taken | _holds(steps)
        rules.append(Rule(tuple(Condition(names[f], at, cuts[f][b - 1]) for f, at, b in steps)))
    return rules


def _grow(rows: DataFrame, cuts: list[list[float]], max_conditions: int) -> list[Step]:
    """Add the step of the largest gain until the rule covers no good row, or nothing is gained."""
    steps: list[Step] = []
    while len(steps) < max_conditions:
        counts = (
            rows.where(_holds(steps)).select("bad", "n", F.posexplode("bins").alias("f", "b"))
            .groupBy("f", "b").agg(F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("p"), F.sum("n").alias("n")).collect()
        )
        per: dict[int, dict[int, tuple[int, int]]] = {}
        for r in counts:
            per.setdefault(r["f"], {})[r["b"]] = (r["p"], r["n"])
        if not per:
            break
        p0, n0 = (sum(x[i] for x in per[0].values()) for i in (0, 1))
        if not p0 or p0 == n0:
            break
        best: tuple[float, Step] | None = None
        for f in sorted(per):
            p = n = 0
            for b in range(len(cuts[f]) + 1):
                for at_least, (q, m) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
                    if b and q and m < n0:
                        gain = q * (math.log2(q / m) - math.log2(p0 / n0))
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, (f, at_least, b))
                p, n = p + per[f].get(b, (0, 0))[0], n + per[f].get(b, (0, 0))[1]
        if best is None:
            break
        steps.append(best[1])
    return steps


def _prune(rows: DataFrame, steps: list[Step], precision: float) -> list[Step]:
    """The prefix of a rule that does best on the rows held back; none if it isn't precise there."""
    if not steps:
        return []
    sums = []
    for k in range(1, len(steps) + 1):
        hit = _holds(steps[:k]) & F.col("prune")
        sums += [F.sum(F.when(hit & F.col("bad"), F.col("n")).otherwise(0)), F.sum(F.when(hit, F.col("n")).otherwise(0))]
    found = rows.agg(*sums).first()
    worth = [((2 * (found[2 * k] or 0) - (found[2 * k + 1] or 0)) / ((found[2 * k + 1] or 0) + 2), -k) for k in range(len(steps))]
    k = -max(worth)[1]
    p, n = found[2 * k] or 0, found[2 * k + 1] or 0
    return steps[: k + 1] if n and p >= precision * n else []


def rejected(rules: list[Rule]) -> Column:
    """The number of the first rule that covers a row, as an ordered CASE; null where none does."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(rules[0].column(), 1)
    for i, rule in enumerate(rules[1:], 2):
        out = out.when(rule.column(), i)
    return out


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, the number of the rejecting rule, and kept."""
    stats = stage(statistics(documents), "decision-statistics")
    rules = learn(stats, labels)
    marked = stats.withColumns({"base_failed": base_failed(), "rule": rejected(rules)})
    return marked.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
