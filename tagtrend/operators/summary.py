"""Per-stage summary tables with printable text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import one_decimal, percent_bar, thousands
from tagtrend.operators.counts import top_values, value_counts


def count_lines(df: DataFrame, column: str, section: str, *, weight: str | None = None) -> DataFrame:
    """`section, label, n, line`: every value with its count, percentage and a text bar."""
    counts = value_counts(df, column, weight=weight)
    line = F.concat_ws(" ", thousands("n"), F.concat(F.lit("("), one_decimal("pct"), F.lit("%)")), percent_bar("pct"))
    return counts.select(F.lit(section).alias("section"), F.col("value").alias("label"), "n", F.rtrim(line).alias("line"))


def stage_summary(
    df: DataFrame, *, shares: Mapping[str, str], tops: Mapping[str, tuple[str, int]], covered: Mapping[str, Column],
    distinct: Sequence[str] = (), weight: str | None = None,
) -> DataFrame:
    """The printed summary of a stage as one table: totals, shares, leading values and coverage. `weight` is
    the number of records a row stands for, where `df` is already counted."""
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    names = list(covered)
    facts = df.agg(
        F.sum(one).alias("rows"),
        *[F.count_distinct(F.col(c)).alias(f"_d{i}") for i, c in enumerate(distinct)],
        *[F.sum(F.when(covered[n], one).otherwise(0)).alias(f"_c{i}") for i, n in enumerate(names)],
    )

    def entry(section: str, label: str, n: Column, line: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), F.lit(label).alias("label"), n.alias("n"), line.alias("line"))

    entries = [entry("total", "rows", F.col("rows"), thousands("rows"))]
    entries += [entry("distinct", c, F.col(f"_d{i}"), thousands(f"_d{i}")) for i, c in enumerate(distinct)]
    for i, n in enumerate(names):
        pct = F.col(f"_c{i}") * 100.0 / F.col("rows")
        line = F.concat(thousands(f"_c{i}"), F.lit(" ("), one_decimal(pct), F.lit("%)"))
        entries.append(entry("coverage", n, F.col(f"_c{i}"), line))
    out = facts.select(F.inline(F.array(*entries)))
    for section, column in shares.items():
        out = out.unionByName(count_lines(df, column, section, weight=weight))
    for section, (column, k) in tops.items():
        top = top_values(df, column, k, weight=weight).select(
            F.lit(section).alias("section"), F.col("value").cast("string").alias("label"), "n", thousands("n").alias("line")
        )
        out = out.unionByName(top)
    return out
