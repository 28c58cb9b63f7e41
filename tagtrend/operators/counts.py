"""Counts, shares, coverage and distributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _records(weight: str | None, condition: Column | None = None) -> Column:
    """Number of records: of rows, or of what the rows stand for where they are already counted."""
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    return F.sum(one if condition is None else F.when(condition, one).otherwise(0))


def _counts(df: DataFrame, column: str, weight: str | None) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(_records(weight).alias("n"))


def value_counts(df: DataFrame, column: str, *, weight: str | None = None) -> DataFrame:
    """`value, n, pct`. The total is a scalar subquery over the counts, so no window gathers them."""
    counts = _counts(df, column, weight)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.col("n") * 100.0 / total)


def top_values(df: DataFrame, column: str, k: int, *, weight: str | None = None) -> DataFrame:
    return _counts(df, column, weight).orderBy(F.desc("n"), "value").limit(k)


def distinct_counts(df: DataFrame, columns: Sequence[str], *, error: float | None = None) -> DataFrame:
    """Rows and distinct non-null values per column.

    Each column is aggregated on its own, so no copy of the rows is made per column and a map task sends each value
    once. With `error`, a relative standard deviation, the counts are sketches of fixed size from a single pass.
    """
    if error is not None:
        return df.agg(F.count("*").alias("n"), *[F.approx_count_distinct(c, error).alias(f"distinct_{c}") for c in columns])
    counted = [df.agg(F.count_distinct(F.col(c)).alias("d")).scalar().alias(f"distinct_{c}") for c in columns]
    return df.agg(F.count("*").alias("n")).select("n", *counted)


def coverage(df: DataFrame, conditions: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """Per condition the number and percentage of rows that meet it, overall or per group."""
    aggs = [F.count("*").alias("n")]
    for name, condition in conditions.items():
        hits = F.count_if(condition)
        aggs += [hits.alias(name), (hits * 100.0 / F.count("*")).alias(f"{name}_pct")]
    return df.groupBy(*by).agg(*aggs)


def distribution(df: DataFrame, group: str, category: str, *, weight: str | None = None) -> DataFrame:
    """`group, category, n, ratio` with the ratio over the group. The window sees counts, not rows."""
    counts = df.groupBy(group, category).agg(_records(weight).alias("n"))
    total = F.sum("n").over(Window.partitionBy(group))
    return counts.withColumn("ratio", F.col("n") * 100.0 / total)


def category_share(df: DataFrame, group: str, category: str, value: str, *, weight: str | None = None) -> DataFrame:
    """Per group the percentage of records of one category."""
    hits, every = _records(weight, F.col(category) == value), _records(weight)
    return df.groupBy(group).agg(every.alias("n"), (hits * 100.0 / every).alias("share"))


def numeric_profile(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group the mean and null share of a number, repeated on one row per distinct value and its count.

    Long form: a value's count is a row, so no group's distribution is gathered into one cell.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("n"))
    totals = counts.groupBy(group).agg(
        F.sum("n").alias("rows_in_group"),
        (F.sum(F.col(value) * F.col("n")) / F.sum(F.when(F.col(value).isNotNull(), F.col("n")))).alias("mean"),
        (F.sum(F.when(F.col(value).isNull(), F.col("n")).otherwise(0)) * 100.0 / F.sum("n")).alias("null_pct"),
    )
    return counts.join(totals, group).select(group, "rows_in_group", "mean", "null_pct", value, "n")
