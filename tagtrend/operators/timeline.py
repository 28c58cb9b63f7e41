"""Dates: linear fit of time on id, imputation, calendar columns and monthly counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.dates import EPOCH, date_of_seconds, epoch_seconds, year_month
from tagtrend.functions.text import as_column


def fit_id_to_time(df: DataFrame, ident: str | Column, moment: str | Column) -> DataFrame:
    """Least-squares fit of time (seconds) on a numeric id over the rows that have both.

    One pass, one row: `n, slope, intercept, r, mean_id, mean_estimate` (the fit checked at the mean id).
    """
    known = df.select(as_column(ident).cast("double").alias("x"), epoch_seconds(moment).alias("y")).where(
        F.col("x").isNotNull() & F.col("y").isNotNull()
    )
    fit = known.agg(
        F.count("*").alias("n"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.corr("y", "x").alias("r"),
        F.avg("x").alias("mean_id"),
    )
    at_mean = F.col("slope") * F.floor("mean_id") + F.col("intercept")
    return fit.withColumn("mean_estimate", date_of_seconds(at_mean))


def impute_dates(
    df: DataFrame,
    fit: DataFrame,
    *,
    ident: str | Column,
    given: str | Column,
    estimable: Column | None = None,
    low: str,
    high: str,
    min_abs_r: float | None = None,
    out: str = "date_est",
) -> DataFrame:
    """The given date, else (where `estimable`) the fitted one, null outside [`low`, `high`].

    The one-row fit enters as a scalar subquery, so no join is planned.
    """
    coefficients = fit.select(F.struct("slope", "intercept", "r")).scalar()
    seconds = coefficients["slope"] * as_column(ident).cast("double") + coefficients["intercept"]
    usable = F.lit(True) if estimable is None else estimable
    if min_abs_r is not None:
        usable = usable & (F.abs(coefficients["r"]) >= min_abs_r)
    work = df.withColumn("_sec", F.when(usable, seconds))
    bounds = [epoch_seconds(F.lit(d).cast("date")) for d in (low, high)]
    estimate = F.when(F.col("_sec").between(*bounds), date_of_seconds("_sec"))
    return work.withColumn(out, F.coalesce(as_column(given).cast("date"), estimate)).drop("_sec")


def posting_calendar(df: DataFrame, deadline: str, *, lead_days: int = 30, prefix: str = "posted") -> DataFrame:
    """Posting date = deadline minus `lead_days`, with its year-month, year, month and quarter."""
    posted = f"{prefix}_est"
    return (
        df.withColumn(posted, F.date_sub(F.col(deadline), lead_days))
        .withColumn("ym", year_month(posted))
        .withColumn("year", F.year(posted))
        .withColumn("month", F.month(posted))
        .withColumn("quarter", F.quarter(posted))
    )


def in_months(ym: str | Column, low: str, high: str) -> Column:
    """Closed range of `yyyy-MM`; null and empty months fall out."""
    return as_column(ym).between(low, high)


def month_counts(
    df: DataFrame, ym: str, low: str | None = None, high: str | None = None, *, weight: str | None = None
) -> DataFrame:
    """Records per month, in a closed range of months if given; undated records fall out."""
    rows = df if low is None else df.where(in_months(ym, low, high))
    count = F.count("*") if weight is None else F.sum(weight)
    return rows.where(F.col(ym).isNotNull() & (F.col(ym) != "")).groupBy(ym).agg(count.alias("n"))


def month_category_table(
    df: DataFrame, ym: str, category: str, values: Sequence[str], *, weight: str | None = None
) -> DataFrame:
    """Wide month x category counts in a fixed column order, zero where a month has none. One aggregate.

    `weight` is the number of records a row stands for, where `df` is already counted.
    """
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    return df.groupBy(ym).agg(*[F.sum(F.when(F.col(category) == v, one).otherwise(0)).alias(v) for v in values])


def month_category_counts(
    df: DataFrame, ym: str, category: str, values: Sequence[str], *, weight: str | None = None
) -> DataFrame:
    """The same table in long form (`ym, category, n`), zeros included."""
    wide = month_category_table(df, ym, category, values, weight=weight)
    cells = F.array(*[F.struct(F.lit(v).alias("category"), F.col(f"`{v}`").alias("n")) for v in values])
    return wide.select(F.col(ym).alias("ym"), F.inline(cells))
