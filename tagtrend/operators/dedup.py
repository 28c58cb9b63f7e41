"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key under a total order.

    An aggregate and not a window: each map task reduces a key to one row before the shuffle, so a key
    with a third of all rows costs no more than any other.
    """
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    carried = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*[F.col(c) for c in carried]), F.struct(*order_cols))
    return df.groupBy(*keys).agg(first.alias("_first")).select(*[c if c in keys else f"_first.{c}" for c in df.columns])


def keep_smallest(df: DataFrame, keys: Sequence[str], ident: str) -> DataFrame:
    """`keep_first` in the order of a unique number: the smallest `ident` of every key, then the rows that have it.

    The winners are fixed-width numbers, so they are hash-aggregated with map-side combining, and no row is sorted or
    carried through the aggregate; rows with long texts meet the winners in a semi-join on the number.
    """
    winners = df.groupBy(*keys).agg(F.min(ident).alias(ident)).select(ident)
    return df.join(winners, ident, "left_semi")


def with_digest(df: DataFrame, text: str, name: str = "text_key") -> DataFrame:
    """A fixed-width key for long texts, so whole texts are hashed once and never sorted as keys."""
    return df.withColumn(name, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows before, rows removed and rows kept by `keep_first` on the same keys."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("before_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("removed_rows"),
        F.count("*").alias("after_rows"),
    )
