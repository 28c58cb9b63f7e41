"""Two-segment token rates and the bundle of comparison metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import tokens


def two_segment_token_rates(
    df: DataFrame, segment: str, tags: str, a: str, b: str, k: int = 10, *, weight: str | None = None
) -> DataFrame:
    """The `k` tokens most common over two segments, with each segment's share of rows that hold them.

    Rows of other segments are ignored; a row's repeated token counts once. `weight` is the number of
    records a row stands for, where `df` is already counted.
    """
    rows = df.where(F.col(segment).isin(a, b))
    # The empty token stands for the row itself, so segment sizes come out of the same aggregate.
    items = F.concat(F.array(F.lit("")), F.array_distinct(tokens(tags)))
    one = F.lit(1).cast("long") if weight is None else F.col(weight)

    def of(which: str) -> Column:
        return F.sum(F.when(F.col("_segment") == which, F.col("_w")).otherwise(0))

    counted = (
        rows.select(F.col(segment).alias("_segment"), one.alias("_w"), F.explode(items).alias("token"))
        .groupBy("token")
        .agg(of(a).alias("n_a"), of(b).alias("n_b"))
    )
    is_row = F.col("token") == ""
    sizes = counted.agg(F.struct(F.max(F.when(is_row, F.col("n_a"))).alias("a"), F.max(F.when(is_row, F.col("n_b"))).alias("b"))).scalar()
    top = counted.orderBy(is_row, F.desc(F.col("n_a") + F.col("n_b")), "token").limit(k).where(F.col("token") != "")
    return top.select(
        "token", "n_a", "n_b",
        (F.col("n_a") * 100.0 / F.nullif(sizes["a"], F.lit(0))).alias("rate_a"),
        (F.col("n_b") * 100.0 / F.nullif(sizes["b"], F.lit(0))).alias("rate_b"),
    )


def _object(key: str, value: str) -> Column:
    """Aggregate: a JSON object from key to value, keys in order. Used on aggregates keyed by rule labels
    and dictionary keywords, whose number bounds the object."""
    entries = F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(value).alias("v")))

    def by_key(x: Column, y: Column) -> Column:
        return F.when(x["k"] < y["k"], -1).when(x["k"] > y["k"], 1).otherwise(0)

    return F.map_from_entries(F.array_sort(entries, by_key))


def metrics_bundle(
    distribution: DataFrame, rates: DataFrame, ranking: DataFrame, gaps: DataFrame, shares: DataFrame, *,
    segment: str, category: str, dictionary: str,
) -> DataFrame:
    """One JSON document of the comparison: totals, keyword rates by segment and dictionary category, leading
    and distinctive keywords, the share of one category, and the category distribution.

    Inputs are result tables: `distribution` (segment, category, n, ratio), `rates` (segment, dictionary,
    keyword, rate), `ranking` (segment, rank, keyword, rate), `gaps` (name, a, b, diff, leader) and `shares`
    (segment, n, share). Every one is bounded by the rules and the dictionary, not by the data.
    """
    def one(df: DataFrame, value: Column) -> Column:
        return df.agg(value).scalar()

    def nested(df: DataFrame, outer: str, inner: str, value: str) -> DataFrame:
        return df.groupBy(outer).agg(_object(inner, value).alias("_object"))

    ratio = distribution.withColumn("_ratio", F.round("ratio", 1))
    rate = rates.withColumn("_rate", F.round("rate", 1))
    by_dictionary = rate.groupBy(segment, dictionary).agg(_object("keyword", "_rate").alias("_inner"))
    leaders = F.array_sort(F.collect_list(F.struct("rank", "keyword", F.round("rate", 1).alias("rate"))))
    distinct_keywords = F.array_sort(F.collect_list(F.struct("name", "a", "b", "diff", "leader")))
    totals = shares.withColumn("_share", F.round("share", 1)).agg(
        F.sum("n").alias("total"), _object(segment, "n").alias("segments"), _object(segment, "_share").alias("share")
    )
    return totals.select(F.to_json(F.struct(
        F.struct("total", "segments").alias("meta"),
        one(nested(by_dictionary, segment, dictionary, "_inner"), _object(segment, "_object")).alias("keyword_rates"),
        one(ranking.groupBy(segment).agg(leaders.alias("_list")), _object(segment, "_list")).alias("top_keywords"),
        one(gaps, distinct_keywords).alias("distinctive"),
        F.col("share").alias("category_share"),
        one(nested(ratio, segment, category, "_ratio"), _object(segment, "_object")).alias("distribution"),
    )).alias("document"))
