"""Keyword rates per group or month, growth between periods, and the summary derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtrend.functions.text import mention, sql_text, text_or_empty
from tagtrend.operators.timeline import in_months


def keyword_rates(
    df: DataFrame, by: Sequence[str], tags: str, keywords: Sequence[str], *, match: str = "substring",
    weight: str | None = None,
) -> DataFrame:
    """`by..., keyword, n, total, rate`: the share of a group's rows whose tags mention each keyword.

    All keywords are counted in one conditional aggregate, so the shuffle carries one row per group and
    map task whatever the number of rows, and absent keywords keep their zero cells. `weight` is the number
    of records a row stands for, where `df` is already counted.
    """
    one = F.lit(1).cast("long") if weight is None else F.col(weight)
    lowered = df.select(*by, F.lower(text_or_empty(tags)).alias("_tags"), one.alias("_w"))
    hits = [F.expr(f"sum(CASE WHEN {mention('_tags', k, match)} THEN _w ELSE 0 END) AS _k{i}") for i, k in enumerate(keywords)]
    wide = lowered.groupBy(*by).agg(F.sum("_w").alias("total"), *hits)
    cells = ", ".join(f"struct({sql_text(k)} AS keyword, _k{i} AS n)" for i, k in enumerate(keywords))
    long = wide.select(*by, "total", F.expr(f"inline(array({cells}))"))
    return long.select(*by, "keyword", "n", "total", (F.col("n") * 100.0 / F.col("total")).alias("rate"))


def period_growth(
    rates: DataFrame,
    *,
    month: str = "ym",
    first: tuple[str, str],
    second: tuple[str, str],
    recent_from: str,
) -> DataFrame:
    """Per keyword the mean monthly rate in each period and the growth from the first to the second.

    Means are taken over unrounded monthly rates. A keyword absent from the first period has growth 0.
    The absolute counts behind the two periods come along as `count_first` and `count_second`.
    """
    ym = F.col(month)
    in_first, in_second = in_months(ym, *first), in_months(ym, *second)
    per_keyword = rates.groupBy("keyword").agg(
        F.coalesce(F.avg(F.when(in_first, F.col("rate"))), F.lit(0.0)).alias("mean_first"),
        F.coalesce(F.avg(F.when(in_second, F.col("rate"))), F.lit(0.0)).alias("mean_second"),
        F.coalesce(F.avg(F.when(ym >= recent_from, F.col("rate"))), F.lit(0.0)).alias("mean_recent"),
        F.avg("rate").alias("mean_all"),
        F.sum(F.when(in_first, F.col("n")).otherwise(0)).alias("count_first"),
        F.sum(F.when(in_second, F.col("n")).otherwise(0)).alias("count_second"),
    )
    growth = (F.col("mean_second") - F.col("mean_first")) / F.col("mean_first") * 100
    return per_keyword.withColumn("growth", F.when(F.col("mean_first") > 0, growth).otherwise(0.0))


def top_rising(growth: DataFrame, k: int) -> DataFrame:
    """The `k` fastest growing keywords, ranked as reported: by growth to one decimal, then by name."""
    return growth.orderBy(F.desc(F.round("growth", 1)), "keyword").limit(k)


def top_falling(growth: DataFrame, k: int) -> DataFrame:
    """The `k` fastest shrinking keywords, in the same ranking from the other end."""
    return growth.orderBy(F.round("growth", 1), "keyword").limit(k)


def trend_summary(
    growth: DataFrame, peaks: DataFrame, *, rising: int = 5, falling: int = 3, top: int = 10
) -> DataFrame:
    """`section, rank, name, value, mean, at`: rising, falling and most common keywords, and peak months.

    `growth` has one row per dictionary keyword, so ranking it in one task is bounded by the dictionary.
    """
    g = growth.select(
        "keyword", F.round("growth", 1).alias("g"), F.round("mean_all", 1).alias("m"), F.lit(0).alias("_one")
    )

    def rank(*order):
        return F.row_number().over(Window.partitionBy("_one").orderBy(*order, "keyword"))

    ranked = g.select(
        "keyword", "g", "m", rank(F.desc("g")).alias("up"), rank(F.asc("g")).alias("down"), rank(F.desc("m")).alias("big")
    )

    def entry(section: str, position: str, value: str, last: int):
        cell = F.struct(
            F.lit(section).alias("section"), F.col(position).alias("rank"), F.col("keyword").alias("name"),
            F.col(value).alias("value"), F.col("m").alias("mean"), F.lit(None).cast("string").alias("at"),
        )
        return F.when(F.col(position) <= last, cell)

    entries = F.array_compact(
        F.array(entry("rising", "up", "g", rising), entry("falling", "down", "g", falling), entry("top", "big", "m", top))
    )
    peak_rows = peaks.select(
        F.lit("peak").alias("section"), F.lit(1).alias("rank"), F.col("category").alias("name"),
        F.col("peak_n").cast("double").alias("value"), F.lit(None).cast("double").alias("mean"),
        F.col("peak_month").alias("at"),
    )
    return ranked.select(F.inline(entries)).unionByName(peak_rows)


def segment_ranking(rates: DataFrame, segment: str, k: int) -> DataFrame:
    """The `k` highest-rated keywords of every segment."""
    window = Window.partitionBy(segment).orderBy(F.desc("rate"), "keyword")
    return rates.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)


def two_segments(rates: DataFrame, segment: str, name: str, value: str, a: str, b: str) -> DataFrame:
    """Pivot-join of two segments: `name, a, b, total, diff`, a side without the entry counting as 0."""
    side = {
        out: F.coalesce(F.max(F.when(F.col(segment) == which, F.col(value))), F.lit(0.0)).alias(out)
        for out, which in (("a", a), ("b", b))
    }
    pairs = rates.where(F.col(segment).isin(a, b)).groupBy(F.col(name).alias("name")).agg(*side.values())
    return pairs.select("name", "a", "b", (F.col("a") + F.col("b")).alias("total"), (F.col("a") - F.col("b")).alias("diff"))


def distinctive(pairs: DataFrame, threshold: float = 8.0) -> DataFrame:
    """Entries whose two rates, to one decimal, differ by at least `threshold` points, and the leading side."""
    gap = F.round(F.round("a", 1) - F.round("b", 1), 1)
    return (
        pairs.select("name", F.round("a", 1).alias("a"), F.round("b", 1).alias("b"), gap.alias("diff"))
        .where(F.abs("diff") >= threshold)
        .withColumn("leader", F.when(F.col("diff") > 0, F.lit("a")).otherwise(F.lit("b")))
    )


def common_and_different(pairs: DataFrame, *, common: int = 4, different: int = 3) -> DataFrame:
    """`section, rank, name, a, b, diff`: entries both segments share most, each side's largest leads, and
    the headline pair (largest sum, largest absolute gap). Ranks are taken over the small pivot table."""
    p = pairs.select(
        "name", F.round("a", 1).alias("a"), F.round("b", 1).alias("b"), F.lit(0).alias("_one")
    ).withColumns({"total": F.round(F.col("a") + F.col("b"), 1), "diff": F.round(F.col("a") - F.col("b"), 1)})

    def rank(*order):
        return F.row_number().over(Window.partitionBy("_one").orderBy(*order, "name"))

    ranked = p.withColumns({
        "r_common": rank(F.desc("total")), "r_gap": rank(F.desc(F.abs("diff"))),
        "r_a": rank(F.desc("diff")), "r_b": rank(F.asc("diff")),
    })

    def entry(section: str, position: str, condition):
        return F.when(condition, F.struct(
            F.lit(section).alias("section"), F.col(position).alias("rank"), "name", "a", "b", "diff"
        ))

    entries = F.array_compact(F.array(
        entry("common", "r_common", F.col("r_common") <= common),
        entry("a_leads", "r_a", (F.col("r_a") <= different) & (F.col("diff") > 0)),
        entry("b_leads", "r_b", (F.col("r_b") <= different) & (F.col("diff") < 0)),
        entry("headline_common", "r_common", F.col("r_common") == 1),
        entry("headline_gap", "r_gap", F.col("r_gap") == 1),
    ))
    return ranked.select(F.inline(entries))
