"""Tag records from a keyword dictionary and classify them by ordered rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import Rules, as_column, first_match, joined_tags, lower_rules, text_or_empty, tokens


def tag_records(
    df: DataFrame,
    text: str | Column,
    dictionary: Mapping[str, Sequence[str]],
    *,
    match: str = "substring",
    prefix: str = "tags_",
    per_category: bool = True,
) -> DataFrame:
    """Add `tags_<category>` (dictionary order) and `tags_all` (sorted, distinct), both ", "-joined.

    The dictionary is fixed when the plan is built, so the search is one expression per keyword in the
    same stage as the scan: no join against a dictionary table, no shuffle, and the sorted union needs no
    sort at run time. The text is lower-cased once in a projection of its own, which Catalyst keeps
    because it is read more than once.
    """
    lowered = df.withColumn("_lower", F.lower(text_or_empty(text)))
    every = sorted({k for words in dictionary.values() for k in words})
    out = [joined_tags("_lower", every, match).alias(f"{prefix}all")]
    if per_category:
        out += [joined_tags("_lower", words, match).alias(f"{prefix}{c}") for c, words in dictionary.items()]
    return lowered.select(*[F.col(c) for c in df.columns], *out)


def classify(
    df: DataFrame, text: str | Column, rules: Rules, default: str | None, out: str, *, ignore_case: bool = True
) -> DataFrame:
    """Add the first rule, in order, that has a keyword inside the text; `default` where none has."""
    value = F.lower(text_or_empty(text)) if ignore_case else text_or_empty(text)
    found = first_match("_text", lower_rules(rules) if ignore_case else rules, default)
    return df.withColumn("_text", value).select(*[F.col(c) for c in df.columns], found.alias(out))


def dictionary_table(df_of_session: DataFrame, dictionary: Mapping[str, Sequence[str]]) -> DataFrame:
    """The dictionary as a table `category, position, keyword`, for export and for size reports."""
    rows = [(c, i, k) for c, words in dictionary.items() for i, k in enumerate(words)]
    return df_of_session.sparkSession.createDataFrame(rows, "category string, position int, keyword string")


def dictionary_usage(
    df: DataFrame, text: str | Column, dictionary: Mapping[str, Sequence[str]], *, match: str = "substring"
) -> DataFrame:
    """Per category: keywords in the dictionary and keywords seen in the text, with a total row."""
    seen = token_counts(tag_records(df, text, dictionary, match=match, per_category=False), "tags_all")
    listed = dictionary_table(df, dictionary).join(
        seen.select(F.col("token").alias("keyword"), "n"), "keyword", "left"
    )
    return (
        listed.rollup("category")
        .agg(F.count("*").alias("listed"), F.count("n").alias("seen"))
        .withColumn("category", F.coalesce("category", F.lit("(total)")))
    )


def token_counts(df: DataFrame, tags: str | Column, *, distinct: bool = False) -> DataFrame:
    """Occurrences of each element of a joined list; `distinct` counts a row's repeats once."""
    items = tokens(tags)
    return (
        df.select(F.explode(F.array_distinct(items) if distinct else items).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def token_frequency(df: DataFrame, tags: str, k: int) -> DataFrame:
    """The `k` most frequent tokens and their rate over all rows, tagged or not."""
    all_rows = df.select(F.count("*")).scalar()
    top = token_counts(df, tags).orderBy(F.desc("n"), "token").limit(k)
    return top.withColumn("rate", F.col("n") * 100.0 / all_rows)


def tag_coverage(df: DataFrame, tags: str | Column) -> DataFrame:
    tagged = F.count_if(text_or_empty(as_column(tags)) != "")
    return df.agg(F.count("*").alias("n"), tagged.alias("tagged"), (tagged * 100.0 / F.count("*")).alias("pct"))
