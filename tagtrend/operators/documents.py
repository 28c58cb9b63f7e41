"""Retrieval documents: text-present filter, labelled rendering and capped metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import as_column, cap, longer_than, text_or_empty
from tagtrend.operators.rows import keep_where


def with_text(df: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """Rows where at least one text column is longer than `n` characters."""
    condition = longer_than(columns[0], n)
    for column in columns[1:]:
        condition = condition | longer_than(column, n)
    return keep_where(df, condition)


def labelled_lines(lines: Sequence[tuple[str, Column | str]]) -> Column:
    """`[label] value` per line; a missing value leaves the label."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"[{label}] "), text_or_empty(value)) for label, value in lines])


def retrieval_documents(
    df: DataFrame,
    *,
    ident: str,
    lines: Sequence[tuple[str, Column | str]],
    metadata: Mapping[str, tuple[str | Column, int | None]],
    prefix: str = "job_",
) -> DataFrame:
    """`id, document, metadata`: the rendered text and a struct of text fields, each capped where given."""
    fields = [
        (cap(as_column(c).cast("string"), n) if n else text_or_empty(as_column(c).cast("string"))).alias(name)
        for name, (c, n) in metadata.items()
    ]
    return df.select(
        F.concat(F.lit(prefix), F.col(ident)).alias("id"),
        labelled_lines(lines).alias("document"),
        F.struct(*fields).alias("metadata"),
    )
