"""Standardise sources into one schema and union them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.operators.position import with_position


def standardise(df: DataFrame, mapping: Mapping[str, Column | str | None]) -> DataFrame:
    """One output column per entry: an expression, a constant text, or null for an absent field."""
    return df.select(
        *[(c if isinstance(c, Column) else F.lit(c).cast("string")).alias(name) for name, c in mapping.items()]
    )


def surrogate_ids(df: DataFrame, by: str, prefix: str, name: str) -> DataFrame:
    """Contiguous ids `prefix0`, `prefix1`, ... in the order of a unique numeric key."""
    return with_position(df, by, "_pos").withColumn(name, F.concat(F.lit(prefix), F.col("_pos"))).drop("_pos")


def union_sources(frames: Sequence[DataFrame], priority: str | None = None, *, blank: bool = False) -> DataFrame:
    """Union by name with missing columns back-filled; `priority` records each frame's place in the list."""
    if priority:
        frames = [f.withColumn(priority, F.lit(i)) for i, f in enumerate(frames)]
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.na.fill("") if blank else merged
