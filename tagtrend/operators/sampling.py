"""Deterministic, md5-keyed sampling, splitting and shuffling: the same rows whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.operators.position import with_position


def hash_key(key: str | Column, seed: int | str) -> Column:
    c = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(c.cast("string"), F.lit(str(seed))))


def hash_split(df: DataFrame, key: str, *, seed: int = 42, eval_share: float = 0.1, name: str = "split") -> DataFrame:
    """Mark each row `train` or `eval` by its own hash, so no row count or sort is needed."""
    cut = f"{round(eval_share * 0x10000):04x}"
    is_eval = F.substring(hash_key(key, seed), 1, 4) < cut
    return df.withColumn(name, F.when(is_eval, F.lit("eval")).otherwise(F.lit("train")))


def hash_sample(df: DataFrame, key: str, n: int, *, seed: int = 42) -> DataFrame:
    """Exactly `n` rows (or all, if fewer) without replacement; each task keeps only its own best `n`."""
    return df.orderBy(hash_key(key, seed), key).limit(n)


def shuffle_positions(df: DataFrame, key: str, *, seed: int = 42, name: str = "position") -> DataFrame:
    """A full shuffle as a 0-based position per row, numbered bucket by bucket."""
    number = F.conv(F.substring(hash_key(key, seed), 1, 15), 16, 10).cast("long")
    return with_position(df.withColumn("_hash", number), "_hash", name, tie_break=[key]).drop("_hash")
