"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tagtrend.session import PACKED, shuffles_freed, small_side, stage, stage_by

__all__ = ["PACKED", "fresh", "shuffle_tasks", "shuffles_freed", "small_side", "stage", "stage_by"]


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, columns: Sequence[str]) -> str:
    """A column name that the table does not have (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
