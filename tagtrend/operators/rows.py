"""Row selection on computed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_where(df: DataFrame, condition: Column) -> DataFrame:
    """`where` for a condition on costly computed columns.

    A plain filter is pushed below the projection that computes its columns, with their expressions copied
    into it: a cleaned or tagged text would be worked out twice, the second time once per keyword. Unnesting
    a one-element array where the condition holds, and nothing elsewhere, keeps the same rows and reads the
    columns as computed. Use a plain `where` for conditions on stored columns, which should reach the scan.
    """
    return df.withColumn("_kept", F.explode(F.when(condition, F.array(F.lit(True))))).drop("_kept")
