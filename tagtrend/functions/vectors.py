"""Vector expressions over `array<float|double>` columns, through MLlib's JVM vector code."""

from __future__ import annotations

from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_vector(df: DataFrame, array: str, out: str) -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array).cast("array<double>")))


def unit_vectors(df: DataFrame, vector: str, out: str, *, as_array: bool = True) -> DataFrame:
    """L2-normalise an array column; the zero vector stays zero."""
    work = Normalizer(p=2.0, inputCol="_in", outputCol="_unit").transform(to_vector(df, vector, "_in"))
    value: Column = vector_to_array("_unit") if as_array else F.col("_unit")
    return work.withColumn(out, value).drop("_in", "_unit")
