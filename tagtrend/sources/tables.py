"""Readers and writers. Schemas are explicit: nothing is inferred, an empty text is null on read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.operators.position import with_position

BOM = "\ufeff"


def read_csv(spark: SparkSession, path: str, schema: str | None = None, *, multiline: bool = True) -> DataFrame:
    """CSV with a header: by position under `schema`, else every column as text under its header name.

    `multiline` is needed where quoted texts hold line breaks and makes each file one task; write such
    exports as many files, or turn it off so that files can be split.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"').option("quote", '"')
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def with_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns and no other, in this order; a column that a file lacks is null."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


def with_row_order(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows of a table as it was read from files: by path, then place in the file. This is the order key
    for keep-first and for surrogate ids.

    Spark packs files into tasks by size, so a row's task says nothing about its file; within one block of one file
    the running id follows the rows. Sources with a row number of their own should use that.
    """
    placed = df.withColumns({
        "_path": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"), "_run": F.monotonically_increasing_id(),
    })
    return with_position(placed, "_path", name, tie_break=["_block", "_run"]).drop("_path", "_block", "_run")


def write_csv(df: DataFrame, path: str, *, bom: bool = True) -> None:
    """CSV with a header; `bom` puts the UTF-8 mark at the start of every file, before the first column name."""
    out = df.withColumnRenamed(df.columns[0], BOM + df.columns[0]) if bom else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').option("quote", '"').csv(path)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object per line; blank lines are skipped."""
    return spark.read.schema(schema).json(path)


def read_json_document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that each hold one JSON document."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_json_documents(df: DataFrame, path: str, column: str = "document") -> None:
    """A column of JSON texts, one per line."""
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_stage(df: DataFrame, path: str) -> None:
    """The table between two stages."""
    df.write.mode("overwrite").parquet(path)


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def publish(df: DataFrame, name: str) -> None:
    """Make a result table available to SQL lookups of the session under a name."""
    df.createOrReplaceTempView(name)


def lookup(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
