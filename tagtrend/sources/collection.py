"""The vector collection: id, document, metadata and vector, laid out by category, with its vectoriser beside it."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions.vectors import unit_vectors
from tagtrend.operators.neighbours import top_k_similar
from tagtrend.operators.vectors import apply_text_vectors, fit_text_vectors


def _model_path(path: str) -> str:
    return f"{path.rstrip('/')}.vectoriser"


def _entries(vector: str) -> Column:
    """A sparse MLlib vector as a struct of indices and values."""
    stored = F.unwrap_udt(F.col(vector))
    return F.struct(stored["indices"].alias("indices"), stored["values"].alias("values"))


def build_collection(documents: DataFrame, path: str, *, category: str = "job_category", vector: str = "vector") -> None:
    """Drop and rebuild the collection at `path`.

    `documents` has `id`, `document`, `metadata` and a vector: an array, or the sparse struct of
    `build_text_collection`. One folder per category lets a filtered search read only its own files. Every task writes
    its own file per category, so a category with a third of the rows is many files and no task gathers it.
    """
    dense = documents.schema[vector].dataType.typeName() == "array"
    unit = unit_vectors(documents, vector, vector) if dense else documents
    unit.withColumn(category, F.col("metadata")[category]).write.mode("overwrite").partitionBy(category).parquet(path)


def build_text_collection(documents: DataFrame, path: str, *, category: str = "job_category") -> None:
    """Fit the vectoriser on the documents' texts, save it beside the collection and build that."""
    model = fit_text_vectors(documents, "document")
    model.write().overwrite().save(_model_path(path))
    rows = apply_text_vectors(documents, model).withColumn("vector", _entries("vector"))
    build_collection(rows, path, category=category)


def read_collection(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def search(
    spark: SparkSession, path: str, queries: DataFrame, *, query_id: str, vector: str, category: str | None = None,
    k: int = 5, column: str = "job_category",
) -> DataFrame:
    """Top `k` documents per query. With `category` only that folder is read; no match means no rows."""
    rows = read_collection(spark, path)
    if category is not None:
        rows = rows.where(F.col(column) == category)
    near = top_k_similar(queries, rows, k, query_id=query_id, query_vector=vector, row_id="id", row_vector="vector")
    return near.join(rows.select("id", "document", "metadata"), "id")


def search_texts(
    spark: SparkSession, path: str, queries: DataFrame, *, query_id: str, text: str, category: str | None = None,
    k: int = 5, column: str = "job_category",
) -> DataFrame:
    """Top `k` documents for query texts, by the collection's own vectoriser.

    `category` names a column of the queries: a query that has one sees only documents of that category, a query
    without one sees all.
    """
    model = PipelineModel.load(_model_path(path))
    asked = queries.select(
        F.col(query_id), F.col(text).alias("document"), (F.col(category) if category else F.lit(None).cast("string")).alias("_category")
    )
    wanted = apply_text_vectors(asked, model).withColumn("vector", _entries("vector"))
    rows = read_collection(spark, path)
    names = dict(query_id=query_id, query_vector="vector", row_id="id", row_vector="vector")
    near = top_k_similar(wanted.where(F.col("_category").isNull()), rows, k, **names)
    if category:
        within = wanted.where(F.col("_category").isNotNull())
        near = near.unionByName(top_k_similar(within, rows, k, on=[("_category", column)], **names))
    return near.join(rows.select("id", "document", "metadata"), "id")
