"""Base views of the catalogue over the given tables: each reads only the columns its query needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions.dates import year_month
from tagtrend.operators.tagging import classify, tag_records
from tagtrend.plans import vocabulary as v
from tagtrend.session import spread

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tagged_parts(spark: SparkSession, sf_dir: str, *, per_category: bool = False) -> DataFrame:
    parts = table(spark, sf_dir, "part")
    return tag_records(parts, "p_name", v.PART_KEYWORDS, per_category=per_category)


def postings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Line items as dated records: `month, category, title, tags_all, segment`, as far as asked for.

    A title is tagged once per part and not once per line item. Tables that no asked column needs are not
    joined; orders meet customers first, being the smaller pair.
    """
    parts = tagged_parts(spark, sf_dir).select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("title"), F.col("p_type").alias("category"), "tags_all"
    )
    rows = table(spark, sf_dir, "lineitem").withColumn("month", F.trunc(F.col("l_shipdate").cast("date"), "month"))
    if {"title", "category", "tags_all"} & set(columns):
        rows = rows.join(parts, "l_partkey")
    if "segment" in columns:
        rows = rows.join(order_segments(spark, sf_dir), rows.l_orderkey == F.col("o_orderkey"))
    return rows.select(*columns)


def counted_postings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Postings counted (`n`) by the given columns, the month as `ym`: one scan and one small shuffle, whose
    size is bounded by the columns' value combinations. Keywords are then searched once per combination."""
    counted = postings(spark, sf_dir, *columns).groupBy(*columns).agg(F.count("*").alias("n"))
    return counted.withColumn("ym", year_month("month")) if "month" in columns else counted


def order_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey", F.col("c_mktsegment").alias("segment")
    )


def counted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders counted (`n`) by month and priority."""
    orders = table(spark, sf_dir, "orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"), F.col("o_orderpriority").alias("category")
    )
    counted = orders.groupBy("month", "category").agg(F.count("*").alias("n"))
    return counted.withColumn("ym", year_month("month"))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Documents for per-row text work."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", *columns), "doc_id")


def tagged_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tag_records(documents(spark, sf_dir, "text", *columns), "text", v.DOCUMENT_KEYWORDS, per_category=False)


def retrievable_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their category, over the whole text."""
    rows = documents(spark, sf_dir, "text").withColumn("_lower", F.lower("text"))
    return classify(rows, "_lower", v.TOPIC_RULES, "other", "category").select("doc_id", "category", "text")


def cluster_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled vectors with their documents' language, source and tags."""
    labels = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster"))
    return labels.join(tagged_documents(spark, sf_dir, "lang", "source"), "doc_id").drop("text")


def user_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn."""
    return table(spark, sf_dir, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as learner profiles; a negative balance leaves the experience unknown."""
    c = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_mktsegment").alias("job"),
        F.format_string("firm %d", "c_nationkey").alias("company"),
        F.when(c >= 5000, F.lit("experienced")).when(c >= 0, F.lit("junior")).alias("experience"),
        F.when(c >= 7500, F.lit("long")).when(c >= 2500, F.lit("medium")).when(c >= 1000, F.lit("short"))
        .otherwise(F.lit("open")).alias("period"),
        F.when(c >= 2500, F.array(F.lit("Gear"), F.lit("Oil"))).when(c >= 0, F.array(F.lit("Oil")))
        .otherwise(F.array().cast("array<string>")).alias("stack"),
    )
