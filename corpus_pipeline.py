"""The corpus pipeline: named stages from `documents` to token ids, each calling one operator of `tagtrend.llm`.

Every stage reads what its predecessor kept. All but the last return the columns of `documents`; the last returns the
token ids, and the number of bytes that they decode to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.llm import prefix_bpe, quality_model, recompression, simhash, tiling
from tagtrend.llm.queries import crc_remainder, vocabulary
from tagtrend.llm.store import fresh, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
ORACLE_SQL = None  # the stages learn a model and follow links, which SQL does not express


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good. It learns from labels outside its held-out third."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.fit(docs, labels, crc_remainder("doc_id", 3) != 1)
    score = fresh("_score", docs.columns)
    return quality_model.scored(docs, model, score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies (fingerprints of three-word shingles, at most two bits apart)."""
    return simhash.one_of_each(docs).select(*docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that an earlier one has; what is left empty goes, unless
    it came empty. n_chars counts the characters that are left."""
    left = recompression.without_repeats(docs)
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return tiling.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, decoded again as a check: doc_id, ids, n_tokens, n_bytes."""
    import public_tokenizers

    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return prefix_bpe.round_trip(docs, path, pattern).select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.octet_length("bytes").cast("long").alias("n_bytes"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; each result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
