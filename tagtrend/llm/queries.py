"""The registered queries of the operators over the given tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.llm import alignment, pfor, pitman_yor, prefix_bpe, quality_model
from tagtrend.llm.anchor_bounds import hard_negatives
from tagtrend.llm.decision_list import judged
from tagtrend.llm.recompression import substring_dedup
from tagtrend.llm.sharding import with_slots, write_shards
from tagtrend.llm.simhash import hexadecimal, near_duplicates
from tagtrend.llm.suffixes import suffix_dedup
from tagtrend.llm.tiling import matches
from tagtrend.llm.tree_forest import near_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under a 50-word window that an earlier document has too, by sorted sparse suffixes."""
    return suffix_dedup(table(spark, sf_dir, "documents")).drop("spans", "kept")


@_query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words under a 50-word window that an earlier document has too, by recompression."""
    return substring_dedup(table(spark, sf_dir, "documents")).drop("spans", "kept")


_REPEATS = r"""WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM t, unnest(range(1, len(w) - 48)) AS r(i)),
d AS (SELECT g.doc_id, g.i FROM g JOIN (SELECT h, min(doc_id) AS lowest FROM g GROUP BY h) m USING (h) WHERE g.doc_id > m.lowest),
c AS (SELECT DISTINCT doc_id, i + k AS p FROM d, range(0, 50) AS r(k)),
l AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id),
k AS (SELECT t.doc_id, len(w) AS n_words, [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(coalesce(gone, []), x[2])] AS kept
FROM t LEFT JOIN l USING (doc_id))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_words - len(kept) AS BIGINT) AS n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""
ORACLES["op1_suffix_dedup"] = ORACLES["op2_substring_dedup"] = _REPEATS


@_query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; links are at most two differing bits."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal("fingerprint").alias("fingerprint"), "component_id")


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op7_patched_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in patched frame-of-reference segments and read back."""
    segments = pfor.write_segments(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return pfor.digests(segments)


@_query
def op9_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document by prefix tables, and the bytes they decode to."""
    import public_tokenizers

    path, pattern = vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return prefix_bpe.digests(table(spark, sf_dir, "documents"), path, pattern)


@_query
def op3_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with how much of it tiles cover."""
    found = matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_words", "n_covered", F.size("tiles").alias("n_tiles"))


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot as read back from the written shards."""
    written = write_shards(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    narrow = written.select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
        "shard", "grown_shard", "bucket", "place",
    )
    return with_slots(narrow).select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"
    )


@_query
def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics of every document, the base verdict, and that of the learned rules."""
    found = judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id written as text, modulo a number."""
    return F.crc32(F.col(column).cast("string")) % modulus


@_query
def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; a third of the ids is never learned from."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model.fit(documents, table(spark, sf_dir, "labels"), crc_remainder("doc_id", 3) != 1)
    return quality_model.scored(documents, model).select(
        "doc_id", (crc_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@_query
def op10_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by a hierarchical Pitman-Yor model, and by add-one unigrams."""
    return pitman_yor.scored(table(spark, sf_dir, "documents"), crc_remainder("doc_id", 7) == 2).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of every document's ids by two tokenizers, and how often its links occur in all documents."""
    return alignment.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@_query
def op12_tree_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.95, found in the leaves of a random-projection forest."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@_query
def op13_anchor_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, by bounds along a spanning tree of these."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


ORACLES["op13_anchor_bounds"] = """WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
[floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT a.vec_id AS anchor_id, x.vec_id AS id, a.label = x.label AS same, CAST(list_inner_product(a.q, x.q) AS BIGINT) AS score
FROM r a JOIN r x ON a.vec_id <> x.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""
ORACLES["op12_tree_forest"] = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([1 FOR x IN embedding IF x <> 0]) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
c AS (SELECT a AS vec_id, a AS reached FROM l UNION SELECT c.vec_id, l.b FROM c JOIN l ON c.reached = l.a),
m AS (SELECT vec_id, min(reached) AS lowest FROM c GROUP BY vec_id), n AS (SELECT a AS vec_id, count(*) AS links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.links, 0) AS n_links, coalesce(m.lowest, e.vec_id) AS component_id, e.vec_id = coalesce(m.lowest, e.vec_id) AS kept
FROM embeddings e LEFT JOIN m USING (vec_id) LEFT JOIN n USING (vec_id)"""
