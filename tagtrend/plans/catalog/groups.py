"""Cluster profiles, vectors, neighbours, k-means and projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions.vectors import to_vector, unit_vectors
from tagtrend.operators import cells, clusters, counts, lloyd, neighbours, rates, vectors
from tagtrend.plans import views
from tagtrend.plans import vocabulary as v
from tagtrend.plans.catalog.registry import DOCUMENTS, query, rounded, sql_rates
from tagtrend.session import fresh_path, stage

_RECORDS = f"SELECT label AS cluster, lang, source, tags_all FROM embeddings JOIN ({DOCUMENTS}) ON vec_id = doc_id"


def _ranked(column: str) -> str:
    return f"SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, value) AS rk FROM (SELECT cluster, {column} AS value, count(*) AS n FROM rec GROUP BY ALL)"


PROFILE = f"""WITH rec AS ({_RECORDS}),
lg AS ({_ranked('lang')}), sr AS ({_ranked('source')}),
tk AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, value) AS rk FROM (SELECT cluster, value, count(*) AS n
  FROM (SELECT cluster, unnest(string_split(tags_all, ', ')) AS value FROM rec) WHERE value <> '' GROUP BY ALL))
SELECT t.cluster, t.n, lg.value AS top_category, lg.n * 100.0 / t.n AS top_category_pct, tk5 AS top_tokens, sr.value AS top_size,
lg3 AS categories, sr2 AS sizes, printf('C%02d-', t.cluster) || lg.value || '(' || tk2 || ')' AS name
FROM (SELECT cluster, count(*) AS n FROM rec GROUP BY 1) t
JOIN lg ON lg.cluster = t.cluster AND lg.rk = 1 JOIN sr ON sr.cluster = t.cluster AND sr.rk = 1
JOIN (SELECT cluster, string_agg(value, ', ' ORDER BY rk) AS lg3 FROM lg WHERE rk <= 3 GROUP BY 1) l3 ON l3.cluster = t.cluster
JOIN (SELECT cluster, string_agg(value, ', ' ORDER BY rk) AS sr2 FROM sr WHERE rk <= 2 GROUP BY 1) s2 ON s2.cluster = t.cluster
JOIN (SELECT cluster, string_agg(value, ', ' ORDER BY rk) AS tk5 FROM tk WHERE rk <= 5 GROUP BY 1) t5 ON t5.cluster = t.cluster
JOIN (SELECT cluster, string_agg(value, '+' ORDER BY rk) AS tk2 FROM tk WHERE rk <= 2 GROUP BY 1) t2 ON t2.cluster = t.cluster"""


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster_profile(views.cluster_records(spark, sf_dir), "cluster", "lang", "source", "tags_all")


@query(f"SELECT cluster, n, top_category, round(top_category_pct, 6) AS top_category_pct, top_tokens, top_size, categories, sizes FROM ({PROFILE})")
def cluster_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile(spark, sf_dir), "top_category_pct").drop("name")


@query(f"SELECT cluster, name FROM ({PROFILE})")
def cluster_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile(spark, sf_dir).select("cluster", "name")


@query(f"SELECT cluster, keyword, n, total, round(rate, 6) AS rate FROM ({sql_rates(_RECORDS, 'cluster', v.DOCUMENT_LIST)})")
def cluster_keyword_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.cluster_records(spark, sf_dir)
    return rounded(rates.keyword_rates(rows, ["cluster"], "tags_all", v.DOCUMENT_LIST), "rate")


@query(f"""SELECT cluster, lang, n, round(n * 100.0 / sum(n) OVER (PARTITION BY cluster), 6) AS ratio
FROM (SELECT cluster, lang, count(*) AS n FROM ({_RECORDS}) GROUP BY ALL)""")
def cluster_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.distribution(views.cluster_records(spark, sf_dir), "cluster", "lang"), "ratio")


@query("""SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(x / norm, 6) AS x FROM (
SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x, sqrt(list_sum([CAST(e AS DOUBLE) * CAST(e AS DOUBLE) for e in embedding])) AS norm FROM embeddings)""")
def l2_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = unit_vectors(views.table(spark, sf_dir, "embeddings"), "embedding", "unit")
    return rounded(unit.select("vec_id", F.posexplode("unit").alias("pos", "x")), "x")


_MEANS = """SELECT label, i, avg(CAST(x AS DOUBLE)) AS m FROM (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x FROM embeddings) GROUP BY ALL"""


@query(f"SELECT label, CAST(i - 1 AS INTEGER) AS pos, round(m, 6) AS x FROM ({_MEANS})")
def mean_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = vectors.mean_vectors(views.table(spark, sf_dir, "embeddings"), "label", "embedding")
    return rounded(means.select("label", F.posexplode("mean").alias("pos", "x")), "x")


def _knn_sql(condition: str) -> str:
    return f"""SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY s DESC, vec_id) AS INTEGER) AS rank, vec_id, round(s, 6) AS score FROM (
SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])), 9) AS s
FROM (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q JOIN embeddings e ON {condition}) QUALIFY rank <= 5"""


def _asked(collection: DataFrame) -> DataFrame:
    """The stated query set: every row whose id is divisible by 20."""
    return collection.where(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")


def _nearest(spark: SparkSession, sf_dir: str, on: list[tuple[str, str]]) -> DataFrame:
    collection = views.table(spark, sf_dir, "embeddings")
    near = neighbours.top_k_similar(
        _asked(collection), collection, 5, query_id="query_id", query_vector="embedding", row_id="vec_id", row_vector="embedding", on=on
    )
    return rounded(near, "score")


@query(_knn_sql("true"))
def knn_top5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to each of the query set, over the whole collection."""
    return _nearest(spark, sf_dir, [])


@query(_knn_sql("e.label = q.label"))
def knn_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five vectors nearest to each of the query set among those of its own group."""
    return _nearest(spark, sf_dir, [("label", "label")])


def _cell_index(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    collection = views.table(spark, sf_dir, "embeddings")
    path = fresh_path(spark, "cells")
    cells.build_cells(collection, path, row_id="vec_id", vector="embedding")
    return path, _asked(collection)


@query(_knn_sql("true"))
def cell_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `knn_top5`, from an index of k-means cells, until the bound rules out all cells that were not read."""
    path, asked = _cell_index(spark, sf_dir)
    near = cells.search_cells(spark, path, asked, 5, query_id="query_id", query_vector="embedding", exact=True)
    return rounded(near, "score").withColumnRenamed("id", "vec_id")


@query("SELECT count(*) AS n_queries, true AS recall_of_90, true AS under_30_of_rows FROM embeddings WHERE vec_id % 20 = 0")
def cell_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the nearest cells alone hold nine in ten of the exact neighbours, at less than 30 % of the rows."""
    path, asked = _cell_index(spark, sf_dir)
    near = cells.search_cells(spark, path, asked, 5, query_id="query_id", query_vector="embedding")
    exact = _nearest(spark, sf_dir, []).select("query_id", F.col("vec_id").alias("id"))
    found = exact.join(near.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left").agg(F.count("hit") / F.count("*")).scalar()
    read = cells.compared(spark, path, asked, query_vector="embedding").select(F.col("compared") / F.col("all_rows")).scalar()
    return asked.agg(F.count("*").alias("n_queries")).select("n_queries", (found >= 0.9).alias("recall_of_90"), (read < 0.3).alias("under_30_of_rows"))


def _document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.text_vectors(views.documents(spark, sf_dir, "text"), "text")


def _written_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text vectors for plans that read them several times."""
    return stage(_document_vectors(spark, sf_dir).select("doc_id", "vector"), "text-vectors")


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}_]') THEN 1.0 ELSE 0.0 END AS norm FROM documents")
def tfidf_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The norm of each sparse vector; `tfidf_weights` has the weights in long form, with an exact check."""
    return _document_vectors(spark, sf_dir).select("doc_id", F.round(vectors.vector_norm("vector"), 6).alias("norm"))


def _embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_vector(views.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", "vector").drop("embedding")


K_RANGE = (5, 7, 8, 9, 10, 12, 15)


@query()
def kmeans_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    swept = vectors.sweep_k(_embedding_vectors(spark, sf_dir), "vector", K_RANGE)
    return rounded(swept.select("k", "inertia", "silhouette", "chosen"), "inertia", "silhouette")


@query()
def kmeans_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _embedding_vectors(spark, sf_dir)
    model = vectors.best_kmeans(rows, "vector", 10)
    return vectors.label_clusters(rows, "vector", model).select("vec_id", "cluster")


@query(f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{v.TERM_PATTERN}')) AS w FROM documents),
tf AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 262144 AS slot, count(*) AS n FROM t GROUP BY ALL),
df AS (SELECT slot, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY slot),
w AS (SELECT doc_id, slot, n * idf AS x FROM tf JOIN df USING (slot))
SELECT doc_id, count(*) AS terms, round(sqrt(sum(x * x)), 6) AS norm, round(max(x) / nullif(sqrt(sum(x * x)), 0), 6) AS heaviest FROM w GROUP BY doc_id""")
def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed TF-IDF of whole texts in long form: terms, norm and largest unit weight of each document."""
    weights = vectors.term_weights(views.documents(spark, sf_dir, "text"), "doc_id", "text", pattern=v.TERM_PATTERN)
    square = F.sqrt(F.sum(F.col("weight") * F.col("weight")))
    return rounded(
        weights.groupBy("doc_id").agg(F.count("*").alias("terms"), square.alias("norm"), (F.max("weight") / F.nullif(square, F.lit(0.0))).alias("heaviest")),
        "norm", "heaviest",
    )


@query(f"""WITH m AS (SELECT label, list(m ORDER BY i) AS c FROM ({_MEANS}) GROUP BY 1),
d AS (SELECT vec_id, m.label, round(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(CAST(embedding AS DOUBLE[]), c)]), 9) AS d FROM embeddings e, m)
SELECT vec_id, arg_min(label, d * 1000 + label * 1e-9) AS nearest FROM d GROUP BY vec_id""")
def nearest_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the group whose mean is nearest to it."""
    rows = views.table(spark, sf_dir, "embeddings")
    means = vectors.mean_vectors(rows, "label", "embedding")
    return vectors.nearest_centre(rows, "embedding", means, "label", "mean").select("vec_id", "nearest")


@query("SELECT 10 AS clusters, count(*) AS n, count(*) AS own_centre_is_nearest, true AS centres_are_means, true AS converged FROM embeddings")
def kmeans_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of a finished k-means: each row's centre is its nearest, and each centre is the mean of its rows."""
    rows = views.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = vectors.best_kmeans(rows, "embedding", 10)
    labelled = vectors.label_clusters(rows.withColumn("vector", F.col("embedding")), "vector", model)
    means = vectors.mean_vectors(labelled, "cluster", "embedding")
    near = vectors.nearest_centre(labelled, "embedding", means, "cluster", "mean")
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.centres)], "cluster int, centre array<double>")
    apart = F.aggregate(F.zip_with("mean", "centre", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda x, y: F.greatest(x, y))
    same = means.join(centres, "cluster").agg(F.max(apart) < 1e-3).scalar()
    return near.agg(
        F.count_distinct("cluster").cast("int").alias("clusters"), F.count("*").alias("n"), F.count_if(F.col("cluster") == F.col("nearest")).alias("own_centre_is_nearest"),
    ).select("*", same.alias("centres_are_means"), F.lit(model.converged).alias("converged"))


@query("SELECT unnest([5, 7, 8, 9, 10, 12, 15]) AS k, true AS converged, true AS silhouette_in_range, true AS cheaper_than_one_cluster")
def sweep_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds of every fit of a sweep: it ended by itself, and it costs less than a single cluster."""
    rows = _embedding_vectors(spark, sf_dir)
    swept = vectors.sweep_k(rows, "vector", K_RANGE)
    whole = views.table(spark, sf_dir, "embeddings").select("embedding", F.lit(0).alias("one"))
    mean = vectors.mean_vectors(whole, "one", "embedding").select("mean").scalar()
    gaps = F.aggregate(F.zip_with(F.col("embedding").cast("array<double>"), F.col("mean"), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)
    total = whole.withColumn("mean", mean).agg(F.sum(gaps)).scalar()
    return swept.select(
        "k", "converged", F.col("silhouette").between(-1, 1).alias("silhouette_in_range"), (F.col("inertia") < total).alias("cheaper_than_one_cluster")
    )


def _projected(rows: DataFrame) -> DataFrame:
    """What holds of two principal components: centred, uncorrelated, the first the wider."""
    return rows.agg(
        F.count("*").alias("n"), (F.greatest(F.abs(F.avg("x")), F.abs(F.avg("y"))) < 1e-9).alias("centred"), (F.abs(F.corr("x", "y")) < 1e-6).alias("uncorrelated"),
        (F.var_pop("x") >= F.var_pop("y")).alias("ordered"), (F.var_pop("x") + F.var_pop("y")).alias("wide"),
    )


@query("""SELECT count(*) AS n, true AS centred, true AS uncorrelated, true AS ordered, true AS wider_than_any_two_columns FROM embeddings""")
def projection_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the given vectors: beside the above, no two columns spread the rows further."""
    table = views.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    columns = table.select(F.posexplode("embedding").alias("i", "x")).groupBy("i").agg(F.var_pop("x").alias("wide"))
    widest = columns.agg(F.slice(F.sort_array(F.collect_list("wide"), asc=False), 1, 2).alias("w")).select(F.get("w", F.lit(0)) + F.get("w", F.lit(1))).scalar()
    return _projected(vectors.project_2d(table, "embedding")).withColumn("wider_than_any_two_columns", F.col("wide") >= widest).drop("wide")


@query("SELECT count(*) AS n, true AS centred, true AS uncorrelated, true AS ordered FROM documents")
def text_projection_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the wide, sparse text vectors."""
    return _projected(vectors.project_2d(_written_vectors(spark, sf_dir), "vector")).drop("wide")


_STEP = """c{n} AS (SELECT vec_id, e, arg_min(label, d * 1000 + label * 1e-9) AS label FROM (SELECT vec_id, e, m.label,
round(list_sum([(x[1] - x[2]) * (x[1] - x[2]) FOR x IN list_zip(e, m.c)]), 9) AS d FROM rows_, m{n} m) GROUP BY ALL),
m{next} AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(e[i]) AS x FROM c{n}, generate_series(1, 64) AS g(i) GROUP BY ALL) GROUP BY 1)"""


@query(f"""WITH rows_ AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), m0 AS (SELECT label, list(m ORDER BY i) AS c FROM ({_MEANS}) GROUP BY 1),
{', '.join(_STEP.format(n=i, next=i + 1) for i in range(4))}
SELECT vec_id, label AS cluster FROM c3""")
def kmeans_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three steps of k-means from the groups' means, then each row's nearest centre."""
    rows = views.table(spark, sf_dir, "embeddings")
    means = vectors.mean_vectors(rows, "label", "embedding").orderBy("label").collect()  # a row per group
    fit = lloyd.fit_many(rows, "embedding", [(len(means), 0)], max_iter=3, tolerance=0.0, start=[[r["mean"] for r in means]])[0]
    near = lloyd.nearest(rows.select("vec_id", "embedding"), "embedding", fit, "at")
    labels = F.array(*[F.lit(r["label"]) for r in means])
    return near.select("vec_id", F.element_at(labels, F.col("at") + 1).alias("cluster"))


@query()
def text_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents clustered on their text vectors, the best of ten fits, then profiled."""
    rows = _written_vectors(spark, sf_dir)
    labelled = vectors.label_clusters(rows, "vector", vectors.best_kmeans(rows, "vector", 9, written=True))
    records = views.tagged_documents(spark, sf_dir, "lang", "source").join(labelled, "doc_id")
    return rounded(clusters.cluster_profile(records, "cluster", "lang", "source", "tags_all"), "top_category_pct")


@query()
def project_2d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(vectors.project_2d(_embedding_vectors(spark, sf_dir), "vector").select("vec_id", "x", "y"), "x", "y")
