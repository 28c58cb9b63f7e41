import os

import numpy as np
import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.functions.vectors import to_vector, unit_vectors
from tagtrend.operators import cells, clusters, neighbours, projection, vectors
from tagtrend.session import shared_folder


def random_vectors(n, d=8, seed=0, hot=0.0):
    """Unit-free vectors, a share of them in group 0, with some exact copies."""
    rng = np.random.default_rng(seed)
    matrix = rng.normal(size=(n, d))
    matrix[n // 2 : n // 2 + n // 10] = matrix[: n // 10]
    groups = np.where(rng.random(n) < hot, 0, rng.integers(0, 4, n))
    return [(i, [float(x) for x in matrix[i]], int(groups[i])) for i in range(n)]


def brute_force(queries, rows, k, filtered):
    def unit(v):
        v = np.array(v)
        return v / (np.sqrt((v * v).sum()) or 1.0)

    found = set()
    for q, qv, qg in queries:
        scored = sorted((-round(float(unit(qv) @ unit(v)), 9), i) for i, v, grp in rows if not filtered or grp == qg)
        found |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return found


@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("blocks", [(10_000, 10_000), (50, 10_000), (40, 7)])
def test_top_k_equals_brute_force_whatever_the_blocks(spark, filtered, blocks):
    rows, queries = random_vectors(300, hot=0.4), random_vectors(25, seed=1, hot=0.4)
    c = spark.createDataFrame(rows, "id long, v array<double>, grp int")
    q = spark.createDataFrame(queries, "qid long, qv array<double>, qgrp int")
    got = neighbours.top_k_similar(
        q, c, 5, query_id="qid", query_vector="qv", row_id="id", row_vector="v", on=[("qgrp", "grp")] if filtered else [],
        rows_per_block=blocks[0], queries_per_block=blocks[1],
    )
    assert {(r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in got.collect()} == {
        (a, b, i, round(s, 9)) for a, b, i, s in brute_force(queries, rows, 5, filtered)
    }


def test_filter_without_rows_gives_nothing(spark):
    c = spark.createDataFrame([(1, [1.0, 0.0], "a")], "id long, v array<double>, g string")
    q = spark.createDataFrame([("x", [1.0, 0.0], "a"), ("y", [1.0, 0.0], "b")], "qid string, qv array<double>, qg string")
    got = neighbours.top_k_similar(q, c, 5, query_id="qid", query_vector="qv", row_id="id", row_vector="v", on=[("qg", "g")])
    assert values(got, "qid", "id") == [("x", 1)]


def test_no_pairs_leave_a_block(spark):
    c = spark.createDataFrame(random_vectors(300), "id long, v array<double>, g int")
    got = neighbours.top_k_similar(c, c.withColumnRenamed("id", "rid"), 2, query_id="id", query_vector="v", row_id="rid", row_vector="v")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


NAMES = dict(query_id="qid", query_vector="qv", row_id="id", row_vector="v")


@pytest.mark.parametrize("block", [4, 10_000])
def test_null_filter_values_match_nothing(spark, block):
    rows = [(i, [float(i % 7) + 1, 1.0], None if i % 2 else "a") for i in range(40)]
    c = spark.createDataFrame(rows, "id long, v array<double>, g string")
    q = spark.createDataFrame([(1, [1.0, 1.0], "a"), (2, [1.0, 1.0], None)], "qid long, qv array<double>, qg string")
    got = neighbours.top_k_similar(q, c, 3, on=[("qg", "g")], rows_per_block=block, queries_per_block=block, **NAMES).collect()
    assert {r["qid"] for r in got} == {1} and all(r["id"] % 2 == 0 for r in got) and len(got) == 3


GIVEN = "/root/testdata/sf0.1/embeddings.parquet"


def hits(frame):
    return {(r["qid"], r["rank"], r["id"], r["score"]) for r in frame.select("qid", "rank", "id", "score").collect()}


@pytest.mark.skipif(not os.path.exists(GIVEN), reason="the given tables are not here")
def test_cells_find_nine_in_ten_of_the_given_neighbours(spark, tmp_path):
    """Rows with an id divisible by 20 against all; 0.98 at 28 % of the rows when this was written."""
    c = spark.read.parquet(GIVEN).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    q = c.where("id % 20 = 0").toDF("qid", "qv")
    cells.build_cells(c, f"{tmp_path}/x", row_id="id", vector="v")
    exact = hits(neighbours.top_k_similar(q, c, 5, **NAMES))
    near = hits(cells.search_cells(spark, f"{tmp_path}/x", q, 5, query_id="qid", query_vector="qv"))
    keys = {(a, i) for a, _, i, _ in exact}
    assert len(keys & {(a, i) for a, _, i, _ in near}) >= 0.95 * len(keys)
    read = cells.compared(spark, f"{tmp_path}/x", q, query_vector="qv").first()
    assert 0 < read["compared"] < 0.3 * read["all_rows"] == 0.3 * 100 * 2000
    assert hits(cells.search_cells(spark, f"{tmp_path}/x", q, 5, query_id="qid", query_vector="qv", exact=True)) == exact


@pytest.mark.parametrize("groups", [1, 40])
def test_exact_cells_equal_the_search_over_all_rows(spark, tmp_path, groups):
    """On rows that form groups the bound leaves most cells unread; ties, copies and a crowded cell included."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(groups, 16))
    points = centres[np.arange(1200) % groups] + rng.normal(scale=0.02, size=(1200, 16))
    points[:300] = points[0]
    rows = [(i, [float(x) for x in p * rng.uniform(0.1, 9)]) for i, p in enumerate(points)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (2004, [])]
    c = spark.createDataFrame(rows, "id long, v array<double>")
    q = c.where("id % 20 = 0 OR id >= 2000").toDF("qid", "qv")
    good = c.where("id < 2000")
    cells.build_cells(c, f"{tmp_path}/x", row_id="id", vector="v", cells=groups * 2)
    exact = neighbours.top_k_similar(q.where("qid < 2000"), good, 5, **NAMES)
    assert hits(cells.search_cells(spark, f"{tmp_path}/x", q, 5, query_id="qid", query_vector="qv", exact=True, share=0.05)) == hits(exact)


def test_cells_of_nothing_and_of_a_few_rows(spark, tmp_path):
    c = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "id long, v array<double>")
    q = c.toDF("qid", "qv")
    cells.build_cells(c.where("false"), f"{tmp_path}/none", row_id="id", vector="v")
    assert cells.search_cells(spark, f"{tmp_path}/none", q, 5, query_id="qid", query_vector="qv", exact=True).count() == 0
    cells.build_cells(c, f"{tmp_path}/two", row_id="id", vector="v")
    assert len(hits(cells.search_cells(spark, f"{tmp_path}/two", q, 5, query_id="qid", query_vector="qv", exact=True))) == 4


def test_a_cluster_has_to_name_its_shared_folder():
    class Session:
        class sparkContext:  # noqa: N801
            master, applicationId = "local-cluster[2,1,1024]", "app"
            getConf = staticmethod(dict)

        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: default)

    with pytest.raises(ValueError):
        shared_folder(Session)


def test_unit_and_mean_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (1, [0.0, 0.0]), (2, [1.0, 0.0])], "g int, v array<float>")
    assert sorted(r["u"] for r in unit_vectors(df, "v", "u").collect()) == [[0.0, 0.0], [0.6, 0.8], [1.0, 0.0]]
    means = {r["g"]: r["mean"] for r in vectors.mean_vectors(df, "g", "v").collect()}
    assert means[1] == pytest.approx([1.5, 2.0]) and means[2] == [1.0, 0.0]


def blobs(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(scale=0.05, size=3) + 5 * np.eye(3)[i % 3]]) for i in range(90)]
    return to_vector(spark.createDataFrame(rows, "id int, a array<double>"), "a", "vector")


def test_sweep_and_fit_find_the_blobs(spark):
    df = blobs(spark)
    sweep = vectors.sweep_k(df, "vector", [2, 3, 4]).collect()
    assert [r["k"] for r in sweep if r["chosen"]] == [3] and len(sweep) == 3
    model = vectors.best_kmeans(df, "vector", 3, restarts=3)
    labels = {r["id"]: r["cluster"] for r in vectors.label_clusters(df, "vector", model).collect()}
    assert len({labels[i] for i in range(3)}) == 3 and all(labels[i] == labels[i % 3] for i in labels)


def test_projection_keeps_rows_and_spread(spark):
    got = vectors.project_2d(blobs(spark), "vector").select("id", "x", "y").collect()
    assert len(got) == 90 and np.var([r["x"] for r in got]) > 1


@pytest.mark.parametrize("narrow", [512, 2])
def test_projection_equals_exact_components(spark, monkeypatch, narrow):
    """Exact for narrow rows; the range finder agrees where the spectrum falls."""
    monkeypatch.setattr(projection, "NARROW", narrow)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 20)) * 0.7 ** np.arange(20) + 5
    centred = x - x.mean(axis=0)
    want = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    sparse = [(i, (list(range(0, 60, 3)), [float(v) for v in r])) for i, r in enumerate(x)]
    for df in (
        spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None)], "id int, v array<double>"),
        spark.createDataFrame(sparse, "id int, v struct<indices:array<int>,values:array<double>>"),
    ):
        got = {r["id"]: (r["x"], r["y"]) for r in vectors.project_2d(df, "v").collect()}
        assert got.pop(900, (None, None)) == (None, None)
        out = np.array([got[i] for i in range(300)])
        out *= np.sign((out * want).sum(axis=0))
        assert np.allclose(out, want, atol=1e-3 if narrow == 2 else 1e-8)


@pytest.mark.skipif(not os.path.exists(GIVEN), reason="the given tables are not here")
def test_projection_of_the_given_vectors(spark):
    df = spark.read.parquet(GIVEN).select("vec_id", "embedding")
    x = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()], dtype=float)
    centred = x - x.mean(axis=0)
    got = np.array([(r["x"], r["y"]) for r in vectors.project_2d(df, "embedding").orderBy("vec_id").collect()])
    want = centred @ np.linalg.svd(centred, full_matrices=False)[2][:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6) and np.abs(got.mean(axis=0)).max() < 1e-9


def test_projection_of_nothing_and_of_one_row(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, None)], "id int, v array<double>")
    assert [tuple(r) for r in vectors.project_2d(df, "v").orderBy("id").collect()] == [(1, 0.0, 0.0), (2, None, None)]
    assert vectors.project_2d(df.where("false"), "v").count() == 0


def test_text_vectors_are_unit(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a d"), (3, "e f")], "id int, t string")
    norms = [np.linalg.norm(r["vector"].toArray()) for r in vectors.text_vectors(df, "t", features=64).collect()]
    assert norms == pytest.approx([1.0, 1.0, 1.0])


def test_encoder_plugs_in(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(70)], "id int, t string").repartition(3)
    got = vectors.encoded_vectors(df, "t", lambda: (lambda texts: [[len(t), 1.0] for t in texts]), batch=8)
    assert {r["id"]: r["vector"] for r in got.collect()} == {i: [float(i), 1.0] for i in range(70)}


def test_cluster_profile(spark):
    rows = [(0, "be", "small", "Java, AWS"), (0, "be", "big", "Java"), (0, "fe", "small", ""), (1, "fe", "big", "React"), (1, "be", "small", "Vue")]
    df = spark.createDataFrame(rows, "c int, j string, s string, t string")
    got = {r["c"]: r for r in clusters.cluster_profile(df, "c", "j", "s", "t").collect()}
    a, b = got[0], got[1]
    assert (a["n"], a["top_category"], round(a["top_category_pct"], 1), a["top_tokens"], a["top_size"], a["name"]) == (
        3, "be", 66.7, "Java, AWS", "small", "C00-be(Java+AWS)")
    assert (b["n"], b["top_category"], b["categories"], b["sizes"], b["name"]) == (2, "be", "be, fe", "big, small", "C01-be(React+Vue)")


def test_ranked_values_counts_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.when(F.col("id") < 700, "hot").otherwise("cold").alias("v"))
    got = clusters.ranked_values(df, "g", {"k": F.array("v")}, 1)
    assert values(got, "g", "value", "n") == [(0, "hot", 350), (1, "hot", 350)]
