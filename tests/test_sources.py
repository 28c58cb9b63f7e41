import glob
import json

from helpers import values
from pyspark.sql import functions as F

from tagtrend.operators import dedup, neighbours
from tagtrend.sources import collection, tables


def test_csv_round_trip_with_line_breaks_quotes_and_mark(spark, tmp_path):
    rows = [(1, 'a "quoted", text\nwith a break', None), (2, "", "x")]
    df = spark.createDataFrame(rows, "id int, t string, u string")
    tables.write_csv(df, str(tmp_path / "t"))
    part = glob.glob(str(tmp_path / "t" / "part-*.csv"))[0]
    assert open(part, "rb").read(3) == b"\xef\xbb\xbf"
    back = tables.read_csv(spark, str(tmp_path / "t"), "id int, t string, u string")
    assert values(back) == [(1, 'a "quoted", text\nwith a break', None), (2, None, "x")]


def test_json_lines_skip_blanks(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text('{"a": 1, "b": "x"}\n\n   \n{"a": 2}\n')
    assert values(tables.read_json_lines(spark, str(path), "a int, b string").where("a is not null")) == [(1, "x"), (2, None)]
    tables.write_json_lines(spark.createDataFrame([(1, ["x"])], "a int, l array<string>"), str(tmp_path / "out"))
    assert values(tables.read_json_lines(spark, str(tmp_path / "out"), "a int, l array<string>")) == [(1, ["x"])]


def test_json_document(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"a": {"b": [1, 2]}}, indent=2))
    assert tables.read_json_document(spark, str(path), "a struct<b: array<int>>").first()["a"]["b"] == [1, 2]
    tables.write_json_documents(spark.createDataFrame([('{"k":1}',)], "document string"), str(tmp_path / "o"))
    assert tables.read_json_lines(spark, str(tmp_path / "o"), "k int").first()["k"] == 1


def test_stage_and_lookup(spark, tmp_path):
    df = spark.createDataFrame([(1, [0.5, 1.0])], "id int, v array<float>")
    tables.write_stage(df, str(tmp_path / "s"))
    tables.publish(tables.read_stage(spark, str(tmp_path / "s")), "a_result")
    assert tables.lookup(spark, "a_result").first()["v"] == [0.5, 1.0]


def test_row_order_follows_the_file(spark, tmp_path):
    (tmp_path / "x.csv").write_text("n\n" + "\n".join(str(i) for i in range(20)) + "\n")
    df = tables.with_row_order(tables.read_csv(spark, str(tmp_path / "x.csv")))
    assert [r["n"] for r in df.orderBy("_row").collect()] == [str(i) for i in range(20)]


def test_row_order_follows_the_files_whatever_their_size(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for name, rows in (("00", 1), ("01", 3), ("02", 30_000)):
        (folder / f"{name}.csv").write_text("n,k\n" + "\n".join(f"{name}-{i},{i % 2}" for i in range(rows)) + "\n")
    for split in (True, False):
        df = tables.with_row_order(tables.read_csv(spark, str(folder), multiline=not split))
        got = [r["n"] for r in df.orderBy("_row").collect()]
        assert got == ["00-0", *[f"01-{i}" for i in range(3)], *[f"02-{i}" for i in range(30_000)]]
    first = {r["k"]: r["n"] for r in dedup.keep_first(df, ["k"], ["_row"]).collect()}
    assert first == {"0": "00-0", "1": "01-1"}
    lacking = tables.with_columns(df, ["n", "gone"]).columns
    assert lacking == ["n", "gone"]


def test_collection_is_partitioned_and_searched_by_category(spark, tmp_path):
    rows = [(i, f"job_{i}", f"text {i}", ("a" if i % 3 else "b",), [float(i + 1), 1.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "row_id long, id string, document string, metadata struct<job_category: string>, vector array<double>")
    path = str(tmp_path / "c")
    collection.build_collection(df, path)
    collection.build_collection(df, path)
    stored = collection.read_collection(spark, path)
    assert stored.count() == 12
    assert all(abs(sum(x * x for x in r["vector"]) - 1) < 1e-12 for r in stored.collect())
    queries = spark.createDataFrame([("q", [1.0, 1.0])], "q string, v array<double>")
    hits = collection.search(spark, path, queries, query_id="q", vector="v", category="b", k=2)
    assert values(hits, "rank", "id") == [(1, "job_0"), (2, "job_3")]
    assert collection.search(spark, path, queries, query_id="q", vector="v", category="none").count() == 0
    everything = collection.search(spark, path, queries, query_id="q", vector="v", k=2)
    assert values(everything, "rank", "id") == [(1, "job_0"), (2, "job_1")]
    plan = stored.where(F.col("job_category") == "b")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(job_category" in plan
    assert neighbours.ROWS_PER_BLOCK > 0


def test_a_collection_of_texts_is_searched_by_text(spark, tmp_path):
    texts = ["python data pipelines with spark", "java services and spring", "python web services", "spark streaming in java", "", None]
    rows = [(f"job_{i}", t, ("a" if i % 2 else "b",)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id string, document string, metadata struct<job_category: string>")
    path = str(tmp_path / "texts")
    collection.build_text_collection(df, path)
    queries = spark.createDataFrame([(1, "spark pipelines", None), (2, "spark pipelines", "a"), (3, "spark pipelines", "none"), (4, "zzz", None)], "q int, t string, c string")
    near = collection.search_texts(spark, path, queries, query_id="q", text="t", category="c", k=2)
    assert values(near.where("score > 0"), "q", "rank", "id") == [(1, 1, "job_0"), (1, 2, "job_3"), (2, 1, "job_3")]
    same = collection.search_texts(spark, path, df.select(F.col("id").alias("q"), F.col("document").alias("t")).where("t <> ''"), query_id="q", text="t", k=1)
    assert values(same.withColumn("score", F.round("score", 6)), "q", "id", "score") == [(f"job_{i}", f"job_{i}", 1.0) for i in range(4)]
