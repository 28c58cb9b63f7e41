"""Merged states against direct counts, and the automaton against one expression per keyword."""

import time

import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.operators.automaton import keyword_automaton, tag_by_automaton
from tagtrend.operators.sketches import merged_states, sketch_states, sketch_summary
from tagtrend.operators.tagging import tag_records
from tagtrend.plans import vocabulary as v

FOLDER = "/root/testdata/sf0.01"


def test_merged_states_equal_direct_ones_within_the_error(spark, tmp_path):
    orders = spark.read.parquet(f"{FOLDER}/orders.parquet").withColumn("ym", F.date_format("o_orderdate", "yyyy-MM"))
    states = sketch_states(orders, ["ym", "o_orderpriority"], ["o_custkey", "o_orderstatus"], ["o_totalprice"])
    states.write.parquet(f"{tmp_path}/states")
    stored = spark.read.parquet(f"{tmp_path}/states")
    for by in ([], ["o_orderpriority"], ["ym"]):
        exact = {
            tuple(r[c] for c in by): r
            for r in orders.groupBy(*by).agg(
                F.count("*").alias("n"), F.count_distinct("o_custkey").alias("d"), F.count_distinct("o_orderstatus").alias("s"),
                F.sort_array(F.collect_list(F.col("o_totalprice").cast("double"))).alias("prices"),
            ).collect()
        }
        found = sketch_summary(stored, by, [0.1, 0.5]).collect()
        assert len(found) == len(exact)
        for r in found:
            true = exact[tuple(r[c] for c in by)]
            assert r["n"] == true["n"] and r["distinct_o_orderstatus"] == true["s"]
            assert abs(r["distinct_o_custkey"] - true["d"]) <= max(1, 0.05 * true["d"])
            for q, name in ((0.1, "p10_o_totalprice"), (0.5, "p50_o_totalprice")):
                rank = sum(p <= r[name] for p in true["prices"]) / true["n"]
                assert abs(rank - q) < 0.04 + 1 / true["n"]


def test_increments_are_merged_without_the_old_rows(spark):
    rows = spark.range(20_000).select((F.col("id") % 3).alias("g"), (F.col("id") % 700).alias("x"))
    old, new = (sketch_states(rows.where(c), ["g"], ["x"]) for c in ("x < 400", "x >= 300"))
    both = sketch_summary(merged_states(old.unionByName(new), ["g"])).first()
    assert abs(both["distinct_x"] - 700) < 35


def test_states_of_nulls_and_of_nothing(spark):
    rows = spark.createDataFrame([("a", None, None), ("a", None, None), ("b", "x", 2.0)], "g string, c string, x double")
    found = sketch_summary(sketch_states(rows, ["g"], ["c"], ["x"]), ["g"])
    assert values(found, "g", "n", "distinct_c", "p50_x") == [("a", 2, 0, None), ("b", 1, 1, 2.0)]
    assert sketch_summary(sketch_states(rows.where("g = 'z'"), ["g"], ["c"], ["x"]), ["g"]).count() == 0


@pytest.mark.parametrize("keywords", [v.DOCUMENT_LIST, ["C++", "c++", "a", "ab", "b", "É", "日本"]])
def test_automaton_equals_expressions(spark, keywords):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = rows.unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "xABy c++ É 日本語"), (-4, "nan")], "doc_id long, text string"))
    plain = tag_records(rows, "text", {"all": list(keywords)}, per_category=False)
    assert values(tag_by_automaton(rows, "text", keywords), "doc_id", "tags_all") == values(plain, "doc_id", "tags_all")


def test_cost_hardly_depends_on_the_number_of_keywords(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").persist()
    words = [r["w"] for r in rows.select(F.explode(F.split("text", " ")).alias("w")).where("length(w) > 3").groupBy("w").count().orderBy("count", "w").limit(100).collect()]
    many = words + [f"zq{i:05d}" for i in range(9_900)]

    def seconds(keywords):
        begin = time.perf_counter()
        tag_by_automaton(rows, "text", keywords).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds(words)
    assert min(seconds(many) for _ in range(2)) < 2 * min(seconds(words) for _ in range(2)) + 0.5
    rows.unpersist()


def test_keywords_that_are_refused(spark):
    with pytest.raises(ValueError, match="empty"):
        keyword_automaton(["a", ""])
    rows = spark.createDataFrame([("a",)], "text string")
    assert tag_by_automaton(rows, "text", []).first()["tags_all"] == ""
