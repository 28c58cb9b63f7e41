from datetime import date

import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.functions import dates
from tagtrend.operators import combine, counts, dedup, position, timeline


def test_keep_first_by_file_and_row(spark):
    old = spark.createDataFrame([(1, 0, "old1"), (2, 1, "old2"), (2, 2, "later")], "id int, row int, x string")
    new = spark.createDataFrame([(1, 0, "new1"), (3, 1, "new3")], "id int, row int, x string")
    kept = dedup.keep_first(combine.union_sources([old, new], "file"), ["id"], ["file", "row"])
    assert values(kept, "id", "x") == [(1, "old1"), (2, "old2"), (3, "new3")]
    report = dedup.dedup_report(combine.union_sources([old, new]), ["id"]).first()
    assert tuple(report) == (5, 2, 3)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(50_000).select(F.col("id"), F.when(F.col("id") < 30_000, 0).otherwise(F.col("id")).alias("k"))
    kept = dedup.keep_first(df, ["k"], ["id"])
    assert kept.count() == 20_001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_positions_are_contiguous(spark):
    df = spark.range(0, 3000, 3).select((F.col("id") * F.col("id")).alias("k"))
    got = position.with_position(df, "k").orderBy("k").collect()
    assert [r["position"] for r in got] == list(range(1000))
    assert position.with_position(df.where("k < 0"), "k").count() == 0


def test_positions_with_equal_keys(spark):
    df = spark.range(500).select(F.lit(1).alias("k"), "id").unionByName(spark.range(500, 700).select(F.lit(2).alias("k"), "id"))
    got = position.with_position(df, "k", tie_break=["id"]).orderBy("k", "id").collect()
    assert [r["position"] for r in got] == list(range(700))


@pytest.mark.parametrize("rows", [5, 4000])
def test_positions_of_null_keys_come_last(spark, rows):
    df = spark.range(rows).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("x"))
    one, many = (position.with_position(df.repartition(n), "k").collect() for n in (1, 7))
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)
    in_order = [r["k"] for r in sorted(one, key=lambda r: r["position"])]
    assert [r["position"] for r in sorted(one, key=lambda r: r["position"])] == list(range(rows))
    known = [k for k in in_order if k is not None]
    assert in_order == sorted(known) + [None] * (rows - len(known))


def test_surrogate_ids_and_back_fill(spark):
    a = combine.surrogate_ids(spark.createDataFrame([(7, "x"), (3, "y")], "k int, n string"), "k", "SR_", "id")
    assert values(a, "id", "n") == [("SR_0", "y"), ("SR_1", "x")]
    merged = combine.union_sources([a.select("id", "n"), spark.createDataFrame([("z",)], "id string")], blank=True)
    assert ("z", "") in values(merged, "id", "n")


@pytest.mark.parametrize("raw, expected", [
    ("2026-05-18", date(2026, 5, 18)), ("2026.05.18", date(2026, 5, 18)), ("20260518", date(2026, 5, 18)),
    ("2026-05-18 10:00:00", date(2026, 5, 18)), ("2026-05-18T10:00:00", date(2026, 5, 18)), ("2026-05-18T10:00:00.123Z", date(2026, 5, 18)),
    ("2026-05-18 10:00", date(2026, 5, 18)), ("2026-5-8", date(2026, 5, 8)), ("2026.5.18", date(2026, 5, 18)), ("2026/5/8 9:30", date(2026, 5, 8)),
    ("always open", None), ("2026-05-18 late", None), (None, None), ("", None), ("2026-13-40", None),
])
def test_lenient_date(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(dates.lenient_date("c")).first()[0] == expected


def test_month_arithmetic(spark):
    df = spark.createDataFrame([("2026-01",), ("2025-10",)], "m string")
    assert [r[0] for r in df.select(dates.shift_month("m", -2)).collect()] == ["2025-11", "2025-08"]


def test_fit_and_impute(spark):
    day = 86400
    rows = [(i, "A", date(2024, 1, 1 + i)) for i in range(0, 20, 2)]
    rows += [(5, "A", None), (100_000, "A", None), (-3000, "A", None), (7, "B", None), (None, "A", None)]
    df = spark.createDataFrame(rows, "id long, src string, given date")
    fit = timeline.fit_id_to_time(df.where("src = 'A'"), "id", "given")
    f = fit.first()
    assert f["n"] == 10 and abs(f["slope"] - day) < 1e-6 and abs(f["r"] - 1) < 1e-12
    assert f["mean_estimate"] == date(2024, 1, 10)
    options = dict(ident="id", given="given", estimable=F.col("src") == "A", low="2020-01-01", high="2028-01-01")
    got = {r["id"]: r["date_est"] for r in timeline.impute_dates(df, fit, **options).collect()}
    assert got[4] == date(2024, 1, 5) and got[5] == date(2024, 1, 6)
    assert got[100_000] is None and got[-3000] is None and got[7] is None and got[None] is None
    strict = timeline.impute_dates(df, fit.withColumn("r", F.lit(0.2)), min_abs_r=0.5, **options)
    assert {r["id"]: r["date_est"] for r in strict.collect()}[5] is None


def test_calendar(spark):
    df = spark.createDataFrame([(date(2026, 1, 10),), (None,)], "d date")
    got = timeline.posting_calendar(df, "d").collect()
    assert tuple(got[0])[1:] == (date(2025, 12, 11), "2025-12", 2025, 12, 4)
    assert tuple(got[1])[1:] == (None, None, None, None, None)


def test_month_counts_and_pivot(spark):
    df = spark.createDataFrame(
        [("2025-07", "a"), ("2025-07", "b"), ("2025-08", "a"), ("2024-01", "a"), ("", "a"), (None, "a")], "ym string, c string"
    )
    assert values(timeline.month_counts(df, "ym", "2025-07", "2025-12")) == [("2025-07", 2), ("2025-08", 1)]
    wide = timeline.month_category_table(df.where("ym >= '2025'"), "ym", "c", ["b", "a"])
    assert wide.columns == ["ym", "b", "a"] and values(wide) == [("2025-07", 1, 1), ("2025-08", 0, 1)]


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 4)], "c string, v int")
    assert values(counts.value_counts(df, "c")) == [("a", 2, 200 / 3), ("b", 1, 100 / 3)]
    assert values(counts.top_values(df, "c", 1)) == [("a", 2)]
    assert values(counts.distinct_counts(df, ["c", "v"])) == [(4, 2, 3)]
    covered = counts.coverage(df, {"has": F.col("v").isNotNull()}, ["c"])
    assert values(covered) == [("a", 2, 2, 100.0), ("b", 1, 0, 0.0), (None, 1, 1, 100.0)]


def test_numeric_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("a", None), ("b", None)], "g string, v int")
    assert values(counts.numeric_profile(df, "g", "v")) == sorted(
        [("a", 4, 2.0, 25.0, 1, 2), ("a", 4, 2.0, 25.0, 4, 1), ("a", 4, 2.0, 25.0, None, 1), ("b", 1, None, 100.0, None, 1)], key=repr
    )
