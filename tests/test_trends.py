import json

import golden as g
import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.operators import counts, rates, seasons, segments, timeline

PERIODS = {"first": ("2025-07", "2025-09"), "second": ("2025-10", "2025-12"), "recent_from": "2026-01"}


@pytest.fixture(scope="module")
def monthly(spark):
    rows = [(m, k, n[i], g.TOTALS[i], n[i] / g.TOTALS[i] * 100) for k, n in g.KEYWORD_COUNTS.items() for i, m in enumerate(g.MONTHS)]
    return spark.createDataFrame(rows, "ym string, keyword string, n long, total long, rate double")


@pytest.fixture(scope="module")
def jobs(spark):
    rows = [(m, c, n[i]) for c, n in g.JOB_COUNTS.items() for i, m in enumerate(g.MONTHS)]
    return spark.createDataFrame(rows, "ym string, category string, n long")


def test_period_growth_matches_published_table(monthly):
    got = rates.period_growth(monthly, **PERIODS).collect()
    names = ("mean_first", "mean_second", "mean_recent", "growth", "mean_all")
    assert {r["keyword"]: tuple(round(r[c], 1) for c in names) for r in got} == g.GROWTH


def test_keyword_absent_from_first_period_has_growth_zero(spark):
    df = spark.createDataFrame([("2025-07", "x", 0, 5, 0.0), ("2025-10", "x", 5, 5, 100.0)], "ym string, keyword string, n long, total long, rate double")
    row = rates.period_growth(df, **PERIODS).first()
    assert row["growth"] == 0 and row["count_second"] == 5


def test_trend_summary_matches_published_ranking(monthly, jobs):
    got = rates.trend_summary(rates.period_growth(monthly, **PERIODS), seasons.peaks(jobs)).collect()
    def ranked(section):
        return [r["name"] for r in sorted((r for r in got if r["section"] == section), key=lambda r: r["rank"])]
    assert ranked("rising") == g.RISING and ranked("falling") == g.FALLING and ranked("top") == g.TOP
    assert {r["name"]: r["at"] for r in got if r["section"] == "peak"} == g.PEAKS


def test_peaks_uplift_and_preparation(jobs):
    got = {r["category"]: r for r in seasons.peaks(jobs).collect()}
    assert {c: r["peak_month"] for c, r in got.items()} == g.PEAKS
    assert got["백엔드"]["peak_n"] == 581 and round(got["백엔드"]["mean_n"], 1) == 494.8 and round(got["백엔드"]["uplift"], 1) == 17.4
    assert got["AI_ML"]["prep_month"] == "2026-01" and got["DevOps"]["prep_month"] == "2025-08"


def test_peak_ties_go_to_the_earlier_month(spark):
    df = spark.createDataFrame([("2025-08", "a", 5), ("2025-07", "a", 5), ("2025-09", "a", 1)], "ym string, category string, n long")
    assert seasons.peaks(df).first()["peak_month"] == "2025-07"
    assert values(seasons.peak_flags(df).where("is_peak"), "ym") == [("2025-07",)]
    assert values(seasons.ranked_peaks(df, 2), "ym", "rank") == [("2025-07", 1), ("2025-08", 2)]


def test_first_last_growth(spark, jobs):
    growth = seasons.first_last_growth(jobs)
    assert {r["category"]: round(r["growth"], 1) for r in growth.collect()} == g.FIRST_LAST
    assert [r["category"] for r in seasons.growing(growth).collect()] == ["AI_ML", "데이터", "모바일", "DevOps"]
    assert [r["category"] for r in seasons.largest(growth).collect()] == ["백엔드", "AI_ML", "DevOps", "프론트엔드"]
    zero = spark.createDataFrame([("2025-07", "a", 0), ("2025-08", "a", 5)], "ym string, category string, n long")
    assert seasons.first_last_growth(zero).first()["growth"] == 0


def test_headline(monthly, jobs):
    got = seasons.headline(seasons.first_last_growth(jobs), rates.period_growth(monthly, **PERIODS))
    assert values(got, "kind", "name") == [("category", "AI_ML"), ("keyword", "Linux")]


def test_keyword_rates_modes_and_weights(spark):
    df = spark.createDataFrame([("g", "Java, JavaScript", 1), ("g", "JavaScript", 3), ("h", "", 2), ("h", None, 1)], "grp string, tags string, w long")
    sub = values(rates.keyword_rates(df, ["grp"], "tags", ["Java"]), "grp", "n", "total", "rate")
    assert sub == [("g", 2, 2, 100.0), ("h", 0, 2, 0.0)]
    token = values(rates.keyword_rates(df, ["grp"], "tags", ["Java"], match="token"), "grp", "n", "rate")
    assert token == [("g", 1, 50.0), ("h", 0, 0.0)]
    weighted = values(rates.keyword_rates(df, ["grp"], "tags", ["JavaScript"], weight="w"), "grp", "n", "total")
    assert weighted == [("g", 4, 4), ("h", 0, 3)]


def test_month_counts_of_counted_rows(spark):
    df = spark.createDataFrame([("2025-07", "a", 3), ("2025-07", "a", 2), ("2025-08", "b", 1)], "ym string, c string, w long")
    got = values(timeline.month_category_counts(df, "ym", "c", ["a", "b"], weight="w"))
    assert got == [("2025-07", "a", 5), ("2025-07", "b", 0), ("2025-08", "a", 0), ("2025-08", "b", 1)]


@pytest.fixture(scope="module")
def postings(spark):
    rows = [("big", c, n) for c, (n, _) in g.BIG_JOBS.items()] + [("small", c, n) for c, (n, _) in g.SMALL_JOBS.items()]
    return spark.createDataFrame(rows, "size string, job string, n long")


def test_segment_distribution_matches_published_ratios(spark, postings):
    got = counts.distribution(postings, "size", "job", weight="n")
    assert {r["job"]: (r["n"], round(r["ratio"], 1)) for r in got.where("size = 'big'").collect()} == g.BIG_JOBS
    assert {r["job"]: (r["n"], round(r["ratio"], 1)) for r in got.where("size = 'small'").collect()} == g.SMALL_JOBS
    rows = postings.select("size", "job", F.explode(F.sequence(F.lit(1), F.col("n"))))
    assert {tuple(r)[0]: round(r["share"], 1) for r in counts.category_share(rows, "size", "job", "풀스택").collect()} == {"big": 0.3, "small": 2.1}
    pairs = rates.two_segments(got, "size", "job", "ratio", "big", "small")
    parts = {(r["section"], r["rank"]): (r["name"], r["diff"]) for r in rates.common_and_different(pairs).collect()}
    assert parts["headline_common", 1][0] == "백엔드" and parts["headline_gap", 1] == ("DevOps", 8.8)
    assert [parts["common", i][0] for i in (1, 2, 3, 4)] == ["백엔드", "DevOps", "AI_ML", "데이터"]
    assert [parts["a_leads", i][0] for i in (1, 2, 3)] == ["DevOps", "보안", "데이터"]
    assert [parts["b_leads", i][0] for i in (1, 2, 3)] == ["백엔드", "프론트엔드", "기타"]


def test_distinctive_threshold(spark):
    rows = [("small", "TypeScript", 18.6), ("big", "TypeScript", 6.4), ("small", "React", 22.4), ("big", "React", 11.5),
            ("small", "Java", 29.0), ("big", "Java", 38.5), ("small", "Spring", 15.4), ("big", "Spring", 22.6), ("small", "only", 9.0)]
    pairs = rates.two_segments(spark.createDataFrame(rows, "s string, k string, r double"), "s", "k", "r", "small", "big")
    got = values(rates.distinctive(pairs), "name", "diff", "leader")
    assert got == [("Java", -9.5, "b"), ("React", 10.9, "a"), ("TypeScript", 12.2, "a"), ("only", 9.0, "a")]


def test_two_segment_token_rates(spark):
    rows = [("big", "a, a, b"), ("big", "a"), ("small", "b"), ("small", ""), ("other", "c, c")]
    got = segments.two_segment_token_rates(spark.createDataFrame(rows, "s string, t string"), "s", "t", "big", "small", 2)
    assert values(got) == [("a", 2, 0, 100.0, 0.0), ("b", 1, 1, 50.0, 50.0)]


def test_metrics_bundle(spark):
    rows = spark.createDataFrame([("x", "j1", "k1"), ("x", "j2", "k1, k2"), ("y", "j1", "")], "s string, j string, t string")
    by = rates.keyword_rates(rows, ["s"], "t", ["k1", "k2"])
    gaps = rates.distinctive(rates.two_segments(by, "s", "keyword", "rate", "x", "y"), 60)
    grouped = by.withColumn("d", F.when(F.col("keyword") == "k1", "one").otherwise("two"))
    bundle = segments.metrics_bundle(
        counts.distribution(rows, "s", "j"), grouped, rates.segment_ranking(by, "s", 1), gaps, counts.category_share(rows, "s", "j", "j2"),
        segment="s", category="j", dictionary="d",
    )
    assert bundle.count() == 1
    assert json.loads(bundle.first()["document"]) == {
        "meta": {"total": 3, "segments": {"x": 2, "y": 1}},
        "keyword_rates": {"x": {"one": {"k1": 100.0}, "two": {"k2": 50.0}}, "y": {"one": {"k1": 0.0}, "two": {"k2": 0.0}}},
        "top_keywords": {"x": [{"rank": 1, "keyword": "k1", "rate": 100.0}], "y": [{"rank": 1, "keyword": "k1", "rate": 0.0}]},
        "distinctive": [{"name": "k1", "a": 100.0, "b": 0.0, "diff": 100.0, "leader": "a"}],
        "category_share": {"x": 50.0, "y": 0.0},
        "distribution": {"x": {"j1": 50.0, "j2": 50.0}, "y": {"j1": 100.0}},
    }
