"""The whole pipeline on a small set of raw exports."""

from datetime import date

import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.plans import posting_values as p
from tagtrend.plans import postings
from tagtrend.sources import tables

LONG = "Python 과 Java 로 Spring API 서버를 개발하고 AWS 환경에서 운영합니다. " * 3


def write(path, header, rows):
    def cell(value):
        return '"' + value.replace('"', '""') + '"'

    path.write_text("\ufeff" + ",".join(header) + "\n" + "\n".join(",".join(cell(c) for c in r) for r in rows) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    old_columns = ["공고ID", "공고제목", "회사명", "지역", "경력", "주요업무", "자격요건", "우대사항", "혜택복지", "마감일", "상태", "링크", "수집일시"]
    new_columns = [c for c in old_columns if c != "마감일"]
    old = [
        [str(100 + i), f"백엔드 개발자 {i}", "카카오" if i % 3 == 0 else f"회사{i}", "서울", str(i), LONG, LONG if i % 2 else "Docker", "", "", d, "open", "l", "t"]
        for i, d in enumerate(["2025-08-15", "2025-09-14", "2025-10-14", "2025-11-13", "2025-12-13", "2026-01-12"])
    ]
    new = [
        ["103", "다른 제목", "회사9", "서울", "1", "x", "y", "", "", "open", "l", "t"],
        ["106", "React 개발자", " 회사7 ", "부산", "", "React\n와 TypeScript 🚀 " + "x" * 60, "Next.js, C++", "", "", "open", "l", "t"],
    ]
    b = [["React 개발자", "회사7", "대구", "신입", "2026.03.01", "u", "t"], ["데이터 엔지니어", "한국전력", "대전", "3년", "상시", "u", "t"]]
    c = [["iOS 앱", "회사8", "서울 | 경력 2년", "http://x"], ["PO", "회사10", "서울", "http://y"]]
    out = postings.run(
        spark,
        site_a=[write(folder / "a1.csv", old_columns, old), write(folder / "a2.csv", new_columns, new)],
        site_b=write(folder / "b.csv", ["공고제목", "회사명", "지역", "경력", "마감일", "링크", "수집일시"], b),
        site_c=write(folder / "c.csv", ["공고제목", "회사명", "추가정보", "url"], c),
        out=str(folder / "out"),
    )
    return out, folder


def test_integration(spark, results):
    rows = {r["공고ID"]: r for r in tables.read_stage(spark, str(results[1] / "out" / "integrated")).collect()}
    # 103 of the new file and the site B copy of 106 are duplicates.
    assert sorted(rows) == sorted(["100", "101", "102", "103", "104", "105", "106", "SR_1", "JD_0", "JD_1"])
    assert rows["103"]["공고제목"] == "백엔드 개발자 3" and rows["106"]["마감일"] == "" and rows["106"]["출처"] == p.SOURCE_A
    assert (rows["JD_0"]["지역"], rows["JD_0"]["경력"], rows["JD_1"]["경력"]) == ("서울", "경력 2년", "")
    assert rows["SR_1"]["상태"] == "unknown" and rows["SR_1"]["주요업무"] == ""


def test_dates(results):
    rows = {r["공고ID"]: r for r in results[0]["cleaned"].collect()}
    assert rows["100"]["마감일_추정"] == date(2025, 8, 15) and rows["100"]["게시일_추정"] == date(2025, 7, 16) and rows["100"]["게시년월"] == "2025-07"
    assert rows["106"]["마감일_추정"] == date(2026, 2, 11)
    assert rows["SR_1"]["마감일_추정"] is None and rows["SR_1"]["게시년월"] is None


def test_cleaning_tags_and_classes(results):
    rows = {r["공고ID"]: r for r in results[0]["cleaned"].collect()}
    assert rows["106"]["주요업무_clean"].startswith("React 와 TypeScript x")
    assert rows["106"]["tech_all"] == "C++, Next.js, React, TypeScript" and rows["106"]["tech_언어"] == "TypeScript, C++"
    assert rows["100"]["tech_all"] == "AWS, Docker, Java, Python, Spring"
    assert {k: rows[k]["직무카테고리"] for k in ("100", "106", "SR_1", "JD_0", "JD_1")} == {
        "100": "백엔드", "106": "프론트엔드", "SR_1": "데이터", "JD_0": "모바일", "JD_1": "PM_기획"}
    assert (rows["100"]["회사규모"], rows["101"]["회사규모"], rows["SR_1"]["회사규모"]) == (p.BIG, p.SMALL, p.PUBLIC)


def test_result_tables(spark, results):
    out = results[0]
    assert out["tech_monthly"].select("ym").distinct().count() == 7 and out["tech_monthly"].count() == 7 * len(p.TREND_KEYWORDS)
    java = out["tech_growth"].where("keyword = 'Java'").first()
    assert (java["mean_first"], java["mean_second"], java["growth"], java["count_first"]) == (100.0, 100.0, 0.0, 3)
    assert values(out["job_peak"].where("category = '백엔드'"), "peak_month", "prep_month") == [("2025-07", "2025-05")]
    assert out["tech_ratio_by_size"].count() == 2 * 91
    assert values(out["job_category_by_size"].where(F.col("회사규모") == p.BIG), "직무카테고리", "n") == [("백엔드", 2)]
    assert spark.table("trend_summary").where("section = 'peak'").count() == len(p.TREND_JOBS)
    assert values(out["stage_report"].where("section = 'total'"), "n") == [(10,)]


def test_documents_clusters_and_search(spark, results):
    cleaned = results[0]["cleaned"]
    docs = postings.retrieval_documents(cleaned)
    first = docs.where("id = 'job_100'").first()
    assert first["document"].splitlines()[:3] == ["[공고제목] 백엔드 개발자 0", "[회사] 카카오 (대기업)", "[지역] 서울"]
    assert len(first["document"].splitlines()) == 8 and first["metadata"]["job_category"] == "백엔드"
    assert docs.count() == 7
    out = str(results[1] / "out")
    made = postings.run_clusters(spark, out=out, ks=(2, 3), restarts=2)
    assert made["clusters"].count() == 7 and sum(r["n"] for r in made["cluster_summary"].collect()) == 7
    assert spark.table("company_size").where("token = 'Java'").first()["rate_a"] == 100.0
    assert spark.read.parquet(f"{out}/collection").where("job_category = '백엔드'").count() == 6


def test_sample_file(spark, results):
    out = str(results[1] / "out")
    rows = postings.run_samples(spark, out=out).collect()
    assert sorted({r["kind"] for r in rows}) == ["A", "B", "C", "D"] and len(rows) == 119
    assert all(r["conversations"][2]["content"] == r["answer"] for r in rows)


def test_samples(spark, results):
    cleaned = results[0]["cleaned"].withColumn("_n", F.xxhash64("공고ID"))
    comparison = postings.comparison_tables(cleaned)
    a, b, c = postings.roadmap_samples(comparison, spark), postings.choice_samples(comparison), postings.compare_samples(comparison)
    d = postings.posting_samples(cleaned, order="_n")
    records = spark.createDataFrame([(0, "제목", "업무", "", None, None), (1, "t", "", "", "x", "서울"), (2, None, None, "자격", "우대", None)],
                                    "n long, `공고제목` string, `주요업무` string, `자격요건` string, `우대사항` string, `지역` string")
    for name in ("주요업무_clean", "자격요건_clean", "우대사항_clean", "검색어"):
        records = records.withColumn(name, F.lit(None).cast("string"))
    e = postings.record_samples(records, order="n")
    assert (a.count(), b.count(), c.count(), e.count()) == (100, 10, 6, 2)
    assert d.count() == 3  # three postings with at least 20 characters of requirements
    text = a.where(F.col("question").startswith("백엔드 개발자로 대기업")).first()["answer"]
    assert text.startswith("**백엔드 개발자 학습 로드맵** (대기업 취업 목표)\n\n📌 1단계 — 프로그래밍 기초\n   필수 기술: Python 또는 Java, 자료구조/알고리즘, Git\n")
    assert text.endswith("   대기업 TOP5 기술: AWS(100.0%), Java(100.0%), Python(100.0%), Spring(100.0%), Docker(50.0%)")
    answers_e = [r["answer"] for r in e.collect()]
    assert any("정보 없음" in x and "서울 기반" in x for x in answers_e) and any("⭐ **우대사항**" in x for x in answers_e)
    built = postings.sample_set([a, b, c, d, e], 4321)
    row = built.first()
    assert built.count() == 121 and [t["role"] for t in row["conversations"]] == ["system", "user", "assistant"]
    assert row["text"].startswith("<|begin_of_text|>") and row["split"] in ("train", "eval")
    assert "4321" in row["conversations"][0]["content"] and any("4321" in r["answer"] for r in built.where("kind = 'A'").collect())
    assert "{" not in "".join(r["question"] + r["answer"] for r in built.collect())


def test_answers(spark, results):
    cleaned = results[0]["cleaned"].withColumn("_n", F.xxhash64("공고ID"))
    clustered = spark.createDataFrame([(0, "백엔드", p.BIG, "Java, AWS"), (1, "프론트엔드", p.SMALL, "React")], "cluster int, `직무카테고리` string, `회사규모` string, tech_all string")
    questions = spark.createDataFrame([(1, "백엔드 Java 공부 언제 시작?"), (2, "안녕"), (3, "대기업 차이")], "id int, message string")
    got = {r["id"]: r["answer"] for r in postings.answer_questions(questions, cleaned, clustered, ident="_n").collect()}
    assert "## 백엔드 개발자 필수 기술스택" in got[1] and "**[유형 1] C00-백엔드(AWS+Java)** (1개 공고)" in got[1]
    assert "피크 시즌: **2025-07**" in got[1] and "**관련 채용공고 샘플:**" in got[1] and "**3. " in got[1]
    assert "회사 규모별" in got[3] and "회사 규모별" not in got[2]
    assert all(x.endswith("*데이터 출처: 채용공고 분석*") for x in got.values())
