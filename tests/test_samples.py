import pytest
from helpers import values
from pyspark.sql import functions as F

from tagtrend.operators import documents, roadmap, samples, sampling
from tagtrend.plans import posting_values as p
from tagtrend.plans import vocabulary as v


def test_rotation_counts_skipped_rows(spark):
    df = spark.createDataFrame([(10, True), (20, False), (30, True), (40, True)], "id int, ok boolean")
    got = samples.rotating_template(df, ["a", "b", "c", "d"], "id").where("ok")
    assert values(got, "id", "template_no", "template") == [(10, 0, "a"), (30, 2, "c"), (40, 3, "d")]


def test_each_template_adds_no_join(spark):
    got = samples.each_template(spark.createDataFrame([("x",), ("y",)], "s string"), ["q1", "q2"])
    assert values(got) == [("x", 0, "q1"), ("x", 1, "q2"), ("y", 0, "q1"), ("y", 1, "q2")]
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_record_and_flattening(spark):
    df = spark.createDataFrame([("Q?", "A!")], "q string, a string")
    row = df.select(samples.chat_record("S", F.col("q"), F.col("a")).alias("c")).select("c", samples.flatten_record(F.col("c"), v.CHAT_MARKERS).alias("t")).first()
    assert [(t["role"], t["content"]) for t in row["c"]] == [("system", "S"), ("user", "Q?"), ("assistant", "A!")]
    def turn(role, text):
        return f"<|start_header_id|>{role}<|end_header_id|>\n\n{text}<|eot_id|>\n"
    assert row["t"] == "<|begin_of_text|>" + turn("system", "S") + turn("user", "Q?") + turn("assistant", "A!") + "<|end_of_text|>"


def test_a_conversation_of_any_length_is_one_row(spark):
    rows = [(1, t, "user", f"m{t}") for t in range(300)] + [(2, 0, "user", "only"), (3, 5, "user", None)]
    df = spark.createDataFrame(rows, "c int, t long, r string, x string").repartition(4)
    got = {r["c"]: r["text"] for r in samples.flatten_turns(df, "c", "t", "r", "x", v.CHAT_MARKERS).collect()}
    turns = "".join(f"<|start_header_id|>user<|end_header_id|>\n\nm{t}<|eot_id|>\n" for t in range(300))
    assert len(got) == 3 and got[1] == v.CHAT_MARKERS["begin"] + turns + v.CHAT_MARKERS["end"]
    assert all(t.startswith(v.CHAT_MARKERS["begin"]) and t.endswith(v.CHAT_MARKERS["end"]) for t in got.values())


def test_cap_words(spark):
    df = spark.createDataFrame([("  a b\n c\td ",), ("a",), ("",)], "t string")
    assert values(samples.cap_words(df, "t", 3), "t", "n_words", "truncated") == [("", 0, False), ("a b c", 4, True), ("a", 1, False)]


def test_split_sample_and_shuffle_do_not_depend_on_partitions(spark):
    df = spark.range(3000).withColumnRenamed("id", "k")
    def run(n):
        part = df.repartition(n)
        return (values(sampling.hash_split(part, "k")), values(sampling.hash_sample(part, "k", 50)), values(sampling.shuffle_positions(part, "k")))
    one, many = run(1), run(7)
    assert one == many
    share = sum(1 for r in one[0] if r[1] == "eval") / 3000
    assert 0.08 < share < 0.12 and len(one[1]) == 50 and sorted(r[1] for r in one[2]) == list(range(3000))


def test_documents(spark):
    df = spark.createDataFrame([("1", "t" * 120, "x" * 60, None), ("2", "t", "short", None)], "id string, title string, body string, r string")
    kept = documents.with_text(df, ["body"], 50)
    got = documents.retrieval_documents(kept, ident="id", lines=[("a", "body"), ("b", "r")], metadata={"title": ("title", 100), "r": ("r", None)}).collect()
    assert len(got) == 1 and got[0]["id"] == "job_1" and got[0]["document"] == "[a] " + "x" * 60 + "\n[b] "
    assert got[0]["metadata"].asDict() == {"title": "t" * 100, "r": ""}


@pytest.fixture(scope="module")
def planned(spark):
    rows = [(1, "백엔드", "스타트업", None, ["Python"], "3개월"), (2, "없는직무", "대기업", "전공자", [], "2년"), (3, "AI_ML", "AI 스타트업", "", None, "1년")]
    df = spark.createDataFrame(rows, "id int, job string, company string, experience string, current_stack array<string>, goal_period string")
    from tagtrend.plans import postings
    return {r["id"]: r for r in postings.profile_prompts(postings.profile_plans(df)).collect()}


def test_rule_plan(planned):
    plan = planned[1]
    assert plan["total_weeks"] == 12 and len(plan["steps"]) == 5
    step = plan["steps"][1]
    assert (step["step"], step["title"], step["duration"]) == (2, "웹 프레임워크", "2주")
    assert step["techs"] == ["Spring Boot", "FastAPI/Django"]
    assert step["resources"] == ["스프링 공식 가이드", "인프런 스프링부트 강의", "공식 문서 정독"]
    assert step["description"] == "웹 프레임워크 단계에서는 Spring Boot, FastAPI/Django을 집중 학습합니다."
    assert step["milestone"] == "Spring Boot 기반 미니 프로젝트 1개 완성"
    assert plan["steps"][2]["resources"] == ["MySQL 공식 문서", "생활코딩 MySQL", "공식 문서 정독"]
    assert plan["title"] == "백엔드 개발자 3개월 로드맵 (스타트업 목표)"
    assert plan["market_insight"].startswith("스타트업은")
    assert plan["step_summaries"][1] == "2단계 [웹 프레임워크] — Spring Boot, FastAPI/Django (2주)"


def test_rule_plan_defaults(planned):
    other = planned[2]
    assert other["total_weeks"] == 24 and other["steps"][0]["title"] == "프로그래밍 기초" and other["steps"][0]["duration"] == "4주"
    assert other["market_insight"].startswith("대기업은")
    assert planned[3]["total_weeks"] == 48 and planned[3]["steps"][0]["duration"] == "9주"


def test_profile_prompt(planned):
    assert planned[1]["prompt"].startswith("저는 비전공자 배경을 가진 취업 준비생입니다.\n목표: 스타트업 백엔드 개발자 취업 (3개월 내)\n현재 알고 있는 기술: Python\n\n")
    assert "현재 알고 있는 기술: 없음" in planned[2]["prompt"] and "저는 전공자" in planned[2]["prompt"]
    assert '"total_weeks": 숫자' in planned[3]["prompt"]


def test_parsed_plans_fall_back(spark):
    from tagtrend.plans import postings
    profiles = spark.createDataFrame([(1, "백엔드", "대기업", "x", ["a"], "6개월"), (2, "백엔드", "대기업", "x", ["a"], "6개월")],
                                     "id int, job string, company string, experience string, current_stack array<string>, goal_period string")
    replies = spark.createDataFrame([(1, 'ok {"title":"T","total_weeks":3,"steps":[{"step":1,"title":"s"}]} end'), (2, "{broken")], "id int, reply string")
    got = {r["id"]: r for r in postings.parsed_plans(replies, "reply", postings.profile_plans(profiles), "id").collect()}
    assert got[1]["title"] == "T" and got[1]["from_reply"] and got[1]["steps"][0]["title"] == "s"
    assert not got[2]["from_reply"] and len(got[2]["steps"]) == 5 and got[2]["total_weeks"] == 24


def test_step_weeks_are_at_least_one(spark):
    df = spark.createDataFrame([("x", "c", "w")], "job string, company string, period string")
    got = roadmap.rule_plan(
        df, job="job", company="company", period="period", plans={"x": [("t", ["a"])] * 9}, default_plan="x", weeks={"w": 4}, default_weeks=1,
        resources={}, default_resource="r", texts=p.PLAN_TEXTS, insights={}, default_insight="i",
    ).first()
    assert {s["duration"] for s in got["steps"]} == {"1주"} and got["market_insight"] == "i"
