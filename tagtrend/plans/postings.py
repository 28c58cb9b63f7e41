"""The job-posting pipeline: raw site exports to result tables, every stage a DataFrame to DataFrame step."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions import text
from tagtrend.functions.dates import lenient_date, lenient_number
from tagtrend.operators import (
    answers, clusters, combine, counts, dedup, documents, rates, roadmap, samples, sampling, seasons, segments, summary,
    tagging, timeline, vectors,
)
from tagtrend.operators.rows import keep_where
from tagtrend.plans import posting_values as p
from tagtrend.session import cut_lineage
from tagtrend.sources import collection, tables

RAW_A = ["공고ID", "공고제목", "회사명", "지역", "경력", "주요업무", "자격요건", "우대사항", "혜택복지", "마감일", "상태", "링크", "수집일시"]
RAW_B = ["공고제목", "회사명", "지역", "경력", "마감일", "링크", "수집일시"]
RAW_C = ["공고제목", "회사명", "추가정보", "url"]
COLUMNS = ["공고ID", "출처", "공고제목", "회사명", "지역", "경력", "주요업무", "자격요건", "우대사항", "혜택복지", "마감일", "상태", "링크", "수집일시"]


def integrate(site_a: list[DataFrame], site_b: DataFrame, site_c: DataFrame, *, row: str = "_row") -> DataFrame:
    """Union the exports into the common schema and keep the first of each id and of each company and title.

    `row` is a unique number per row in file order. Files of site A rank in list order, sites A, B, C.
    """
    union_a = combine.union_sources(site_a, "_file")
    missing = {c: F.lit(None).cast("string") for c in COLUMNS if c not in union_a.columns}
    union_a = union_a.withColumns(missing)
    first_a = dedup.keep_first(union_a, ["공고ID"], ["_file", row])
    plain = {c: F.col(c) for c in COLUMNS if c != "출처"}
    order = {"_file": F.col("_file"), "_row": F.col(row)}
    standard_a = combine.standardise(first_a, {**plain, "출처": p.SOURCE_A, **order})
    same_b = ["공고제목", "회사명", "지역", "경력", "마감일", "링크", "수집일시"]
    standard_b = combine.standardise(combine.surrogate_ids(site_b, row, "SR_", "_id"), {
        **dict.fromkeys(COLUMNS), **{c: F.col(c) for c in same_b}, "공고ID": F.col("_id"), "출처": p.SOURCE_B,
        "상태": p.UNKNOWN_STATUS, "_file": F.lit(0), "_row": F.col(row),
    })
    standard_c = combine.standardise(combine.surrogate_ids(site_c, row, "JD_", "_id"), {
        **dict.fromkeys(COLUMNS), "공고제목": F.col("공고제목"), "회사명": F.col("회사명"),
        "지역": text.split_field("추가정보", 0), "경력": text.split_field("추가정보", 1), "링크": F.col("url"),
        "공고ID": F.col("_id"), "출처": p.SOURCE_C, "상태": p.UNKNOWN_STATUS, "_file": F.lit(0), "_row": F.col(row),
    })
    every = combine.union_sources([standard_a, standard_b, standard_c], "_site")
    keyed = every.withColumn("_key", text.composite_key("회사명", "공고제목"))
    return dedup.keep_first(keyed, ["_key"], ["_site", "_file", "_row"]).select(*COLUMNS).na.fill("", subset=COLUMNS)


def date_postings(integrated: DataFrame) -> DataFrame:
    """Deadlines given or, for site A, estimated from the id; posting date, month, year and quarter."""
    is_a = F.col("출처") == p.SOURCE_A
    work = integrated.withColumn("_given", lenient_date("마감일")).withColumn("_id", lenient_number("공고ID"))
    fit = timeline.fit_id_to_time(work.where(is_a), "_id", "_given")
    low, high = p.ESTIMATE_RANGE
    dated = timeline.impute_dates(work, fit, ident="_id", given="_given", estimable=is_a, low=low, high=high, out="마감일_추정")
    return timeline.posting_calendar(dated, "마감일_추정", lead_days=p.LEAD_DAYS, prefix="게시일").drop("_given", "_id").withColumnsRenamed(
        {"게시일_est": "게시일_추정", "ym": "게시년월", "year": "게시년도", "month": "게시월", "quarter": "게시분기"}
    )


def clean_postings(dated: DataFrame, *, match: str = "substring") -> DataFrame:
    """Cleaned texts, their union, keyword tags per category, job category and company size."""
    cleaned = dated.withColumns({f"{c}_clean": text.clean_text(c) for c in ("주요업무", "자격요건", "우대사항")})
    joined = cleaned.withColumn("텍스트_통합", text.join_texts("공고제목", "주요업무_clean", "자격요건_clean", "우대사항_clean"))
    tagged = tagging.tag_records(joined, "텍스트_통합", p.KEYWORDS, match=match, prefix="tech_")
    by_job = tagging.classify(tagged, "텍스트_통합", p.JOB_RULES, p.OTHER_JOB, "직무카테고리")
    return tagging.classify(by_job, "회사명", p.SIZE_RULES, p.SMALL, "회사규모", ignore_case=False)


def timed(cleaned: DataFrame, months: tuple[str, str] = p.TREND_MONTHS) -> DataFrame:
    return cleaned.where(timeline.in_months("게시년월", *months))


def explore_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The tables of the first look: postings per month of the wide window, the dated months, and how often each size
    of company mentions the leading keywords."""
    return {
        "month_counts": timeline.month_counts(cleaned, "게시년월", *p.EDA_MONTHS),
        "date_summary": timeline.month_counts(cleaned, "게시년월"),
        "size_keywords": rates.keyword_rates(cleaned, ["회사규모"], "tech_all", p.TREND_KEYWORDS[:8]),
    }


def trend_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """The tables of the trend stage and of the lookups built on them.

    The month, category and tag combinations are counted once; every table is an aggregate of that.
    """
    by = [F.col("게시년월").alias("ym"), F.col("직무카테고리").alias("category"), F.col("tech_all")]
    counted = cut_lineage(timed(cleaned).groupBy(*by).agg(F.count("*").alias("n")))
    monthly = rates.keyword_rates(counted, ["ym"], "tech_all", p.TREND_KEYWORDS, weight="n")
    growth = rates.period_growth(monthly, **p.PERIODS)
    by_job = timeline.month_category_counts(counted, "ym", "category", p.TREND_JOBS, weight="n")
    ends = seasons.first_last_growth(by_job)
    return {
        "tech_frequency": tagging.token_frequency(cleaned, "tech_all", 30),
        "tech_monthly": monthly,
        "tech_growth": growth,
        "job_monthly": by_job,
        "job_monthly_wide": timeline.month_category_table(counted, "ym", "category", p.TREND_JOBS, weight="n"),
        "job_growth": ends,
        "job_peak": seasons.peaks(by_job),
        "trend_summary": rates.trend_summary(growth, seasons.peaks(by_job)),
        "headline": seasons.headline(ends, growth),
        "job_tech_rate": rates.keyword_rates(
            cleaned.where(F.col("직무카테고리").isin(*p.TREND_JOBS)), ["직무카테고리"], "tech_all", p.CLUSTER_KEYWORDS
        ),
    }


def comparison_tables(cleaned: DataFrame) -> dict[str, DataFrame]:
    """Big against small companies: keyword ratios, job mix, leaders, gaps and what both share."""
    rows = cleaned.where(F.col("회사규모").isin(p.BIG, p.SMALL)).withColumn("years", lenient_number("경력"))
    two = cut_lineage(rows.groupBy("회사규모", "직무카테고리", "tech_all").agg(F.count("*").alias("n")))
    every = [k for words in p.KEYWORDS.values() for k in words]
    by_size = rates.keyword_rates(two, ["회사규모"], "tech_all", every, match="token", weight="n")
    groups = F.broadcast(tagging.dictionary_table(two, p.KEYWORDS).select(F.col("category").alias("카테고리"), "keyword"))
    jobs = counts.distribution(two, "회사규모", "직무카테고리", weight="n")
    gaps = rates.distinctive(rates.two_segments(by_size, "회사규모", "keyword", "rate", p.SMALL, p.BIG))
    ranking = rates.segment_ranking(by_size, "회사규모", 10)
    ratios = by_size.join(groups, "keyword")
    shares = counts.category_share(two, "회사규모", "직무카테고리", p.FULLSTACK, weight="n")
    return {
        "tech_ratio_by_size": ratios,
        "job_category_by_size": jobs,
        "top_techs_per_size": ranking,
        "distinctive_techs": gaps,
        "fullstack_preference": shares,
        "experience_requirement": counts.numeric_profile(rows, "회사규모", "years"),
        "job_comparison": rates.common_and_different(rates.two_segments(jobs, "회사규모", "직무카테고리", "ratio", p.BIG, p.SMALL)),
        "metrics": segments.metrics_bundle(
            jobs, ratios, ranking, gaps, shares, segment="회사규모", category="직무카테고리", dictionary="카테고리"
        ),
    }


def stage_report(cleaned: DataFrame) -> DataFrame:
    """The printed summaries: shares of sites, jobs and sizes, leading regions, text and tag coverage."""
    return summary.stage_summary(
        cleaned,
        shares={"source": "출처", "job": "직무카테고리", "size": "회사규모"},
        tops={"region": ("지역", 10)},
        covered={
            "duties": text.longer_than("주요업무", 10), "requirements": text.longer_than("자격요건", 10),
            "tagged": F.col("tech_all") != "", "dated": F.col("게시일_추정").isNotNull(),
        },
        distinct=["회사명"],
    )


def _document_lines() -> list[tuple[str, Column | str]]:
    """The labelled lines of a posting as a retrieval document."""
    values: list[Column | str] = [
        "공고제목", F.concat(F.col("회사명"), F.lit(" ("), F.col("회사규모"), F.lit(")")), "지역", "직무카테고리", "tech_all",
        text.cap("주요업무_clean", 500), text.cap("자격요건_clean", 500), text.cap("우대사항_clean", 300),
    ]
    return list(zip(p.DOCUMENT_LABELS, values))


def retrieval_documents(cleaned: DataFrame) -> DataFrame:
    """`id, document, metadata` of every posting with more than 50 characters of duties or requirements."""
    return documents.retrieval_documents(
        documents.with_text(cleaned, ["주요업무_clean", "자격요건_clean"], 50),
        ident="공고ID",
        lines=_document_lines(),
        metadata={
            "title": ("공고제목", 100), "company": ("회사명", 50), "company_size": ("회사규모", None), "region": ("지역", 30),
            "job_category": ("직무카테고리", None), "tech_stack": ("tech_all", 200), "source": ("출처", None),
            "year_month": ("게시년월", None),
        },
    )


def build_collection(cleaned: DataFrame, path: str) -> None:
    """Vectorise the documents and rebuild the collection at `path`."""
    collection.build_text_collection(retrieval_documents(cleaned), path)


def cluster_postings(cleaned: DataFrame, *, ks: tuple[int, ...] = p.K_RANGE, restarts: int = 10) -> DataFrame:
    """Label every posting with enough text: vectors of title and the first 200 characters of duties and
    requirements, the number of clusters of best silhouette, the best of several fits."""
    rows = documents.with_text(cleaned, ["주요업무_clean", "자격요건_clean"], 30)
    capped = text.join_texts("공고제목", text.cap("주요업무_clean", 200), text.cap("자격요건_clean", 200))
    embedded = vectors.text_vectors(rows.withColumn("_input", capped), "_input")
    chosen = vectors.sweep_k(embedded, "vector", ks).where("chosen").first()["k"]
    model = vectors.best_kmeans(embedded, "vector", chosen, restarts=restarts)
    return vectors.label_clusters(embedded, "vector", model).select(
        "공고ID", "공고제목", "회사명", "직무카테고리", "회사규모", "tech_all", "게시년월", "cluster"
    )


def cluster_tables(clustered: DataFrame) -> dict[str, DataFrame]:
    return {
        "cluster_summary": clusters.cluster_profile(clustered, "cluster", "직무카테고리", "회사규모", "tech_all"),
        "cluster_jobs": counts.distribution(clustered, "cluster", "직무카테고리"),
        "cluster_techs": rates.keyword_rates(clustered, ["cluster"], "tech_all", p.CLUSTER_KEYWORDS),
        "company_size": segments.two_segment_token_rates(clustered, "회사규모", "tech_all", p.BIG, p.SMALL),
    }


def _ranked_list(df: DataFrame, by: str, item: Column, rank: str = "rank") -> DataFrame:
    listed = F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), item.alias("x"))))
    return df.groupBy(by).agg(F.transform(listed, lambda e: e["x"]).alias("items"))


def _percents(name: str = "keyword") -> Column:
    return F.concat(F.col(name), F.lit("("), text.one_decimal("rate"), F.lit("%)"))


def roadmap_samples(comparison: Mapping[str, DataFrame], spark: SparkSession) -> DataFrame:
    """Kind A: every job and segment pair with every question; plan text and the segment's top five. `{n}`, the number
    of postings, stays a slot until `sample_set` fills it."""
    top5 = _ranked_list(comparison["top_techs_per_size"].where("rank <= 5"), "회사규모", _percents())
    pairs = spark.createDataFrame(p.SAMPLE_SEGMENTS, "job string, size string, company string")
    plans = {
        job: "\n".join(
            p.ROADMAP_STEP.format(step=i, title=title, techs=", ".join(skills)) for i, (title, skills) in enumerate(steps, 1)
        )
        for job, steps in p.PLAN_TEMPLATES.items()
    }
    rows = samples.each_template(pairs.join(top5, pairs.size == F.col("회사규모"), "left"), p.ROADMAP_QUESTIONS)
    head = text.fill_slots(F.lit(p.ROADMAP_HEAD), job=F.col("job"), company=F.col("company"))
    steps = samples.template_text(plans, F.col("job"))
    listed = F.coalesce(F.array_join("items", ", "), F.lit(p.NO_DATA))
    tail = text.fill_slots(F.lit(p.ROADMAP_TOP5), size=F.col("size"), top5=listed)
    answer = F.concat(F.concat_ws("\n", head, steps, F.lit(p.ROADMAP_TIP)), tail)
    return rows.select(
        F.lit("A").alias("kind"), text.fill_slots(F.col("template"), job=F.col("job"), company=F.col("company")).alias("question"),
        answer.alias("answer"),
    )


def choice_samples(comparison: Mapping[str, DataFrame]) -> DataFrame:
    """Kind B: per segment the three leading languages and frameworks."""
    ratio = comparison["tech_ratio_by_size"]

    def top3(category: str, out: str) -> DataFrame:
        ranked = rates.segment_ranking(ratio.where(F.col("카테고리") == category), "회사규모", 3)
        listed = _ranked_list(ranked, "회사규모", F.struct(F.col("keyword").alias("name"), _percents().alias("line")))
        return listed.withColumnRenamed("items", out)

    rows = top3("언어", "languages").join(top3("프레임워크", "frameworks"), "회사규모")
    size = F.col("회사규모")
    display = samples.template_text(p.SIZE_DISPLAY, size)
    asked = samples.each_template(rows, p.CHOICE_QUESTIONS)
    answer = text.fill_slots(
        F.lit(p.CHOICE_ANSWER), size_key=size, languages=F.array_join("languages.line", ", "),
        frameworks=F.array_join("frameworks.line", ", "), language=F.get("languages.name", F.lit(0)),
        framework=F.get("frameworks.name", F.lit(0)), size=display, focus=samples.template_text(p.CHOICE_FOCUS, size),
    )
    return asked.select(F.lit("B").alias("kind"), text.fill_slots(F.col("template"), size=display).alias("question"), answer.alias("answer"))


def compare_samples(comparison: Mapping[str, DataFrame]) -> DataFrame:
    """Kind C: comparison questions over the distinctive keywords and the full-stack shares."""
    def leads(side: str) -> Column:
        line = F.concat("name", F.lit("(+"), text.one_decimal(F.abs("diff")), F.lit("%p)"))
        entry = F.when(F.col("leader") == side, F.struct((-F.abs("diff")).alias("o"), F.col("name").alias("k"), line.alias("x")))
        listed = F.transform(F.slice(F.array_sort(F.collect_list(entry)), 1, 5), lambda e: e["x"])
        return F.coalesce(F.nullif(F.array_join(listed, ", "), F.lit("")), F.lit(p.COMPARE_NONE))

    def share(size: str) -> Column:
        return F.coalesce(text.one_decimal(F.max(F.when(F.col("회사규모") == size, F.col("share")))), F.lit("0.0"))

    shares = comparison["fullstack_preference"].agg(F.struct(share(p.SMALL).alias("small"), share(p.BIG).alias("big"))).scalar()
    lists = comparison["distinctive_techs"].agg(leads("a").alias("small_list"), leads("b").alias("big_list"))
    job = F.get(F.array(*[F.lit(j) for j in p.COMPARE_JOBS]), F.pmod("template_no", F.lit(len(p.COMPARE_JOBS))).cast("int"))
    answer = text.fill_slots(
        F.lit(p.COMPARE_ANSWER), small_list=F.col("small_list"), big_list=F.col("big_list"), small_share=shares["small"],
        big_share=shares["big"],
    )
    return samples.each_template(lists, p.COMPARE_QUESTIONS).select(
        F.lit("C").alias("kind"), text.fill_slots(F.col("template"), job=job).alias("question"), answer.alias("answer")
    )


def posting_samples(cleaned: DataFrame, *, order: str) -> DataFrame:
    """Kind D: one sample per posting with requirements and tags; templates rotate over the postings with a
    job, size and tags in the order of the numeric column `order`, before the length filter."""
    usable = cleaned.where(
        (F.col("자격요건_clean") != "") & F.col("회사규모").isin(p.SMALL, p.BIG) & F.col("직무카테고리").isNotNull() & (F.col("tech_all") != "")
    )
    rows = samples.rotating_template(usable, p.POSTING_QUESTIONS, order).withColumns({
        "req": F.trim(text.cap("자격요건_clean", 400)), "techs": text.tokens("tech_all", limit=6),
    })
    rows = keep_where(rows, (F.char_length("req") >= 20) & (F.size("techs") > 0))
    slots = {"size": F.col("회사규모"), "job": F.col("직무카테고리")}
    answer = text.fill_slots(
        F.lit(p.POSTING_ANSWER), **slots, techs=F.array_join("techs", ", "),
        lines=samples.numbered(F.slice("techs", 1, 4), p.POSTING_LINE), tip=samples.template_text(p.POSTING_TIP, F.col("회사규모")),
    )
    return rows.select(
        F.lit("D").alias("kind"), text.fill_slots(F.col("template"), **slots, req=F.col("req")).alias("question"), answer.alias("answer")
    )


def record_samples(records: DataFrame, *, order: str) -> DataFrame:
    """Kind E: one sample per raw record that has duties or requirements."""
    d = p.RECORD_DEFAULTS

    def present(name: str, n: int) -> Column:
        return F.trim(text.cap(text.first_present(f"{name}_clean", name), n))

    rows = samples.rotating_template(records, p.RECORD_QUESTIONS, order).withColumns({
        "_title": text.cap(text.first_present("공고제목", default=d["title"]), 60), "_duties": present("주요업무", 300),
        "_req": present("자격요건", 300), "_pref": present("우대사항", 200),
    })
    rows = keep_where(rows, (F.col("_duties") != "") | (F.col("_req") != ""))
    duties, req = text.cap("_duties", 200), text.cap("_req", 200)
    preferred = F.when(F.col("_pref") != "", F.replace(F.lit(p.RECORD_PREFERRED), F.lit("{preferred}"), text.cap("_pref", 150)))
    answer = text.fill_slots(
        F.lit(p.RECORD_ANSWER), title=F.col("_title"), duties=text.first_present(duties, default=d["empty"]),
        req=text.first_present(req, default=d["empty"]), preferred=F.coalesce(preferred, F.lit("")),
        region=text.first_present("지역", default=d["region"]), search=text.first_present("검색어", default=d["search"]),
    )
    question = text.fill_slots(F.col("template"), title=F.col("_title"), duties=duties, req=req)
    return rows.select(F.lit("E").alias("kind"), question.alias("question"), answer.alias("answer"))


def sample_set(parts: list[DataFrame], postings: int) -> DataFrame:
    """All kinds as records, with the flattened and capped training text and the split. `postings` is the number of
    postings that the texts speak of."""
    counted = {"n": F.lit(str(postings))}
    rows = combine.union_sources(parts).withColumn("answer", text.fill_slots(F.col("answer"), **counted))
    record = samples.chat_record(text.fill_slots(F.lit(p.SYSTEM_PROMPT), **counted), F.col("question"), F.col("answer"))
    built = rows.withColumn("conversations", record).withColumn("text", samples.flatten_record(F.col("conversations"), p.CHAT_MARKERS))
    keyed = samples.cap_long(built, "text", p.MAX_WORDS).withColumn("_key", F.concat("question", "answer"))
    return sampling.hash_split(keyed, "_key", seed=p.SPLIT_SEED, eval_share=p.EVAL_SHARE).drop("_key")


def profile_prompts(profiles: DataFrame) -> DataFrame:
    prompt = roadmap.profile_prompt(p.PROFILE_PROMPT, p.PROFILE_DEFAULTS, F.col("current_stack"), p.NO_STACK)
    return profiles.withColumn("prompt", prompt)


def profile_plans(profiles: DataFrame) -> DataFrame:
    """Rule-based plans of profiles (`job, company, experience, current_stack, goal_period`)."""
    filled = profiles.withColumns({c: text.first_present(c, default=value) for c, value in p.PROFILE_DEFAULTS.values()})
    planned = roadmap.rule_plan(
        filled, job="job", company="company", period="goal_period", plans=p.PLAN_TEMPLATES, default_plan=p.DEFAULT_PLAN,
        weeks=p.PLAN_WEEKS, default_weeks=p.DEFAULT_WEEKS, resources=p.PLAN_RESOURCES, default_resource=p.DEFAULT_RESOURCE,
        texts=p.PLAN_TEXTS, insights=p.PLAN_INSIGHTS, default_insight=p.PLAN_DEFAULT_INSIGHT,
    )
    return planned.withColumn("step_summaries", roadmap.step_summaries("steps", p.STEP_PATTERN))


def parsed_plans(replies: DataFrame, reply: str, plans: DataFrame, key: str) -> DataFrame:
    """Plans found as JSON in reply texts; where there is none or it is broken, the rule-based plan."""
    fields = ["title", "summary", "total_weeks", "steps", "portfolio_tip", "market_insight"]
    parsed = replies.select(key, text.json_in_text(reply, p.PLAN_SCHEMA).alias("_parsed"))
    use = F.col("_parsed.steps").isNotNull()
    return parsed.join(plans, key).select(
        key, *[F.when(use, F.col(f"_parsed.{c}")).otherwise(F.col(c)).alias(c) for c in fields], use.alias("from_reply")
    )


def answer_questions(
    questions: DataFrame, cleaned: DataFrame, clustered: DataFrame, *, ident: str, question: str = "message"
) -> DataFrame:
    """An answer for every question. `ident` is a unique long number of a posting."""
    f = p.ANSWER_FORMATS
    detected = answers.detect(questions, question, p.TOPIC_RULES, p.INTENT_RULES)
    listed = documents.with_text(cleaned, ["주요업무_clean", "자격요건_clean"], 50)
    rendered = listed.withColumn("_document", documents.labelled_lines(_document_lines()))
    near = answers.retrieve_samples(
        detected, rendered, topic="topic", question=question, doc_id=ident, doc_category="직무카테고리", doc_text="_document"
    )
    found = answers.sample_sections(
        near, listed, doc_id=ident, title=text.cap("공고제목", 100), company=text.cap("회사명", 50), tags=F.col("tech_all"), formats=f
    )
    trend, comparison = trend_tables(cleaned), comparison_tables(cleaned)
    by_job = rates.keyword_rates(cleaned.where(F.col("직무카테고리").isin(*p.TREND_JOBS)), ["직무카테고리"], "tech_all", p.TREND_KEYWORDS)
    timing, timing_all = answers.timing_sections(trend["job_peak"], f)
    profiles = cluster_tables(clustered)["cluster_summary"]
    return answers.answer_report(
        detected,
        question=question,
        topics=list(p.TOPIC_RULES),
        by_topic=[
            answers.study_sections(by_job, "직무카테고리", f),
            answers.cluster_sections(profiles, p.TOPIC_CLUSTERS, "cluster", f),
            timing,
        ],
        overall=[
            answers.trend_sections(trend["tech_growth"], f),
            timing_all,
            answers.size_section(comparison["tech_ratio_by_size"], "회사규모", p.BIG, p.SMALL, f),
            answers.overview_section(tagging.token_frequency(cleaned, "tech_all", 5), f),
        ],
        samples=found,
        footer=p.ANSWER_FOOTER,
    ).select(*questions.columns, "answer")


def run(
    spark: SparkSession, *, site_a: list[str], site_b: str, site_c: str, out: str
) -> dict[str, DataFrame]:
    """From raw CSV exports to stage tables and result tables under `out`; `exports` holds the tables that others read."""
    def raw(path: str, columns: list[str]) -> DataFrame:
        return tables.with_columns(tables.with_row_order(tables.read_csv(spark, path)), [*columns, "_row"])

    integrated = integrate([raw(path, RAW_A) for path in site_a], raw(site_b, RAW_B), raw(site_c, RAW_C))
    tables.write_stage(integrated, f"{out}/integrated")
    tables.write_stage(date_postings(tables.read_stage(spark, f"{out}/integrated")), f"{out}/dated")
    tables.write_stage(clean_postings(tables.read_stage(spark, f"{out}/dated")), f"{out}/cleaned")
    cleaned = tables.read_stage(spark, f"{out}/cleaned")
    results = {**explore_tables(cleaned), **trend_tables(cleaned), **comparison_tables(cleaned), "stage_report": stage_report(cleaned)}
    for name, frame in results.items():
        tables.write_stage(frame, f"{out}/{name}")
        results[name] = tables.read_stage(spark, f"{out}/{name}")
        tables.publish(results[name], name)
    export(cleaned, results, f"{out}/exports")
    return {"cleaned": cleaned, **results}


def export(cleaned: DataFrame, results: Mapping[str, DataFrame], path: str) -> None:
    """The hand-over files: the flat tables as CSV, the summaries as one JSON text per row."""
    flat = ["tech_monthly", "tech_growth", "job_monthly_wide", "tech_frequency", "tech_ratio_by_size", "job_category_by_size"]
    tables.write_csv(cleaned.select(*[c for c, kind in cleaned.dtypes if not kind.startswith("array")]), f"{path}/cleaned")
    for name in flat:
        tables.write_csv(results[name], f"{path}/{name}")
    for name in ("metrics", "trend_summary", "size_keywords"):
        tables.write_json_lines(results[name], f"{path}/{name}")


def run_clusters(
    spark: SparkSession, *, out: str, ks: tuple[int, ...] = p.K_RANGE, restarts: int = 10
) -> dict[str, DataFrame]:
    """From the cleaned stage under `out` to the vector collection, the labels and the cluster tables."""
    cleaned = tables.read_stage(spark, f"{out}/cleaned")
    build_collection(cleaned, f"{out}/collection")
    tables.write_stage(cluster_postings(cleaned, ks=ks, restarts=restarts), f"{out}/clusters")
    clustered = tables.read_stage(spark, f"{out}/clusters")
    results = cluster_tables(clustered)
    for name, frame in results.items():
        tables.write_stage(frame, f"{out}/{name}")
        results[name] = tables.read_stage(spark, f"{out}/{name}")
        tables.publish(results[name], name)
    return {"clusters": clustered, **results}


def run_samples(spark: SparkSession, *, out: str, records: DataFrame | None = None, order: str = "n") -> DataFrame:
    """From the cleaned stage under `out`, and raw records if given, to the sample set as JSON lines.

    Postings rotate over the templates in the order of a hash of their id, which any partitioning keeps.
    """
    cleaned = tables.read_stage(spark, f"{out}/cleaned").withColumn("_order", F.xxhash64("공고ID"))
    comparison = comparison_tables(cleaned)
    parts = [
        roadmap_samples(comparison, spark), choice_samples(comparison), compare_samples(comparison),
        posting_samples(cleaned, order="_order"),
    ]
    if records is not None:
        parts.append(record_samples(records, order=order))
    tables.write_json_lines(sample_set(parts, cleaned.count()), f"{out}/samples")
    schema = (
        "kind string, question string, answer string, conversations array<struct<role: string, content: string>>, text string, "
        "n_words int, truncated boolean, split string"
    )
    return tables.read_json_lines(spark, f"{out}/samples", schema)
