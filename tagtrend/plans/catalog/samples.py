"""Documents, chat samples, splits, prompts and plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtrend.functions import text
from tagtrend.operators import combine, documents, rates, roadmap, samples, sampling, tagging
from tagtrend.operators.rows import keep_where
from tagtrend.plans import views
from tagtrend.plans import vocabulary as v
from tagtrend.plans.catalog import trends
from tagtrend.session import cut_lineage
from tagtrend.plans.catalog.registry import (
    CLEAN, DOCUMENTS, POSTINGS, SEGMENT_RATES, query, quoted, sql_1d, sql_fill, sql_first, sql_list, sql_pick,
)

_M = v.CHAT_MARKERS

_RENDERED = f"""SELECT doc_id, source, lang, quality, tags_all, {CLEAN.format('text')} AS body, {sql_first('lower(text)', v.TOPIC_RULES, "'other'")} AS topic
FROM ({DOCUMENTS}) LEFT JOIN labels USING (doc_id)"""


@query(f"""SELECT 'job_' || doc_id AS id,
'[source] ' || source || chr(10) || '[language] ' || lang || chr(10) || '[topic] ' || topic || chr(10) || '[keywords] ' || tags_all || chr(10)
|| '[quality] ' || coalesce(CAST(quality AS VARCHAR), '') || chr(10) || '[text] ' || substr(body, 1, 500) AS document,
substr(body, 1, 100) AS title, substr(source, 1, 50) AS company, lang AS region, topic AS job_category, substr(tags_all, 1, 200) AS tech_stack
FROM ({_RENDERED}) WHERE length(body) > 50 OR length(tags_all) > 50""")
def render_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = views.table(spark, sf_dir, "labels").select("doc_id", "quality")
    tagged = views.tagged_documents(spark, sf_dir, "lang", "source")
    rows = tagging.classify(tagged, "text", v.TOPIC_RULES, "other", "topic").withColumn("body", text.clean_text("text"))
    rows = documents.with_text(rows, ["body", "tags_all"], 50).withColumn("body", text.cap("body", 500))
    rendered = documents.retrieval_documents(
        rows.join(labels, "doc_id", "left"),
        ident="doc_id",
        lines=[
            ("source", "source"), ("language", "lang"), ("topic", "topic"), ("keywords", "tags_all"),
            ("quality", F.col("quality").cast("string")), ("text", "body"),
        ],
        metadata={
            "title": ("body", 100), "company": ("source", 50), "region": ("lang", 30), "job_category": ("topic", None),
            "tech_stack": ("tags_all", 200),
        },
    )
    return rendered.select("id", "document", "metadata.*")


_TURN = f"{quoted(_M['header_start'])} || role || {quoted(_M['header_end'])} || text || {quoted(_M['turn_end'])}"


@query(f"""SELECT conv_id, {quoted(_M['begin'])} || string_agg({_TURN}, '' ORDER BY turn) || {quoted(_M['end'])} AS text
FROM conversations GROUP BY conv_id""")
def chat_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = views.table(spark, sf_dir, "conversations")
    return samples.flatten_turns(turns, "conv_id", "turn", "role", "text", _M)


@query("SELECT conv_id, turn, CASE WHEN substr(md5(conv_id || '42'), 1, 4) < '199a' THEN 'eval' ELSE 'train' END AS split FROM conversations")
def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations go to one side: the split is keyed by conversation."""
    return sampling.hash_split(views.table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id")


@query("SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || '42'), doc_id LIMIT 200")
def hash_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.hash_sample(views.table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", 200)


@query("""SELECT doc_id, row_number() OVER (ORDER BY CAST('0x' || substr(md5(doc_id || '42'), 1, 15) AS BIGINT), doc_id) - 1 AS position FROM documents""")
def hash_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.shuffle_positions(views.table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


_WORDS = r"[w for w in regexp_split_to_array(text, '[ \t\r\n]+') if w <> '']"


@query(f"""SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, len(words) > 1024 AS truncated, array_to_string(words[1:1024], ' ') AS text
FROM (SELECT doc_id, {_WORDS} AS words FROM documents)""")
def length_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.cap_words(views.documents(spark, sf_dir, "text"), "text", 1024)


# Samples of the first kind: every (segment, category) pair of the postings with every question.

_TOP5 = f"""SELECT segment, string_agg(keyword || '(' || {sql_1d('rate')} || '%)', ', ' ORDER BY rank) AS top5 FROM (
SELECT *, row_number() OVER (PARTITION BY segment ORDER BY rate DESC, keyword) AS rank FROM ({SEGMENT_RATES}) QUALIFY rank <= 5) GROUP BY 1"""
_QUESTIONS = ", ".join(f"({i}, {quoted(t)})" for i, t in enumerate(v.CROSS_TEMPLATES))
_CROSS = f"""SELECT segment, category, template_no, replace(replace(template, '{{segment}}', segment), '{{category}}', category) AS question,
category || ' plan for ' || segment || chr(10) || 'TOP5: ' || top5 AS answer
FROM (SELECT DISTINCT segment, category FROM ({POSTINGS})) JOIN ({_TOP5}) USING (segment), (VALUES {_QUESTIONS}) t(template_no, template)"""


def _counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_lineage(views.counted_postings(spark, sf_dir, "segment", "category", "tags_all"))


def _segment_rates(counted: DataFrame) -> DataFrame:
    return rates.keyword_rates(counted, ["segment"], "tags_all", v.PART_LIST, weight="n")


def segment_top5(counted: DataFrame) -> DataFrame:
    ranked = rates.segment_ranking(_segment_rates(counted), "segment", 5)
    item = F.concat("keyword", F.lit("("), text.one_decimal("rate"), F.lit("%)"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("r"), item.alias("x"))))
    return ranked.groupBy("segment").agg(listed.alias("_l")).select(
        "segment", F.array_join(F.transform("_l", lambda e: e["x"]), ", ").alias("top5")
    )


def _cross(counted: DataFrame) -> DataFrame:
    cells = counted.select("segment", "category").distinct()
    rows = samples.each_template(cells.join(segment_top5(counted), "segment"), v.CROSS_TEMPLATES)
    question = text.fill_slots(F.col("template"), segment=F.col("segment"), category=F.col("category"))
    answer = F.concat(F.col("category"), F.lit(" plan for "), F.col("segment"), F.lit("\nTOP5: "), F.col("top5"))
    return rows.select("segment", "category", "template_no", question.alias("question"), answer.alias("answer"))


@query(f"SELECT segment, category, CAST(template_no AS INTEGER) AS template_no, question, answer FROM ({_CROSS})")
def template_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cross(_counted(spark, sf_dir))


# Samples by segment: the leading keywords of two dictionary categories.

_CHOICES = " UNION ALL ".join(f"SELECT {i} AS template_no, {quoted(t)} AS template" for i, t in enumerate(v.CHOICE_TEMPLATES))
_GROUPED = f"""SELECT segment, keyword, rate, CASE WHEN list_contains({sql_list(v.PART_KEYWORDS['item'])}, keyword) THEN 'item' ELSE 'colour' END AS dictionary
FROM ({SEGMENT_RATES}) WHERE list_contains({sql_list(v.PART_KEYWORDS['item'] + v.PART_KEYWORDS['colour'])}, keyword)"""
_LEADING = f"""SELECT segment, dictionary, string_agg(keyword || '(' || {sql_1d('rate')} || '%)', ', ' ORDER BY rk) AS listed, min(keyword) FILTER (WHERE rk = 1) AS leader
FROM (SELECT *, row_number() OVER (PARTITION BY segment, dictionary ORDER BY rate DESC, keyword) AS rk FROM ({_GROUPED}) QUALIFY rk <= 3) GROUP BY ALL"""


_CHOICE = f"""SELECT segment, CAST(template_no AS INTEGER) AS template_no, replace(template, '{{segment}}', segment) AS question,
'Items: ' || i.listed || chr(10) || 'Colours: ' || c.listed || chr(10) || 'Start with ' || i.leader AS answer
FROM (SELECT * FROM ({_LEADING}) WHERE dictionary = 'item') i JOIN (SELECT * FROM ({_LEADING}) WHERE dictionary = 'colour') c USING (segment), ({_CHOICES})"""


@query(_CHOICE)
def template_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment the three leading items and colours, with every question."""
    return _choice(trends.segment_rates(spark, sf_dir))


def _choice(segment_rates: DataFrame) -> DataFrame:
    grouped = segment_rates.join(trends.dictionary_of(segment_rates), "keyword").where(F.col("dictionary").isin("item", "colour"))
    window = Window.partitionBy("segment", "dictionary").orderBy(F.desc("rate"), "keyword")
    ranked = grouped.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= 3)
    item = F.concat("keyword", F.lit("("), text.one_decimal("rate"), F.lit("%)"))

    def listed(dictionary: str) -> Column:
        entry = F.when(F.col("dictionary") == dictionary, F.struct("rank", item.alias("x"), "keyword"))
        return F.array_sort(F.collect_list(entry))

    lists = ranked.groupBy("segment").agg(listed("item").alias("items"), listed("colour").alias("colours"))
    answer = F.concat(
        F.lit("Items: "), F.array_join("items.x", ", "), F.lit("\nColours: "), F.array_join("colours.x", ", "),
        F.lit("\nStart with "), F.get("items.keyword", F.lit(0)),
    )
    rows = samples.each_template(lists, v.CHOICE_TEMPLATES)
    return rows.select(
        "segment", "template_no", text.fill_slots(F.col("template"), segment=F.col("segment")).alias("question"), answer.alias("answer")
    )


# Samples of the second kind: one per valid document, templates rotating over all documents in id order.

_REQ = f"substr({CLEAN.format('text')}, 1, 400)"
_ROTATING = sql_pick("template_no", {str(i): quoted(t) for i, t in enumerate(v.ROTATING_TEMPLATES)}, "NULL").replace("= '", "= ").replace("' THEN", " THEN")
_ROTATE = f"""SELECT doc_id, template_no, replace(replace(replace({_ROTATING}, '{{source}}', source), '{{lang}}', lang), '{{req}}', req) AS question,
'Analysis of ' || lang || ' ' || source || chr(10) || 'Keywords: ' || array_to_string(kws, ', ') || chr(10)
|| array_to_string([i || '. **' || kws[i] || '** - one practice project' for i in range(1, least(len(kws), 4) + 1)], chr(10)) AS answer
FROM (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) % {len(v.ROTATING_TEMPLATES)} AS template_no, source, lang, quality,
trim({_REQ}) AS req, string_split(tags_all, ', ')[1:6] AS kws, tags_all FROM ({DOCUMENTS}) LEFT JOIN labels USING (doc_id))
WHERE quality IS NOT NULL AND lang IN ('en', 'de') AND length(req) >= 20 AND tags_all <> ''"""


def _rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = samples.rotating_template(views.table(spark, sf_dir, "documents").select("doc_id"), v.ROTATING_TEMPLATES, "doc_id")
    chosen = views.documents(spark, sf_dir, "text", "lang", "source").where(F.col("lang").isin("en", "de"))
    rows = tagging.tag_records(chosen, "text", v.DOCUMENT_KEYWORDS, per_category=False).select(
        "doc_id", "lang", "source", text.tokens("tags_all", limit=6).alias("kws"),
        F.trim(text.cap(text.clean_text("text"), 400)).alias("req"),
    )
    labels = views.table(spark, sf_dir, "labels").select("doc_id", "quality")
    listed = labels.where(F.col("quality").isNotNull())
    valid = keep_where(rows, (F.char_length("req") >= 20) & (F.size("kws") > 0)).join(listed, "doc_id").join(numbers, "doc_id")
    question = text.fill_slots(F.col("template"), source=F.col("source"), lang=F.col("lang"), req=F.col("req"))
    answer = F.concat_ws(
        "\n",
        F.concat(F.lit("Analysis of "), F.col("lang"), F.lit(" "), F.col("source")),
        F.concat(F.lit("Keywords: "), F.array_join("kws", ", ")),
        samples.numbered(F.slice("kws", 1, 4), "{i}. **{item}** - one practice project"),
    )
    return valid.select("doc_id", "template_no", question.alias("question"), answer.alias("answer"))


@query(f"SELECT doc_id, CAST(template_no AS INTEGER) AS template_no, question, answer FROM ({_ROTATE})")
def template_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rotate(spark, sf_dir)


# Samples of the third kind: comparison questions over the two segments' distinctive keywords.

_LEADS = {
    side: f"""coalesce((SELECT string_agg(name || '(+' || {sql_1d('abs(diff)')} || '%p)', ', ' ORDER BY abs(diff) DESC, name) FROM (
SELECT name, diff FROM ({trends._DISTINCTIVE}) WHERE leader = '{side}' ORDER BY abs(diff) DESC, name LIMIT 5)), 'no data')"""
    for side in ("a", "b")
}
_COMPARE = " UNION ALL ".join(
    f"SELECT {i} AS template_no, {sql_fill(t, job=quoted(v.COMPARE_JOBS[i % len(v.COMPARE_JOBS)]))} AS question" for i, t in enumerate(v.COMPARE_TEMPLATES)
)
_SLOTS = f"""SELECT template_no, question, '{v.SEGMENTS[0]}: ' || {_LEADS['a']} || chr(10) || '{v.SEGMENTS[1]}: ' || {_LEADS['b']} AS answer FROM ({_COMPARE})"""


def _slots(segment_rates: DataFrame) -> DataFrame:
    gaps = rates.distinctive(rates.two_segments(segment_rates, "segment", "keyword", "rate", *v.SEGMENTS), trends._THRESHOLD)

    def leads(side: str) -> Column:
        item = F.concat("name", F.lit("(+"), text.one_decimal(F.abs("diff")), F.lit("%p)"))
        entry = F.when(F.col("leader") == side, F.struct((-F.abs("diff")).alias("o"), F.col("name").alias("n"), item.alias("x")))
        listed = F.slice(F.array_sort(F.collect_list(entry)), 1, 5)
        return F.coalesce(F.nullif(F.array_join(F.transform(listed, lambda e: e["x"]), ", "), F.lit("")), F.lit("no data"))

    lists = gaps.agg(leads("a").alias("a"), leads("b").alias("b"))
    job = F.get(F.array(*[F.lit(j) for j in v.COMPARE_JOBS]), F.pmod("template_no", F.lit(len(v.COMPARE_JOBS))).cast("int"))
    rows = samples.each_template(lists, v.COMPARE_TEMPLATES)
    answer = F.concat(F.lit(f"{v.SEGMENTS[0]}: "), F.col("a"), F.lit(f"\n{v.SEGMENTS[1]}: "), F.col("b"))
    return rows.select("template_no", text.fill_slots(F.col("template"), job=job).alias("question"), answer.alias("answer"))


@query(_SLOTS)
def slot_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _slots(trends.segment_rates(spark, sf_dir))


# Samples of the fourth kind: one per document, with a section that only labelled documents have.

_RECORD_QUESTION = sql_pick("template_no", {str(i): quoted(t) for i, t in enumerate(v.RECORD_TEMPLATES)}, "NULL").replace("= '", "= ").replace("' THEN", " THEN")
_OPTIONAL = f"""SELECT doc_id, replace(replace(replace({_RECORD_QUESTION}, '{{source}}', source), '{{lang}}', lang), '{{duties}}', substr(duties, 1, 200)) AS question, '**' || substr(source, 1, 60) || '**' || chr(10) || 'Duties: ' || coalesce(nullif(substr(duties, 1, 200), ''), 'none')
|| chr(10) || CASE WHEN quality IS NOT NULL THEN 'Extra: quality ' || quality || chr(10) ELSE '' END || 'Field: ' || lang AS answer
FROM (SELECT doc_id, source, lang, quality, (row_number() OVER (ORDER BY doc_id) - 1) % {len(v.RECORD_TEMPLATES)} AS template_no,
trim(substr({CLEAN.format('text')}, 1, 300)) AS duties FROM documents LEFT JOIN labels USING (doc_id)) WHERE duties <> ''"""


def _optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = samples.rotating_template(views.table(spark, sf_dir, "documents").select("doc_id"), v.RECORD_TEMPLATES, "doc_id")
    labels = views.table(spark, sf_dir, "labels").select("doc_id", "quality")
    rows = views.documents(spark, sf_dir, "source", "lang", "text").select(
        "doc_id", "source", "lang", F.trim(text.cap(text.clean_text("text"), 300)).alias("duties")
    )
    rows = keep_where(rows, F.col("duties") != "").join(labels, "doc_id", "left").join(numbers, "doc_id")
    question = text.fill_slots(F.col("template"), source=F.col("source"), lang=F.col("lang"), duties=text.cap("duties", 200))
    extra = F.when(F.col("quality").isNotNull(), F.concat(F.lit("Extra: quality "), F.col("quality"), F.lit("\n")))
    answer = F.concat(
        F.lit("**"), text.cap("source", 60), F.lit("**\nDuties: "), text.first_present(text.cap("duties", 200), default="none"),
        F.lit("\n"), F.coalesce(extra, F.lit("")), F.lit("Field: "), F.col("lang"),
    )
    return rows.select("doc_id", question.alias("question"), answer.alias("answer"))


@query(_OPTIONAL)
def optional_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample per document with a text, its questions rotating over all documents in id order."""
    return _optional(spark, sf_dir)


def _flat_sql(question: str, answer: str) -> str:
    def turn(role: str, content: str) -> str:
        return f"{quoted(_M['header_start'])} || '{role}' || {quoted(_M['header_end'])} || {content} || {quoted(_M['turn_end'])}"

    turns = " || ".join([turn("system", quoted(v.SYSTEM_TEXT)), turn("user", question), turn("assistant", answer)])
    return f"{quoted(_M['begin'])} || {turns} || {quoted(_M['end'])}"


_KINDS = " UNION ALL ".join(
    f"SELECT '{kind}' AS kind, question, answer FROM ({part})"
    for kind, part in (("cross", _CROSS), ("choice", _CHOICE), ("slots", _SLOTS), ("rotate", _ROTATE), ("record", _OPTIONAL))
)


@query(f"""SELECT kind, CASE WHEN len(words) > {v.MAX_WORDS} THEN array_to_string(words[1:{v.MAX_WORDS}], ' ') ELSE text END AS text, len(words) > {v.MAX_WORDS} AS truncated, split
FROM (SELECT *, {_WORDS} AS words FROM (SELECT kind, {_flat_sql('question', 'answer')} AS text,
CASE WHEN substr(md5(question || answer || '42'), 1, 4) < '199a' THEN 'eval' ELSE 'train' END AS split FROM ({_KINDS})))""")
def sample_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five sample kinds as records, flattened, capped and split."""
    counted = _counted(spark, sf_dir)
    segment_rates = _segment_rates(counted)
    kinds = {
        "cross": _cross(counted), "choice": _choice(segment_rates), "slots": _slots(segment_rates), "rotate": _rotate(spark, sf_dir),
        "record": _optional(spark, sf_dir),
    }
    parts = [frame.select(F.lit(kind).alias("kind"), "question", "answer") for kind, frame in kinds.items()]
    record = samples.chat_record(v.SYSTEM_TEXT, F.col("question"), F.col("answer"))
    keyed = combine.union_sources(parts).withColumn("_key", F.concat("question", "answer")).withColumn("text", samples.flatten_record(record, _M))
    return samples.cap_long(sampling.hash_split(keyed, "_key"), "text", v.MAX_WORDS).select("kind", "text", "truncated", "split")


_PROFILES = """SELECT c_custkey, c_mktsegment AS job, 'firm ' || c_nationkey AS company,
CASE WHEN c_acctbal >= 5000 THEN 'experienced' WHEN c_acctbal >= 0 THEN 'junior' END AS experience,
CASE WHEN c_acctbal >= 7500 THEN 'long' WHEN c_acctbal >= 2500 THEN 'medium' WHEN c_acctbal >= 1000 THEN 'short' ELSE 'open' END AS period,
CASE WHEN c_acctbal >= 2500 THEN 'Gear, Oil' WHEN c_acctbal >= 0 THEN 'Oil' ELSE 'none' END AS stack FROM customer"""


@query(f"""SELECT c_custkey, {sql_fill(v.PROMPT, stack='stack', experience="coalesce(experience, 'career changer')", company='company', job='job', period='period')} AS prompt FROM ({_PROFILES})""")
def profile_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "experience": ("experience", "career changer"), "company": ("company", "firm 0"), "job": ("job", "BUILDING"), "period": ("period", "medium"),
    }
    prompt = roadmap.profile_prompt(v.PROMPT, fields, F.col("stack"), "none")
    return views.profiles(spark, sf_dir).select("c_custkey", prompt.alias("prompt"))


def plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roadmap.rule_plan(
        views.profiles(spark, sf_dir), job="job", company="company", period="period", plans=v.PLAN_TEMPLATES,
        default_plan="BUILDING", weeks=v.PLAN_WEEKS, default_weeks=24, resources=v.PLAN_RESOURCES,
        default_resource="Manual", texts=v.PLAN_TEXTS, insights=v.PLAN_INSIGHTS, default_insight=v.PLAN_DEFAULT_INSIGHT,
    )


_STEP_ROWS = ", ".join(
    f"({quoted(job)}, {i}, {len(steps)}, {quoted(title)}, {sql_list(skills)})" for job, steps in v.PLAN_TEMPLATES.items() for i, (title, skills) in enumerate(steps, 1)
)
_RESOURCE_ROWS = ", ".join(f"({quoted(k)}, {sql_list(r)})" for k, r in v.PLAN_RESOURCES.items())
_TOTAL = sql_pick("period", {k: str(w) for k, w in v.PLAN_WEEKS.items()}, "24")
_STEPS = f"""SELECT c_custkey, job, company, period, total_weeks, step, s.title, greatest(1, total_weeks // steps) || ' weeks' AS duration, techs, resources
FROM (SELECT *, {_TOTAL} AS total_weeks, {sql_pick('job', {k: quoted(k) for k in v.PLAN_TEMPLATES}, "'BUILDING'")} AS plan FROM ({_PROFILES}))
JOIN (SELECT plan, step, steps, title, [trim(string_split(x, '(')[1]) for x in skills] AS techs FROM (VALUES {_STEP_ROWS}) t(plan, step, steps, title, skills)) s USING (plan)
JOIN (SELECT plan, step, list_distinct_ordered AS resources FROM (
  SELECT plan, step, list(r ORDER BY first_at) AS list_distinct_ordered FROM (
    SELECT plan, step, r, min(place) AS first_at FROM (
      SELECT plan, step, unnest(coalesce(rs, ['Manual'])) AS r, k * 10 + generate_subscripts(coalesce(rs, ['Manual']), 1) AS place FROM (
        SELECT plan, step, unnest([1, 2]) AS k, trim(string_split(skills[unnest([1, 2])], '(')[1]) AS skill FROM (VALUES {_STEP_ROWS}) t(plan, step, steps, title, skills))
      LEFT JOIN (VALUES {_RESOURCE_ROWS}) q(skill, rs) USING (skill) WHERE skill IS NOT NULL)
    GROUP BY ALL) GROUP BY ALL)) USING (plan, step)"""


@query(f"""SELECT c_custkey, job || ' plan over a ' || period || ' term (' || company || ')' AS plan_title, company || ': ' || job || ' in a ' || period || ' term' AS summary,
total_weeks, CAST(step AS INTEGER) AS step, title, duration, array_to_string(techs, '; ') AS techs, 'Stage ' || title || ' trains ' || array_to_string(techs[1:3], ', ') || '.' AS description,
array_to_string(resources[1:3], '; ') AS resources, 'One small ' || techs[1] || ' project' AS milestone,
CASE WHEN contains(company, '1') THEN {quoted(v.PLAN_INSIGHTS['1'])} WHEN contains(company, '2') THEN {quoted(v.PLAN_INSIGHTS['2'])} ELSE {quoted(v.PLAN_DEFAULT_INSIGHT)} END AS market_insight
FROM ({_STEPS})""")
def rule_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plans(spark, sf_dir).select("c_custkey", F.col("title").alias("plan_title"), "summary", "total_weeks", "market_insight", F.inline("steps"))
    return rows.select(
        "c_custkey", "plan_title", "summary", "total_weeks", "step", "title", "duration", F.array_join("techs", "; ").alias("techs"),
        "description", F.array_join("resources", "; ").alias("resources"), "milestone", "market_insight",
    )


@query(f"""SELECT c_custkey, string_agg('step ' || step || ' [' || title || '] - ' || array_to_string(techs[1:3], ', ') || ' (' || duration || ')', chr(10) ORDER BY step) AS summaries
FROM ({_STEPS}) GROUP BY c_custkey""")
def step_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = roadmap.step_summaries("steps", v.STEP_PATTERN)
    return plans(spark, sf_dir).select("c_custkey", F.array_join(lines, "\n").alias("summaries"))
