"""Unification, de-duplication, dates, cleaning, tagging and plain counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions import dates, text
from tagtrend.operators import combine, counts, dedup, tagging, timeline
from tagtrend.operators.rows import keep_where
from tagtrend.plans import views
from tagtrend.plans import vocabulary as v
from tagtrend.plans.catalog.registry import CLEAN, DOCUMENTS, PARTS, query, rounded, sql_first, sql_list, sql_tags

_UNION = """SELECT 'C_' || (row_number() OVER (ORDER BY c_custkey) - 1) AS id, 'customer' AS source, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance, 0 AS place, c_custkey AS row_no FROM customer
UNION ALL SELECT 'S_' || (row_number() OVER (ORDER BY s_suppkey) - 1), 'supplier', s_name, s_nationkey, '', s_acctbal, 1, s_suppkey FROM supplier"""


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = combine.surrogate_ids(views.table(spark, sf_dir, "customer"), "c_custkey", "C_", "id")
    suppliers = combine.surrogate_ids(views.table(spark, sf_dir, "supplier"), "s_suppkey", "S_", "id")
    first = combine.standardise(customers, {
        "id": F.col("id"), "source": "customer", "name": F.col("c_name"), "nation": F.col("c_nationkey"),
        "segment": F.col("c_mktsegment"), "balance": F.col("c_acctbal"), "row_no": F.col("c_custkey"),
    })
    second = combine.standardise(suppliers, {
        "id": F.col("id"), "source": "supplier", "name": F.col("s_name"), "nation": F.col("s_nationkey"),
        "balance": F.col("s_acctbal"), "row_no": F.col("s_suppkey"),
    })
    return combine.union_sources([first, second], "place").na.fill("", subset=["segment"])


@query(f"SELECT id, source, name, nation, segment, balance FROM ({_UNION})")
def union_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(spark, sf_dir).drop("place", "row_no")


@query(f"""SELECT nation, id, source, name FROM ({_UNION})
QUALIFY row_number() OVER (PARTITION BY nation ORDER BY place, row_no) = 1""")
def dedup_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _union(spark, sf_dir).select("nation", "id", "source", "name", "place", "row_no")
    return dedup.keep_first(rows, ["nation"], ["place", "row_no"]).drop("place", "row_no")


@query("""SELECT doc_id, lang, source, n_chars, text FROM documents
QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1""")
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = dedup.with_digest(views.table(spark, sf_dir, "documents"), "text")
    return dedup.keep_smallest(documents, ["text_key"], "doc_id").select("doc_id", "lang", "source", "n_chars", "text")


@query("""SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
QUALIFY row_number() OVER (PARTITION BY trim(p_brand) || '|' || trim(p_name) ORDER BY p_partkey) = 1""")
def dedup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = views.table(spark, sf_dir, "part").withColumn("key", text.composite_key("p_brand", "p_name"))
    return dedup.keep_first(keyed, ["key"], ["p_partkey"]).drop("key")


@query("""SELECT count(*) AS before_rows, count(*) - count(DISTINCT text) AS removed_rows, count(DISTINCT text) AS after_rows FROM documents""")
def dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_report(dedup.with_digest(views.table(spark, sf_dir, "documents"), "text"), ["text_key"])


@query("""SELECT p_partkey, trim(string_split(p_name, ' ')[1]) AS first_field, trim(string_split(p_name, ' ')[3]) AS third_field FROM part""")
def split_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "part").select(
        "p_partkey", text.split_field("p_name", 0, " ").alias("first_field"), text.split_field("p_name", 2, " ").alias("third_field")
    )


@query(f"SELECT doc_id, {CLEAN.format('text')} AS cleaned FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.documents(spark, sf_dir, "text").select("doc_id", text.clean_text("text").alias("cleaned"))


@query(f"""SELECT doc_id, source || ' ' || {CLEAN.format('text')} || ' ' || coalesce(CAST(quality AS VARCHAR), '') AS joined_text
FROM documents LEFT JOIN labels USING (doc_id)
WHERE length({CLEAN.format('text')}) > 50 OR length(source) > 4""")
def analysis_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = views.documents(spark, sf_dir, "source", "text"), views.table(spark, sf_dir, "labels")
    cleaned = documents.select("doc_id", "source", text.clean_text("text").alias("cleaned"))
    present = keep_where(cleaned, text.longer_than("cleaned", 50) | text.longer_than("source", 4))
    return present.join(labels, "doc_id", "left").select(
        "doc_id", text.join_texts("source", "cleaned", F.col("quality").cast("string")).alias("joined_text")
    )


@query(f"SELECT doc_id, tags_all FROM ({DOCUMENTS})")
def keyword_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.tagged_documents(spark, sf_dir).select("doc_id", "tags_all")


_PART_COLUMNS = ", ".join(f"{sql_tags('p_name', words)} AS tags_{c}" for c, words in v.PART_KEYWORDS.items())


@query(f"SELECT p_partkey, tags_all, {_PART_COLUMNS} FROM ({PARTS})")
def tag_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = views.tagged_parts(spark, sf_dir, per_category=True)
    return tagged.select("p_partkey", "tags_all", *[f"tags_{c}" for c in v.PART_KEYWORDS])


@query(f"""SELECT p_partkey, array_to_string([k for k in {sql_list(sorted(v.PART_LIST))} if list_contains(string_split(lower(p_name), ' '), k)], ', ') AS tags_all FROM part""")
def word_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = views.table(spark, sf_dir, "part")
    tagged = tagging.tag_records(parts, "p_name", v.PART_KEYWORDS, match="word", per_category=False)
    return tagged.select("p_partkey", "tags_all")


@query(f"""SELECT doc_id, {sql_first('lower(text)', v.TOPIC_RULES, "'other'")} AS topic FROM documents""")
def classify_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = views.documents(spark, sf_dir, "text")
    return tagging.classify(documents, "text", v.TOPIC_RULES, "other", "topic").drop("text")


@query(f"""SELECT p_partkey, {sql_first('p_type', v.SCALE_RULES, "'small'")} AS scale FROM part""")
def classify_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = views.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return tagging.classify(parts, "p_type", v.SCALE_RULES, "small", "scale", ignore_case=False).drop("p_type")


@query(f"""SELECT {sql_first('lower(o_orderpriority)', v.PRIORITY_RULES, "'other'")} AS pace, count(*) AS n FROM orders GROUP BY 1""")
def classify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = views.table(spark, sf_dir, "orders").select("o_orderpriority")
    paced = tagging.classify(orders, "o_orderpriority", v.PRIORITY_RULES, "other", "pace")
    return paced.groupBy("pace").agg(F.count("*").alias("n"))


@query(f"""SELECT token, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM part), 6) AS rate
FROM (SELECT unnest(string_split(tags_all, ', ')) AS token FROM ({PARTS})) WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 30""")
def token_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tagging.token_frequency(views.tagged_parts(spark, sf_dir), "tags_all", 30), "rate")


@query(f"""SELECT count(*) AS n, count(*) FILTER (WHERE tags_all <> '') AS tagged, round(count(*) FILTER (WHERE tags_all <> '') * 100.0 / count(*), 6) AS pct FROM ({DOCUMENTS})""")
def tag_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tagging.tag_coverage(views.tagged_documents(spark, sf_dir), "tags_all"), "pct")


@query("SELECT o_orderpriority AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM orders), 6) AS pct FROM orders GROUP BY 1")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.value_counts(views.table(spark, sf_dir, "orders"), "o_orderpriority"), "pct")


@query("SELECT source AS value, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.top_values(views.table(spark, sf_dir, "documents"), "source", 10)


@query("""SELECT count(*) AS n, count(DISTINCT o_custkey) AS distinct_o_custkey, count(DISTINCT o_orderstatus) AS distinct_o_orderstatus,
count(DISTINCT o_orderpriority) AS distinct_o_orderpriority FROM orders""")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.distinct_counts(views.table(spark, sf_dir, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"])


@query("""SELECT lang, count(*) AS n, count(quality) AS labelled, round(count(quality) * 100.0 / count(*), 6) AS labelled_pct,
count(*) FILTER (WHERE length(text) > 1000) AS long, round(count(*) FILTER (WHERE length(text) > 1000) * 100.0 / count(*), 6) AS long_pct
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = views.table(spark, sf_dir, "documents"), views.table(spark, sf_dir, "labels")
    conditions = {"labelled": F.col("quality").isNotNull(), "long": F.col("_long")}
    # The text is reduced to a flag before the join, so whole texts are not shuffled.
    flagged = documents.select("doc_id", "lang", text.longer_than("text", 1000).alias("_long"))
    return rounded(counts.coverage(flagged.join(labels, "doc_id", "left"), conditions, ["lang"]), "labelled_pct", "long_pct")


_RAW_DATE = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 'O' THEN strftime(o_orderdate, '%Y.%m.%d') ELSE 'always open' END"""


@query(f"""SELECT o_orderkey, raw, strftime(try_strptime(raw, ['%Y-%m-%d', '%Y.%m.%d']), '%Y-%m-%d') AS parsed,
TRY_CAST(string_split(raw, '.')[1] AS DOUBLE) AS leading_number FROM (SELECT o_orderkey, {_RAW_DATE} AS raw FROM orders)""")
def lenient_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, day = F.col("o_orderstatus"), F.col("o_orderdate").cast("date").cast("string")
    raw = F.when(status == "F", day).when(status == "O", F.replace(day, F.lit("-"), F.lit("."))).otherwise("always open")
    return views.table(spark, sf_dir, "orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw", dates.lenient_date("raw").cast("string").alias("parsed"),
        dates.lenient_number(text.split_field("raw", 0, ".")).alias("leading_number"),
    )


# Two event types arrive without a time; of these only "error" rows may be estimated from their id.
_GIVEN = "CASE WHEN event_type NOT IN ('error', 'click') THEN ts END"
_FIT = f"""SELECT count(g) AS n, regr_slope(epoch(g), event_id) AS slope, regr_intercept(epoch(g), event_id) AS intercept,
corr(epoch(g), event_id) AS r, avg(event_id) FILTER (WHERE g IS NOT NULL) AS mean_id
FROM (SELECT event_id, {_GIVEN} AS g FROM events) WHERE g IS NOT NULL"""
_LOW, _HIGH = "2024-01-05", "2024-01-25"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = F.when(~F.col("event_type").isin("error", "click"), F.col("ts"))
    return views.table(spark, sf_dir, "events").select("event_id", "event_type", given.alias("given"))


@query(f"""SELECT n, round(slope, 3) AS slope, round(intercept, 1) AS intercept, round(r, 6) AS r, round(mean_id, 6) AS mean_id,
strftime(DATE '1970-01-01' + CAST(floor((slope * floor(mean_id) + intercept) / 86400) AS INTEGER), '%Y-%m-%d') AS mean_estimate FROM ({_FIT})""")
def id_date_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = timeline.fit_id_to_time(_events(spark, sf_dir), "event_id", "given")
    return fit.select(
        "n", F.round("slope", 3).alias("slope"), F.round("intercept", 1).alias("intercept"), F.round("r", 6).alias("r"),
        F.round("mean_id", 6).alias("mean_id"), F.col("mean_estimate").cast("string").alias("mean_estimate"),
    )


_IMPUTED = f"""SELECT event_id, event_type, coalesce(CAST(g AS DATE), CASE WHEN event_type = 'error'
AND slope * event_id + intercept BETWEEN epoch(DATE '{_LOW}') AND epoch(DATE '{_HIGH}')
THEN DATE '1970-01-01' + CAST(floor((slope * event_id + intercept) / 86400) AS INTEGER) END) AS d
FROM (SELECT event_id, event_type, {_GIVEN} AS g FROM events), ({_FIT})"""


def _imputed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir)
    fit = timeline.fit_id_to_time(events, "event_id", "given")
    dated = timeline.impute_dates(
        events, fit, ident="event_id", given="given", estimable=F.col("event_type") == "error", low=_LOW, high=_HIGH
    )
    return timeline.posting_calendar(dated, "date_est")


@query(f"""SELECT event_id, strftime(d, '%Y-%m-%d') AS deadline, strftime(d - 30, '%Y-%m-%d') AS posted, strftime(d - 30, '%Y-%m') AS ym,
CAST(year(d - 30) AS INTEGER) AS year, CAST(month(d - 30) AS INTEGER) AS month, CAST(quarter(d - 30) AS INTEGER) AS quarter FROM ({_IMPUTED})""")
def id_date_impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _imputed(spark, sf_dir).select(
        "event_id", F.col("date_est").cast("string").alias("deadline"), F.col("posted_est").cast("string").alias("posted"),
        "ym", "year", "month", "quarter",
    )


@query(f"""SELECT event_type, count(*) AS n, count(d) AS dated, round(count(d) * 100.0 / count(*), 6) AS dated_pct FROM ({_IMPUTED}) GROUP BY 1""")
def date_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    covered = counts.coverage(_imputed(spark, sf_dir), {"dated": F.col("date_est").isNotNull()}, ["event_type"])
    return rounded(covered, "dated_pct")


_PROPS = """CASE event_type WHEN 'error' THEN 'broken ' || replace(props, '}', '') || ' tail' WHEN 'click' THEN 'no braces here'
ELSE 'note ' || props || ' end' END"""


@query(f"""SELECT event_id, coalesce(TRY_CAST(regexp_extract(w, '"k": ([0-9]+)\\}}', 1) AS BIGINT), -1) AS k, regexp_matches(w, '"k": [0-9]+\\}}') AS parsed
FROM (SELECT event_id, {_PROPS} AS w FROM events)""")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, props = F.col("event_type"), F.col("props")
    wrapped = (
        F.when(kind == "error", F.concat(F.lit("broken "), F.replace(props, F.lit("}"), F.lit("")), F.lit(" tail")))
        .when(kind == "click", F.lit("no braces here"))
        .otherwise(F.concat(F.lit("note "), props, F.lit(" end")))
    )
    parsed = views.table(spark, sf_dir, "events").select("event_id", text.json_in_text(wrapped, "k bigint")["k"].alias("_k"))
    return parsed.select("event_id", F.coalesce("_k", F.lit(-1).cast("bigint")).alias("k"), F.col("_k").isNotNull().alias("parsed"))


