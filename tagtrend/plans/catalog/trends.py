"""Monthly shares, growth, peaks and segment comparisons over the postings view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.functions.dates import year_month
from tagtrend.operators import automaton, counts, rates, seasons, segments, sketches, summary, tagging, timeline
from tagtrend.plans import views
from tagtrend.plans import vocabulary as v
from tagtrend.plans.catalog.registry import (
    DOCUMENTS, FIRST_LAST, GROWTH, MONTH_RATES, ORDER_MONTHS, PARTS, PEAKS, POSTINGS, SEGMENT_RATES, query, quoted, rounded,
    sql_1d, sql_list, sql_rates,
)
from tagtrend.session import cut_lineage
from tagtrend.sources import tables

_A, _B = v.SEGMENTS


def posting_rates(spark: SparkSession, sf_dir: str, by: str, column: str | None = None) -> DataFrame:
    counted = views.counted_postings(spark, sf_dir, column or by, "tags_all")
    return rates.keyword_rates(counted, [by], "tags_all", v.PART_LIST, weight="n")


def month_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_rates(spark, sf_dir, "ym", "month")


def segment_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_rates(spark, sf_dir, "segment")


def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.period_growth(month_rates(spark, sf_dir), **v.PERIODS)


def order_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = timeline.month_category_counts(views.counted_orders(spark, sf_dir), "ym", "category", v.PRIORITIES, weight="n")
    # the last month counts once its last day is there
    last = views.table(spark, sf_dir, "orders").agg(F.max("o_orderdate")).scalar().cast("date")
    return counted.where(F.col("ym") < year_month(F.date_add(last, 1)))


@query(f"""SELECT strftime(o_orderdate, '%Y-%m') AS ym, count(*) AS n FROM orders
WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '{v.MONTHS[0]}' AND '{v.MONTHS[1]}' GROUP BY 1""")
def month_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.month_counts(views.counted_orders(spark, sf_dir), "ym", *v.MONTHS, weight="n")


_WIDE = ", ".join(f"count(*) FILTER (WHERE o_orderpriority = {quoted(p)}) AS \"{p}\"" for p in v.PRIORITIES)


@query(f"SELECT strftime(o_orderdate, '%Y-%m') AS ym, {_WIDE} FROM orders GROUP BY 1")
def month_category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.month_category_table(views.counted_orders(spark, sf_dir), "ym", "category", v.PRIORITIES, weight="n")


@query(f"SELECT strftime(o_orderdate, '%Y-%m') AS ym, {_WIDE} FROM orders GROUP BY 1")
def published_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result table published under a name and read back by it."""
    tables.publish(month_category_pivot(spark, sf_dir), "month_category")
    return tables.lookup(spark, "month_category")


@query(f"SELECT category, keyword, n, total, round(rate, 6) AS rate FROM ({sql_rates(POSTINGS, 'category', v.PART_LIST)})")
def group_keyword_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(posting_rates(spark, sf_dir, "category"), "rate")


_BY_GROUP = " UNION ALL ".join(f"SELECT {quoted(c)} AS dictionary, {quoted(k)} AS keyword" for c, ks in v.PART_KEYWORDS.items() for k in ks)


@query(f"SELECT segment, dictionary, keyword, n, total, round(rate, 6) AS rate FROM ({SEGMENT_RATES}) JOIN ({_BY_GROUP}) USING (keyword)")
def segment_category_keyword_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_segment = segment_rates(spark, sf_dir)
    return rounded(by_segment.join(dictionary_of(by_segment), "keyword"), "rate")


def dictionary_of(df: DataFrame) -> DataFrame:
    """Keyword to dictionary category, a table as large as the dictionary."""
    return F.broadcast(tagging.dictionary_table(df, v.PART_KEYWORDS).select(F.col("category").alias("dictionary"), "keyword"))


@query(f"SELECT ym, keyword, n, total, round(rate, 6) AS rate FROM ({MONTH_RATES})")
def month_keyword_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(month_rates(spark, sf_dir), "rate")


_MEANS = ("mean_first", "mean_second", "mean_recent", "mean_all", "growth")
_GROWTH_COLUMNS = ", ".join(f"round({c}, 6) AS {c}" for c in _MEANS)


@query(f"SELECT keyword, {_GROWTH_COLUMNS}, count_first, count_second FROM ({GROWTH})")
def period_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(growth(spark, sf_dir), *_MEANS)


@query(f"""SELECT keyword, round(growth, 1) AS growth, round(mean_first, 1) AS mean_first, round(mean_second, 1) AS mean_second
FROM ({GROWTH}) ORDER BY round(growth, 1) DESC, keyword LIMIT 5""")
def rising_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: tagged postings to monthly shares to period growth to the five fastest risers."""
    top = rates.top_rising(growth(spark, sf_dir), 5)
    return rounded(top.select("keyword", "growth", "mean_first", "mean_second"), "growth", "mean_first", "mean_second", digits=1)


@query(f"""SELECT keyword, round(growth, 1) AS growth FROM ({GROWTH}) ORDER BY round(growth, 1), keyword LIMIT 3""")
def falling_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rates.top_falling(growth(spark, sf_dir), 3).select("keyword", "growth"), "growth", digits=1)


@query(f"SELECT category, peak_month, peak_n FROM ({PEAKS})")
def peak_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasons.peaks(order_months(spark, sf_dir)).select("category", "peak_month", "peak_n")


@query(f"SELECT category, peak_n, round(mean_n, 6) AS mean_n, round(uplift, 6) AS uplift FROM ({PEAKS})")
def peak_uplift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(seasons.peaks(order_months(spark, sf_dir)).select("category", "peak_n", "mean_n", "uplift"), "mean_n", "uplift")


@query(f"SELECT category, peak_month, prep_month FROM ({PEAKS})")
def prep_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasons.peaks(order_months(spark, sf_dir)).select("category", "peak_month", "prep_month")


@query(f"SELECT category, ym, n, ym = peak_month AS is_peak FROM ({ORDER_MONTHS}) JOIN ({PEAKS}) USING (category)")
def peak_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasons.peak_flags(order_months(spark, sf_dir))


@query(f"SELECT category, first_n, last_n, round(growth, 6) AS growth FROM ({FIRST_LAST})")
def first_last_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(seasons.first_last_growth(order_months(spark, sf_dir)), "growth")


@query(f"SELECT category, round(growth, 1) AS growth FROM ({FIRST_LAST}) WHERE round(growth, 1) > 0")
def up_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(seasons.growing(seasons.first_last_growth(order_months(spark, sf_dir))).select("category", "growth"), "growth", digits=1)


@query(f"SELECT category, last_n FROM ({FIRST_LAST}) ORDER BY last_n DESC, category LIMIT 4")
def largest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seasons.largest(seasons.first_last_growth(order_months(spark, sf_dir))).select("category", "last_n")


@query(f"""(SELECT 'keyword' AS kind, keyword AS name, round(growth, 1) AS growth FROM ({GROWTH}) ORDER BY round(growth, 1) DESC, keyword LIMIT 1)
UNION ALL (SELECT 'category', category, round(growth, 1) FROM ({FIRST_LAST}) ORDER BY round(growth, 1) DESC, category LIMIT 1)""")
def headline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = seasons.headline(seasons.first_last_growth(order_months(spark, sf_dir)), growth(spark, sf_dir))
    return rounded(found, "growth", digits=1)


_RANKED = f"""SELECT keyword, round(growth, 1) AS g, round(mean_all, 1) AS m FROM ({GROWTH})"""


def _section(name: str, order: str, value: str, k: int) -> str:
    return f"""(SELECT '{name}' AS section, CAST(row_number() OVER (ORDER BY {order}, keyword) AS INTEGER) AS rank, keyword AS name, {value} AS value, m AS mean, CAST(NULL AS VARCHAR) AS at
FROM ({_RANKED}) QUALIFY rank <= {k})"""


@query(" UNION ALL ".join([
    _section("rising", "g DESC", "g", 5), _section("falling", "g", "g", 3), _section("top", "m DESC", "m", 10),
    f"SELECT 'peak', 1, category, CAST(peak_n AS DOUBLE), CAST(NULL AS DOUBLE), peak_month FROM ({PEAKS})",
]))
def trend_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.trend_summary(growth(spark, sf_dir), seasons.peaks(order_months(spark, sf_dir)))


_TWO = f"SELECT segment, tags_all FROM ({POSTINGS}) WHERE segment IN ('{_A}', '{_B}')"


@query(f"""SELECT token, n_a, n_b, round(n_a * 100.0 / (SELECT count(*) FROM ({_TWO}) WHERE segment = '{_A}'), 6) AS rate_a,
round(n_b * 100.0 / (SELECT count(*) FROM ({_TWO}) WHERE segment = '{_B}'), 6) AS rate_b FROM (
SELECT token, count(*) FILTER (WHERE segment = '{_A}') AS n_a, count(*) FILTER (WHERE segment = '{_B}') AS n_b
FROM (SELECT segment, unnest(list_distinct(string_split(tags_all, ', '))) AS token FROM ({_TWO})) WHERE token <> '' GROUP BY token)
ORDER BY n_a + n_b DESC, token LIMIT 10""")
def segment_rates_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = views.counted_postings(spark, sf_dir, "segment", "tags_all")
    return rounded(segments.two_segment_token_rates(counted, "segment", "tags_all", _A, _B, weight="n"), "rate_a", "rate_b")


_DISTRIBUTION = f"""SELECT segment, category, n, n * 100.0 / sum(n) OVER (PARTITION BY segment) AS ratio
FROM (SELECT segment, category, count(*) AS n FROM ({POSTINGS}) GROUP BY ALL)"""


def distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.distribution(views.counted_postings(spark, sf_dir, "segment", "category"), "segment", "category", weight="n")


@query(f"SELECT segment, category, n, round(ratio, 6) AS ratio FROM ({_DISTRIBUTION})")
def segment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(distribution(spark, sf_dir), "ratio")


@query(f"""SELECT segment, count(*) AS n, round(count(*) FILTER (WHERE category = 'PROMO') * 100.0 / count(*), 6) AS share FROM ({POSTINGS}) GROUP BY 1""")
def category_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = views.counted_postings(spark, sf_dir, "segment", "category")
    return rounded(counts.category_share(counted, "segment", "category", "PROMO", weight="n"), "share")


_TOPK = f"SELECT *, row_number() OVER (PARTITION BY segment ORDER BY rate DESC, keyword) AS rank FROM ({SEGMENT_RATES}) QUALIFY rank <= 10"


@query(f"SELECT segment, keyword, n, total, round(rate, 6) AS rate, CAST(rank AS INTEGER) AS rank FROM ({_TOPK})")
def segment_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rates.segment_ranking(segment_rates(spark, sf_dir), "segment", 10), "rate")


_PAIRS = f"""SELECT keyword AS name, max(rate) FILTER (WHERE segment = '{_A}') AS a, max(rate) FILTER (WHERE segment = '{_B}') AS b FROM ({SEGMENT_RATES}) GROUP BY 1"""
# The counts are close to uniform, so a small threshold separates the keywords.
_THRESHOLD = 0.3


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.two_segments(segment_rates(spark, sf_dir), "segment", "keyword", "rate", _A, _B)


_DISTINCTIVE = f"""SELECT name, a, b, diff, CASE WHEN diff > 0 THEN 'a' ELSE 'b' END AS leader FROM (
SELECT name, round(a, 1) AS a, round(b, 1) AS b, round(round(a, 1) - round(b, 1), 1) AS diff FROM ({_PAIRS})) WHERE abs(diff) >= {_THRESHOLD}"""


@query(_DISTINCTIVE)
def distinctive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.distinctive(pairs(spark, sf_dir), _THRESHOLD)


_ROUND = f"""SELECT name, a, b, round(a + b, 1) AS total, round(a - b, 1) AS diff FROM (SELECT name, round(a, 1) AS a, round(b, 1) AS b FROM ({_PAIRS}))"""


def _side(section: str, order: str, condition: str, k: int) -> str:
    return f"""(SELECT '{section}' AS section, CAST(row_number() OVER (ORDER BY {order}, name) AS INTEGER) AS rank, name, a, b, diff FROM ({_ROUND}) QUALIFY rank <= {k} AND {condition})"""


_COMMON = " UNION ALL ".join([
    _side("common", "total DESC", "true", 4), _side("a_leads", "diff DESC", "diff > 0", 3), _side("b_leads", "diff", "diff < 0", 3),
    _side("headline_common", "total DESC", "true", 1), _side("headline_gap", "abs(diff) DESC", "true", 1),
])


@query(_COMMON)
def common_different(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.common_and_different(pairs(spark, sf_dir))


@query(f"""WITH p AS (SELECT category AS name, max(ratio) FILTER (WHERE segment = '{_A}') AS a, max(ratio) FILTER (WHERE segment = '{_B}') AS b FROM ({_DISTRIBUTION}) GROUP BY 1)
{_COMMON.replace(_PAIRS, 'SELECT * FROM p')}""")
def common_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = rates.two_segments(distribution(spark, sf_dir), "segment", "category", "ratio", _A, _B)
    return rates.common_and_different(shares)


@query("""SELECT p_type, rows_in_group, round(mean, 6) AS mean, round(null_pct, 6) AS null_pct, p_size, n FROM
(SELECT p_type, p_size, count(*) AS n FROM part GROUP BY ALL) JOIN
(SELECT p_type, count(*) AS rows_in_group, avg(p_size) AS mean, count(*) FILTER (WHERE p_size IS NULL) * 100.0 / count(*) AS null_pct FROM part GROUP BY 1) USING (p_type)""")
def requirement_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(counts.numeric_profile(views.table(spark, sf_dir, "part"), "p_type", "p_size"), "mean", "null_pct")


def _object(key: str, value: str) -> str:
    return f"map_from_entries(list({{'k': {key}, 'v': {value}}} ORDER BY {key}))"


_SHARES = f"""SELECT segment, count(*) AS n, count(*) FILTER (WHERE category = 'PROMO') * 100.0 / count(*) AS share FROM ({POSTINGS}) GROUP BY 1"""


@query(f"""SELECT to_json({{'meta': {{'total': CAST(sum(n) AS BIGINT), 'segments': {_object('segment', 'n')}}},
'keyword_rates': (SELECT {_object('segment', 'x')} FROM (SELECT segment, {_object('dictionary', 'y')} AS x FROM (
  SELECT segment, dictionary, {_object('keyword', 'round(rate, 1)')} AS y FROM ({SEGMENT_RATES}) JOIN ({_BY_GROUP}) USING (keyword) GROUP BY ALL) GROUP BY ALL)),
'top_keywords': (SELECT {_object('segment', 'x')} FROM (SELECT segment, list({{'rank': rank, 'keyword': keyword, 'rate': round(rate, 1)}} ORDER BY rank) AS x FROM ({_TOPK}) GROUP BY 1)),
'distinctive': (SELECT coalesce(list({{'name': name, 'a': a, 'b': b, 'diff': diff, 'leader': leader}} ORDER BY name), []) FROM ({_DISTINCTIVE})),
'category_share': {_object('segment', 'round(share, 1)')},
'distribution': (SELECT {_object('segment', 'x')} FROM (SELECT segment, {_object('category', 'round(ratio, 1)')} AS x FROM ({_DISTRIBUTION}) GROUP BY 1))}}) AS document
FROM ({_SHARES})""")
def metrics_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cut_lineage(views.counted_postings(spark, sf_dir, "segment", "category", "tags_all"))
    by_segment = rates.keyword_rates(counted, ["segment"], "tags_all", v.PART_LIST, weight="n")
    return segments.metrics_bundle(
        counts.distribution(counted, "segment", "category", weight="n"),
        by_segment.join(dictionary_of(by_segment), "keyword"),
        rates.segment_ranking(by_segment, "segment", 10),
        rates.distinctive(rates.two_segments(by_segment, "segment", "keyword", "rate", _A, _B), _THRESHOLD),
        counts.category_share(counted, "segment", "category", "PROMO", weight="n"),
        segment="segment", category="category", dictionary="dictionary",
    )


_SEEN = f"""SELECT keyword, dictionary, (SELECT count(*) FROM ({PARTS}) WHERE contains(tags_all, keyword)) AS n FROM ({_BY_GROUP})"""


@query(f"""SELECT coalesce(dictionary, '(total)') AS category, count(*) AS listed, count(*) FILTER (WHERE n > 0) AS seen
FROM ({_SEEN}) GROUP BY ROLLUP (dictionary)""")
def dictionary_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.dictionary_usage(views.table(spark, sf_dir, "part"), "p_name", v.PART_KEYWORDS)


def _lines(section: str, column: str) -> str:
    pct = f"n * 100.0 / (SELECT count(*) FROM ({POSTINGS}))"
    return f"""SELECT '{section}' AS section, {column} AS label, n, rtrim(format('{{:,}}', n) || ' (' || {sql_1d(pct)} || '%) ' || repeat('█', CAST(floor({pct} / 2) AS INTEGER))) AS line
FROM (SELECT {column}, count(*) AS n FROM ({POSTINGS}) GROUP BY 1)"""


_TAGGED = f"SELECT count(*) AS r, count(*) FILTER (WHERE contains(tags_all, 'ring')) AS c, count(DISTINCT title) AS d FROM ({POSTINGS})"


@query(f"""SELECT 'total' AS section, 'rows' AS label, r AS n, format('{{:,}}', r) AS line FROM ({_TAGGED})
UNION ALL SELECT 'distinct', 'title', d, format('{{:,}}', d) FROM ({_TAGGED})
UNION ALL SELECT 'coverage', 'ring', c, format('{{:,}}', c) || ' (' || {sql_1d('c * 100.0 / r')} || '%)' FROM ({_TAGGED})
UNION ALL {_lines('segments', 'segment')} UNION ALL {_lines('categories', 'category')}
UNION ALL (SELECT 'titles', title, count(*) AS n, format('{{:,}}', count(*)) FROM ({POSTINGS}) GROUP BY title ORDER BY n DESC, title LIMIT 5)""")
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = cut_lineage(views.counted_postings(spark, sf_dir, "segment", "category", "title", "tags_all"))
    return summary.stage_summary(
        counted, weight="n", shares={"segments": "segment", "categories": "category"}, tops={"titles": ("title", 5)},
        covered={"ring": F.contains("tags_all", F.lit("ring"))}, distinct=["title"],
    )


@query(f"""SELECT ym, sum(n) AS n, {', '.join(f"CAST(max(n) FILTER (WHERE keyword = {quoted(k)}) AS BIGINT) AS {k}" for k in ('hot', 'cold', 'old'))}
FROM (SELECT ym, keyword, n FROM ({MONTH_RATES}) WHERE list_contains({sql_list(['hot', 'cold', 'old'])}, keyword)) GROUP BY ym""".replace("sum(n) AS n", "CAST(sum(n) AS BIGINT) AS n"))
def month_keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute monthly counts, wide; `cold` rows also count for `old`, which lies inside it."""
    chosen = ["hot", "cold", "old"]
    counted = views.counted_postings(spark, sf_dir, "month", "tags_all")
    long = rates.keyword_rates(counted, ["ym"], "tags_all", chosen, weight="n")
    return long.groupBy("ym").agg(
        F.sum("n").alias("n"), *[F.max(F.when(F.col("keyword") == k, F.col("n"))).alias(k) for k in chosen]
    )


@query("""SELECT o_orderpriority AS category, count(*) AS n, count(DISTINCT o_custkey) AS customers, true AS count_close, true AS median_close
FROM orders GROUP BY 1""")
def sketch_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and median price per segment from merged monthly states, held against the exact figures: counts
    within 6 % (four standard errors), the rank of the median within 0.05."""
    orders = views.table(spark, sf_dir, "orders").withColumn("ym", year_month("o_orderdate"))
    states = sketches.sketch_states(orders, ["ym", "o_orderpriority"], ["o_custkey"], ["o_totalprice"])
    found = sketches.sketch_summary(states, ["o_orderpriority"]).drop("n")
    price = F.col("o_totalprice").cast("double")
    exact = orders.join(found, "o_orderpriority").groupBy("o_orderpriority", "distinct_o_custkey").agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"),
        (F.count_if(price <= F.col("p50_o_totalprice")) / F.count("*")).alias("rank"),
    )
    return exact.select(
        F.col("o_orderpriority").alias("category"), "n", "customers",
        (F.abs(F.col("distinct_o_custkey") - F.col("customers")) <= F.greatest(F.lit(1), 0.06 * F.col("customers"))).alias("count_close"),
        (F.abs(F.col("rank") - 0.5) <= 0.05).alias("median_close"),
    )


@query(f"SELECT doc_id, tags_all FROM ({DOCUMENTS})")
def automaton_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of every document by one pass of the keyword automaton."""
    documents = views.table(spark, sf_dir, "documents")
    return automaton.tag_by_automaton(documents, "text", v.DOCUMENT_LIST).select("doc_id", "tags_all")
