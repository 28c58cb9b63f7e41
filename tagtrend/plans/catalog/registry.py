"""Registration of queries with their check, and the SQL fragments the checks share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagtrend.plans import vocabulary as v

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; without `sql` the check is on rows and in the tests."""
    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(words: Sequence[str]) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def sql_tags(text: str, words: Sequence[str]) -> str:
    return f"array_to_string([k for k in {sql_list(words)} if contains(lower({text}), lower(k))], ', ')"


def sql_first(text: str, rules: Mapping[str, Sequence[str]], default: str) -> str:
    cases = " ".join(
        f"WHEN len([w for w in {sql_list(words)} if contains({text}, w)]) > 0 THEN {quoted(label)}" for label, words in rules.items()
    )
    return f"CASE {cases} ELSE {default} END"


def sql_pick(key: str, values: Mapping[str, str], default: str) -> str:
    cases = " ".join(f"WHEN {key} = {quoted(k)} THEN {value}" for k, value in values.items())
    return f"CASE {cases} ELSE {default} END"


def sql_fill(template: str, **slots: str) -> str:
    """Nested `replace` calls over a template constant."""
    out = quoted(template)
    for name, value in slots.items():
        out = f"replace({out}, '{{{name}}}', {value})"
    return out


def sql_1d(x: str) -> str:
    return f"printf('%.1f', round(CAST({x} AS DOUBLE), 1))"


def sql_signed(x: str) -> str:
    return f"(CASE WHEN round(CAST({x} AS DOUBLE), 1) > 0 THEN '+' ELSE '' END || {sql_1d(x)} || '%')"


CLEAN = r"trim(regexp_replace(regexp_replace(coalesce({0}, ''), '[^\p{{L}}\p{{N}}_\s.+#\-/]', ' ', 'g'), '\s+', ' ', 'g'))"
PARTS = f"SELECT *, {sql_tags('p_name', sorted(v.PART_LIST))} AS tags_all FROM part"
POSTINGS = f"""SELECT strftime(l_shipdate, '%Y-%m') AS ym, p_type AS category, p_name AS title, tags_all, c_mktsegment AS segment
FROM lineitem JOIN ({PARTS}) ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""
DOCUMENTS = f"SELECT *, {sql_tags('text', sorted(v.DOCUMENT_LIST))} AS tags_all FROM documents"


def sql_rates(source: str, by: str, words: Sequence[str], tags: str = "tags_all") -> str:
    hit = f"contains(lower({tags}), lower(keyword))"
    return f"""SELECT *, n * 100.0 / total AS rate FROM (
SELECT {by}, keyword, count(*) FILTER (WHERE {hit}) AS n, count(*) AS total
FROM ({source}), (SELECT unnest({sql_list(words)}) AS keyword) GROUP BY ALL)"""


MONTH_RATES = sql_rates(POSTINGS, "ym", v.PART_LIST)
SEGMENT_RATES = sql_rates(POSTINGS, "segment", v.PART_LIST)
_P = v.PERIODS
_FIRST = f"ym BETWEEN '{_P['first'][0]}' AND '{_P['first'][1]}'"
_SECOND = f"ym BETWEEN '{_P['second'][0]}' AND '{_P['second'][1]}'"
GROWTH = f"""SELECT *, CASE WHEN mean_first > 0 THEN (mean_second - mean_first) / mean_first * 100 ELSE 0 END AS growth FROM (
SELECT keyword, coalesce(avg(rate) FILTER (WHERE {_FIRST}), 0) AS mean_first, coalesce(avg(rate) FILTER (WHERE {_SECOND}), 0) AS mean_second,
coalesce(avg(rate) FILTER (WHERE ym >= '{_P['recent_from']}'), 0) AS mean_recent, avg(rate) AS mean_all,
CAST(coalesce(sum(n) FILTER (WHERE {_FIRST}), 0) AS BIGINT) AS count_first, CAST(coalesce(sum(n) FILTER (WHERE {_SECOND}), 0) AS BIGINT) AS count_second
FROM ({MONTH_RATES}) GROUP BY keyword)"""
ORDER_MONTHS = f"""SELECT ym, category, count(o_orderkey) AS n FROM
(SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS ym FROM orders), (SELECT unnest({sql_list(v.PRIORITIES)}) AS category)
LEFT JOIN orders ON strftime(o_orderdate, '%Y-%m') = ym AND o_orderpriority = category
WHERE ym < (SELECT strftime(max(o_orderdate) + INTERVAL 1 DAY, '%Y-%m') FROM orders) GROUP BY ALL"""


def sql_peaks(counts: str) -> str:
    return f"""SELECT category, (array_agg(ym ORDER BY n DESC, ym))[1] AS peak_month, max(n) AS peak_n, avg(n) AS mean_n,
(max(n) / avg(n) - 1) * 100 AS uplift,
strftime(CAST((array_agg(ym ORDER BY n DESC, ym))[1] || '-01' AS DATE) - INTERVAL 2 MONTH, '%Y-%m') AS prep_month FROM ({counts}) GROUP BY category"""


PEAKS = sql_peaks(ORDER_MONTHS)
FIRST_LAST = f"""SELECT *, CASE WHEN first_n <> 0 THEN (last_n - first_n) * 100.0 / first_n ELSE 0 END AS growth FROM (
SELECT category, arg_min(n, ym) AS first_n, arg_max(n, ym) AS last_n FROM ({ORDER_MONTHS}) GROUP BY category)"""
