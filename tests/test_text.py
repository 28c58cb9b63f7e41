import re

import pytest
from helpers import values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagtrend.functions import text
from tagtrend.operators import tagging


def one(spark, value, column, type_="string"):
    return spark.createDataFrame([(value,)], f"c {type_}").select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("raw, expected", [
    ("A(b)·C!  C++/C# CI/CD v1.0 ½ x_y", "A b C C++/C# CI/CD v1.0 ½ x_y"),
    (None, ""), ("", ""), ("  \t\n ", ""), ("가나\u3000다 🚀 é", "가나 다 é"),
])
def test_clean_text(spark, raw, expected):
    assert one(spark, raw, text.clean_text("c")) == expected


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=30))
def test_clean_text_matches_the_two_step_definition(spark, raws):
    def expected(raw):
        return re.sub(r"\s+", " ", re.sub(r"[^\w\s.+#\-/]", " ", raw)).strip()

    # Unassigned and newly assigned code points differ between Unicode versions.
    raws = [r for r in raws if all(ord(ch) < 0x3000 for ch in r) and "\x1c" not in r]
    raws = [re.sub("[\x1c-\x1f\x85]", "", r) for r in raws] or ["a"]
    df = spark.createDataFrame(list(enumerate(raws)), "i int, c string")
    got = {r["i"]: r["r"] for r in df.select("i", text.clean_text("c").alias("r")).collect()}
    for i, raw in enumerate(raws):
        assert got[i] == expected(raw), raw


def test_tags_substring_and_word(spark):
    words = {"lang": ["Java", "JavaScript", "C++"], "web": ["Next.js", "Git"]}
    df = spark.createDataFrame([(1, "C++ and Next.js"), (2, "JavaScript on GitHub"), (3, None)], "i int, t string")
    got = values(tagging.tag_records(df, "t", words), "i", "tags_all", "tags_lang", "tags_web")
    assert got == [(1, "C++, Next.js", "C++", "Next.js"), (2, "Git, Java, JavaScript", "Java, JavaScript", "Git"), (3, "", "", "")]
    word = values(tagging.tag_records(df, "t", words, match="word"), "i", "tags_all")
    assert word == [(1, "C++, Next.js"), (2, "JavaScript"), (3, "")]


def test_tags_keep_quotes_and_backslashes(spark):
    df = spark.createDataFrame([(1, r"it's a c:\dir path")], "i int, t string")
    assert values(tagging.tag_records(df, "t", {"x": ["it's", "c:\\dir"]}), "tags_all") == [("c:\\dir, it's",)]


def test_first_rule_wins(spark):
    rules = {"one": ["api", "x y"], "two": ["ai"], "three": ["api server"]}
    df = spark.createDataFrame([(1, "API server AI"), (2, "an AI"), (3, "none"), (4, None)], "i int, t string")
    assert values(tagging.classify(df, "t", rules, "other", "r"), "i", "r") == [(1, "one"), (2, "two"), (3, "other"), (4, "other")]
    cased = tagging.classify(df, "t", {"up": ["AI"]}, "other", "r", ignore_case=False)
    assert values(cased, "i", "r") == [(1, "up"), (2, "up"), (3, "other"), (4, "other")]


def test_split_field(spark):
    assert one(spark, "Seoul | 3y", text.split_field("c", 1)) == "3y"
    assert one(spark, "Seoul", text.split_field("c", 1)) is None
    assert one(spark, None, text.split_field("c", 0)) is None


def test_tokens(spark):
    assert one(spark, " a, b ,,nan, NaN,c", text.tokens("c")) == ["a", "b", "c"]
    assert one(spark, "a, b, c", text.tokens("c", limit=2)) == ["a", "b"]
    assert one(spark, None, text.tokens("c")) == []


@pytest.mark.parametrize("raw, expected", [('x {"title":"t"} y', "t"), ("{bad", "fallback"), ("no braces", "fallback"), ('a {"title": } b', "fallback")])
def test_json_in_text(spark, raw, expected):
    assert one(spark, raw, F.coalesce(text.json_in_text("c", "title string")["title"], F.lit("fallback"))) == expected


def test_number_formats(spark):
    assert one(spark, 1234567, text.thousands("c"), "long") == "1,234,567"
    assert one(spark, 3.25, text.signed_percent("c"), "double") == "+3.3%"
    assert one(spark, -3.2, text.signed_percent("c"), "double") == "-3.2%"
    assert one(spark, 9.9, text.percent_bar("c"), "double") == "████"
    assert one(spark, "Gear (spur) x", text.strip_suffix("c")) == "Gear"


def test_first_present_and_slots(spark):
    df = spark.createDataFrame([("", "b"), ("a", "b"), (None, "")], "x string, y string")
    assert [r[0] for r in df.select(text.first_present("x", "y", default="d")).collect()] == ["b", "a", "d"]
    assert one(spark, "v", text.fill_slots(F.lit("{a}-{b}"), a=F.col("c"), z=F.lit("n"))) == "v-{b}"


def test_token_match_is_whole_elements(spark):
    df = spark.createDataFrame([("javascript, git",)], "c string")
    got = df.select(text.mentions("c", "Java"), text.mentions("c", "Java", "token"), text.mentions("c", "Git", "token")).first()
    assert tuple(got) == (True, False, True)


def test_token_frequency_rate_over_all_rows(spark):
    df = spark.createDataFrame([("a, b",), ("a",), ("",), (None,)], "t string")
    assert values(tagging.token_frequency(df, "t", 5), "token", "n", "rate") == [("a", 2, 50.0), ("b", 1, 25.0)]
