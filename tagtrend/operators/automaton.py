"""Tags from dictionaries of many thousands of keywords: one pass over each text, however many keywords there are.

`tagging.tag_records` turns every keyword into an expression, which is the faster way for a few hundred. Beyond that an
Aho-Corasick automaton is built once, broadcast (its size is that of the dictionary, which is checked) and run over Arrow
slices of the texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import text_or_empty

MAX_CHARACTERS = 50_000_000


def keyword_automaton(keywords: Iterable[str]) -> ahocorasick.Automaton:
    """Lower-cased keywords, each with the spellings that it stands for; empty ones lie in every text and are refused."""
    spellings: dict[str, set[str]] = {}
    for keyword in keywords:
        if not keyword:
            raise ValueError("an empty keyword")
        spellings.setdefault(keyword.lower(), set()).add(keyword)
    size = sum(map(len, spellings))
    if size > MAX_CHARACTERS:
        raise ValueError(f"{size} characters of keywords are more than the {MAX_CHARACTERS} that are broadcast")
    out = ahocorasick.Automaton()
    for lowered, words in spellings.items():
        out.add_word(lowered, tuple(sorted(words)))
    if len(out):
        out.make_automaton()
    return out


def tag_by_automaton(df: DataFrame, text: str | Column, keywords: Iterable[str], out: str = "tags_all") -> DataFrame:
    """Add the keywords that the text mentions (anywhere, whatever the case), sorted, distinct, ", "-joined: what
    `tag_records` puts into `tags_all`. Null text and no keyword give the empty string."""
    automaton = keyword_automaton(keywords)
    if not len(automaton):
        return df.withColumn(out, F.lit(""))
    shared = df.sparkSession.sparkContext.broadcast(automaton)

    @F.pandas_udf("string")
    def tags(slices: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = shared.value.iter
        for texts in slices:
            found = ({words for _, words in find(t)} for t in texts)
            yield pd.Series([", ".join(sorted({w for words in hits for w in words})) for hits in found], dtype="object")

    # lower-cased on the JVM, by the rule that the expressions use
    return df.withColumn(out, tags(F.lower(text_or_empty(text))))
