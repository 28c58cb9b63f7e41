"""Chat-style samples: templates, records, flattening and length caps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.functions.text import fill_slots, text_or_empty
from tagtrend.operators.position import with_position


def each_template(df: DataFrame, templates: Sequence[str], *, out: str = "template") -> DataFrame:
    """Every row with every template and its number: the templates travel in the row, so no join is made."""
    entries = F.array(*[F.lit(t) for t in templates])
    return df.select(*df.columns, F.posexplode(entries).alias("template_no", out))


def rotating_template(
    df: DataFrame, templates: Sequence[str], by: str, *, tie_break: Sequence[str] = (), out: str = "template"
) -> DataFrame:
    """Template number = position in the order of `by` modulo the number of templates.

    The position counts every row, so apply row filters after this step. Rows with equal `by` follow `tie_break`, then
    a hash of the row, so the numbers do not depend on the partitions.
    """
    placed = with_position(df, by, "_pos", tie_break=tie_break)
    number = F.pmod(F.col("_pos"), F.lit(len(templates))).cast("int")
    entries = F.array(*[F.lit(t) for t in templates])
    return placed.withColumn("template_no", number).withColumn(out, F.get(entries, F.col("template_no"))).drop("_pos")


def template_text(templates: Mapping[str, str], which: Column, **slots: Column) -> Column:
    """The template of a named case with its slots filled; null for an unknown case."""
    chain = None
    for name, template in templates.items():
        filled = fill_slots(F.lit(template), **slots)
        chain = F.when(which == name, filled) if chain is None else chain.when(which == name, filled)
    return chain


def numbered(items: Column, line: str) -> Column:
    """One filled line per array element, with `{i}` from 1 and `{item}`."""
    return F.array_join(
        F.transform(items, lambda x, i: F.replace(
            F.replace(F.lit(line), F.lit("{i}"), (i + 1).cast("string")), F.lit("{item}"), x
        )),
        "\n",
    )


def chat_record(system: str | Column, user: Column, assistant: Column) -> Column:
    """`array<struct<role, content>>` of the three turns."""
    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(
        turn("system", F.lit(system) if isinstance(system, str) else system),
        turn("user", user), turn("assistant", assistant),
    )


def turn_text(role: Column, content: Column, markers: Mapping[str, str]) -> Column:
    return F.concat(
        F.lit(markers["header_start"]), role, F.lit(markers["header_end"]), content, F.lit(markers["turn_end"])
    )


def flatten_record(record: Column, markers: Mapping[str, str]) -> Column:
    """One training text from a record: begin marker, each turn with its role header, end marker."""
    turns = F.transform(record, lambda t: turn_text(t["role"], t["content"], markers))
    return F.concat(F.lit(markers["begin"]), F.array_join(turns, ""), F.lit(markers["end"]))


def flatten_turns(df: DataFrame, conversation: str, turn: str, role: str, text: str, markers: Mapping[str, str]) -> DataFrame:
    """Flatten a long table of turns: `conversation, text`, one row per conversation with its turns in order.

    A conversation is one training sample, so its text is one cell, whatever its length; each map task brings the
    turns it has of a conversation together before the shuffle.
    """
    entry = F.struct(F.col(turn).cast("long").alias("t"), turn_text(text_or_empty(role), text_or_empty(text), markers).alias("x"))
    turns = df.groupBy(conversation).agg(F.array_sort(F.collect_list(entry)).alias("_turns"))
    body = F.array_join(F.transform("_turns", lambda t: t["x"]), "")
    return turns.select(conversation, F.concat(F.lit(markers["begin"]), body, F.lit(markers["end"])).alias("text"))


def cap_words(df: DataFrame, text: str, limit: int = 1024) -> DataFrame:
    """Cut each sample to its first `limit` blank-separated words; adds `n_words` and `truncated`."""
    words = F.filter(F.split(F.col(text), r"[ \t\r\n]+"), lambda w: w != "")
    work = df.withColumn("_words", words)
    return (
        work.withColumn("n_words", F.size("_words"))
        .withColumn("truncated", F.size("_words") > limit)
        .withColumn(text, F.array_join(F.slice("_words", 1, limit), " "))
        .drop("_words")
    )


def cap_long(df: DataFrame, text: str, limit: int) -> DataFrame:
    """As `cap_words`, but a sample within the limit keeps its blanks and line breaks as they are."""
    whole = "_whole"
    capped = cap_words(df.withColumn(whole, F.col(text)), text, limit)
    return capped.withColumn(text, F.when(F.col("truncated"), F.col(text)).otherwise(F.col(whole))).drop(whole)
