"""Text cleaning, keyword search, ordered rules and small formatting expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = Mapping[str, Sequence[str]]

# A run of blanks and characters outside letters, digits, "_", ".", "+", "#", "-", "/" becomes one space.
_NOT_KEPT = r"[^\p{L}\p{N}_.+#\-/]+"
_WORD = r"\p{L}\p{N}_"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(as_column(c), F.lit(""))


def clean_text(c: str | Column) -> Column:
    """Keep word characters and `. + # - /`; everything else and any run of blanks is one space."""
    return F.trim(F.regexp_replace(text_or_empty(c), _NOT_KEPT, " "))


def join_texts(*parts: str | Column, sep: str = " ") -> Column:
    """Concatenate with missing parts as empty text (separators stay)."""
    return F.concat_ws(sep, *[text_or_empty(p) for p in parts])


def cap(c: str | Column, n: int) -> Column:
    """The first `n` characters, for quoted snippets and metadata fields."""
    return F.substring(text_or_empty(c), 1, n)


def first_present(*candidates: str | Column, default: str = "") -> Column:
    """The first candidate that is neither null nor empty."""
    return F.coalesce(*[F.nullif(as_column(c), F.lit("")) for c in candidates], F.lit(default))


def composite_key(*parts: str | Column, sep: str = "|") -> Column:
    return F.concat_ws(sep, *[F.trim(text_or_empty(p)) for p in parts])


def split_field(c: str | Column, index: int, sep: str = "|") -> Column:
    """Trimmed field number `index` of a delimited text; null where the text has fewer fields."""
    return F.trim(F.get(F.split(as_column(c), re.escape(sep)), F.lit(index)))


def longer_than(c: str | Column, n: int) -> Column:
    return F.char_length(text_or_empty(c)) > n


def sql_text(value: str) -> str:
    """A text as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Keyword and rule lists become one SQL expression over a column name: a dictionary of a hundred entries is
# then one call into the JVM, and one chain of `contains` in the generated code.


def mention(lowered: str, keyword: str, match: str = "substring") -> str:
    """SQL condition: an already lower-cased column mentions `keyword`.

    `match` is `substring`, `word` (no letter, digit or `_` on either side) or `token` (an element of a
    ", "-joined list).
    """
    needle = keyword.lower()
    if match == "substring":
        return f"contains(`{lowered}`, {sql_text(needle)})"
    if match == "word":
        pattern = f"(^|[^{_WORD}]){re.escape(needle)}($|[^{_WORD}])"
        return f"`{lowered}` rlike {sql_text(pattern)}"
    if match == "token":
        return f"contains(concat(', ', `{lowered}`, ', '), {sql_text(f', {needle}, ')})"
    raise ValueError(f"unknown match mode {match!r}")


def mentions(lowered: str, keyword: str, match: str = "substring") -> Column:
    return F.expr(mention(lowered, keyword, match))


def joined_tags(lowered: str, keywords: Iterable[str], match: str = "substring") -> Column:
    """The mentioned keywords in the given order, ", "-joined; no shuffle, no lambda, one codegen stage."""
    hits = [f"CASE WHEN {mention(lowered, k, match)} THEN {sql_text(k)} END" for k in keywords]
    return F.expr(f"concat_ws(', ', {', '.join(hits)})")


def any_of(column: str, words: Sequence[str]) -> Column:
    """Whether the column holds any of the words, as written."""
    return F.expr(_any_of(column, words))


def _any_of(column: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains(`{column}`, {sql_text(w)})" for w in words) + ")"


def first_match(column: str, rules: Rules, default: str | None) -> Column:
    """The first rule, in order, one of whose words lies in the column as written; null text gets the default."""
    if not rules:
        return F.lit(default).cast("string")
    cases = " ".join(f"WHEN {_any_of(column, words)} THEN {sql_text(label)}" for label, words in rules.items())
    return F.expr(f"CASE {cases} ELSE {'NULL' if default is None else sql_text(default)} END")


def lower_rules(rules: Rules) -> Rules:
    return {label: [w.lower() for w in words] for label, words in rules.items()}


def tokens(c: str | Column, sep: str = ",", limit: int | None = None) -> Column:
    """Trimmed non-empty elements of a joined list; the text 'nan' counts as empty."""
    parts = F.transform(F.split(text_or_empty(c), re.escape(sep)), lambda x: F.trim(x))
    kept = F.filter(parts, lambda x: (x != "") & (F.lower(x) != "nan"))
    return F.slice(kept, 1, limit) if limit else kept


def fill_slots(template: Column, **slots: Column) -> Column:
    """Replace each `{name}` by its value; a slot the template lacks changes nothing."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def json_in_text(c: str | Column, schema: str) -> Column:
    """Parse the widest `{...}` part of a text; null struct fields where there is none or it is broken."""
    return F.from_json(F.regexp_extract(text_or_empty(c), r"(?s)\{.*\}", 0), schema)


def strip_suffix(c: str | Column, opener: str = "(") -> Column:
    """The text before the first `opener`, trimmed."""
    return F.trim(F.substring_index(as_column(c), opener, 1))


def one_decimal(c: str | Column) -> Column:
    return F.format_string("%.1f", F.round(as_column(c).cast("double"), 1))


def signed_percent(c: str | Column) -> Column:
    value = F.round(as_column(c).cast("double"), 1)
    return F.concat(F.when(value > 0, F.lit("+")).otherwise(F.lit("")), F.format_string("%.1f%%", value))


def thousands(c: str | Column) -> Column:
    return F.format_number(as_column(c), 0)


def percent_bar(c: str | Column, step: float = 2.0) -> Column:
    return F.repeat(F.lit("█"), F.floor(as_column(c) / step).cast("int"))
