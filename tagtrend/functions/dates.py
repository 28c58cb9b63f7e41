"""Lenient parsing and calendar expressions. All of them work on dates or zone-less timestamps, so the
result does not depend on the session time zone."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagtrend.functions.text import as_column

DATE_FORMATS = ("yyyy-MM-dd", "yyyy.MM.dd", "yyyy/MM/dd", "yyyyMMdd", "yyyy-M-d", "yyyy.M.d", "yyyy/M/d")
# A time of day may follow, after a blank or `T`, with or without seconds, their fraction and a zone.
_TIME = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?$"
EPOCH = "1970-01-01"


def lenient_date(c: str | Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The date under the first format that fits, else null; never an error.

    A format is only tried on texts of its shape: a failed parse costs far more than the shape test.
    """
    text = F.regexp_replace(F.trim(as_column(c)), _TIME, "")
    return F.coalesce(*[F.when(F.rlike(text, F.lit(_shape(f))), F.try_to_date(text, f)) for f in formats])


def _shape(date_format: str) -> str:
    """A pattern for the texts that a format can parse: a letter on its own stands for one digit or two."""
    def digits(m: re.Match) -> str:
        return r"\d{1,2}" if len(m[0]) == 1 else r"\d" * len(m[0])

    return "^" + re.sub(r"y+|M+|d+", digits, date_format.replace(".", "[.]")) + "$"


def lenient_number(c: str | Column) -> Column:
    return F.trim(as_column(c)).try_cast("double")


def epoch_seconds(c: str | Column) -> Column:
    """Seconds since 1970 of a date or zone-less timestamp, as double."""
    moment = as_column(c).cast("timestamp_ntz")
    gap = moment - F.lit(EPOCH).cast("timestamp_ntz")
    return gap.cast("interval second").cast("decimal(20,6)").cast("double")


def date_of_seconds(c: str | Column) -> Column:
    return F.date_add(F.lit(EPOCH).cast("date"), F.floor(as_column(c) / 86400).cast("int"))


def year_month(c: str | Column) -> Column:
    """`yyyy-MM` of a date. Formatted from the date's parts, which needs no time zone."""
    return F.substring(as_column(c).cast("date").cast("string"), 1, 7)


def shift_month(ym: str | Column, months: int) -> Column:
    """`yyyy-MM` plus a number of months, with year wrap."""
    return year_month(F.add_months(F.concat(as_column(ym), F.lit("-01")).cast("date"), months))
