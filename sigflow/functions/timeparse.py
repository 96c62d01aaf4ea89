"""Parsing of the feed's ``dd MM yyyy HH:mm`` text without legacy parser flags.

The feed was parsed with Spark's lenient (LEGACY) parser. For this pattern it
behaves as follows (observed on Spark 4.1.2 with the LEGACY policy):

* each field is a run of ASCII digits of any length: ``001`` is 1, ``02018``
  is 2018, and a year is taken literally (``18`` is year 18, ``20180`` is
  year 20180);
* each blank of the pattern must be a real blank, after which any run of
  Java whitespace is skipped; whitespace before the first field is skipped;
* the calendar is strict (day 32, month 13, hour 24, minute 60 and 29
  February of a common year are invalid);
* text after the last field is ignored, so a bare ``dd MM yyyy`` has a date
  but no timestamp.

Under the Spark 4 parser the same input raises or is null, so the rule is
rebuilt from public functions: the field prefix is cut out with a regular
expression, its digit runs are read once, and the value is built with
``try_make_timestamp`` (null when the calendar rejects it).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A field: optional Java whitespace, then digits.
_FIELD = r"\p{javaWhitespace}*\d+"
_DATE_PREFIX = rf"^{_FIELD} {_FIELD} {_FIELD}"
_TS_PREFIX = rf"^{_FIELD} {_FIELD} {_FIELD} {_FIELD}:{_FIELD}"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fields(text: Column, prefix: str, n: int) -> list[Column]:
    """The first ``n`` digit runs of the prefix as ints (null when absent)."""
    digits = F.regexp_extract_all(F.regexp_extract(text, prefix, 0), F.lit(r"(\d+)"), 1)
    return [F.try_element_at(digits, F.lit(i)).try_cast("int") for i in range(1, n + 1)]


def _calendar_year(year: Column) -> Column:
    # Year 0 does not exist in the strict calendar. The guard sits on the
    # argument, not around the result, so the shared field extraction stays
    # a common subexpression and is computed once per row.
    return F.when(year >= 1, year)


def parse_signal_date(text: Column | str) -> Column:
    """Calendar date at the start of the raw text, or null."""
    day, month, year = _fields(_col(text), _DATE_PREFIX, 3)
    midnight = F.try_make_timestamp(_calendar_year(year), month, day, F.lit(0), F.lit(0), F.lit(0))
    return F.to_date(midnight)


def parse_signal_ts(text: Column | str) -> Column:
    """Minute timestamp at the start of the raw text, or null."""
    day, month, year, hour, minute = _fields(_col(text), _TS_PREFIX, 5)
    return F.try_make_timestamp(_calendar_year(year), month, day, hour, minute, F.lit(0))
