"""Text predicates that follow Python's notion of whitespace.

Python's ``str.strip()`` removes every character for which ``isspace()``
holds: the ASCII controls tab..carriage return, the separators 0x1C-0x1F,
NEL (0x85) and every Unicode space, line or paragraph separator (\\p{Z}).
Spark's ``trim`` removes only the blank, so the class is spelt out; it is
valid in both Java and RE2 regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WS_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(text: Column | str) -> Column:
    """True for null, empty or whitespace-only text."""
    t = _col(text)
    return t.isNull() | t.rlike(f"^{WS_CLASS}*$")


def strip_text(text: Column | str) -> Column:
    """Text without leading and trailing whitespace."""
    return F.regexp_replace(_col(text), f"^{WS_CLASS}+|{WS_CLASS}+$", "")
