"""Whitespace handling for text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space at both ends of a text.
WHITESPACE = (
    r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_whitespace(text: Column) -> Column:
    """Remove white space of any kind at both ends (``trim`` removes only blanks)."""
    return F.regexp_replace(
        text, F.lit(f"\\A[{WHITESPACE}]+|(?<![{WHITESPACE}])[{WHITESPACE}]+\\z"), F.lit("")
    )
