"""Cleaning a column of generated SQL texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tocsin.functions.text import WHITESPACE, strip_whitespace

# A character that belongs to a word, and the places where none stands.
_WORD = r"[\p{L}\p{N}_]"
_BEFORE = f"(?<!{_WORD})"
_AFTER = f"(?!{_WORD})"
_SPACE = f"[{WHITESPACE}]+"

# Keyword and alias to look for, in this order, and the table the alias means.
ALIASES = [
    ("FROM", "D", "RAW_DRUGS"),
    ("JOIN", "AE", "RAW_ADVERSE_EVENTS"),
    ("JOIN", "S", "RAW_SALES_VOLUME"),
    ("FROM", "AE", "RAW_ADVERSE_EVENTS"),
]


def strip_fences(sql: Column) -> Column:
    """Remove Markdown code fences and the white space around the rest."""
    bare = F.replace(F.replace(sql, F.lit("```sql"), F.lit("")), F.lit("```"), F.lit(""))
    return strip_whitespace(bare)


def strip_comments(sql: Column) -> Column:
    """Remove ``--`` comments up to the end of their line."""
    return F.regexp_replace(sql, F.lit(r"--[^\n]*"), F.lit(""))


def unescape_underscores(sql: Column) -> Column:
    return F.replace(sql, F.lit("\\_"), F.lit("_"))


def first_statement(sql: Column) -> Column:
    """The text before the first semicolon, trimmed; a text without one as it is."""
    before = strip_whitespace(F.substring_index(sql, ";", 1))
    return F.when(F.contains(sql, F.lit(";")), before).otherwise(sql)


def normalise_sql(sql: Column) -> Column:
    """Fences, comments, escapes, first statement."""
    return first_statement(unescape_underscores(strip_comments(strip_fences(sql))))


def qualify_aliases(sql: Column, schema: str | None = None) -> Column:
    """Write the full table name before a table alias that stands alone."""
    prefix = f"{schema}." if schema else ""
    for keyword, alias, table in ALIASES:
        sql = F.regexp_replace(
            sql,
            F.lit(f"(?iu){_BEFORE}{keyword}{_SPACE}{alias}{_AFTER}"),
            F.lit(f"{keyword} {prefix}{table} {alias}"),
        )
    return sql


def clean_sql(sql: Column, schema: str | None = None) -> Column:
    return qualify_aliases(normalise_sql(sql), schema)
