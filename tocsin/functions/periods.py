"""Quarter labels, month arithmetic and the date ranges that let a filter reach the scan."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

_LABEL = re.compile(r"(\d{4})-Q([1-4])")


def parse_quarter(label: str) -> tuple[int, int]:
    match = _LABEL.fullmatch(label)
    if match is None:
        raise ValueError(f"quarter must look like '2024-Q1', not {label!r}")
    return int(match[1]), int(match[2])


def shift_quarter(label: str, by: int) -> str:
    year, quarter = parse_quarter(label)
    index = year * 4 + quarter - 1 + by
    return f"{index // 4:04d}-Q{index % 4 + 1}"


def previous_quarter(label: str) -> str:
    return shift_quarter(label, -1)


def last_quarters(label: str, n: int) -> list[str]:
    """``n`` labels ending with ``label``, newest first."""
    return [shift_quarter(label, -i) for i in range(n)]


def quarter_start(label: str) -> date:
    year, quarter = parse_quarter(label)
    return date(year, 3 * quarter - 2, 1)


def quarters_range(labels: list[str]) -> tuple[date, date]:
    """Half-open date range from the earliest to the end of the latest label."""
    ordered = sorted(labels)
    return quarter_start(ordered[0]), quarter_start(shift_quarter(ordered[-1], 1))


def as_of_date(as_of: date | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of)


def months_between_starts(earlier: Column, later: Column) -> Column:
    """Number of month boundaries crossed, so Jan 31 to Feb 1 is 1."""
    months = (F.year(later) * 12 + F.month(later)) - (F.year(earlier) * 12 + F.month(earlier))
    return months.cast("bigint")


def label_of(year: Column, quarter_num: Column) -> Column:
    """'YYYY-Qn' of a year and a quarter number."""
    return F.concat(year.cast("string"), F.lit("-Q"), quarter_num.cast("string"))


def quarter_label(day: Column) -> Column:
    """'YYYY-Qn' of a date."""
    return label_of(F.year(day), F.quarter(day))


def month_start(year_month: Column) -> Column:
    """First day of a 'YYYY-MM' text; a text that is no month is an error.

    A cast reads ISO dates much faster than a format pattern does.
    """
    return F.concat(year_month, F.lit("-01")).cast("date")


def year_month(day: Column) -> Column:
    """'YYYY-MM' text of a date."""
    return F.date_format(day, "yyyy-MM")


def in_year(day: Column, year: int) -> Column:
    """``year(day) = year`` written as a date range, which the Parquet scan can use."""
    return (day >= F.lit(date(year, 1, 1))) & (day < F.lit(date(year + 1, 1, 1)))


def quarter_index(year: Column, quarter_num: Column) -> Column:
    """Consecutive number of a calendar quarter."""
    return year * 4 + (quarter_num - 1)


def index_parts(index: Column) -> tuple[Column, Column]:
    """Year and quarter number of a ``quarter_index``."""
    return F.floor(index / 4).cast("int"), (index % 4 + 1).cast("int")
