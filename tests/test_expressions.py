"""Column helpers against plain Python."""

from __future__ import annotations

from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tocsin.functions import hashing, numeric, periods
from tocsin.functions.text import strip_whitespace


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def values(spark, items, kind, expression):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i INT, x {kind}")
    rows = df.select("i", expression(F.col("x")).alias("y")).collect()
    return [y for _, y in sorted((r.i, r.y) for r in rows)]


@pytest.mark.parametrize(
    ("number", "digits", "rounded"),
    [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.25, 1, 0.3), (39.95, 1, 40.0),
     (None, 1, None)],
)
def test_round_half_away(spark, number, digits, rounded):
    assert value(spark, numeric.round_half_away(F.lit(number).cast("double"), digits)) == rounded


def test_ratio_of_zero_is_null(spark):
    assert value(spark, numeric.ratio(F.lit(1), F.lit(0))) is None
    assert value(spark, numeric.ratio(F.lit(1), F.lit(4))) == 0.25


def test_quarter_arithmetic():
    assert periods.previous_quarter("2024-Q1") == "2023-Q4"
    assert periods.last_quarters("2024-Q1", 4) == ["2024-Q1", "2023-Q4", "2023-Q3", "2023-Q2"]
    assert periods.quarters_range(["2024-Q1", "2023-Q4"]) == (date(2023, 10, 1), date(2024, 4, 1))
    with pytest.raises(ValueError):
        periods.parse_quarter("2024-Q5")


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(date(1990, 1, 1), date(2040, 12, 31)), min_size=50, max_size=200))
def test_date_expressions(spark, days):
    start = date(2000, 1, 31)
    assert values(spark, days, "DATE", periods.quarter_label) == [
        f"{d.year}-Q{(d.month - 1) // 3 + 1}" for d in days
    ]
    assert values(
        spark, days, "DATE", lambda c: periods.months_between_starts(F.lit(start), c)
    ) == [(d.year - start.year) * 12 + d.month - start.month for d in days]
    assert values(spark, days, "DATE", periods.year_month) == [f"{d:%Y-%m}" for d in days]
    assert values(spark, days, "DATE", lambda c: periods.in_year(c, 2024)) == [
        d.year == 2024 for d in days
    ]


def test_month_text(spark):
    assert value(spark, periods.month_start(F.lit("2024-02"))) == date(2024, 2, 1)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, periods.month_start(F.lit("2024-13")))


def test_month_boundary_counts_one(spark):
    months = periods.months_between_starts(F.lit(date(2024, 1, 31)), F.lit(date(2024, 2, 1)))
    assert value(spark, months) == 1


@settings(max_examples=10, deadline=None)
@given(st.lists(
    st.text(st.sampled_from(list("ab \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2003\u2028\u3000\u200b.")), max_size=12),
    min_size=100, max_size=300,
))
def test_strip_like_python(spark, texts):
    assert values(spark, texts, "STRING", strip_whitespace) == [t.strip() for t in texts]


def test_hash_is_uniform_and_repeatable(spark):
    ids = spark.range(200000).repartition(7)
    for salt in (0, 5):
        buckets = ids.groupBy(hashing.hash_index(F.col("id"), salt, F.lit(10)).alias("b")).count()
        shares = [r["count"] / 200000 for r in buckets.collect()]
        assert len(shares) == 10 and all(abs(s - 0.1) < 0.005 for s in shares)
    one, two = (
        ids.repartition(n).agg(F.sum(hashing.hash_residue(F.col("id"), 3))).first()[0]
        for n in (1, 5)
    )
    assert one == two


def test_hash_does_not_repeat_after_the_modulus(spark):
    far = spark.range(1000).select(
        *[
            hashing.hash_residue(F.col("id") + n * hashing.MODULUS, 1).alias(f"h{n}")
            for n in (0, 1, 2**20)
        ]
    ).collect()
    assert sum(len(set(r)) < 3 for r in far) < 3


def test_hash_accepts_any_bigint(spark):
    edges = spark.createDataFrame([(0,), (-1,), (2**63 - 1,), (-(2**63),)], "id BIGINT")
    for row in edges.select(hashing.hash_uniform(F.col("id"), 1).alias("u")).collect():
        assert 0.0 <= row.u < 1.0


def test_weighted_choice(spark):
    pick = hashing.weighted_choice(F.col("u"), ["a", "b", "c"], [1, 2, 1])
    df = spark.createDataFrame([(u,) for u in (0.0, 0.24, 0.25, 0.74, 0.75, 0.99)], "u DOUBLE")
    assert [r[0] for r in df.select(pick).collect()] == ["a", "a", "b", "b", "c", "c"]
