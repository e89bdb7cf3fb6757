"""Rounding, ratios and order-independent means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(value: Column, digits: int = 0) -> Column:
    """Round a double half away from zero by scaling it first.

    Spark's two-argument ``round`` rounds the shortest decimal text of a double
    (1.005 -> 1.01); the expected results round the scaled binary value
    (1.005 -> 1.0). Scaling and rounding to whole numbers gives those.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` as double; NULL when the denominator is zero."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def mean_rate_per_1k(reports: Column, units: Column) -> Column:
    """Aggregate: unweighted mean over rows of ``reports / units * 1000``, as double.

    A sum of doubles depends on the order in which partitions arrive, so it may
    differ in the last digits between runs. The sum here is a decimal(38,18),
    which has one result under any partitioning. Rows with no reports, no units
    or zero units do not count.
    """
    rate = (
        (reports.cast("bigint") * F.lit(1000)).cast("decimal(20,0)")
        / F.nullif(units.cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    )
    return (F.sum(rate) / F.nullif(F.count(rate), F.lit(0)).cast("decimal(20,0)")).cast("double")
