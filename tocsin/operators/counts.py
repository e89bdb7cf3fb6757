"""Report counts: cells, rollups and period counts.

A *rollup* is any table with the three counts ``total_reports``,
``serious_reports`` and ``novel_reports`` for some keys. Rollups add up, so
they may be written once, united and summed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = ["total_reports", "serious_reports", "novel_reports"]
QUARTER_KEYS = ["drug_id", "quarter", "event_year", "event_quarter_num"]


def _as_count(flag: str) -> Column:
    return F.col(flag).cast("int").cast("bigint")


def report_cells(events: DataFrame, *keys: str) -> DataFrame:
    """Number of events for each combination of ``keys``."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("report_count"))


def unit_counts(events: DataFrame) -> DataFrame:
    """Each event as a rollup row of its own."""
    return events.withColumns({
        "total_reports": F.lit(1).cast("bigint"),
        "serious_reports": _as_count("is_serious"),
        "novel_reports": _as_count("is_novel_reaction"),
    })


def merge_rollups(rollup: DataFrame, *keys: str) -> DataFrame:
    """Add up rollup rows that agree in ``keys``."""
    return rollup.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in COUNTS])


def quarter_rollup(events: DataFrame) -> DataFrame:
    """Counts per entity and quarter; both trend and watchlist can be made from it."""
    return merge_rollups(unit_counts(events), *QUARTER_KEYS)


def counts_of_rollup(rollup: DataFrame, current: str, previous: str) -> DataFrame:
    """Current and previous period counts per entity, in one pass.

    A count is NULL where the entity has no row in that period, as in an outer
    join of the two periods.
    """
    in_current = F.col("quarter") == current
    in_previous = F.col("quarter") == previous
    return (
        rollup.filter(in_current | in_previous)
        .groupBy("drug_id")
        .agg(
            *[F.sum(F.when(in_current, F.col(c))).alias(c) for c in COUNTS],
            F.sum(F.when(in_previous, F.col("total_reports"))).alias("prev_reports"),
        )
    )


def period_counts(events: DataFrame, current: str, previous: str) -> DataFrame:
    """The same counts straight from event rows."""
    return counts_of_rollup(unit_counts(events), current, previous)


def distinct_reactions(events: DataFrame, quarter: str, approximate: bool = False) -> DataFrame:
    """Number of different reactions per entity in one quarter."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return (
        events.filter(F.col("quarter") == quarter)
        .groupBy("drug_id")
        .agg(count(F.col("reaction")).alias("distinct_reactions"))
    )


# --- distinct counts that add up ------------------------------------------------------------

#: Registers (as a power of two) of a sketch: an error of about 0.8 %, 16 KB at most.
SKETCH_BITS = 14


def reaction_sketches(events: DataFrame, *keys: str) -> DataFrame:
    """A sketch of the different reactions for each combination of ``keys``.

    Distinct counts do not add up, sketches do: stored by entity and quarter they give the count
    over any quarters without another look at the events.
    """
    return events.groupBy(*keys).agg(
        F.hll_sketch_agg("reaction", F.lit(SKETCH_BITS)).alias("reactions")
    )


def united_reactions(sketches: DataFrame, *keys: str) -> DataFrame:
    """About how many different reactions the sketches hold together, for each of fewer ``keys``."""
    united = F.hll_union_agg("reactions")
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(united).alias("distinct_reactions"))
