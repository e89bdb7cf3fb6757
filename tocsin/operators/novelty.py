"""Which reactions of an entity are new, i.e. unseen in its first months on the market.

Novelty is a property of an (entity, reaction) pair: a pair is *known* if it
was seen before the end of the first months after launch, or before launch,
and novel otherwise. So it follows from the first date on which the pair was
seen, which a grouped count keeps at no extra cost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.functions.periods import label_of, quarters_range
from tocsin.operators.counts import COUNTS, QUARTER_KEYS
from tocsin.operators.joins import join_lookup

GRACE_MONTHS = 6
PAIR = ["drug_id", "reaction"]
QUARTER = ["event_year", "event_quarter_num"]


def _grace_end(months: int) -> Column:
    return F.add_months("launch_date", months)


def pair_cells(events: DataFrame) -> DataFrame:
    """Reports, serious reports and the first date of each pair and quarter.

    One pass over the events; novelty, period counts and trend all follow from
    these rows, of which there are as many as pairs and quarters.
    """
    return events.groupBy(*PAIR, *QUARTER).agg(
        F.count(F.lit(1)).alias("total_reports"),
        F.sum(F.col("is_serious").cast("int")).alias("serious_reports"),
        F.min("event_date").alias("first_seen"),
    )


def novel_quarter_rollup(
    cells: DataFrame, entities: DataFrame, months: int = GRACE_MONTHS
) -> DataFrame:
    """Quarter rollup (as ``counts.quarter_rollup``) of known entities, from pair cells."""
    seen = F.min("first_seen").over(Window.partitionBy(*PAIR))
    grace = entities.select("drug_id", _grace_end(months).alias("grace_end"))
    novel = (F.col("seen") >= F.col("grace_end")).cast("int") * F.col("total_reports")
    rollup = (
        cells.withColumn("seen", seen)
        .join(grace, "drug_id")
        .withColumn("novel_reports", novel)
        .groupBy("drug_id", *QUARTER)
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
    )
    label = label_of(F.col("event_year"), F.col("event_quarter_num"))
    return rollup.withColumn("quarter", label).select(*QUARTER_KEYS, *COUNTS)


def pair_states(events: DataFrame, current: str, previous: str) -> DataFrame:
    """The first date of each pair and its reports in two quarters, in one grouped pass.

    Unlike cells by quarter, a pair's events of all time combine into one row before the shuffle.
    """

    def within(quarter: str) -> Column:
        start, end = quarters_range([quarter])
        return (F.col("event_date") >= F.lit(start)) & (F.col("event_date") < F.lit(end))

    now = within(current)
    return events.groupBy(*PAIR).agg(
        F.min("event_date").alias("first_seen"),
        F.count_if(now).alias("total_reports"),
        F.count_if(now & F.col("is_serious")).alias("serious_reports"),
        F.count_if(within(previous)).alias("prev_reports"),
    )


def period_counts_of_pairs(
    states: DataFrame, entities: DataFrame, months: int = GRACE_MONTHS
) -> DataFrame:
    """Period counts (as ``counts.counts_of_rollup``) of known entities, from pair states."""
    grace = entities.select("drug_id", _grace_end(months).alias("grace_end"))
    total, novel = F.col("total_reports"), F.col("first_seen") >= F.col("grace_end")
    summed = (
        states.filter((total > 0) | (F.col("prev_reports") > 0))
        .join(grace, "drug_id")
        .withColumn("novel_reports", F.when(novel, total).otherwise(F.lit(0)))
        .groupBy("drug_id")
        .agg(*[F.sum(c).alias(c) for c in [*COUNTS, "prev_reports"]])
    )
    # An entity without reports in a quarter has no counts there.
    return summed.select(
        "drug_id",
        *[F.when(total > 0, F.col(c)).alias(c) for c in COUNTS],
        F.nullif("prev_reports", F.lit(0).cast("bigint")).alias("prev_reports"),
    )


def first_sightings(events: DataFrame) -> DataFrame:
    """The first event date of each (entity, reaction) pair."""
    return events.groupBy(*PAIR).agg(F.min("event_date").alias("first_seen"))


def known_pairs(
    events: DataFrame, entities: DataFrame, months: int = GRACE_MONTHS
) -> DataFrame:
    """The known (entity, reaction) pairs.

    Events after the end of the last grace period cannot matter and fall away
    first. The others are reduced to first sightings, one row per pair, and
    these meet the entity table.
    """
    grace = entities.select("drug_id", _grace_end(months).alias("grace_end"))
    last_day = grace.agg(F.max("grace_end")).scalar()
    early = events.select(*PAIR, "event_date").filter(F.col("event_date") < last_day)
    return known_sightings(first_sightings(early), entities, months)


def known_sightings(
    sightings: DataFrame, entities: DataFrame, months: int = GRACE_MONTHS
) -> DataFrame:
    """The known pairs among first sightings."""
    grace = entities.select("drug_id", _grace_end(months).alias("grace_end"))
    in_grace = F.col("first_seen") < F.col("grace_end")
    return sightings.join(grace, "drug_id").filter(in_grace).select(*PAIR)


def attach_novelty(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Give rows with (drug_id, reaction) the flag ``is_novel_reaction``.

    A row of an unknown entity counts as novel; staging drops such rows.
    """
    marked = known.withColumn("is_known", F.lit(True))
    joined = join_lookup(rows, marked, PAIR, "left")
    return joined.withColumn("is_novel_reaction", F.col("is_known").isNull()).drop("is_known")


def flag_events(events: DataFrame, known: DataFrame) -> DataFrame:
    """Give event rows the flag ``is_novel_reaction``.

    ``known`` should be a written table: both sides of the join then come
    straight from a shuffle, which lets adaptive execution split a hot pair.
    """
    return attach_novelty(events, known)

