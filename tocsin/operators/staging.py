"""From raw tables to staged ones."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.functions.periods import (
    as_of_date, index_parts, label_of, month_start, months_between_starts, quarter_index,
)
from tocsin.operators.joins import join_lookup
from tocsin.schemas import STAGED_EVENT_COLUMNS

# Outcomes and what they mean.
SERIOUS_OUTCOMES = ["Hospitalization", "Disability", "Death"]
SEVERITY_BUCKETS = {
    "Death": "Critical",
    "Disability": "Critical",
    "Hospitalization": "Serious",
    "Moderate": "Moderate",
}
OTHER_SEVERITY = "Mild"

# What staged events take from the entity table.
ENTITY_COLUMNS = ("drug_name", "therapeutic_area")


def is_serious_outcome(outcome: Column) -> Column:
    """True for a serious outcome, False for any other, also for an unknown one."""
    return F.coalesce(outcome.isin(SERIOUS_OUTCOMES), F.lit(False))


def severity_bucket(outcome: Column) -> Column:
    """Severity of an outcome; unknown and missing outcomes count as the mildest."""
    bucket = F.lit(OTHER_SEVERITY)
    for name, severity in SEVERITY_BUCKETS.items():
        bucket = F.when(outcome == name, severity).otherwise(bucket)
    return bucket


def not_future(day: Column, as_of: date | None) -> Column:
    return day <= as_of_date(as_of)


def stage_entities(entities: DataFrame, as_of: date | None = None) -> DataFrame:
    """The entity table with its age in months."""
    return entities.withColumn(
        "months_since_launch", months_between_starts(F.col("launch_date"), as_of_date(as_of))
    )


def event_fields(
    events: DataFrame, as_of: date | None = None, title_case_reactions: bool = False
) -> DataFrame:
    """The row-local half of event staging: guard the date, derive and type columns.

    It needs no join, so aggregates run on it directly and meet the entity
    table afterwards, with one row per group. Columns that the input does not
    have are not derived.
    """
    present = set(events.columns)
    derived = {
        "event_year": ("event_date", F.year("event_date")),
        "event_quarter_num": ("event_date", F.quarter("event_date")),
        "is_novel_reaction": ("is_novel_reaction", F.col("is_novel_reaction").cast("boolean")),
        "is_serious": ("is_serious", F.col("is_serious").cast("boolean")),
        "severity_bucket": ("outcome", severity_bucket(F.col("outcome"))),
    }
    if title_case_reactions:
        derived["reaction"] = ("reaction", F.initcap("reaction"))
    return events.filter(not_future(F.col("event_date"), as_of)).withColumns(
        {name: expr for name, (source, expr) in derived.items() if source in present}
    )


def describe(rows: DataFrame, entities: DataFrame, *columns: str) -> DataFrame:
    """Give aggregated rows the entity table's columns; unknown entities are dropped.

    The entity table is authoritative, so columns of the same name are replaced.
    """
    columns = columns or ENTITY_COLUMNS
    return rows.drop(*columns).join(entities.select("drug_id", *columns), "drug_id")


def stage_events(
    events: DataFrame,
    entities: DataFrame,
    as_of: date | None = None,
    title_case_reactions: bool = False,
) -> DataFrame:
    """All event rows of known entities, cleaned and enriched."""
    cleaned = event_fields(events, as_of, title_case_reactions).drop(*ENTITY_COLUMNS)
    staged = join_lookup(cleaned, entities.select("drug_id", *ENTITY_COLUMNS), ["drug_id"])
    return staged.select(*[c for c in STAGED_EVENT_COLUMNS if c in staged.columns])


def stage_quarterly_sales(sales: DataFrame) -> DataFrame:
    """Units per entity and calendar quarter, from months written as 'YYYY-MM'.

    Rows are grouped by the number of the quarter; its year, number and label
    are written on the groups.
    """
    month = month_start(F.col("year_month"))
    index = quarter_index(F.year(month), F.quarter(month)).alias("quarter_index")
    units = F.sum(F.col("units_sold").cast("bigint")).alias("quarterly_units_sold")
    year, quarter_num = index_parts(F.col("quarter_index"))
    return sales.groupBy("drug_id", index).agg(units).select(
        "drug_id",
        year.alias("sales_year"),
        quarter_num.alias("sales_quarter_num"),
        label_of(year, quarter_num).alias("quarter"),
        "quarterly_units_sold",
    )


def months_on_market(events: DataFrame, entities: DataFrame) -> DataFrame:
    """Events with the number of months from launch to the event."""
    with_launch = join_lookup(events, entities.select("drug_id", "launch_date"), ["drug_id"])
    months = months_between_starts(F.col("launch_date"), F.col("event_date"))
    return with_launch.withColumn("months_on_market", months).drop("launch_date")
