"""Fixed questions about the events, with parameters bound by the caller.

Most severe and most reports in a year are asked of staged events, the others
of raw ones, future dates included. Where a question names its entities, the
events of all others fall away first; otherwise counts come before the joins
with the entity table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.functions.periods import in_year
from tocsin.operators.counts import report_cells
from tocsin.operators.staging import describe


def _top(df: DataFrame, count: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(count), F.asc(tie)).limit(k)


def top_per_group(
    df: DataFrame, groups: list[str], order: list[Column], k: int, place: str = "place"
) -> DataFrame:
    """The first ``k`` rows of each group in a total order, numbered from 1 in ``place``.

    Each task keeps ``k`` rows of a group at most before the shuffle, so a group that holds most of
    the rows sends no more than that from each.
    """
    number = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(place, number).filter(F.col(place) <= k)


def most_severe(events: DataFrame, entities: DataFrame, k: int = 1) -> DataFrame:
    """Entities with the most critical reports."""
    critical = events.filter(F.col("severity_bucket") == "Critical")
    counts = describe(report_cells(critical, "drug_id"), entities, "drug_name")
    return _top(counts.withColumnRenamed("report_count", "critical_reports"),
                "critical_reports", "drug_id", k)


def fatal_count(events: DataFrame, entities: DataFrame, drug_name: str) -> DataFrame:
    """Number of fatal outcomes of one named entity; 0 if it has none."""
    named = entities.filter(F.col("drug_name") == drug_name).select("drug_id")
    fatal = events.join(named, "drug_id", "left_semi").filter(F.col("outcome") == "Death")
    return fatal.agg(F.count(F.lit(1)).alias("fatal_reports")).select(
        F.lit(drug_name).alias("drug_name"), "fatal_reports"
    )


def common_reactions(
    events: DataFrame, entities: DataFrame, area: str, k: int = 5
) -> DataFrame:
    """The commonest reactions in a therapeutic area."""
    in_area = entities.filter(F.col("therapeutic_area") == area).select("drug_id")
    counts = report_cells(events.join(in_area, "drug_id", "left_semi"), "reaction")
    return _top(counts, "report_count", "reaction", k)


def top_reactions_per_area(events: DataFrame, entities: DataFrame, k: int = 5) -> DataFrame:
    """The commonest reactions in every therapeutic area at once."""
    cells = report_cells(events, "drug_id", "reaction")
    counts = (
        describe(cells, entities, "therapeutic_area")
        .groupBy("therapeutic_area", "reaction")
        .agg(F.sum("report_count").alias("report_count"))
    )
    order = [F.desc("report_count"), F.asc_nulls_last("reaction")]
    return top_per_group(counts, ["therapeutic_area"], order, k)


def top_entities_per_area_and_year(
    events: DataFrame, entities: DataFrame, k: int = 3
) -> DataFrame:
    """The entities with the most reports in every area and calendar year."""
    counts = describe(report_cells(events, "drug_id", "event_year"), entities)
    order = [F.desc("report_count"), F.asc("drug_id")]
    return top_per_group(counts, ["therapeutic_area", "event_year"], order, k)


def top_reports_in_year(
    events: DataFrame, entities: DataFrame, year: int, k: int = 1
) -> DataFrame:
    """Entities with the most reports in a calendar year."""
    counts = report_cells(events.filter(in_year(F.col("event_date"), year)), "drug_id")
    return _top(describe(counts, entities, "drug_name"), "report_count", "drug_id", k)


def compare_areas(events: DataFrame, entities: DataFrame, areas: list[str]) -> DataFrame:
    """Serious and all reports of the given therapeutic areas."""
    chosen = entities.filter(F.col("therapeutic_area").isin(areas))
    counts = events.join(chosen.select("drug_id"), "drug_id", "left_semi").groupBy("drug_id").agg(
        F.count(F.lit(1)).alias("total_reports"),
        F.sum(F.col("is_serious").cast("int")).alias("serious_reports"),
    )
    return (
        describe(counts, chosen, "therapeutic_area")
        .groupBy("therapeutic_area")
        .agg(
            F.sum("total_reports").alias("total_reports"),
            F.sum("serious_reports").alias("serious_reports"),
        )
    )
