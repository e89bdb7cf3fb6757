"""Synthetic portfolio data as distributed jobs.

Every value is a function of a row's id, so the rows are the same under any
partitioning and after a lost executor.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.functions.hashing import hash_index, hash_uniform, weighted_choice
from tocsin.functions.numeric import round_half_away
from tocsin.functions.periods import quarter_label, year_month
from tocsin.operators.joins import join_lookup
from tocsin.operators.staging import is_serious_outcome
from tocsin.sources.workspace import written_once

# The make-up of the synthetic data.
MONTHLY_UNITS = {
    "DRG001": 18500, "DRG002": 22000, "DRG003": 14200, "DRG004": 31000,
    "DRG005": 45000, "DRG006": 28000, "DRG007": 52000, "DRG008": 9800,
    "DRG009": 12000, "DRG010": 38000, "DRG011": 41000, "DRG012": 19500,
}
VOLUME_NOISE = (0.92, 1.08)
SALES_END = date(2024, 3, 1)
BASE_REACTIONS = {
    "Oncology": ["Nausea", "Fatigue", "Alopecia", "Neutropenia"],
    "CNS": ["Headache", "Dizziness", "Insomnia", "Somnolence"],
    "Cardiology": ["Dizziness", "Hypotension", "Bradycardia", "Oedema"],
    "Infectious": ["Nausea", "Diarrhea", "Fatigue", "Headache"],
    "Autoimmune": ["Infection", "Headache", "Fatigue", "Nausea"],
}
NOVEL_REACTIONS = {
    "DRG001": ["Hepatotoxicity", "QT prolongation", "Dyspnea"],
    "DRG004": ["Serotonin syndrome", "Hallucination", "Akathisia"],
    "DRG006": ["Hyperkalaemia", "Renal impairment", "Angioedema"],
}
NOVEL_SHARE = 0.85
OUTCOMES = ["Non-serious", "Moderate", "Hospitalization", "Disability", "Death"]
OUTCOME_WEIGHTS = [0.45, 0.30, 0.14, 0.07, 0.04]
FLAGGED_OUTCOME_WEIGHTS = [0.05, 0.10, 0.38, 0.28, 0.19]
REPORTERS = ["Physician", "Consumer", "Pharmacist", "Other"]
REPORTER_WEIGHTS = [42, 28, 18, 12]
COUNTRIES = ["US", "DE", "GB", "FR", "JP", "CA"]
AGE_GROUPS = ["18-44", "45-64", "65-74", "75+"]
AGE_WEIGHTS = [15, 40, 30, 15]
SEXES = ["F", "M", "U"]
EVENTS_FROM = date(2020, 1, 1)
EVENT_DAYS = 1501

# Hexadecimal digits of the hash by which entities are numbered.
BUCKET_DIGITS = 3

# One salt for each value drawn for a row.
(
    SALT_ENTITY, SALT_NOVEL, SALT_REACTION, SALT_OUTCOME, SALT_DAY,
    SALT_REPORTER, SALT_COUNTRY, SALT_AGE, SALT_SEX, SALT_VOLUME,
) = range(10)


def _lookup(table: dict, key: Column) -> Column:
    """The value of a small fixed table, NULL for a key it does not have."""
    found = F.lit(None)
    for name, value in table.items():
        entry = F.array(*map(F.lit, value)) if isinstance(value, list) else F.lit(value)
        found = F.when(key == name, entry).otherwise(found)
    return found


def demo_portfolio(entities: DataFrame) -> DataFrame:
    """Give the demo entities, read from their CSV, what the generators need."""
    return entities.select(
        "*",
        _lookup(MONTHLY_UNITS, F.col("drug_id")).alias("monthly_units"),
        _lookup(BASE_REACTIONS, F.col("therapeutic_area")).alias("base_reactions"),
        _lookup(NOVEL_REACTIONS, F.col("drug_id")).alias("novel_reactions"),
    )


def numbered(entities: DataFrame) -> DataFrame:
    """Give entities the numbers 0, 1, 2, ... in ``entity_no``, whatever their ids are.

    They are numbered within buckets of a hash of the id, and each bucket
    starts where those before it end, so no task sees all entities.
    """
    bucket = F.substring(F.md5(F.col("drug_id").cast("string")), 1, BUCKET_DIGITS)
    placed = entities.withColumn("_bucket", bucket)
    sizes = placed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy("drug_id"))
    return (
        placed.withColumn("_within", within)
        .join(starts, "_bucket")
        .withColumn("entity_no", F.col("_start") + F.col("_within") - 1)
        .drop("_bucket", "_start", "_within")
    )


def _required(value: Column, what: str) -> Column:
    """The value; a row without one fails the job."""
    message = F.concat(F.lit(f"no {what} for entity "), F.col("drug_id").cast("string"))
    return F.when(value.isNull(), F.raise_error(message)).otherwise(value)


def month_spine(entities: DataFrame, end: date) -> DataFrame:
    """One row per entity and month, from the month of launch to that of ``end``."""
    first = F.trunc("launch_date", "MM")
    months = F.when(
        first <= F.lit(end), F.sequence(first, F.lit(end), F.expr("INTERVAL 1 MONTH"))
    )
    return entities.withColumn("month", F.explode(months)).withColumn(
        "year_month", year_month(F.col("month"))
    )


def generate_sales(portfolio: DataFrame, end: date = SALES_END) -> DataFrame:
    """Monthly units: the entity's usual volume with some noise."""
    low, high = VOLUME_NOISE
    month_no = F.year("month") * 12 + F.month("month")
    noise = F.lit(low) + hash_uniform(
        F.col("entity_no") * 100000 + month_no, SALT_VOLUME
    ) * F.lit(high - low)
    units = _required(F.col("monthly_units"), "usual volume")
    return month_spine(numbered(portfolio), end).select(
        "drug_id",
        "year_month",
        round_half_away(units * noise).cast("bigint").alias("units_sold"),
    )


def generate_events(reports: DataFrame, portfolio: DataFrame) -> DataFrame:
    """One event report for each ``report_id``.

    An entity with ``novel_reactions`` is a flagged one; one without
    ``base_reactions`` fails the job. The numbered portfolio is written, because
    it is counted and joined; its size then says how it is joined.
    """
    key = F.col("report_id")
    entities = written_once(numbered(portfolio), "portfolio")
    size = entities.agg(F.count(F.lit(1))).scalar()
    drawn = reports.select(
        "report_id",
        hash_index(key, SALT_ENTITY, size).alias("entity_no"),
    )
    flagged = F.col("novel_reactions").isNotNull()
    novel = flagged & (hash_uniform(key, SALT_NOVEL) < NOVEL_SHARE)
    outcome_at = hash_uniform(key, SALT_OUTCOME)

    def pick(values: Column) -> Column:
        return F.get(values, hash_index(key, SALT_REACTION, F.size(values)).cast("int"))

    def any_of(values: list[str], salt: int) -> Column:
        return F.get(
            F.array(*map(F.lit, values)), hash_index(key, salt, F.lit(len(values))).cast("int")
        )

    base_reactions = _required(F.col("base_reactions"), "reactions")
    with_entity = join_lookup(drawn, entities, ["entity_no"]).select(
        "report_id", "drug_id", "drug_name", "therapeutic_area",
        F.date_add(
            F.lit(EVENTS_FROM), hash_index(key, SALT_DAY, F.lit(EVENT_DAYS)).cast("int")
        ).alias("event_date"),
        F.when(novel, pick(F.col("novel_reactions")))
        .otherwise(pick(base_reactions)).alias("reaction"),
        novel.cast("int").alias("is_novel_reaction"),
        F.when(flagged, weighted_choice(outcome_at, OUTCOMES, FLAGGED_OUTCOME_WEIGHTS))
        .otherwise(weighted_choice(outcome_at, OUTCOMES, OUTCOME_WEIGHTS)).alias("outcome"),
        weighted_choice(
            hash_uniform(key, SALT_REPORTER), REPORTERS, REPORTER_WEIGHTS
        ).alias("reporter_type"),
        any_of(COUNTRIES, SALT_COUNTRY).alias("country"),
        weighted_choice(hash_uniform(key, SALT_AGE), AGE_GROUPS, AGE_WEIGHTS).alias("age_group"),
        any_of(SEXES, SALT_SEX).alias("sex"),
    )
    return with_entity.select(
        "report_id", "drug_id", "drug_name", "therapeutic_area", "event_date",
        quarter_label(F.col("event_date")).alias("quarter"),
        F.lit(0).alias("months_on_market"),
        "reaction", "is_novel_reaction", "outcome",
        is_serious_outcome(F.col("outcome")).cast("int").alias("is_serious"),
        "reporter_type", "country", "age_group", "sex",
    )
