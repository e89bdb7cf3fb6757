"""Declared schemas of the raw tables and column orders of the outputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, required: bool = False) -> T.StructField:
    return T.StructField(name, dtype, not required)


RAW_DRUGS = T.StructType([
    _field("drug_id", T.StringType(), True),
    _field("drug_name", T.StringType(), True),
    _field("therapeutic_area", T.StringType(), True),
    _field("indication", T.StringType()),
    _field("launch_date", T.DateType(), True),
    _field("class_avg_serious_rate", T.DoubleType(), True),
])

RAW_ADVERSE_EVENTS = T.StructType([
    _field("report_id", T.LongType(), True),
    _field("drug_id", T.StringType(), True),
    _field("drug_name", T.StringType()),
    _field("therapeutic_area", T.StringType()),
    _field("event_date", T.DateType(), True),
    _field("quarter", T.StringType()),
    _field("months_on_market", T.IntegerType()),
    _field("reaction", T.StringType(), True),
    _field("is_novel_reaction", T.IntegerType(), True),
    _field("outcome", T.StringType(), True),
    _field("is_serious", T.IntegerType(), True),
    _field("reporter_type", T.StringType()),
    _field("country", T.StringType()),
    _field("age_group", T.StringType()),
    _field("sex", T.StringType()),
])

RAW_SALES_VOLUME = T.StructType([
    _field("drug_id", T.StringType(), True),
    _field("year_month", T.StringType(), True),
    _field("units_sold", T.LongType(), True),
])

RAW_TABLES = {
    "raw_drugs": RAW_DRUGS,
    "raw_adverse_events": RAW_ADVERSE_EVENTS,
    "raw_sales_volume": RAW_SALES_VOLUME,
}

# Natural keys; storage does not enforce them, the quality operators check them.
RAW_KEYS = {
    "raw_drugs": ["drug_id"],
    "raw_adverse_events": ["report_id"],
    "raw_sales_volume": ["drug_id", "year_month"],
}

STAGED_EVENT_COLUMNS = [
    "report_id", "drug_id", "drug_name", "therapeutic_area", "event_date", "quarter",
    "event_year", "event_quarter_num", "months_on_market", "reaction", "is_novel_reaction",
    "outcome", "is_serious", "severity_bucket", "reporter_type", "country", "age_group", "sex",
]

WATCHLIST_COLUMNS = [
    "drug_id", "drug_name", "therapeutic_area", "indication", "launch_date",
    "months_since_launch", "class_avg_serious_rate", "total_reports", "serious_reports",
    "novel_reports", "prev_reports", "units_sold", "serious_pct", "novel_pct", "rate_per_1k",
    "portfolio_avg_rate", "score_reporting_rate", "score_severity", "score_novelty",
    "score_velocity", "composite_score", "signal_flag",
]

BREAKDOWN_KEYS = [
    "drug_id", "drug_name", "therapeutic_area", "quarter", "reaction", "is_novel_reaction",
    "severity_bucket", "reporter_type", "country", "age_group",
]

TREND_COLUMNS = [
    "drug_id", "drug_name", "therapeutic_area", "quarter", "event_year", "event_quarter_num",
    "total_reports", "serious_pct", "novel_pct", "units_sold", "reports_per_1k",
]


def required_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]
