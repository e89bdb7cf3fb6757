"""Every operator as a named query over the shared test tables.

Each function takes a session and the folder of the tables and returns a
DataFrame. Dates leave as ISO text, as they do in the CSV exports.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.config import ScoringConfig
from tocsin.functions import numeric, periods
from tocsin.operators import (
    counts, datagen, novelty, quality, questions, ranking, reports, scoring, sqltext, staging,
)
from tocsin.plans import batch
from tocsin.schemas import RAW_DRUGS, RAW_TABLES, required_columns
from tocsin.sources import files, views
from tocsin.sources.bucketed import bucketed
from tocsin.sources.testtables import AS_OF, EVENT_COLUMNS, SCORING, TestTables
from tocsin.sources.workspace import fresh_path, written_once
from tocsin.streaming import rollup

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# A second set of thresholds, under which all three flags occur.
STRICT = replace(SCORING, investigate_at=50.0, monitor_at=35.0)
GUARD_AS_OF = date(2000, 12, 31)
GEN_END = date(2001, 10, 31)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def iso_dates(df: DataFrame) -> DataFrame:
    days = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({d: F.col(d).cast("string") for d in days})


def exported_changes(df: DataFrame) -> DataFrame:
    """Counts that may be NULL as doubles, the form they have in an exported table."""
    return df.withColumns(
        {c: F.col(c).cast("double") for c in ("prev_quarter_reports", "qoq_change")}
    )


# --- building blocks ------------------------------------------------------------------------


def _staged_entities(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    return staging.stage_entities(t.entities(), cfg.as_of)


def _events(t: TestTables, *columns: str, quarters: list[str] | None = None) -> DataFrame:
    """Cleaned events, all of them or those of some quarters."""
    start, end = periods.quarters_range(quarters) if quarters else (None, None)
    return staging.event_fields(t.events(*columns, start=start, end=end), AS_OF)


def _known_pairs(t: TestTables) -> DataFrame:
    events = _events(t, "drug_id", "reaction", "event_date")
    return novelty.known_pairs(events, t.entities())


def _flagged_events(t: TestTables, *columns: str, quarters: list[str] | None = None) -> DataFrame:
    """Event rows with their novelty flag."""
    start, end = periods.quarters_range(quarters) if quarters else (None, None)
    return staging.event_fields(_flagged_feed(t, *columns, start=start, end=end), AS_OF)


def _flagged_feed(
    t: TestTables, *columns: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """Raw events with their novelty flag, which they get while they are narrow."""
    known = written_once(_known_pairs(t), "known-pairs")
    return t.events(
        *columns, start=start, end=end, flagged=lambda rows: novelty.flag_events(rows, known)
    )


def _rollup(t: TestTables) -> DataFrame:
    """The quarter rollup, from one pass over the events."""
    events = _events(t, "drug_id", "event_date", "reaction", "is_serious")
    return novelty.novel_quarter_rollup(novelty.pair_cells(events), t.entities())


def _counts(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    """Period counts, from one pass over the events up to the end of the current quarter."""
    end = periods.quarters_range([cfg.current_quarter])[1]
    events = t.events("drug_id", "event_date", "reaction", "is_serious", end=end)
    states = novelty.pair_states(
        staging.event_fields(events, AS_OF), cfg.current_quarter, cfg.previous_quarter
    )
    return novelty.period_counts_of_pairs(states, t.entities())


def _units(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    start, end = periods.quarters_range([cfg.current_quarter])
    return scoring.period_units(
        staging.stage_quarterly_sales(t.sales(start, end)), cfg.current_quarter
    )


def _inputs(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    """One row per entity; written, because the snapshot reads it twice."""
    inputs = scoring.entity_inputs(_staged_entities(t, cfg), _counts(t, cfg), _units(t, cfg))
    return written_once(inputs, "entity-inputs")


def _snapshot(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    return scoring.entity_snapshot(_inputs(t, cfg))


def _watchlist(t: TestTables, cfg: ScoringConfig = SCORING) -> DataFrame:
    return scoring.score_snapshot(_snapshot(t, cfg), cfg)


def _breakdown(t: TestTables) -> DataFrame:
    """Counted by everything but novelty, which depends on entity and reaction alone."""
    keys = [k for k in reports.CELL_KEYS if k != "is_novel_reaction"]
    columns = [k for k in keys if k != "severity_bucket"] + ["event_date", "outcome"]
    events = _events(t, *columns, quarters=SCORING.last_quarters(4))
    cells = novelty.attach_novelty(counts.report_cells(events, *keys), _known_pairs(t))
    return reports.describe_cells(cells, t.entities())


def _trend(t: TestTables) -> DataFrame:
    sales = staging.stage_quarterly_sales(t.sales())
    return reports.quarterly_trend(_rollup(t), t.entities(), sales)


# --- sources and sinks ----------------------------------------------------------------------


@query
def csv_roundtrip_entities(spark: SparkSession, folder: str) -> DataFrame:
    declared = TestTables(spark, folder).entities().select(
        *[F.col(f.name).cast(f.dataType) for f in RAW_DRUGS.fields]
    )
    path = fresh_path(spark, "drugs-csv")
    files.write_csv(declared, path)
    return iso_dates(files.read_csv(spark, path, RAW_DRUGS))


@query
def csv_roundtrip_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    watchlist = _watchlist(TestTables(spark, folder))
    path = fresh_path(spark, "watchlist-csv")
    files.write_csv(scoring.ranked(watchlist), path)
    return iso_dates(files.read_csv(spark, path, watchlist.schema))


@query
def csv_roundtrip_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with quotes, commas and line breaks."""
    turns = TestTables(spark, folder).table("conversations")
    shaped = turns.select(
        "conv_id", "turn", "role",
        F.concat(F.col("text"), F.lit('\n"'), F.col("role"), F.lit('", said\r\n')).alias("text"),
    )
    path = fresh_path(spark, "texts-csv")
    files.write_csv(shaped, path)
    return files.read_csv(spark, path, shaped.schema, multi_line=True)


@query
def parquet_roundtrip_trend(spark: SparkSession, folder: str) -> DataFrame:
    trend = _trend(TestTables(spark, folder))
    path = fresh_path(spark, "trend-table")
    files.write_table(trend.limit(0), path, partition_by=["quarter"])
    files.write_table(trend, path, partition_by=["quarter"])
    return files.read_table(spark, path, trend.schema)


@query
def table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of landed tables, from the writes that landed them."""
    t = TestTables(spark, folder)
    home = fresh_path(spark, "landed")
    landed = {
        "raw_drugs": t.entities(),
        "raw_adverse_events": t.events("report_id", "drug_id", "event_date", "quarter"),
        "stg_quarterly_sales": staging.stage_quarterly_sales(t.sales()),
    }
    return files.counts_table(
        spark, {name: files.write_table(df, f"{home}/{name}") for name, df in landed.items()}
    )


@query
def row_count_audit(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    raw = {
        "raw_drugs": t.entities(),
        "raw_adverse_events": t.events("drug_id", "event_date"),
        "raw_sales_volume": t.sales(),
    }
    return batch.audit(raw, SCORING)


@query
def export_status(spark: SparkSession, folder: str) -> DataFrame:
    """The number of rows is what the tasks that wrote the file counted."""
    trend = _trend(TestTables(spark, folder))
    path = fresh_path(spark, "trend-csv")
    return files.export_status(spark, {"quarterly_trend.csv": files.write_csv(trend, path)})


@query
def adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    views.register_views({
        "raw_drugs": t.entities(),
        "raw_adverse_events": t.events(
            "drug_id", "event_date", "quarter", "outcome", "is_serious"
        ),
        "raw_sales_volume": t.sales(),
    })
    return views.run_sql(
        spark,
        """
        SELECT D.therapeutic_area, AE.outcome, COUNT(*) AS reports,
               SUM(AE.is_serious) AS serious_reports
        FROM raw_adverse_events AE
        JOIN raw_drugs D ON D.drug_id = AE.drug_id
        WHERE AE.event_date >= :since
        GROUP BY ALL
        """,
        {"since": date(2000, 1, 1)},
    )


# --- staging --------------------------------------------------------------------------------


@query
def stage_entities(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(_staged_entities(TestTables(spark, folder)))


@query
def stage_events(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    raw = _flagged_feed(t, *EVENT_COLUMNS)
    return iso_dates(staging.stage_events(raw, t.entities(), AS_OF))


@query
def stage_quarterly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stage_quarterly_sales(TestTables(spark, folder).sales())


@query
def severity_buckets(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(TestTables(spark, folder), "outcome", "event_date")
    return counts.report_cells(events, "outcome", "severity_bucket")


@query
def derive_novelty(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return iso_dates(_flagged_events(t, "report_id", "drug_id", "reaction", "event_date").select(
        "report_id", "drug_id", "reaction", "event_date", "is_novel_reaction"
    ))


@query
def derive_seriousness(spark: SparkSession, folder: str) -> DataFrame:
    events = TestTables(spark, folder).events("report_id", "outcome")
    return events.withColumn("is_serious", staging.is_serious_outcome(F.col("outcome")))


@query
def months_on_market(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    events = t.events("report_id", "drug_id", "event_date")
    return iso_dates(staging.months_on_market(events, t.entities()).select(
        "report_id", "drug_id", "event_date", "months_on_market"
    ))


@query
def reaction_initcap(spark: SparkSession, folder: str) -> DataFrame:
    raw = TestTables(spark, folder).events("report_id", "reaction", "event_date")
    return staging.event_fields(raw, AS_OF, title_case_reactions=True).select(
        "report_id", "reaction"
    )


# --- counts and portfolio -------------------------------------------------------------------


@query
def period_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _counts(TestTables(spark, folder))


@query
def period_counts_from_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    pair = [SCORING.current_quarter, SCORING.previous_quarter]
    columns = ("drug_id", "event_date", "quarter", "reaction", "is_serious")
    return counts.period_counts(_flagged_events(t, *columns, quarters=pair), *pair)


@query
def period_units(spark: SparkSession, folder: str) -> DataFrame:
    return _units(TestTables(spark, folder))


@query
def distinct_reactions(spark: SparkSession, folder: str) -> DataFrame:
    quarter = SCORING.current_quarter
    events = _events(
        TestTables(spark, folder), "drug_id", "event_date", "quarter", "reaction",
        quarters=[quarter],
    )
    return counts.distinct_reactions(events, quarter)


@query
def distinct_reactions_by_year(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct reactions per year from stored sketches of quarters, held against exact counts."""
    t = TestTables(spark, folder)
    events = _events(t, "drug_id", "event_date", "reaction")
    keys = ["drug_id", "event_year"]
    sketches = written_once(
        counts.reaction_sketches(events, *keys, "event_quarter_num"), "sketches"
    )
    exact = events.groupBy(*keys).agg(F.count_distinct("reaction").alias("exact"))
    about = F.col("distinct_reactions")
    close = F.abs(about - F.col("exact")) <= F.col("exact") * 0.05
    return counts.united_reactions(sketches, *keys).join(exact, keys).select(
        *keys, "exact", close.alias("within_5_percent")
    )


@query
def portfolio_avg_rate(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return scoring.portfolio_average(_counts(t), _units(t))


@query
def portfolio_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return _snapshot(TestTables(spark, folder)).select(
        "drug_id", "rate_per_1k", "portfolio_avg_rate"
    )


@query
def entity_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(_snapshot(TestTables(spark, folder)).select(
        "drug_id", "drug_name", "launch_date", "months_since_launch", "total_reports",
        "serious_reports", "novel_reports", "prev_reports", "units_sold", "serious_pct",
        "novel_pct", "rate_per_1k", "portfolio_avg_rate",
    ))


# --- scores and watchlist -------------------------------------------------------------------


def _score_query(column: str) -> None:
    def score(spark: SparkSession, folder: str) -> DataFrame:
        return _watchlist(TestTables(spark, folder)).select("drug_id", column)

    QUERIES[column] = score


for _column in (
    "score_reporting_rate", "score_severity", "score_novelty", "score_velocity",
    "composite_score", "signal_flag",
):
    _score_query(_column)


@query
def risk_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(scoring.ranked(_watchlist(TestTables(spark, folder))))


@query
def risk_watchlist_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """The watchlist with each entity's place in it."""
    order = [F.desc_nulls_last("composite_score"), F.asc("drug_id")]
    slim = _watchlist(TestTables(spark, folder)).select(
        "drug_id", "drug_name", "composite_score", "signal_flag"
    )
    return ranking.with_place(slim, order)


@query
def breakdown_ranked(spark: SparkSession, folder: str) -> DataFrame:
    """Entities and reactions by number of reports, most first, with places over all of them."""
    t = TestTables(spark, folder)
    cells = counts.report_cells(_events(t, "drug_id", "event_date", "reaction"), "drug_id", "reaction")
    order = [F.desc("report_count"), F.asc("drug_id"), F.asc_nulls_last("reaction")]
    return ranking.with_place(cells, order)


@query
def watchlist_strict_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(_watchlist(TestTables(spark, folder), STRICT))


@query
def watchlist_rounded_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(_watchlist(TestTables(spark, folder), replace(SCORING, round_inputs=True)))


def _inputs_with_missing_units(t: TestTables) -> DataFrame:
    """Suppliers with no credit balance sell nothing here, so their units are missing."""
    selling = t.table("supplier").filter(F.col("s_acctbal") > 0)
    units = _units(t).join(
        selling.select(F.col("s_suppkey").alias("drug_id")), "drug_id", "left_semi"
    )
    return written_once(
        scoring.entity_inputs(_staged_entities(t), _counts(t), units), "entity-inputs"
    )


@query
def watchlist_missing_units(spark: SparkSession, folder: str) -> DataFrame:
    """A component that is unknown scores the cap."""
    inputs = _inputs_with_missing_units(TestTables(spark, folder))
    return iso_dates(scoring.scored_entities(inputs, SCORING))


@query
def watchlist_zero_for_missing(spark: SparkSession, folder: str) -> DataFrame:
    """The same inputs, but an unknown component scores 0."""
    inputs = _inputs_with_missing_units(TestTables(spark, folder))
    return iso_dates(scoring.scored_entities(inputs, replace(SCORING, null_policy="zero")))


@query
def watchlist_slim(spark: SparkSession, folder: str) -> DataFrame:
    return iso_dates(scoring.watchlist_slim(_watchlist(TestTables(spark, folder))))


@query
def flag_roster(spark: SparkSession, folder: str) -> DataFrame:
    return reports.flag_roster(_watchlist(TestTables(spark, folder), STRICT))


@query
def kpi_cards(spark: SparkSession, folder: str) -> DataFrame:
    return reports.kpi_cards(_watchlist(TestTables(spark, folder), STRICT))


@query
def above_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return reports.above_threshold(
        _watchlist(TestTables(spark, folder), STRICT), STRICT.investigate_at
    )


@query
def preview_top20(spark: SparkSession, folder: str) -> DataFrame:
    watchlist = _watchlist(TestTables(spark, folder))
    order = [F.desc_nulls_last("composite_score"), F.asc("drug_id")]
    return reports.preview(watchlist.select("drug_id", "drug_name", "composite_score"), order)


# --- breakdown and trend --------------------------------------------------------------------


@query
def ae_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sorted_breakdown(_breakdown(TestTables(spark, folder)))


@query
def ae_breakdown_from_rows(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    quarters = SCORING.last_quarters(4)
    columns = [
        "drug_id", "event_date", "quarter", "reaction", "outcome", "reporter_type", "country",
        "age_group",
    ]
    return reports.ae_breakdown(
        _flagged_events(t, *columns, quarters=quarters), t.entities(), quarters
    )


@query
def reaction_bars(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reaction_bars(_breakdown(TestTables(spark, folder)))


@query
def severity_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.severity_share(_breakdown(TestTables(spark, folder)))


@query
def reporter_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reporter_breakdown(_breakdown(TestTables(spark, folder)))


@query
def quarterly_trend(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sorted_trend(_trend(TestTables(spark, folder)))


@query
def quarterly_trend_qoq(spark: SparkSession, folder: str) -> DataFrame:
    changes = reports.with_quarter_change(_trend(TestTables(spark, folder)))
    return reports.sorted_trend(exported_changes(changes))


@query
def quarterly_trend_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """By entity and reaction, where quarters without a report are common."""
    t = TestTables(spark, folder)
    events = _events(t, "drug_id", "event_date", "reaction")
    series = ("drug_id", "reaction")
    cells = events.groupBy(*series, "event_year", "event_quarter_num").agg(
        F.count(F.lit(1)).alias("total_reports")
    )
    return exported_changes(reports.with_quarter_change(cells, calendar=True, series=series))


@query
def quarterly_trend_bucketed(spark: SparkSession, folder: str) -> DataFrame:
    """The trend with changes from counted tables in buckets of the entity."""
    t = TestTables(spark, folder)
    events = _events(t, "drug_id", "event_date", "reaction", "is_serious")
    cells = bucketed(novelty.pair_cells(events), "drug_id", "cells")
    sales = bucketed(staging.stage_quarterly_sales(t.sales()), "drug_id", "sales")
    entities = bucketed(t.entities(), "drug_id", "entities")
    by_quarter = novelty.novel_quarter_rollup(cells, entities)
    trend = reports.trend_by_entity(by_quarter, entities, sales)
    return exported_changes(reports.with_quarter_change(trend))


@query
def quarterly_trend_dense(spark: SparkSession, folder: str) -> DataFrame:
    """Fatal reports by entity and reaction for every quarter since the first one."""
    t = TestTables(spark, folder)
    fatal = _events(t, "drug_id", "event_date", "reaction", "outcome").filter(
        F.col("outcome") == "Death"
    )
    series = ("drug_id", "reaction")
    cells = fatal.groupBy(*series, "event_year", "event_quarter_num").agg(
        F.count(F.lit(1)).alias("total_reports")
    )
    dense = reports.dense_quarters(cells, SCORING.current_quarter, series, ("total_reports",))
    return exported_changes(reports.with_quarter_change(dense, series=series))


@query
def trend_wide(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    quarters = SCORING.last_quarters(8)
    events = _events(t, "drug_id", "event_date", "quarter", quarters=quarters)
    rollup = counts.report_cells(events, "drug_id", "quarter").withColumnRenamed(
        "report_count", "total_reports"
    )
    return reports.trend_wide(rollup, quarters)


@query
def trend_lines(spark: SparkSession, folder: str) -> DataFrame:
    return reports.trend_lines(_trend(TestTables(spark, folder)))


# --- questions ------------------------------------------------------------------------------


@query
def qa_most_severe(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return questions.most_severe(_events(t, "drug_id", "event_date", "outcome"), t.entities())


@query
def qa_fatal_count(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    events = t.events("drug_id", "outcome")
    return questions.fatal_count(events, t.entities(), "Supplier#000000001")


@query
def qa_reactions_by_area(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    events = t.events("drug_id", "reaction")
    return questions.common_reactions(events, t.entities(), "ASIA")


@query
def qa_top_reactions_per_area(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return questions.top_reactions_per_area(t.events("drug_id", "reaction"), t.entities())


@query
def qa_top_entities_per_area_and_year(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return questions.top_entities_per_area_and_year(
        _events(t, "drug_id", "event_date"), t.entities()
    )


@query
def qa_top_reports_in_year(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    in_year = t.events("drug_id", "event_date", start=date(2000, 1, 1), end=date(2001, 1, 1))
    return questions.top_reports_in_year(
        staging.event_fields(in_year, AS_OF), t.entities(), 2000
    )


@query
def qa_compare_areas(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    events = t.events("drug_id", "is_serious")
    return questions.compare_areas(events, t.entities(), ["EUROPE", "ASIA"])


# --- quality --------------------------------------------------------------------------------


@query
def dq_duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(TestTables(spark, folder).events("report_id"), ["report_id"])


@query
def dq_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return (
        quality.key_audit(t.entities(), "raw_drugs", ["drug_id"])
        .unionByName(
            quality.key_audit(t.events("report_id"), "raw_adverse_events", ["report_id"])
        )
        .unionByName(
            quality.key_audit(t.sales(), "raw_sales_volume", ["drug_id", "year_month"])
        )
    )


@query
def dq_bitmap_key_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The same audit by bitmaps; entity and month make one number."""
    t = TestTables(spark, folder)
    month = periods.month_start(F.col("year_month"))
    month_no = F.year(month) * 12 + F.month(month)
    keyed = {
        "raw_drugs": (t.entities(), F.col("drug_id")),
        "raw_adverse_events": (t.events("report_id"), F.col("report_id")),
        "raw_sales_volume": (t.sales(), F.col("drug_id") * 100_000 + month_no),
    }
    audits = [quality.bitmap_key_audit(df, name, key) for name, (df, key) in keyed.items()]
    return reduce(DataFrame.unionByName, audits)


@query
def dq_null_counts(spark: SparkSession, folder: str) -> DataFrame:
    t = TestTables(spark, folder)
    return quality.null_counts(
        t.events(*EVENT_COLUMNS), "raw_adverse_events"
    ).unionByName(quality.null_counts(t.entities(), "raw_drugs", required_columns(RAW_DRUGS)))


@query
def orphan_events(spark: SparkSession, folder: str) -> DataFrame:
    """Only suppliers with a credit balance are known here, so that orphans exist."""
    t = TestTables(spark, folder)
    known = t.table("supplier").filter(F.col("s_acctbal") > 0)
    return quality.orphan_counts(
        t.events("drug_id"), known.select(F.col("s_suppkey").alias("drug_id"))
    )


@query
def guard_future_dates(spark: SparkSession, folder: str) -> DataFrame:
    return quality.guard_future_dates(TestTables(spark, folder).events("event_date"), GUARD_AS_OF)


# --- scalar functions -----------------------------------------------------------------------


@query
def scalar_caps(spark: SparkSession, folder: str) -> DataFrame:
    price, tax = F.col("l_extendedprice"), F.col("l_tax")
    fee = F.nullif(price * tax, F.lit(0.0))
    return TestTables(spark, folder).table("lineitem").select(
        "l_orderkey", "l_linenumber",
        numeric.round_half_away(price * F.col("l_discount"), 1).alias("discount_1dp"),
        numeric.round_half_away(price * (F.lit(1.0) - F.col("l_discount")) / 7, 2).alias("net_2dp"),
        fee.alias("fee_or_null"),
        F.coalesce(fee, F.lit(0.0)).alias("fee_or_zero"),
        F.least(F.lit(100.0), fee).alias("fee_capped"),
        F.greatest(F.lit(500.0), fee).alias("fee_at_least"),
        numeric.ratio(F.col("l_quantity"), F.col("l_linenumber") - 1).alias("safe_ratio"),
    )


@query
def scalar_casts(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_linenumber")
    return TestTables(spark, folder).table("lineitem").select(
        "l_orderkey", "l_linenumber",
        (number - 1).cast("boolean").alias("int_to_bool"),
        (F.col("l_returnflag") == "R").cast("int").alias("bool_to_int"),
        number.cast("string").alias("int_to_text"),
        F.concat(number.cast("string"), F.lit("0")).cast("int").alias("text_to_int"),
        F.coalesce(
            F.when(number > 3, number.cast("string")).otherwise(F.col("l_returnflag"))
            .try_cast("int"),
            F.lit(-1),
        ).alias("mixed_text_to_int"),
        number.cast("double").alias("int_to_double"),
    )


@query
def scalar_period(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    month = periods.year_month(day)
    return TestTables(spark, folder).table("orders").select(
        "o_orderkey",
        F.year(day).alias("event_year"),
        F.quarter(day).alias("event_quarter_num"),
        periods.months_between_starts(F.lit(date(1995, 1, 31)), day).alias("months"),
        month.alias("year_month"),
        F.left(month, F.lit(4)).alias("year_text"),
        periods.month_start(month).cast("string").alias("month_start"),
        periods.quarter_label(day).alias("quarter"),
        periods.in_year(day, 1997).alias("in_1997"),
    )


# --- SQL text -------------------------------------------------------------------------------


def _query_log(spark: SparkSession, folder: str) -> DataFrame:
    """Texts shaped like generated SQL around each message; a fifth stay as they are."""
    message = F.col("text")
    form = (F.col("conv_id") + F.col("turn")) % 5
    fence, line = F.lit("```"), F.lit("\n")
    text = (
        F.when(form == 0, F.col("text"))
        .when(form == 1, F.concat(
            F.lit("  "), fence, F.lit("sql\nSELECT AE.DRUG\\_ID from  ae JOIN D ON x = '"),
            message, F.lit("'\n"), fence, F.lit(" \n"),
        ))
        .when(form == 2, F.concat(
            F.lit("SELECT * FROM D -- "), message, line, F.lit("join\ts ON D.A = S.A; DROP"),
        ))
        .when(form == 3, F.concat(
            F.lit("\tselect 1 ; "), message, F.lit("; FROM AE"),
        ))
        .otherwise(F.concat(
            F.lit("SELECT '"), message, F.lit("' FROM DRUGS JOIN AE ON FROM_D = 1 JOIN SALES"),
        ))
    )
    return TestTables(spark, folder).table("conversations").select(
        "conv_id", "turn", text.alias("sql_text")
    )


@query
def normalise_sql_text(spark: SparkSession, folder: str) -> DataFrame:
    return _query_log(spark, folder).withColumn(
        "sql_text", sqltext.normalise_sql(F.col("sql_text"))
    )


@query
def qualify_sql_aliases(spark: SparkSession, folder: str) -> DataFrame:
    return _query_log(spark, folder).withColumn(
        "sql_text", sqltext.qualify_aliases(F.col("sql_text"), "SAFETY.RAW")
    )


@query
def clean_sql_text(spark: SparkSession, folder: str) -> DataFrame:
    """All rules in their order: fences, comments, escapes, first statement, table names."""
    return _query_log(spark, folder).withColumn(
        "sql_text", sqltext.clean_sql(F.col("sql_text"), "SAFETY.RAW")
    )


# --- generation -----------------------------------------------------------------------------


def _portfolio(t: TestTables) -> DataFrame:
    """Entities with what the generators need; every fourth one is flagged."""
    no = F.col("drug_id").cast("bigint")

    def one_of(lists: list[list[str]], index) -> F.Column:
        return F.get(F.array(*[F.array(*map(F.lit, v)) for v in lists]), index.cast("int"))

    area_no = (F.col("class_avg_serious_rate") * 10 - 3).cast("int")
    return t.entities().select(
        "*",
        (no * 7919 % 42201 + 9800).alias("monthly_units"),
        one_of(list(datagen.BASE_REACTIONS.values()), area_no).alias("base_reactions"),
        F.when(
            no % 4 == 0, one_of(list(datagen.NOVEL_REACTIONS.values()), F.floor(no / 4) % 3)
        ).alias("novel_reactions"),
    )


@query
def gen_month_spine(spark: SparkSession, folder: str) -> DataFrame:
    entities = TestTables(spark, folder).entities()
    return datagen.month_spine(entities, GEN_END).select("drug_id", "year_month")


@query
def gen_sales(spark: SparkSession, folder: str) -> DataFrame:
    return datagen.generate_sales(_portfolio(TestTables(spark, folder)), GEN_END)


@query
def gen_events(spark: SparkSession, folder: str) -> DataFrame:
    """One synthetic report for each order."""
    t = TestTables(spark, folder)
    reports_to_make = t.table("orders").select(F.col("o_orderkey").alias("report_id"))
    return iso_dates(datagen.generate_events(reports_to_make, _portfolio(t)))


@query
def gen_events_gapped_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One report for each order again, for a portfolio whose ids have gaps."""
    t = TestTables(spark, folder)
    reports_to_make = t.table("orders").select(F.col("o_orderkey").alias("report_id"))
    portfolio = _portfolio(t).filter(F.col("drug_id") % 7 != 0)
    return iso_dates(datagen.generate_events(reports_to_make, portfolio))


# --- streams --------------------------------------------------------------------------------

MICRO_BATCHES = 6


def _arriving(events: DataFrame, order: Column) -> DataFrame:
    """Events as a stream that brings them in that order, in several micro-batches."""
    spark = events.sparkSession
    inbox = fresh_path(spark, "inbox")
    events.repartitionByRange(MICRO_BATCHES, order).write.parquet(inbox)
    reader = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(inbox)


@query
def stream_trend(spark: SparkSession, folder: str) -> DataFrame:
    """The trend from events that arrive latest first, so that first dates change all the time."""
    t = TestTables(spark, folder)
    home = fresh_path(spark, "cells")
    events = t.events("drug_id", "reaction", "event_date", "is_serious")
    table = rollup.cell_table(spark, f"{home}/table", "BIGINT")
    arriving = _arriving(events, F.desc("event_date"))
    rollup.refresh(arriving, table, rollup.cell_rows, f"{home}/progress").awaitTermination()
    by_quarter = rollup.read_quarter_rollup(table, t.entities(), AS_OF)
    sales = staging.stage_quarterly_sales(t.sales())
    return reports.quarterly_trend(by_quarter, t.entities(), sales)


@query
def stream_novelty(spark: SparkSession, folder: str) -> DataFrame:
    """Novelty of all reports after the last of several batches has arrived."""
    t = TestTables(spark, folder)
    home = fresh_path(spark, "sightings")
    events = t.events("report_id", "drug_id", "reaction", "event_date")
    table = rollup.sighting_table(spark, f"{home}/table", "BIGINT")
    arriving = _arriving(events, F.desc("event_date"))
    rollup.refresh(arriving, table, rollup.sighting_rows, f"{home}/progress").awaitTermination()
    known = written_once(rollup.read_known_pairs(table, t.entities(), AS_OF), "known-pairs")
    flagged = novelty.flag_events(staging.event_fields(events, AS_OF), known)
    return iso_dates(flagged.select(*events.columns, "is_novel_reaction"))


# --- batch run ------------------------------------------------------------------------------


def _batch(spark: SparkSession, folder: str, output: str) -> DataFrame:
    """Write the raw feeds as compressed CSV, run the batch pipeline on them, read one of its tables.

    Events are written with their novelty, as a feed would bring it.
    """
    t = TestTables(spark, folder)
    home = fresh_path(spark, "batch")
    feeds = {
        "raw_drugs": t.entities(),
        "raw_adverse_events": _flagged_feed(t, *EVENT_COLUMNS),
        "raw_sales_volume": t.sales(),
    }
    for name, schema in RAW_TABLES.items():
        feed = feeds[name]
        columns = [
            (F.col(f.name) if f.name in feed.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
        path = f"{home}/in/{files.RAW_FILES[name]}"
        files.write_csv(feed.select(*columns), path, compression="gzip")
    batch.run_batch(spark, f"{home}/in", f"{home}/out", SCORING)
    found = files.read_table(spark, f"{home}/out/tables/{output}")
    return iso_dates(found.withColumn("drug_id", F.col("drug_id").cast("bigint")))


@query
def batch_watchlist(spark: SparkSession, folder: str) -> DataFrame:
    return _batch(spark, folder, "risk_watchlist")


@query
def batch_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    return _batch(spark, folder, "ae_breakdown")


@query
def batch_trend(spark: SparkSession, folder: str) -> DataFrame:
    return exported_changes(_batch(spark, folder, "quarterly_trend"))
