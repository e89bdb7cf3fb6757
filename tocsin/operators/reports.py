"""Breakdown, quarterly trend and the views a reviewer takes of them.

Each report counts events first and meets the entity table afterwards, so the
joins see one row per group and not one per event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tocsin.functions.numeric import ratio, round_half_away
from tocsin.functions.periods import index_parts, label_of, parse_quarter, quarter_index
from tocsin.operators.counts import COUNTS, report_cells
from tocsin.operators.staging import describe
from tocsin.schemas import BREAKDOWN_KEYS, TREND_COLUMNS

CELL_KEYS = [k for k in BREAKDOWN_KEYS if k not in ("drug_name", "therapeutic_area")]


# --- breakdown ------------------------------------------------------------------------------


def ae_breakdown(events: DataFrame, entities: DataFrame, quarters: list[str]) -> DataFrame:
    """Report counts by the ten breakdown keys, for the given quarters."""
    chosen = events.filter(F.col("quarter").isin(quarters))
    return describe_cells(report_cells(chosen, *CELL_KEYS), entities)


def describe_cells(cells: DataFrame, entities: DataFrame) -> DataFrame:
    """The breakdown's columns from cells counted by ``CELL_KEYS``."""
    return describe(cells, entities).select(*BREAKDOWN_KEYS, "report_count")


def sorted_breakdown(breakdown: DataFrame) -> DataFrame:
    """By entity and quarter, largest count first; the other keys settle ties."""
    ties = [F.asc_nulls_last(k) for k in CELL_KEYS if k not in ("drug_id", "quarter")]
    return breakdown.orderBy(
        F.asc_nulls_last("drug_id"), F.asc_nulls_last("quarter"), F.desc("report_count"), *ties
    )


def reaction_bars(breakdown: DataFrame, drug_id: object = None) -> DataFrame:
    """Reports by reaction and novelty, of one entity or of each."""
    chosen = breakdown if drug_id is None else breakdown.filter(F.col("drug_id") == drug_id)
    return chosen.groupBy("drug_id", "reaction", "is_novel_reaction").agg(
        F.sum("report_count").alias("report_count")
    )


def severity_share(breakdown: DataFrame) -> DataFrame:
    """Each severity bucket's share of its entity's reports, in percent."""
    counts = breakdown.groupBy("drug_id", "severity_bucket").agg(
        F.sum("report_count").alias("report_count")
    )
    of_entity = F.sum("report_count").over(Window.partitionBy("drug_id"))
    return counts.withColumn(
        "share_pct", round_half_away(ratio(F.col("report_count"), of_entity) * 100, 1)
    )


def reporter_breakdown(breakdown: DataFrame) -> DataFrame:
    return breakdown.groupBy("drug_id", "reporter_type").agg(
        F.sum("report_count").alias("report_count")
    )


# --- trend ----------------------------------------------------------------------------------


def quarterly_trend(
    rollup: DataFrame, entities: DataFrame, quarterly_sales: DataFrame
) -> DataFrame:
    """Counts, percentages, units and reporting rate per entity and quarter."""
    units = quarterly_sales.select("drug_id", "quarter", "quarterly_units_sold")
    return trend_figures(describe(rollup.join(units, ["drug_id", "quarter"], "left"), entities))


def trend_figures(described: DataFrame) -> DataFrame:
    """The trend's columns from counts, units and the entity's columns."""
    total = F.col("total_reports")
    sold = F.col("quarterly_units_sold")
    return described.withColumns({
        "serious_pct": round_half_away(ratio(F.col("serious_reports"), total) * 100, 1),
        "novel_pct": round_half_away(ratio(F.col("novel_reports"), total) * 100, 1),
        "units_sold": F.coalesce(sold, F.lit(0).cast("bigint")),
        "reports_per_1k": round_half_away(ratio(total, sold) * 1000, 2),
    }).select(*TREND_COLUMNS)


def units_by_entity(quarterly_sales: DataFrame) -> DataFrame:
    """One row per entity with ``units``, a map from quarter to units; as long as the calendar."""
    pairs = F.collect_list(F.struct("quarter", "quarterly_units_sold"))
    return quarterly_sales.groupBy("drug_id").agg(F.map_from_entries(pairs).alias("units"))


def trend_by_entity(
    rollup: DataFrame, entities: DataFrame, quarterly_sales: DataFrame
) -> DataFrame:
    """``quarterly_trend`` by joins on the entity alone, for tables that are laid out by it."""
    sold = F.try_element_at("units", F.col("quarter"))
    with_units = rollup.join(units_by_entity(quarterly_sales), "drug_id", "left").withColumn(
        "quarterly_units_sold", sold
    )
    return trend_figures(describe(with_units, entities))


def with_quarter_change(
    trend: DataFrame, calendar: bool = False, series: tuple[str, ...] = ("drug_id",)
) -> DataFrame:
    """Add the previous quarter's reports and the change, for each series of quarters.

    The previous quarter is the series' previous row. With ``calendar`` it is
    the calendar quarter before, and a series without a row there had 0.
    """
    order = Window.partitionBy(*series).orderBy("event_year", "event_quarter_num")
    previous: Column = F.lag("total_reports").over(order)
    if calendar:
        index = quarter_index(F.col("event_year"), F.col("event_quarter_num"))
        before = F.lag(index).over(order)
        previous = F.when(before == index - 1, previous).when(
            before.isNotNull(), F.lit(0).cast("bigint")
        )
    return trend.withColumn("prev_quarter_reports", previous).withColumn(
        "qoq_change", F.col("total_reports") - F.col("prev_quarter_reports")
    )


def dense_quarters(
    rollup: DataFrame,
    last: str,
    series: tuple[str, ...] = ("drug_id",),
    counts: tuple[str, ...] = tuple(COUNTS),
) -> DataFrame:
    """The rollup with a row of zeros for every quarter a series has no reports in.

    A series goes from its own first quarter to the quarter ``last``; later rows fall away.
    """
    year, quarter_num = parse_quarter(last)
    end = F.lit(year * 4 + quarter_num - 1)
    index = quarter_index(F.col("event_year"), F.col("event_quarter_num"))
    indexed = rollup.withColumn("quarter_index", index).filter(index <= end)
    spine = indexed.groupBy(*series).agg(F.min("quarter_index").alias("first")).select(
        *series, F.explode(F.sequence("first", end)).alias("quarter_index")
    )
    found_year, found_num = index_parts(F.col("quarter_index"))
    zero = F.lit(0).cast("bigint")
    return spine.join(
        indexed.select(*series, "quarter_index", *counts), [*series, "quarter_index"], "left"
    ).select(
        *series,
        label_of(found_year, found_num).alias("quarter"),
        found_year.alias("event_year"),
        found_num.alias("event_quarter_num"),
        *[F.coalesce(F.col(c), zero).alias(c) for c in counts],
    )


def trend_wide(rollup: DataFrame, quarters: list[str]) -> DataFrame:
    """One row per entity, with a column of reports for each of the declared quarters.

    A quarter without reports is 0. The columns are declared, so no job looks for them, and rows of
    other quarters fall away before the shuffle.
    """
    chosen = rollup.filter(F.col("quarter").isin(quarters))
    wide = chosen.groupBy("drug_id").pivot("quarter", quarters).agg(F.sum("total_reports"))
    zero = F.lit(0).cast("bigint")
    return wide.select(
        "drug_id",
        *[
            F.coalesce(F.col(f"`{q}`"), zero).alias("reports_" + q.lower().replace("-", "_"))
            for q in quarters
        ],
    )


def sorted_trend(trend: DataFrame) -> DataFrame:
    return trend.orderBy(
        *[F.asc_nulls_last(c) for c in ("drug_id", "event_year", "event_quarter_num")]
    )


def trend_lines(trend: DataFrame) -> DataFrame:
    """The two lines of the trend chart, one point per entity and quarter."""
    return trend.select("drug_id", "drug_name", "quarter", "total_reports", "serious_pct")


# --- watchlist views ------------------------------------------------------------------------


def kpi_cards(watchlist: DataFrame) -> DataFrame:
    """Entities and reports per flag."""
    return watchlist.groupBy("signal_flag").agg(
        F.count(F.lit(1)).alias("entities"),
        F.sum("total_reports").alias("total_reports"),
        F.sum("serious_reports").alias("serious_reports"),
        F.max("composite_score").alias("top_score"),
    )


def above_threshold(watchlist: DataFrame, threshold: float) -> DataFrame:
    """Score bars against a reference line, highest first."""
    return watchlist.select(
        "drug_id", "drug_name", "composite_score",
        (F.col("composite_score") >= threshold).alias("above_line"),
    ).orderBy(F.desc_nulls_last("composite_score"), F.asc("drug_id"))


def flag_roster(watchlist: DataFrame, flag: str | None = None) -> DataFrame:
    """The names under each flag, or under one, one row per entity.

    A flag may hold most of the portfolio, so its names are not gathered into
    one array.
    """
    chosen = watchlist if flag is None else watchlist.filter(F.col("signal_flag") == flag)
    return chosen.select("signal_flag", "drug_id", "drug_name").orderBy("signal_flag", "drug_id")


def preview(df: DataFrame, order: list[Column], rows: int = 20) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order).limit(rows)
