"""The batch pipeline: raw tables in, watchlist, breakdown and trend out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.config import ScoringConfig
from tocsin.operators import counts, quality, reports, scoring, staging
from tocsin.sources.files import (
    export_status, read_raw, read_table, row_counts, write_csv, write_table,
)

OUTPUTS = ["risk_watchlist", "ae_breakdown", "quarterly_trend"]


def staged_views(raw: dict[str, DataFrame], cfg: ScoringConfig) -> dict[str, DataFrame]:
    """The three staged tables, lazy, by the names SQL users know them by."""
    return {
        "stg_drugs": staging.stage_entities(raw["raw_drugs"], cfg.as_of),
        "stg_adverse_events": staging.stage_events(
            raw["raw_adverse_events"], raw["raw_drugs"], cfg.as_of
        ),
        "stg_quarterly_sales": staging.stage_quarterly_sales(raw["raw_sales_volume"]),
    }


def inputs_from_rollup(
    rollup: DataFrame, entities: DataFrame, quarterly_sales: DataFrame, cfg: ScoringConfig
) -> DataFrame:
    """What the scores need, from the quarter rollup."""
    return scoring.entity_inputs(
        staging.stage_entities(entities, cfg.as_of),
        counts.counts_of_rollup(rollup, cfg.current_quarter, cfg.previous_quarter),
        scoring.period_units(quarterly_sales, cfg.current_quarter),
    )


def land_raw(spark: SparkSession, data_dir: str, raw_dir: str) -> dict[str, DataFrame]:
    """Read the raw CSV files once and keep them as Parquet tables.

    Events are laid out by quarter, so a reader of some quarters opens their
    folders only, and every reader takes just the columns it needs.
    """
    landed = {}
    for name, df in read_raw(spark, data_dir).items():
        path = f"{raw_dir}/{name}"
        write_table(df, path, ["quarter"] if name == "raw_adverse_events" else None)
        landed[name] = read_table(spark, path, df.schema)
    return landed


def run_batch(spark: SparkSession, data_dir: str, out_dir: str, cfg: ScoringConfig) -> DataFrame:
    """Write the three outputs as tables and as CSV; return one status row for each.

    The events are read in full once, for the quarter rollup, which is written
    and then serves both watchlist and trend. The breakdown reads the last
    four quarters. Tables are replaced in one step, and the status rows come
    from the writes of the CSV files themselves.
    """
    raw = land_raw(spark, data_dir, f"{out_dir}/raw")
    entities = raw["raw_drugs"]
    events = staging.event_fields(raw["raw_adverse_events"], cfg.as_of)

    def table(name: str, df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        path = f"{out_dir}/tables/{name}"
        write_table(df, path, partition_by)
        return read_table(spark, path, df.schema)

    rollup = table("quarter_rollup", counts.quarter_rollup(events))
    sales = table(
        "stg_quarterly_sales", staging.stage_quarterly_sales(raw["raw_sales_volume"])
    )
    inputs = table("entity_inputs", inputs_from_rollup(rollup, entities, sales, cfg))
    outputs = {
        "risk_watchlist": table("risk_watchlist", scoring.scored_entities(inputs, cfg)),
        "ae_breakdown": table(
            "ae_breakdown",
            reports.ae_breakdown(events, entities, cfg.last_quarters(4)),
            partition_by=["quarter"],
        ),
        "quarterly_trend": table(
            "quarterly_trend",
            reports.with_quarter_change(reports.quarterly_trend(rollup, entities, sales)),
        ),
    }
    in_order = {
        "risk_watchlist": scoring.ranked,
        "ae_breakdown": reports.sorted_breakdown,
        "quarterly_trend": reports.sorted_trend,
    }
    return export_status(spark, {
        f"{name}.csv": write_csv(in_order[name](df), f"{out_dir}/{name}.csv")
        for name, df in outputs.items()
    })


def audit(raw: dict[str, DataFrame], cfg: ScoringConfig) -> DataFrame:
    """Row counts of both layers.

    Staged events are counted by entity before they meet the entity table, so no event row is
    joined.
    """
    entities, sales = raw["raw_drugs"], raw["raw_sales_volume"]
    dated = raw["raw_adverse_events"].filter(staging.not_future(F.col("event_date"), cfg.as_of))
    return row_counts({
        **raw,
        "stg_drugs": entities,
        "stg_adverse_events": quality.known_events(dated, entities),
        "stg_quarterly_sales": staging.stage_quarterly_sales(sales),
    })
