"""Entity snapshot, component scores, composite and flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.config import ScoringConfig
from tocsin.functions.numeric import mean_rate_per_1k, ratio, round_half_away
from tocsin.operators.counts import COUNTS
from tocsin.schemas import WATCHLIST_COLUMNS

SNAPSHOT_COUNTS = [*COUNTS, "prev_reports"]


def period_units(quarterly_sales: DataFrame, quarter: str) -> DataFrame:
    return quarterly_sales.filter(F.col("quarter") == quarter).select(
        "drug_id", "quarterly_units_sold"
    )


# --- portfolio and snapshot -----------------------------------------------------------------


def portfolio_average(counts: DataFrame, units: DataFrame) -> DataFrame:
    """One row: mean reporting rate over entities with reports and units."""
    return counts.join(units, "drug_id").agg(
        mean_rate_per_1k(F.col("total_reports"), F.col("quarterly_units_sold")).alias("avg_rate")
    )


def entity_inputs(staged_entities: DataFrame, counts: DataFrame, units: DataFrame) -> DataFrame:
    """Every entity with its counts and units, NULL where it has none."""
    return staged_entities.join(counts, "drug_id", "left").join(units, "drug_id", "left")


def entity_snapshot(inputs: DataFrame) -> DataFrame:
    """Entity inputs with percentages, rate and the portfolio's mean rate.

    The mean rate is a scalar subquery over the same inputs, so they are read
    twice: write them first where they take long to compute. Columns whose
    names start with ``raw_`` keep the NULLs and unrounded values that the
    scores need.
    """
    mean = inputs.agg(mean_rate_per_1k(F.col("total_reports"), F.col("quarterly_units_sold")))
    joined = inputs.withColumn("avg_rate", mean.scalar())
    raw_total = F.col("raw_total")
    zero = F.lit(0).cast("bigint")
    counted = joined.withColumns({"raw_total": F.col("total_reports")}).withColumns({
        c: F.coalesce(F.col(c), zero)
        for c in SNAPSHOT_COUNTS
    })
    raw = counted.withColumns({
        "raw_rate": ratio(F.col("total_reports"), F.col("quarterly_units_sold")) * 1000,
        "raw_serious": ratio(F.col("serious_reports"), raw_total),
        "raw_novel": ratio(F.col("novel_reports"), raw_total),
        "raw_growth": ratio(
            F.col("total_reports") - F.col("prev_reports"), F.col("prev_reports")
        ),
    })
    return raw.withColumns({
        "units_sold": F.coalesce(F.col("quarterly_units_sold"), F.lit(1).cast("bigint")),
        "serious_pct": round_half_away(F.col("raw_serious") * 100, 1),
        "novel_pct": round_half_away(F.col("raw_novel") * 100, 1),
        "rate_per_1k": round_half_away(F.col("raw_rate"), 2),
        "portfolio_avg_rate": F.col("avg_rate"),
    }).drop("raw_total", "quarterly_units_sold", "avg_rate")


# --- component scores -----------------------------------------------------------------------


def _capped(score: Column, cfg: ScoringConfig) -> Column:
    """Round to one digit and cap; a NULL score becomes the cap, as LEAST skips NULL."""
    rounded = round_half_away(score, 1)
    if cfg.null_policy == "zero":
        rounded = F.coalesce(rounded, F.lit(0.0))
    return F.least(F.lit(cfg.cap), rounded)


def score_reporting_rate(cfg: ScoringConfig) -> Column:
    """Reporting rate against the portfolio mean; the mean itself scores 40."""
    rate, average = F.col("raw_rate"), F.col("portfolio_avg_rate")
    if cfg.round_inputs:
        rate, average = F.col("rate_per_1k"), round_half_away(average, 2)
    return _capped(rate / F.nullif(average, F.lit(0.0)) * cfg.benchmark_points, cfg)


def score_severity(cfg: ScoringConfig) -> Column:
    """Serious share against the class benchmark; the benchmark itself scores 40."""
    share = F.col("serious_pct") / 100.0 if cfg.round_inputs else F.col("raw_serious")
    benchmark = F.nullif(F.col("class_avg_serious_rate"), F.lit(0.0))
    return _capped(share / benchmark * cfg.benchmark_points, cfg)


def score_novelty(cfg: ScoringConfig) -> Column:
    """Share of novel reactions; half novel scores 100."""
    if cfg.round_inputs:
        return _capped(F.col("novel_pct") * (cfg.novelty_points / 100.0), cfg)
    return _capped(F.col("raw_novel") * cfg.novelty_points, cfg)


def score_velocity(cfg: ScoringConfig) -> Column:
    """Growth of reports over the previous quarter; no growth and no history score 0."""
    growth = round_half_away(F.col("raw_growth") * cfg.velocity_points, 1)
    return F.least(F.lit(cfg.cap), F.greatest(F.lit(0.0), growth))


def component_scores(snapshot: DataFrame, cfg: ScoringConfig) -> DataFrame:
    return snapshot.withColumns({
        "score_reporting_rate": score_reporting_rate(cfg),
        "score_severity": score_severity(cfg),
        "score_novelty": score_novelty(cfg),
        "score_velocity": score_velocity(cfg),
    })


def composite_score(cfg: ScoringConfig) -> Column:
    """Weighted sum of the four components, one digit."""
    return round_half_away(
        F.col("score_reporting_rate") * cfg.weight_rate
        + F.col("score_severity") * cfg.weight_severity
        + F.col("score_novelty") * cfg.weight_novelty
        + F.col("score_velocity") * cfg.weight_velocity,
        1,
    )


def signal_flag(cfg: ScoringConfig) -> Column:
    """Action for a composite score; the thresholds belong to the higher action."""
    score = F.col("composite_score")
    return (
        F.when(score >= cfg.investigate_at, "Investigate")
        .when(score >= cfg.monitor_at, "Monitor")
        .otherwise("Clear")
    )


def score_snapshot(snapshot: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """Snapshot to scored entities, in the watchlist's column order, unsorted."""
    scored = component_scores(snapshot, cfg).withColumn("composite_score", composite_score(cfg))
    return scored.withColumn("signal_flag", signal_flag(cfg)).select(*WATCHLIST_COLUMNS)


# --- watchlist ------------------------------------------------------------------------------


def scored_entities(inputs: DataFrame, cfg: ScoringConfig) -> DataFrame:
    return score_snapshot(entity_snapshot(inputs), cfg)


def ranked(watchlist: DataFrame) -> DataFrame:
    """Highest score first; equal scores by entity, so the order is total."""
    return watchlist.orderBy(F.desc_nulls_last("composite_score"), F.asc("drug_id"))


def watchlist_slim(watchlist: DataFrame) -> DataFrame:
    """The 17 columns a reader of the ranking needs, with the displayed portfolio mean."""
    return watchlist.select(
        "drug_id", "drug_name", "therapeutic_area", "indication", "launch_date",
        "months_since_launch", "total_reports", "serious_pct", "novel_pct",
        F.col("rate_per_1k").alias("reports_per_1k_units"),
        round_half_away(F.col("portfolio_avg_rate"), 2).alias("portfolio_avg_rate_per_1k"),
        "score_reporting_rate", "score_severity", "score_novelty", "score_velocity",
        "composite_score", "signal_flag",
    )
