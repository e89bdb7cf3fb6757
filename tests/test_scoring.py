"""Scores against published results, and the edge cases of their definition."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

from tocsin.config import ScoringConfig
from tocsin.operators import counts, scoring, staging

CFG = ScoringConfig(current_quarter="2024-Q1", as_of=date(2026, 5, 15))

# A published watchlist. Inputs: id, launch, benchmark, total, serious, novel,
# previous total, units. Results: months, serious %, novel %, rate, four scores, composite, flag.
PUBLISHED = [
    ("DRG001", "2022-04-01", 0.19, 18, 16, 16, 48, 54593,
     49, 88.9, 88.9, 0.33, 51.2, 100.0, 100.0, 0.0, 70.4, "Investigate"),
    ("DRG006", "2022-08-01", 0.14, 21, 20, 15, 37, 84449,
     45, 95.2, 71.4, 0.25, 38.6, 100.0, 100.0, 0.0, 66.6, "Investigate"),
    ("DRG004", "2022-11-01", 0.12, 12, 10, 8, 54, 93120,
     42, 83.3, 66.7, 0.13, 20.0, 100.0, 100.0, 0.0, 61.0, "Monitor"),
    ("DRG008", "2023-01-01", 0.15, 18, 4, 0, 52, 29940,
     40, 22.2, 0.0, 0.6, 93.3, 59.3, 0.0, 0.0, 48.7, "Monitor"),
    ("DRG012", "2020-05-01", 0.14, 15, 5, 0, 29, 58389,
     72, 33.3, 0.0, 0.26, 39.9, 95.2, 0.0, 0.0, 45.3, "Monitor"),
    ("DRG011", "2019-11-01", 0.16, 25, 10, 0, 36, 121285,
     78, 40.0, 0.0, 0.21, 32.0, 100.0, 0.0, 0.0, 44.6, "Monitor"),
    ("DRG007", "2018-02-01", 0.13, 22, 9, 0, 52, 158328,
     99, 40.9, 0.0, 0.14, 21.6, 100.0, 0.0, 0.0, 41.5, "Monitor"),
    ("DRG005", "2019-06-01", 0.11, 13, 4, 0, 49, 131052,
     83, 30.8, 0.0, 0.1, 15.4, 100.0, 0.0, 0.0, 39.6, "Clear"),
    ("DRG009", "2020-07-01", 0.17, 17, 3, 0, 39, 36701,
     70, 17.6, 0.0, 0.46, 71.9, 41.5, 0.0, 0.0, 36.1, "Clear"),
    ("DRG010", "2021-03-01", 0.09, 14, 2, 0, 43, 114826,
     62, 14.3, 0.0, 0.12, 18.9, 63.5, 0.0, 0.0, 27.9, "Clear"),
    ("DRG002", "2021-09-01", 0.21, 15, 3, 0, 38, 67238,
     56, 20.0, 0.0, 0.22, 34.6, 38.1, 0.0, 0.0, 23.7, "Clear"),
    ("DRG003", "2020-03-01", 0.23, 12, 1, 0, 42, 43598,
     74, 8.3, 0.0, 0.28, 42.7, 14.5, 0.0, 0.0, 17.9, "Clear"),
]
PUBLISHED_MEAN = 0.2577567688499889
RESULTS = [
    "months_since_launch", "serious_pct", "novel_pct", "rate_per_1k", "score_reporting_rate",
    "score_severity", "score_novelty", "score_velocity", "composite_score", "signal_flag",
]


def entities_of(spark, rows):
    """rows: id, launch, benchmark"""
    return spark.createDataFrame(
        [(i, i, "Area", "Use", date.fromisoformat(d), b) for i, d, b in rows],
        "drug_id STRING, drug_name STRING, therapeutic_area STRING, indication STRING, "
        "launch_date DATE, class_avg_serious_rate DOUBLE",
    )


def counts_of(spark, rows):
    """rows: id, total, serious, novel, previous"""
    return spark.createDataFrame(
        rows,
        "drug_id STRING, total_reports BIGINT, serious_reports BIGINT, novel_reports BIGINT, "
        "prev_reports BIGINT",
    )


def units_of(spark, rows):
    return spark.createDataFrame(rows, "drug_id STRING, quarterly_units_sold BIGINT")


def scored(spark, entities, counts_rows, units_rows, cfg=CFG):
    inputs = scoring.entity_inputs(
        staging.stage_entities(entities_of(spark, entities), cfg.as_of),
        counts_of(spark, counts_rows),
        units_of(spark, units_rows),
    )
    result = scoring.scored_entities(inputs, cfg)
    return {r.drug_id: r for r in result.collect()}


def published(spark):
    inputs = scoring.entity_inputs(
        staging.stage_entities(entities_of(spark, [r[:3] for r in PUBLISHED]), CFG.as_of),
        counts_of(spark, [(r[0], *r[3:7]) for r in PUBLISHED]),
        units_of(spark, [(r[0], r[7]) for r in PUBLISHED]),
    )
    return scoring.scored_entities(inputs, CFG)


def test_published_watchlist(spark):
    result = scoring.ranked(published(spark)).collect()
    assert [r.drug_id for r in result] == [r[0] for r in PUBLISHED]
    for row, expected in zip(result, PUBLISHED):
        assert tuple(row[c] for c in RESULTS) == expected[8:]
        assert row.portfolio_avg_rate == pytest.approx(PUBLISHED_MEAN, rel=1e-14)


def test_missing_inputs(spark):
    entities = [(i, "2020-01-01", 0.2) for i in ("none", "only_units", "only_reports", "zero_units", "full")]
    rows = scored(
        spark, entities,
        [("only_reports", 4, 1, 0, 2), ("zero_units", 4, 1, 0, 2), ("full", 10, 1, 0, 5)],
        [("only_units", 1000), ("zero_units", 0), ("full", 1000)],
    )
    # No reports at all: shares are unknown, and an unknown component scores the cap.
    assert (rows["none"].score_severity, rows["none"].score_novelty) == (100.0, 100.0)
    assert rows["none"].score_reporting_rate == 100.0 and rows["none"].score_velocity == 0.0
    assert rows["none"].units_sold == 1 and rows["none"].total_reports == 0
    # Units but no reports: the rate is known to be zero.
    assert rows["only_units"].score_reporting_rate == 0.0
    assert rows["only_units"].rate_per_1k == 0.0
    # No units, or zero units: the rate is unknown.
    for name in ("only_reports", "zero_units"):
        assert rows[name].rate_per_1k is None
        assert rows[name].score_reporting_rate == 100.0
    assert rows["only_reports"].units_sold == 1 and rows["zero_units"].units_sold == 0
    # The portfolio mean counts entities with both.
    assert rows["full"].portfolio_avg_rate == 10.0
    assert rows["full"].score_reporting_rate == 40.0


def test_missing_inputs_score_zero_on_request(spark):
    rows = scored(spark, [("none", "2020-01-01", 0.2)], [], [], replace(CFG, null_policy="zero"))
    row = rows["none"]
    assert (row.score_reporting_rate, row.score_severity, row.score_novelty) == (0.0, 0.0, 0.0)
    assert row.signal_flag == "Clear" and row.portfolio_avg_rate is None


@pytest.mark.parametrize(
    ("total", "previous", "score"),
    [(20, 10, 100.0), (15, 10, 50.0), (50, 10, 100.0), (5, 10, 0.0), (7, None, 0.0),
     (None, 3, 0.0), (4, 3, 33.3)],
)
def test_velocity(spark, total, previous, score):
    rows = scored(spark, [("a", "2020-01-01", 0.2)], [("a", total, 0, 0, previous)], [("a", 10)])
    assert rows["a"].score_velocity == score


@pytest.mark.parametrize(
    ("composite", "flag"),
    [(65.0, "Investigate"), (64.9, "Monitor"), (40.0, "Monitor"), (39.9, "Clear"), (0.0, "Clear")],
)
def test_thresholds_are_inclusive(spark, composite, flag):
    df = spark.createDataFrame([(composite,)], "composite_score DOUBLE")
    assert df.select(scoring.signal_flag(CFG)).first()[0] == flag


def test_flag_is_taken_from_the_rounded_composite(spark):
    df = spark.createDataFrame(
        [(100.0, 100.0, 0.0, -0.3)],
        "score_reporting_rate DOUBLE, score_severity DOUBLE, score_novelty DOUBLE, "
        "score_velocity DOUBLE",
    )
    row = df.withColumn("composite_score", scoring.composite_score(CFG)).withColumn(
        "signal_flag", scoring.signal_flag(CFG)
    ).first()
    assert row.composite_score == 65.0 and row.signal_flag == "Investigate"


def test_rounded_inputs_differ_from_unrounded(spark):
    entities = [("a", "2020-01-01", 0.19), ("b", "2020-01-01", 0.19)]
    reports = [("a", 18, 16, 16, 48), ("b", 21, 2, 1, 37)]
    units = [("a", 54593), ("b", 84449)]
    exact = scored(spark, entities, reports, units)
    rounded = scored(spark, entities, reports, units, replace(CFG, round_inputs=True))
    mean = round(exact["a"].portfolio_avg_rate, 2)
    assert rounded["a"].score_reporting_rate == round(0.33 / mean * 40, 1)
    assert rounded["b"].score_novelty == round(4.8 * 2, 1)
    assert exact["b"].score_novelty == round(1 / 21 * 200, 1)


def test_scores_stay_within_bounds_and_entities_appear_once(spark):
    rows = [(f"e{i}", i % 7 or None, i % 3, i % 5, i % 11 or None) for i in range(200)]
    result = scored(
        spark, [(r[0], "2020-01-01", (i % 9) / 10) for i, r in enumerate(rows)], rows,
        [(f"e{i}", i * 3 % 50) for i in range(0, 200, 2)],
    )
    assert len(result) == 200
    for row in result.values():
        for column in RESULTS[4:9]:
            assert 0.0 <= row[column] <= 100.0
        expected = (
            "Investigate" if row.composite_score >= 65
            else "Monitor" if row.composite_score >= 40 else "Clear"
        )
        assert row.signal_flag == expected


def test_mean_rate_does_not_depend_on_partitioning(spark):
    rows = [(f"e{i}", 1 + i * 37 % 101, 0, 0, 0) for i in range(500)]
    units = [(f"e{i}", 1 + i * 7919 % 10007) for i in range(500)]
    results = set()
    for parts in (1, 3, 8):
        left = counts_of(spark, rows).repartition(parts)
        right = units_of(spark, units).repartition(parts, "quarterly_units_sold")
        results.add(scoring.portfolio_average(left, right).first().avg_rate)
    assert len(results) == 1
    exact = sum(r[1] * 1000 / u[1] for r, u in zip(rows, units)) / 500
    assert results.pop() == pytest.approx(exact, rel=1e-13)


def test_period_counts_null_versus_zero(spark):
    events = spark.createDataFrame(
        [("a", "2024-Q1", True, False), ("a", "2024-Q1", False, False), ("b", "2023-Q4", True, True),
         ("c", "2023-Q3", True, True)],
        "drug_id STRING, quarter STRING, is_serious BOOLEAN, is_novel_reaction BOOLEAN",
    )
    rows = {r.drug_id: tuple(r)[1:] for r in counts.period_counts(events, "2024-Q1", "2023-Q4").collect()}
    assert rows == {"a": (2, 1, 0, None), "b": (None, None, None, 1)}


def test_config_rejects_bad_values():
    with pytest.raises(ValueError):
        ScoringConfig(current_quarter="2024Q1")
    with pytest.raises(ValueError):
        ScoringConfig(current_quarter="2024-Q1", null_policy="drop")


def test_slim_watchlist_shows_the_rounded_mean(spark):
    slim = scoring.watchlist_slim(published(spark))
    assert len(slim.columns) == 17
    assert slim.select(F.max("portfolio_avg_rate_per_1k")).first()[0] == 0.26
