"""What the plans look like, and that they hold under skew and without broadcasts."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tocsin.operators import novelty, staging
from tocsin.plans.queries import QUERIES
from tocsin.schemas import RAW_DRUGS
from tocsin.sources.workspace import written_once

FOLDER = "/root/testdata/sf0.001"


def final_plan(df) -> str:
    """The plan as it ran, without the plan it started from."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    kept, skipping = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipping is not None and depth >= skipping:
            continue
        skipping = depth if "== Initial Plan ==" in line else None
        if skipping is None:
            kept.append(line)
    return "\n".join(kept)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_any_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert operator not in plan


def test_watchlist_reads_the_written_inputs_only(spark):
    """The mean rate is a subquery over the scored rows; neither computes the counts again."""
    plan = final_plan(QUERIES["risk_watchlist"](spark, FOLDER))
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2
    assert all("entity-inputs" in line and "l_suppkey" not in line for line in scans)


@pytest.mark.parametrize("name", ["period_counts", "quarterly_trend_qoq"])
def test_events_are_read_once(spark, name):
    """One scan of the events, with the columns that it needs; sales are a scan of their own."""
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_suppkey" in line]
    events = [line for line in scans if "l_partkey" in line]
    assert len(events) == 1
    assert not any("l_comment" in line or "l_extendedprice" in line for line in scans)
    if name == "period_counts":
        assert "LessThan(l_shipdate,2001-10-01" in events[0]


@pytest.mark.parametrize("name", [
    "quarterly_trend_qoq", "period_counts", "ae_breakdown", "kpi_cards", "qa_compare_areas",
    "gen_events",
])
def test_queries_are_lazy(spark, name):
    """Building a query runs one job at most, for rows that it writes and reads twice."""
    group = f"build-{name}"
    spark.sparkContext.setJobGroup(group, name)
    QUERIES[name](spark, FOLDER)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("rest", "rest")
    writes = name in ("kpi_cards", "gen_events")
    # An adaptive write runs its stages as jobs of their own.
    assert (len(jobs) > 0) == writes


def test_named_entities_come_before_the_orders(spark):
    """Events of other entities fall away below the join with the orders."""
    plan = QUERIES["qa_fatal_count"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    orders = next(i for i, line in enumerate(lines) if "o_orderkey" in line and "Join" in line)
    assert orders < semi


def test_year_question_is_a_date_range(spark):
    df = QUERIES["qa_top_reports_in_year"](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in plan


@pytest.fixture
def no_broadcast(spark):
    """Joins as they run on tables of any size, with thresholds that small data can reach."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    before = {k: spark.conf.get(k) for k in settings if k != adaptive}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    spark.conf.unset(adaptive)
    for key, value in before.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize(
    "name", ["risk_watchlist", "quarterly_trend_qoq", "ae_breakdown", "stage_events", "gen_events"]
)
def test_same_rows_without_broadcasts(spark, name, no_broadcast):
    large = sorted(map(str, QUERIES[name](spark, FOLDER).collect()))
    for key in ("spark.sql.autoBroadcastJoinThreshold",):
        spark.conf.set(key, "10MB")
    small = sorted(map(str, QUERIES[name](spark, FOLDER).collect()))
    assert large == small


def test_events_are_flagged_while_narrow(spark, no_broadcast):
    """No event row is shuffled by pair or by customer with the columns of its order."""
    plan = final_plan(QUERIES["stage_events"](spark, FOLDER))
    lines = plan.splitlines()
    dealt = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(drug_id" in line
             and "reaction" in line]
    assert dealt
    for i in dealt:
        assert not re.search("o_orderpriority|c_mktsegment|n_name|outcome", lines[i + 1])
    assert sum("hashpartitioning(o_custkey" in line for line in lines) == 1
    [by_customer] = [i for i, line in enumerate(lines) if "hashpartitioning(o_custkey" in line]
    assert "l_orderkey" not in "".join(lines[by_customer:by_customer + 3])


def hot_events(spark):
    """60,000 events; one entity has two thirds of them, and one of its reactions a third."""
    n = F.col("id")
    hot = n % 3 != 0
    return spark.range(0, 60000, 1, 8).select(
        n.alias("report_id"),
        F.when(hot, F.lit("E0"))
        .otherwise(F.concat(F.lit("E"), (n % 500).cast("string"))).alias("drug_id"),
        F.date_add(F.lit("2022-01-01").cast("date"), (n % 700).cast("int")).alias("event_date"),
        F.when(hot & (n % 2 == 0), F.lit("hot")).otherwise(
            F.concat(F.lit("r"), (n % 40).cast("string"))).alias("reaction"),
        F.lit("Death").alias("outcome"),
        F.repeat(F.sha2(n.cast("string"), 256), 2).alias("country"),
    )


def hot_entities(spark):
    n = F.col("id")
    return spark.range(500).select(
        F.concat(F.lit("E"), n.cast("string")).alias("drug_id"),
        F.concat(F.lit("name "), n.cast("string")).alias("drug_name"),
        F.lit("Area").alias("therapeutic_area"), F.lit("Use").alias("indication"),
        F.lit("2021-10-01").cast("date").alias("launch_date"),
        F.lit(0.2).alias("class_avg_serious_rate"),
    ).select(*RAW_DRUGS.fieldNames())


def test_row_level_joins_split_a_hot_entity(spark, no_broadcast):
    events, entities = hot_events(spark), hot_entities(spark)
    staged = staging.stage_events(events, entities)
    assert staged.count() == 60000
    assert "skew=true" in final_plan(staged.select("report_id", "drug_name", "country"))


def test_novelty_of_rows_splits_a_hot_pair(spark, no_broadcast):
    events, entities = hot_events(spark), hot_entities(spark)
    known = written_once(novelty.known_pairs(events, entities), "known")
    flagged = novelty.flag_events(events, known)
    plan = final_plan(flagged.select("report_id", "is_novel_reaction", "country"))
    assert "skew=true" in plan
    assert flagged.count() == 60000


def test_nothing_is_hinted(spark):
    """No plan forces a broadcast: the session's own limit decides."""
    for name in ("stage_events", "derive_novelty", "months_on_market", "gen_events"):
        plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in plan and "UnresolvedHint" not in plan


def test_counts_of_a_hot_entity_shuffle_partial_sums(spark):
    """Grouped counts combine before the shuffle: at most one row per task and group."""
    from tocsin.operators.counts import report_cells

    df = report_cells(hot_events(spark), "drug_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning.*\n.*HashAggregate\(keys=.*partial_count", plan)
    assert df.filter("drug_id = 'E0'").first().report_count > 40000


def test_bucketed_trend_moves_no_row(spark):
    """No join, group or window of the trend shuffles, also where nothing may be broadcast."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        trend = QUERIES["quarterly_trend_bucketed"](spark, FOLDER)
        plan = trend._jdf.queryExecution().executedPlan().toString()
        assert trend.count() > 0
    finally:
        spark.conf.set(limit, before)
    assert "SortMergeJoin" in plan and "Window" in plan and "Exchange" not in plan
