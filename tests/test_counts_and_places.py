"""Sketches, bitmaps, dense and wide quarters, places and top rows per group."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tocsin.operators import counts, novelty, quality, questions, ranking, reports


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_sketches_add_up(spark):
    rng = random.Random(1)
    rows = [(f"D{rng.randint(0, 3)}", rng.randint(0, 7), f"r{rng.randint(0, 900)}") for _ in range(9000)]
    events = spark.createDataFrame(rows + [("D0", 0, None)], "drug_id STRING, q INT, reaction STRING")
    sketches = counts.reaction_sketches(events, "drug_id", "q")
    for quarters in (range(8), (2, 5), (3,)):
        some = sketches.where(F.col("q").isin(list(quarters)))
        for r in counts.united_reactions(some, "drug_id").collect():
            exact = len({x for d, q, x in rows if d == r.drug_id and q in quarters})
            assert abs(r.distinct_reactions - exact) <= 0.05 * exact


@pytest.mark.parametrize("keys", [
    [1, 2, 3], [], [None], [None, None, 4], [-5, -5, 0, 0, 0, 1], [32768, 32769, 32768],
    [(1 << 62) + 1, (1 << 62) + 1, -(1 << 62)],
    [i * 40_000 for i in range(50)] + [80_000, 80_000, 7],
])
def test_bitmaps_equal_grouped_keys(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "id LONG").repartition(3)
    by_bits = quality.bitmap_key_audit(df, "t", F.col("id")).first()
    assert by_bits == quality.key_audit(df, "t", ["id"]).first()


def test_bitmaps_shuffle_ranges_and_not_keys(spark):
    unique = spark.range(0, 200_000, 1, 4)
    audit = quality.bitmap_key_audit(unique, "t", F.col("id"))
    # Few ranges are sent to the keys, which stay where they are until they are grouped.
    text = plan(audit)
    assert "LeftSemi, BuildRight" in text and "hashpartitioning(range" not in text
    assert "SortMergeJoin" not in text
    assert audit.first().duplicate_keys == 0


def test_quarters_without_reports(spark):
    rollup = spark.createDataFrame(
        [("A", 2022, 4, 3, 1, 0), ("A", 2023, 3, 5, 2, 1), ("B", 2023, 4, 1, 1, 1),
         ("C", 2024, 1, 9, 9, 9)],
        "drug_id STRING, event_year INT, event_quarter_num INT, total_reports LONG, "
        "serious_reports LONG, novel_reports LONG",
    )
    dense = reports.dense_quarters(rollup, "2023-Q4")
    found = sorted((r.drug_id, r.quarter, r.total_reports, r.serious_reports, r.novel_reports)
                   for r in dense.collect())
    assert found == [
        ("A", "2022-Q4", 3, 1, 0), ("A", "2023-Q1", 0, 0, 0), ("A", "2023-Q2", 0, 0, 0),
        ("A", "2023-Q3", 5, 2, 1), ("A", "2023-Q4", 0, 0, 0), ("B", "2023-Q4", 1, 1, 1),
    ]
    change = {(r.drug_id, r.quarter): r.qoq_change
              for r in reports.with_quarter_change(dense).collect()}
    assert change["A", "2023-Q1"] == -3 and change["A", "2023-Q3"] == 5
    assert change["A", "2022-Q4"] is None and change["B", "2023-Q4"] is None


def test_declared_quarters_become_columns(spark):
    rows = [("A", "2023-Q4", 2), ("A", "2024-Q1", 3), ("B", "2023-Q3", 7), ("C", "2024-Q1", 1)]
    rollup = spark.createDataFrame(rows, "drug_id STRING, quarter STRING, total_reports LONG")
    wide = reports.trend_wide(rollup, ["2024-Q1", "2023-Q4"])
    assert wide.columns == ["drug_id", "reports_2024_q1", "reports_2023_q4"]
    assert sorted(tuple(r) for r in wide.collect()) == [("A", 3, 2), ("C", 1, 0)]


def test_places_over_many_partitions(spark):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "score INT, id INT").repartition(5)
    placed = ranking.with_place(df, [F.desc_nulls_last("score"), F.asc("id")])
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert {(r.score, r.id): r.place for r in placed.collect()} == {
        r: i for i, r in enumerate(order, 1)
    }
    assert "Window" not in plan(placed)
    assert ranking.with_place(df.limit(0), [F.asc("id")]).collect() == []


def test_top_rows_are_cut_on_both_sides_of_the_shuffle(spark):
    rows = [(f"g{i % 3}", i % 7, i) for i in range(300)]
    df = spark.createDataFrame(rows, "g STRING, n INT, id INT").repartition(4)
    top = questions.top_per_group(df, ["g"], [F.desc("n"), F.asc("id")], 4)
    expected = set()
    for g in ("g0", "g1", "g2"):
        some = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:4]
        expected |= {(*r, i) for i, r in enumerate(some, 1)}
    assert {tuple(r) for r in top.collect()} == expected
    text = plan(df.transform(lambda d: questions.top_per_group(d, ["g"], [F.desc("n")], 4)))
    limits = [i for i in range(len(text)) if text.startswith("WindowGroupLimit", i)]
    exchange = text.index("Exchange hashpartitioning(g")
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_period_counts_group_the_events_once(spark):
    start = date(2023, 1, 1)
    entities = spark.createDataFrame([("A", start), ("B", start)], "drug_id STRING, launch_date DATE")
    rows = [
        ("A", "x", date(2023, 2, 1), True), ("A", "x", date(2024, 2, 1), True),
        ("A", "y", date(2024, 3, 31), False), ("A", "y", date(2023, 12, 31), True),
        ("B", "x", date(2023, 10, 1), True), ("Z", "x", date(2024, 1, 1), True),
        ("B", "w", date(2022, 1, 1), None),
    ]
    events = spark.createDataFrame(
        rows, "drug_id STRING, reaction STRING, event_date DATE, is_serious BOOLEAN"
    )
    states = novelty.pair_states(events, "2024-Q1", "2023-Q4")
    found = novelty.period_counts_of_pairs(states, entities)
    assert sorted(tuple(r) for r in found.collect()) == [
        ("A", 2, 1, 1, 1), ("B", None, None, None, 1),
    ]
    assert plan(states).count("Exchange") == 1 and "Window" not in plan(found)
