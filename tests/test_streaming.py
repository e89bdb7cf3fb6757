"""Maintained tables: any order of arrival, late first sightings, repeated batches, few folders."""

from __future__ import annotations

import os
import random
from collections import Counter
from datetime import date, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tocsin.operators import novelty, staging
from tocsin.sources.versions import Conflict
from tocsin.streaming import maintained, rollup

AS_OF = date(2024, 6, 30)
EVENT = "report_id LONG, drug_id STRING, reaction STRING, event_date DATE, is_serious BOOLEAN"
SUMS = "k STRING, n BIGINT"


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def sums(spark, path, most=3):
    return maintained.MaintainedTable(spark, str(path), SUMS, summed, most)


@pytest.fixture(scope="module")
def entities(spark):
    rows = [("A", date(2023, 1, 1)), ("B", date(2023, 6, 1)), ("C", date(2024, 1, 1))]
    return spark.createDataFrame(rows, "drug_id STRING, launch_date DATE")


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(2)
    start = date(2023, 1, 1)
    rows = [
        (i, rng.choice("ABCX"), f"reaction {rng.randint(0, 30)}",
         start + timedelta(days=rng.randint(0, 600)), rng.random() < 0.3)
        for i in range(400)
    ]
    return spark.createDataFrame(rows, EVENT)


def fed(spark, events, order, table, prepare, home):
    """Feed the events in an order, a few at a time, in two refreshes with one checkpoint."""
    ids = [r.report_id for r in events.orderBy(F.expr(order)).select("report_id").collect()]
    for half in (ids[:250], ids[250:]):
        for i in range(0, len(half), 50):
            events.where(F.col("report_id").isin(half[i : i + 50])).coalesce(1).write.mode(
                "append"
            ).parquet(f"{home}/inbox")
        arriving = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
        query = rollup.refresh(
            arriving.parquet(f"{home}/inbox"), table, prepare, f"{home}/progress"
        )
        query.awaitTermination()
    return table


@pytest.mark.parametrize("order", ["-datediff(event_date, DATE '2023-01-01')", "hash(report_id)"])
def test_novelty_and_rollup_in_any_order(spark, entities, events, tmp_path, order):
    home = str(tmp_path)
    sightings = fed(
        spark, events, order, rollup.sighting_table(spark, f"{home}/s/table"),
        rollup.sighting_rows, f"{home}/s",
    )
    cells = fed(
        spark, events, order, rollup.cell_table(spark, f"{home}/c/table"), rollup.cell_rows,
        f"{home}/c",
    )
    for as_of in (AS_OF, date(2023, 9, 30)):
        dated = staging.event_fields(events, as_of)
        known = novelty.known_pairs(dated, entities)
        expected = {r.report_id: r.is_novel_reaction
                    for r in novelty.flag_events(dated, known).collect()}
        maintained_pairs = rollup.read_known_pairs(sightings, entities, as_of)
        got = {r.report_id: r.is_novel_reaction
               for r in novelty.flag_events(dated, maintained_pairs).collect()}
        assert got == expected and len(set(got.values())) == 2
        whole = novelty.novel_quarter_rollup(novelty.pair_cells(dated), entities)
        assert sorted(rollup.read_quarter_rollup(cells, entities, as_of).collect()) == sorted(
            whole.collect()
        )


def test_late_first_sighting_turns_reports_known(spark, entities, tmp_path):
    table = rollup.sighting_table(spark, str(tmp_path))
    late = spark.createDataFrame([(2, "A", "rash", date(2023, 2, 1), False)], EVENT)
    first = spark.createDataFrame([(1, "A", "rash", date(2024, 2, 1), False)], EVENT)

    def flags():
        known = rollup.read_known_pairs(table, entities, AS_OF)
        return [r.is_novel_reaction for r in novelty.flag_events(first, known).collect()]

    table.add(rollup.sighting_rows(first), 0)
    assert flags() == [True]
    table.add(rollup.sighting_rows(late), 1)
    assert flags() == [False]


def test_number_of_parts_stays_small(spark, tmp_path):
    table, expected = sums(spark, tmp_path), Counter()
    for batch in range(30):
        rows = [("a", batch), ("b", 1), (f"k{batch % 4}", 2)]
        assert table.add(spark.createDataFrame(rows, SUMS), batch)
        for key, n in rows:
            expected[key] += n
        parts = len(table.log.latest()[1]["folders"])
        assert parts <= 2 * 4  # two of each size at most
    assert {r.k: r.n for r in table.read().collect()} == expected
    # Two entries stay readable, so little more than the parts is on disk.
    assert len(os.listdir(tmp_path / "data")) <= 16 and len(os.listdir(tmp_path / "log")) <= 8


def test_repeated_and_failed_batches(spark, tmp_path, monkeypatch):
    table = sums(spark, tmp_path)
    rows = spark.createDataFrame([("a", 1)], SUMS)
    assert table.add(rows, 0) and table.add(rows, 1)
    assert not table.add(rows, 1)  # run again after a failure behind the commit
    monkeypatch.setattr(table.log, "commit", lambda number, entry: False)
    with pytest.raises(Conflict):
        table.add(rows, 2)
    monkeypatch.undo()
    assert sums(spark, tmp_path).add(rows, 2)  # run again after a failure before it
    assert [tuple(r) for r in sums(spark, tmp_path).read().collect()] == [("a", 3)]


def test_a_task_merges_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    """However large a batch or a file, rows are dealt out before anything is grouped."""
    monkeypatch.setattr(maintained, "ROWS_OF_A_TASK", 100)
    table = rollup.cell_table(spark, str(tmp_path))
    day = F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 700).cast("int"))
    events = spark.range(0, 2000, 1, 1).select(
        F.concat(F.lit("A"), F.col("id") % 1).alias("drug_id"),
        F.concat(F.lit("r"), F.col("id") % 2).alias("reaction"), day.alias("event_date"),
        F.lit(True).alias("is_serious"),
    )
    for batch in range(2):
        table.add(rollup.cell_rows(events), batch)
    cells = table.read()
    plan = cells._jdf.queryExecution().executedPlan().toString()
    under = plan[plan.rindex("HashAggregate"):]
    assert "REPARTITION_BY_NUM" in under and "partial" in under
    assert {r.event_date: r.total_reports for r in cells.collect()} == {
        r.event_date: 2 * r["count"] for r in events.groupBy("event_date").count().collect()
    }
    [first, *_] = table.log.paths(table.log.latest()[1])
    rows = [len(pq.read_table(f)) for f in Path(first).glob("*.parquet")]
    assert sum(rows) == 700 and max(rows) <= 2 * 100


def test_nothing_has_arrived(spark, tmp_path):
    table = sums(spark, tmp_path)
    assert not table.exists() and table.read().collect() == []
    table.add(spark.createDataFrame([], SUMS), 0)
    assert table.exists() and table.read().collect() == []
