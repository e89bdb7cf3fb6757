"""Files, views, data generation, the batch run and the streaming refresh."""

from __future__ import annotations

import os
import uuid
from collections import Counter
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tocsin.__main__ import main
from tocsin.config import ScoringConfig
from tocsin.functions.periods import shift_quarter
from tocsin.operators import counts, datagen, staging
from tocsin.plans import batch
from tocsin.schemas import (
    BREAKDOWN_KEYS, RAW_ADVERSE_EVENTS, RAW_DRUGS, RAW_SALES_VOLUME, TREND_COLUMNS,
    WATCHLIST_COLUMNS,
)
from tocsin.sources import files, views, workspace
from tocsin.streaming.rollup import arriving_events, read_rollup, refresh_rollup

CFG = ScoringConfig(current_quarter="2024-Q1", as_of=date(2026, 5, 15))
AREAS = list(datagen.BASE_REACTIONS)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Raw CSV files of a generated portfolio of twelve."""
    path = tmp_path_factory.mktemp("data")
    entities = spark.createDataFrame(
        [(f"DRG{i:03d}", f'Name "{i}"', AREAS[i % 5], None if i == 2 else "a, b",
          date(2018 + i % 5, 1 + i % 12, 1), 0.1 + i / 100) for i in range(1, 13)],
        RAW_DRUGS,
    )
    files.write_csv(entities, f"{path}/drugs.csv")
    portfolio = datagen.demo_portfolio(files.read_csv(spark, f"{path}/drugs.csv", RAW_DRUGS))
    reports = spark.range(1, 4001).select(F.col("id").cast("int").alias("report_id"))
    files.write_csv(datagen.generate_events(reports, portfolio), f"{path}/adverse_events.csv")
    files.write_csv(datagen.generate_sales(portfolio), f"{path}/sales_volume.csv")
    return str(path)


def test_csv_keeps_quotes_commas_and_nulls(spark, folder):
    rows = {r.drug_id: r for r in files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS).collect()}
    assert rows["DRG001"].drug_name == 'Name "1"' and rows["DRG001"].indication == "a, b"
    assert rows["DRG002"].indication is None
    assert rows["DRG003"].launch_date == date(2021, 4, 1)


def test_malformed_csv_fails(spark, tmp_path):
    (tmp_path / "s.csv").write_text("drug_id,year_month,units_sold\nA,2024-01,many\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_csv(spark, str(tmp_path / "s.csv"), RAW_SALES_VOLUME).collect()


def test_generated_events(spark, folder):
    events = files.read_csv(spark, f"{folder}/adverse_events.csv", RAW_ADVERSE_EVENTS).collect()
    assert sorted(r.report_id for r in events) == list(range(1, 4001))
    share = Counter(r.drug_id for r in events)
    assert len(share) == 12 and all(250 < n < 420 for n in share.values())
    flagged = [r for r in events if r.drug_id in datagen.NOVEL_REACTIONS]
    normal = [r for r in events if r.drug_id not in datagen.NOVEL_REACTIONS]
    assert all(r.is_novel_reaction == 0 for r in normal)
    assert all(r.reaction in datagen.BASE_REACTIONS[r.therapeutic_area] for r in normal)
    novel = [r for r in flagged if r.is_novel_reaction]
    assert 0.80 < len(novel) / len(flagged) < 0.90
    assert all(r.reaction in datagen.NOVEL_REACTIONS[r.drug_id] for r in novel)
    assert 0.20 < sum(r.is_serious for r in normal) / len(normal) < 0.30
    assert 0.80 < sum(r.is_serious for r in flagged) / len(flagged) < 0.90
    assert min(r.event_date for r in events) >= date(2020, 1, 1)
    assert max(r.event_date for r in events) <= date(2024, 2, 9)
    for r in events:
        assert r.is_serious == (r.outcome in staging.SERIOUS_OUTCOMES)
        assert r.quarter == f"{r.event_date.year}-Q{(r.event_date.month - 1) // 3 + 1}"
    reporters = Counter(r.reporter_type for r in events)
    assert abs(reporters["Physician"] / 4000 - 0.42) < 0.03


def test_generated_sales(spark, folder):
    sales = files.read_csv(spark, f"{folder}/sales_volume.csv", RAW_SALES_VOLUME).collect()
    months = Counter(r.drug_id for r in sales)
    # DRG001 launched in February 2019: 62 months up to March 2024.
    assert months["DRG001"] == 62
    for r in sales:
        base = datagen.MONTHLY_UNITS[r.drug_id]
        assert base * 0.92 - 1 <= r.units_sold <= base * 1.08 + 1
    assert len({(r.drug_id, r.year_month) for r in sales}) == len(sales)


def test_rows_do_not_depend_on_partitioning(spark, folder):
    portfolio = datagen.demo_portfolio(files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS))
    reports = spark.range(1, 500).select(F.col("id").alias("report_id"))
    one = datagen.generate_events(reports.repartition(1), portfolio)
    many = datagen.generate_events(reports.repartition(7), portfolio.repartition(3))
    assert sorted(one.collect()) == sorted(many.collect())


def test_batch_run(spark, folder, tmp_path):
    status = [r.status for r in batch.run_batch(spark, folder, str(tmp_path), CFG).collect()]
    written = {n: spark.read.option("header", True).csv(f"{tmp_path}/{n}.csv") for n in batch.OUTPUTS}
    assert written["risk_watchlist"].columns == WATCHLIST_COLUMNS
    assert written["ae_breakdown"].columns == [*BREAKDOWN_KEYS, "report_count"]
    assert written["quarterly_trend"].columns == [
        *TREND_COLUMNS, "prev_quarter_reports", "qoq_change",
    ]
    assert sorted(status) == sorted(
        f"{n}.csv exported — {df.count()} rows" for n, df in written.items()
    )
    raw = files.read_raw(spark, folder)
    events = [r for r in raw["raw_adverse_events"].collect()]
    watchlist = files.read_table(spark, f"{tmp_path}/tables/risk_watchlist").collect()
    current = Counter(r.drug_id for r in events if r.quarter == "2024-Q1")
    previous = Counter(r.drug_id for r in events if r.quarter == "2023-Q4")
    serious = Counter(r.drug_id for r in events if r.quarter == "2024-Q1" and r.is_serious)
    assert len(watchlist) == 12
    for r in watchlist:
        assert (r.total_reports, r.prev_reports, r.serious_reports) == (
            current[r.drug_id], previous[r.drug_id], serious[r.drug_id]
        )
    trend = files.read_table(spark, f"{tmp_path}/tables/quarterly_trend")
    assert trend.agg(F.sum("total_reports")).first()[0] == 4000
    breakdown = files.read_table(spark, f"{tmp_path}/tables/ae_breakdown")
    last = [shift_quarter("2024-Q1", -i) for i in range(4)]
    assert breakdown.agg(F.sum("report_count")).first()[0] == sum(r.quarter in last for r in events)
    nulls = written["quarterly_trend"].filter("prev_quarter_reports IS NULL").count()
    assert nulls == 12


def test_audit_and_sql_over_views(spark, folder):
    raw = files.read_raw(spark, folder)
    staged = batch.staged_views(raw, CFG)
    found = {r.table_name: r.row_count for r in batch.audit(raw, CFG).collect()}
    assert found["raw_drugs"] == found["stg_drugs"] == 12
    assert found["raw_adverse_events"] == found["stg_adverse_events"] == 4000
    views.register_views({**raw, **staged})
    rows = views.run_sql(
        spark,
        "SELECT drug_name, COUNT(*) AS n FROM stg_adverse_events WHERE outcome = :outcome "
        "GROUP BY ALL ORDER BY n DESC LIMIT 3",
        {"outcome": "Death"},
    ).collect()
    assert len(rows) == 3 and rows[0].n >= rows[1].n
    quoted = views.run_sql(spark, "SELECT :name AS name", {"name": "Crohn's"}).first()
    assert quoted.name == "Crohn's"


def test_gaps_in_ids_lose_no_report(spark, folder):
    drugs = files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS)
    some = datagen.demo_portfolio(drugs).filter(F.col("drug_id").isin("DRG001", "DRG005", "DRG009"))
    reports = spark.range(3_000_000_000, 3_000_001_000).select(F.col("id").alias("report_id"))
    events = datagen.generate_events(reports, some)
    assert events.count() == 1000 == events.select("report_id").distinct().count()
    assert events.filter("reaction IS NULL").count() == 0


def test_unknown_area_fails(spark, folder):
    drugs = files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS)
    odd = datagen.demo_portfolio(drugs.withColumn("therapeutic_area", F.lit("Dermatology")))
    reports = spark.range(10).select(F.col("id").alias("report_id"))
    with pytest.raises(Exception, match="no reactions for entity"):
        datagen.generate_events(reports, odd).collect()


def test_ids_beyond_int(spark, folder, tmp_path):
    drugs = datagen.demo_portfolio(files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS))
    reports = spark.range(3_000_000_000, 3_000_000_010).select(F.col("id").alias("report_id"))
    files.write_csv(datagen.generate_events(reports, drugs), f"{tmp_path}/e.csv")
    found = files.read_csv(spark, f"{tmp_path}/e.csv", RAW_ADVERSE_EVENTS)
    assert found.agg(F.max("report_id")).first()[0] == 3_000_000_009


def arrive(spark, rows, inbox):
    files.write_csv(rows.coalesce(2), inbox + "-part")
    # Files arrive one by one in the folder that is watched.
    os.makedirs(inbox, exist_ok=True)
    for path in Path(inbox + "-part").glob("*.csv"):
        os.link(path, f"{inbox}/{uuid.uuid4().hex}.csv")


def test_streaming_refresh_equals_batch(spark, folder, tmp_path):
    raw = files.read_csv(spark, f"{folder}/adverse_events.csv", RAW_ADVERSE_EVENTS)
    raw = raw.withColumn("reaction", F.concat("reaction", F.lit(', "sharp", left')))
    inbox, rollup, checkpoint = (str(tmp_path / n) for n in ("inbox", "rollup", "checkpoint"))
    for part in range(3):
        arrive(spark, raw.filter(F.col("report_id") % 3 == part), inbox)
        refresh_rollup(arriving_events(spark, inbox), rollup, checkpoint).awaitTermination()
    # A refresh without new files changes nothing.
    refresh_rollup(arriving_events(spark, inbox), rollup, checkpoint).awaitTermination()
    # A report dated ahead counts once its day has come, whenever it arrived.
    for as_of in (date(2022, 1, 31), CFG.as_of):
        expected = counts.quarter_rollup(staging.event_fields(raw, as_of))
        assert sorted(read_rollup(spark, rollup, as_of).collect()) == sorted(expected.collect())
    with pytest.raises(ValueError, match="was not written with"):
        refresh_rollup(arriving_events(spark, inbox), rollup, str(tmp_path / "other"))


def test_command_line(spark, folder, tmp_path, capsys):
    data = tmp_path / "data"
    files.write_csv(files.read_csv(spark, f"{folder}/drugs.csv", RAW_DRUGS), f"{data}/drugs.csv")
    main(["generate", "--data", str(data), "--reports", "300"])
    period = ["--quarter", "2023-Q4", "--as-of", "2024-06-30"]
    main(["run", "--data", str(data), "--out", str(tmp_path / "out"), *period])
    shown = capsys.readouterr().out
    assert "risk_watchlist.csv exported — 12 rows" in shown and "signal_flag" in shown
    main(["sql", "--data", str(data), *period, "SELECT COUNT(*) AS n FROM stg_adverse_events"])
    assert "300" in capsys.readouterr().out
    every = "SELECT report_id FROM stg_adverse_events"
    main(["sql", "--data", str(data), *period, every])
    assert len(capsys.readouterr().out.split()) == 301
    main(["sql", "--data", str(data), *period, "--out", str(tmp_path / "all"), every])
    assert spark.read.option("header", True).csv(str(tmp_path / "all")).count() == 300


def test_approximate_distinct_reactions(spark, folder):
    events = files.read_csv(spark, f"{folder}/adverse_events.csv", RAW_ADVERSE_EVENTS)
    exact = {r.drug_id: r.distinct_reactions
             for r in counts.distinct_reactions(events, "2023-Q4").collect()}
    about = {r.drug_id: r.distinct_reactions
             for r in counts.distinct_reactions(events, "2023-Q4", approximate=True).collect()}
    assert exact.keys() == about.keys() and exact["DRG001"] <= 7
    assert all(abs(exact[k] - about[k]) <= 1 for k in exact)


def test_partitioned_table_is_replaced_and_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "2023-Q4"), (2, "2024-Q1")], "id INT, quarter STRING")
    files.write_table(first, path, ["quarter"])
    files.write_table(first.filter("id = 2"), path, ["quarter"])
    again = files.read_table(spark, path, first.schema)
    assert [tuple(r) for r in again.collect()] == [(2, "2024-Q1")]
    pruned = again.filter(F.col("quarter") == "2024-Q1")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarter" in plan


class _Session:
    """Stands for a session: its settings and its master."""

    def __init__(self, folder=None, master="spark://cluster"):
        self.conf = {workspace.CHECKPOINT_DIR: folder} if folder else {}
        self.sparkContext = self
        self.master = master


def test_workspace_is_the_sessions_folder():
    assert workspace.shared_folder(_Session("hdfs://shared/x/")) == "hdfs://shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.shared_folder(_Session())


def test_written_tables_are_kept_apart(spark):
    assert workspace.fresh_path(spark, "a") != workspace.fresh_path(spark, "a")
    assert workspace.written_once(spark.range(5), "five").count() == 5
