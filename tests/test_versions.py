"""Replacement in one step: failed, repeated and concurrent writers, old versions, counts."""

from __future__ import annotations

import os
import time

import pytest
from pyspark.sql import functions as F

from tocsin.sources import files
from tocsin.sources.versions import ReplaceableTable, VersionLog, counted_write


def ids(df):
    return sorted(r.id for r in df.collect())


def failing(spark, rows=1000, bad=997):
    """Rows of which a late one fails, after other tasks have written theirs."""
    message = F.raise_error(F.lit("broken row")).cast("long")
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") == bad, message).otherwise(F.col("id")).alias("id")
    )


def test_failed_write_leaves_the_old_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert files.write_table(spark.range(5), path) == 5
    reader = files.read_table(spark, path)
    with pytest.raises(Exception, match="broken row"):
        files.write_table(failing(spark), path)
    assert ids(files.read_table(spark, path)) == ids(reader) == [0, 1, 2, 3, 4]
    assert len(os.listdir(f"{path}/data")) == 1  # nothing of the failed write is left


def test_reader_keeps_its_version(spark, tmp_path):
    """A frame made before a replacement still has its files afterwards."""
    path = str(tmp_path / "t")
    files.write_table(spark.range(3), path)
    before = files.read_table(spark, path)
    files.write_table(spark.range(10, 14), path)
    assert ids(before) == [0, 1, 2]
    assert ids(files.read_table(spark, path)) == [10, 11, 12, 13]
    # A table may be replaced by rows made from itself.
    files.write_table(files.read_table(spark, path).where("id > 11"), path)
    assert ids(files.read_table(spark, path)) == [12, 13]


def test_old_versions_and_abandoned_folders_go(spark, tmp_path):
    table = ReplaceableTable(spark, str(tmp_path / "t"))
    for n in range(5):
        table.replace(spark.range(n + 1))
    assert table.rows() == 5 and len(os.listdir(tmp_path / "t" / "data")) == 2
    left = tmp_path / "t" / "data" / "left"
    left.mkdir()
    table.log.expire()
    assert left.exists()  # its writer may still be at work
    os.utime(left, (time.time() - 10**6,) * 2)
    table.log.expire()
    assert not left.exists() and ids(table.read()) == [0, 1, 2, 3, 4]


def test_unfinished_entry_is_passed_over(spark, tmp_path):
    table = ReplaceableTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(2))
    (tmp_path / "t" / "log" / f"{7:012d}.json").write_text('{"folders": ["data/x"')
    assert ids(table.read()) == [0, 1]
    table.replace(spark.range(3))
    assert table.log.latest()[0] == 8 and ids(table.read()) == [0, 1, 2]


def test_a_number_is_taken_once(spark, tmp_path):
    one, other = (VersionLog(spark, str(tmp_path / "t")) for _ in range(2))
    assert one.commit(1, {"folders": ["a"]})
    assert not other.commit(1, {"folders": ["b"]})
    assert other.latest() == (1, {"folders": ["a"]})


def test_missing_table_and_empty_rows(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_table(spark, str(tmp_path / "none"))
    empty = spark.range(5).where("id > 9")
    assert files.write_table(empty, str(tmp_path / "e")) == 0
    dealt = empty.limit(0).withColumn("k", F.col("id"))
    assert files.write_table(dealt, str(tmp_path / "e"), ["k"]) == 0
    assert ids(files.read_table(spark, str(tmp_path / "e"))) == []


def test_counts_come_from_the_write(spark, tmp_path):
    """One job for write and count, also behind a sort and a rebalance."""
    jobs = []
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "")
    try:
        rows = spark.range(0, 1000, 1, 4).select("id", (F.col("id") % 3).alias("k"))
        assert counted_write(rows, lambda df: df.write.parquet(str(tmp_path / "p"))) == 1000
        jobs = tracker.getJobIdsForGroup("counted")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert files.write_csv(rows.orderBy("k"), str(tmp_path / "c")) == 1000
    assert files.write_table(rows, str(tmp_path / "t"), ["k"]) == 1000
    status = files.export_status(spark, {"a.csv": 3}).first().status
    assert status == "a.csv exported — 3 rows"


def test_compressed_csv_comes_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    """A compressed file cannot be split, so none holds more than a bounded number of rows."""
    monkeypatch.setattr(files, "COMPRESSED_ROWS", 100)
    rows = spark.range(0, 1000, 1, 2).select("id", F.lit('a "b", c').alias("text"))
    assert files.write_csv(rows, str(tmp_path / "z"), compression="gzip") == 1000
    assert len([*(tmp_path / "z").glob("part-*.csv.gz")]) == 10
    found = files.read_csv(spark, str(tmp_path / "z"), rows.schema)
    assert sorted(found.collect()) == sorted(rows.collect())
    assert files.write_csv(rows, str(tmp_path / "p")) == 1000
    assert len([*(tmp_path / "p").glob("part-*.csv")]) == 2


def test_batch_queries_keep_their_feed_compressed(spark, tmp_path, monkeypatch):
    from tocsin.plans import queries

    monkeypatch.setattr(queries, "fresh_path", lambda _, label: f"{tmp_path}/{label}")
    assert queries.QUERIES["batch_watchlist"](spark, "/root/testdata/sf0.001").count() > 0
    feed = [p.name for p in (tmp_path / "batch/in").glob("*/part-*")]
    assert feed and all(name.endswith(".csv.gz") for name in feed)
