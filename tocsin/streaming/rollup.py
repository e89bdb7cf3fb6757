"""Rollup and novelty kept up to date from arriving events, with Structured Streaming.

Rollups add up, so no state is kept in the stream: each micro-batch adds the counts of its own
events by day to a maintained table. The date guard applies on reading: a report dated ahead counts
as soon as its day has come.

Whether a reaction is new depends on the first date on which its pair was seen, and that may change
when an earlier report arrives late. So novelty is never stored with counts: the maintained tables
keep first dates (and counts) by pair, and reading derives novelty from all that has arrived.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tocsin.operators import novelty
from tocsin.operators.counts import QUARTER_KEYS, merge_rollups, unit_counts
from tocsin.operators.staging import event_fields, not_future
from tocsin.schemas import RAW_ADVERSE_EVENTS
from tocsin.sources.files import CSV_READ
from tocsin.sources.versions import Storage
from tocsin.streaming.maintained import MaintainedTable

DAY_KEYS = ["drug_id", "quarter", "event_date"]
CELL_KEYS = [*novelty.PAIR, "event_date"]
COUNT_TYPES = "total_reports BIGINT, serious_reports BIGINT"
ROLLUP_SCHEMA = (
    f"drug_id STRING, quarter STRING, event_date DATE, {COUNT_TYPES}, novel_reports BIGINT"
)


def arriving_events(spark: SparkSession, folder: str) -> DataFrame:
    """Raw event CSV files as a stream, with the declared schema."""
    return spark.readStream.schema(RAW_ADVERSE_EVENTS).options(**CSV_READ).csv(folder)


def refresh(
    events: DataFrame,
    table: MaintainedTable,
    prepare: Callable[[DataFrame], DataFrame],
    checkpoint: str,
) -> StreamingQuery:
    """Take in everything that arrived since the last refresh, then stop.

    Table and ``checkpoint`` belong together, on storage that all executors share: a new checkpoint
    would start counting anew over the batches that are there, so that is an error.
    """
    if table.exists() and not Storage(table.spark, checkpoint).exists():
        raise ValueError(
            f"{table.log.storage.path} was not written with the checkpoint {checkpoint}"
        )
    return (
        events.writeStream.foreachBatch(lambda rows, batch: table.add(prepare(rows), batch))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --- counts with the feed's own novelty flag ------------------------------------------------


def rollup_table(spark: SparkSession, path: str) -> MaintainedTable:
    return MaintainedTable(
        spark, path, ROLLUP_SCHEMA, lambda rows: merge_rollups(rows, *DAY_KEYS), keys=DAY_KEYS
    )


def refresh_rollup(events: DataFrame, rollup_path: str, checkpoint: str) -> StreamingQuery:
    """Bring the rollup by day up to date."""
    table = rollup_table(events.sparkSession, rollup_path)
    return refresh(events, table, unit_counts, checkpoint)


def read_rollup(
    spark: SparkSession, rollup_path: str, as_of: date | None = None
) -> DataFrame:
    """The quarter rollup of the days up to ``as_of``."""
    days = rollup_table(spark, rollup_path).read()
    return merge_rollups(event_fields(days, as_of), *QUARTER_KEYS)


# --- counts and first dates by pair, novelty on reading -------------------------------------


def _merged_cells(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*CELL_KEYS).agg(
        F.sum("total_reports").alias("total_reports"),
        F.sum("serious_reports").alias("serious_reports"),
    )


def cell_table(spark: SparkSession, path: str, id_type: str = "STRING") -> MaintainedTable:
    """Reports and serious reports by pair and day."""
    schema = f"drug_id {id_type}, reaction STRING, event_date DATE, {COUNT_TYPES}"
    return MaintainedTable(spark, path, schema, _merged_cells, keys=CELL_KEYS)


def cell_rows(events: DataFrame) -> DataFrame:
    """Each event as a cell of its own."""
    return events.select(
        *novelty.PAIR, "event_date",
        F.lit(1).cast("bigint").alias("total_reports"),
        F.col("is_serious").cast("int").cast("bigint").alias("serious_reports"),
    )


def read_quarter_rollup(
    table: MaintainedTable, entities: DataFrame, as_of: date | None = None
) -> DataFrame:
    """The quarter rollup (as ``counts.quarter_rollup``) with novelty as it stands now."""
    days = event_fields(table.read(), as_of)
    cells = days.groupBy(*novelty.PAIR, *novelty.QUARTER).agg(
        F.sum("total_reports").alias("total_reports"),
        F.sum("serious_reports").alias("serious_reports"),
        F.min("event_date").alias("first_seen"),
    )
    return novelty.novel_quarter_rollup(cells, entities)


def _merged_sightings(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*novelty.PAIR).agg(F.min("first_seen").alias("first_seen"))


def sighting_table(spark: SparkSession, path: str, id_type: str = "STRING") -> MaintainedTable:
    """The first date of each pair."""
    schema = f"drug_id {id_type}, reaction STRING, first_seen DATE"
    return MaintainedTable(spark, path, schema, _merged_sightings, keys=novelty.PAIR)


def sighting_rows(events: DataFrame) -> DataFrame:
    return events.select(*novelty.PAIR, F.col("event_date").alias("first_seen"))


def read_known_pairs(
    table: MaintainedTable,
    entities: DataFrame,
    as_of: date | None = None,
    months: int = novelty.GRACE_MONTHS,
) -> DataFrame:
    """The known pairs (as ``novelty.known_pairs``) of all that has arrived.

    A pair first seen on a day that has not come is not known yet.
    """
    seen = table.read().filter(not_future(F.col("first_seen"), as_of))
    return novelty.known_sightings(seen, entities, months)
