"""Checks on the raw tables: keys, required columns, orphans, future dates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.operators.staging import not_future
from tocsin.sources.workspace import written_once


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with the number of rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.filter(F.col("row_count") > 1)


def key_audit(df: DataFrame, table_name: str, keys: list[str]) -> DataFrame:
    """One row: how many keys repeat and how many rows are surplus."""
    return duplicate_keys(df, keys).agg(
        F.count(F.lit(1)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0).cast("bigint")).alias("surplus_rows"),
    ).select(F.lit(table_name).alias("table_name"), "duplicate_keys", "surplus_rows")


def bitmap_key_audit(df: DataFrame, table_name: str, key: Column) -> DataFrame:
    """``key_audit`` for a key that is a whole number, without a shuffle of all keys.

    The keys of a range of 32,768 values become one bitmap, exact and 4 KB long, which combines
    before its shuffle: where keys that are close stand close in the files, a key costs about a bit.
    Only ranges with more rows than set bits hold a key twice, and only their keys are grouped. Those
    ranges are written first, so that their size decides whether the keys must move to meet them.
    """
    keys = df.select(key.cast("bigint").alias("key")).withColumn(
        "range", F.bitmap_bucket_number("key")
    )
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("key")))
    crowded = (
        keys.groupBy("range").agg(F.count(F.lit(1)).alias("row_count"), bits.alias("key_count"))
        .filter(F.col("row_count") > F.col("key_count"))
        .select(F.col("range").alias("crowded_range"))
    )
    suspects = keys.join(
        written_once(crowded, "crowded-ranges"), F.col("range").eqNullSafe(F.col("crowded_range")), "left_semi"
    )
    return key_audit(suspects, table_name, ["key"])


def null_counts(df: DataFrame, table_name: str, columns: list[str] | None = None) -> DataFrame:
    """Number of NULLs in each column, one row per column, in one pass."""
    columns = columns or df.columns
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counted.unpivot([], columns, "column_name", "null_rows")
    return long.select(F.lit(table_name).alias("table_name"), "column_name", "null_rows")


def orphan_counts(events: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: events whose entity is unknown. Events are counted by entity first."""
    known = entities.select("drug_id")
    by_entity = events.groupBy("drug_id").agg(F.count(F.lit(1)).alias("row_count"))
    return by_entity.join(known, "drug_id", "left_anti").agg(
        F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("orphan_ae_records")
    )


def known_events(events: DataFrame, entities: DataFrame) -> DataFrame:
    """One row: ``row_count``, the events of known entities. Events are counted by entity first."""
    by_entity = events.groupBy("drug_id").agg(F.count(F.lit(1)).alias("row_count"))
    return by_entity.join(entities.select("drug_id"), "drug_id").agg(
        F.coalesce(F.sum("row_count"), F.lit(0).cast("bigint")).alias("row_count")
    )


def guard_future_dates(events: DataFrame, as_of: date | None) -> DataFrame:
    """One row: how many events staging keeps and how many it excludes by date."""
    kept = F.coalesce(not_future(F.col("event_date"), as_of), F.lit(False))
    return events.agg(
        F.count_if(kept).alias("kept_reports"), F.count_if(~kept).alias("excluded_reports")
    )
