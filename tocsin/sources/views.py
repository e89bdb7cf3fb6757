"""Named views for users who write SQL."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: dict[str, DataFrame]) -> None:
    """Create or replace a temporary view for each table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, query: str, args: dict[str, Any] | None = None) -> DataFrame:
    """Run ad-hoc SQL over the registered views, with bound ``:name`` parameters."""
    return spark.sql(query, args=args or {})
