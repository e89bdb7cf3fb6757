"""Tables laid out by a hash of their key, so that joins and windows on it move no row.

For counted rows, not for events: a bucket is read by one task, and of events one entity may hold a
third. Rows counted by entity and quarter or reaction are as many as there are of those, whatever
the number of events.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tocsin.sources.workspace import fresh_path

BUCKETS = 64


def bucketed(df: DataFrame, key: str, label: str, buckets: int = BUCKETS) -> DataFrame:
    """Write ``df`` in buckets of ``key`` to the shared folder and return it as read back.

    Tables with the same key type and number of buckets meet without a shuffle. Rows are dealt by
    the key before the write, so each bucket is one file.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key).sortBy(key)
        .format("parquet").option("path", fresh_path(spark, label))
        .saveAsTable(name)
    )
    return spark.table(name).select(*[F.col(c) for c in df.columns])
