"""Places in a total order over a whole table, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tocsin.sources.workspace import written_once

#: A row's number within its partition is in the low bits of the id that Spark gives it.
ROW_BITS = 33


def with_place(df: DataFrame, order: list[Column], place: str = "place") -> DataFrame:
    """Number the rows from 1 in ``order``, which should be total.

    Rows are partitioned by ranges of the order, sorted within each and written with their number
    there. A partition starts where those before it end; for that only one row per partition is
    gathered.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    placed = written_once(
        ranged.withColumns({"_part": F.spark_partition_id(), "_number": number}), "ranked"
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("size"))
    listed = sizes.agg(F.collect_list(F.struct(F.col("_part").alias("part"), "size")))
    start = F.aggregate(
        F.filter("_sizes", lambda other: other["part"] < F.col("_part")),
        F.lit(0).cast("bigint"),
        lambda rows, other: rows + other["size"],
    )
    return (
        placed.withColumn("_sizes", listed.scalar())
        .withColumn(place, start + F.col("_number") + 1)
        .drop("_part", "_number", "_sizes")
    )
