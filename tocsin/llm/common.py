"""What the operators of this package share: words, Arrow batches, hashing, shared storage."""

from __future__ import annotations

import gc
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.sources.workspace import fresh_path

#: Words are maximal runs of characters other than these six (space, \t \n \v \f \r).
#: ``bytes.split()`` splits at exactly these bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def byte_values(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def slices(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive rows with about ``most`` bytes in ``column``, at least a row each."""
    start, held = 0, 0
    offsets = _lengths(batch.column(column))
    for row, length in enumerate(offsets):
        if held and held + length > most:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < batch.num_rows:
        yield batch.slice(start)


def _lengths(column: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Written:
    """Intermediate tables in the shared folder, removed when their owner drops them.

    A table is Parquet, so a lost executor costs a re-read only.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.count = spark, fresh_path(spark, label), 0

    def table(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        found = self.spark.read.schema(df.schema).parquet(path)
        found._written_path = path
        return found

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of finished steps now.

        It acts when the driver collects its garbage, which may be long after a large shuffle is
        no longer needed.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(df._written_path)
            conf = self.spark._jsc.hadoopConfiguration()
            path.getFileSystem(conf).delete(path, True)


def read_json(path: str) -> dict:
    with open(path, encoding="utf-8") as handle:
        return json.load(handle)
