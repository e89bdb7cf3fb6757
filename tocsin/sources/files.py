"""Reading and writing the pipeline's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tocsin.schemas import RAW_TABLES
from tocsin.sources.versions import ReplaceableTable, counted_write


#: How CSV files are written and read, by batch and stream alike.
CSV_FORMAT = {"header": "true", "dateFormat": "yyyy-MM-dd", "escape": '"', "lineSep": "\n"}
CSV_READ = {**CSV_FORMAT, "mode": "FAILFAST", "enforceSchema": "false"}

#: Rows of a compressed file at most.
COMPRESSED_ROWS = 1_000_000

RAW_FILES = {
    "raw_drugs": "drugs.csv",
    "raw_adverse_events": "adverse_events.csv",
    "raw_sales_volume": "sales_volume.csv",
}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """CSV with a header and a declared schema; a malformed row fails the read.

    ``multi_line`` takes line breaks within quotes; a file is then read by one
    task, so leave it off where texts have none.
    """
    options = {k: v for k, v in CSV_READ.items() if not (multi_line and k == "lineSep")}
    reader = spark.read.schema(schema).options(**options).option("multiLine", multi_line)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> int:
    """CSV part files with a header; NULL is an empty field. Returns the number of rows.

    A compressed file is read by one task, so its number of rows is bounded.
    """
    bound = 0 if compression == "none" else COMPRESSED_ROWS
    return counted_write(
        df,
        lambda rows: rows.write.mode("overwrite")
        .options(**CSV_FORMAT)
        .option("compression", compression)
        .option("maxRecordsPerFile", bound)
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path),
    )


def read_raw(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """The three raw tables, from the CSV files of ``data_dir``."""
    return {
        name: read_csv(spark, f"{data_dir}/{RAW_FILES[name]}", schema)
        for name, schema in RAW_TABLES.items()
    }


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> int:
    """Replace the Parquet table at ``path`` in one step; returns its number of rows."""
    return ReplaceableTable(df.sparkSession, path).replace(df, partition_by)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The current rows of a table, with a declared schema or its own."""
    return ReplaceableTable(spark, path).read(schema)


def counts_table(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """One ``(table_name, row_count)`` row for each number of rows that a write returned."""
    return spark.createDataFrame([*counts.items()], "table_name STRING, row_count BIGINT")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``(table_name, row_count)`` row for each table; a table may bring its count along.

    A frame with the one column ``row_count`` counts as counted already.
    """
    counts = [
        (df if df.columns == ["row_count"] else df.agg(F.count(F.lit(1)).alias("row_count")))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def export_status(spark: SparkSession, exported: dict[str, int]) -> DataFrame:
    """One row for each file: '<file> exported — <n> rows', from what the writes counted."""
    rows = [(f"{name} exported — {count} rows",) for name, count in exported.items()]
    return spark.createDataFrame(rows, "status STRING")
