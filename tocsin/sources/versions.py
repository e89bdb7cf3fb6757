"""Tables that are replaced or extended in one step, whatever happens to the writer.

Data goes into a new folder each time. What a table consists of is written last, as a numbered
entry of a log: a small file that is created once and never changed. Readers take the newest entry
that is complete, so a writer that fails leaves the table as it was, and a reader in the midst of a
replacement reads the old rows or the new ones and never a part of either.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Versions that stay readable after a replacement, and the age at which a folder that no entry
#: names counts as left behind by a failed writer.
KEPT_VERSIONS, ABANDONED_SECONDS = 2, 24 * 3600
LOG, DATA = "log", "data"


class Conflict(RuntimeError):
    """Another writer was first."""


class Storage:
    """Folders and small files of the file system that holds ``path``, as Spark sees it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.files = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def exists(self, name: str = "") -> bool:
        return self.files.exists(self.at(name))

    def names(self, folder: str) -> list[tuple[str, float]]:
        """Name and time of change (seconds) of each file or folder in ``folder``."""
        if not self.exists(folder):
            return []
        found = self.files.listStatus(self.at(folder))
        return sorted((f.getPath().getName(), f.getModificationTime() / 1000) for f in found)

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if the name is taken."""
        if self.exists(name):
            return False
        try:
            out = self.files.create(self.at(name), False)
        except Exception as error:  # py4j wraps what the file system throws
            if "AlreadyExists" in str(error):
                return False
            raise
        try:
            out.write(text.encode())
        finally:
            out.close()
        return True

    def text(self, name: str) -> str:
        stream = self.files.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)


class VersionLog:
    """The numbered entries of a table; each names the data folders the table consists of."""

    def __init__(self, spark: SparkSession, path: str):
        self.storage = Storage(spark, path)

    def numbers(self) -> list[int]:
        names = (name.removesuffix(".json") for name, _ in self.storage.names(LOG))
        return sorted(int(n) for n in names if n.isdigit())

    def entry(self, number: int) -> dict | None:
        """The entry, or None if its writer did not finish it."""
        try:
            return json.loads(self.storage.text(self._name(number)))
        except ValueError:
            return None

    def latest(self) -> tuple[int, dict]:
        """Number and content of the newest complete entry; 0 and nothing for a new table."""
        for number in reversed(self.numbers()):
            if entry := self.entry(number):
                return number, entry
        return 0, {"folders": []}

    def next_number(self) -> int:
        return max(self.numbers(), default=0) + 1

    def commit(self, number: int, entry: dict) -> bool:
        """Make the entry the newest one; False if the number is taken."""
        return self.storage.create(self._name(number), json.dumps(entry))

    def fresh_folder(self) -> str:
        return f"{DATA}/{uuid.uuid4().hex}"

    def paths(self, entry: dict) -> list[str]:
        return [f"{self.storage.path}/{folder}" for folder in entry["folders"]]

    def expire(self, keep: int = KEPT_VERSIONS, abandoned: float = ABANDONED_SECONDS) -> None:
        """Drop all but the newest entries, the data only they name, and what failed writers left.

        Entries go before data, so no reader finds an entry without its data.
        """
        numbers = self.numbers()
        kept = [e for n in numbers[-keep:] if (e := self.entry(n))]
        named = {folder for entry in kept for folder in entry["folders"]}
        dropped = [e for n in numbers[:-keep] if (e := self.entry(n))]
        for number in numbers[:-keep]:
            self.storage.delete(self._name(number))
        for folder in {f for entry in dropped for f in entry["folders"]} - named:
            self.storage.delete(folder)
        for name, changed in self.storage.names(DATA):
            if f"{DATA}/{name}" not in named and time.time() - changed > abandoned:
                self.storage.delete(f"{DATA}/{name}")

    @staticmethod
    def _name(number: int) -> str:
        return f"{LOG}/{number:012d}.json"


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write rows and return how many the writing tasks saw, without a job of its own."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


class ReplaceableTable:
    """A Parquet table whose rows are replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, VersionLog(spark, path)

    def replace(self, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Write a new version and make it the current one; returns its number of rows.

        Of two writers the one that ends last wins. With ``partition_by``, rows are rebalanced by
        those columns before the write: small partitions become one file, and a partition that
        holds much of the data is split over several tasks.
        """
        folder = self.log.fresh_folder()
        path = f"{self.log.storage.path}/{folder}"
        rows = df.hint("rebalance", *partition_by) if partition_by else df
        try:
            count = counted_write(
                rows, lambda found: found.write.partitionBy(*partition_by or []).parquet(path)
            )
        except Exception:
            self.log.storage.delete(folder)
            raise
        entry = {"folders": [folder], "rows": count, "schema": df.schema.jsonValue()}
        while not self.log.commit(self.log.next_number(), entry):
            pass  # another writer took the number
        self.log.expire()
        return count

    def current(self) -> dict:
        number, entry = self.log.latest()
        if not number:
            raise FileNotFoundError(f"no table at {self.log.storage.path}")
        return entry

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The current version, with its own columns or the declared ones, in that order."""
        entry = self.current()
        schema = schema or T.StructType.fromJson(entry["schema"])
        [path] = self.log.paths(entry)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    def rows(self) -> int:
        """Number of rows of the current version, as counted when it was written."""
        return self.current()["rows"]
