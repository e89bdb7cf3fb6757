"""Tables that grow by batches and stay small in number of folders.

The rows of such a table add up: a *merge* turns any number of rows into fewer that say the same.
Each micro-batch is merged and written as a part of its own; when a few parts of one size have come
together, they are merged into one of the next size. So a row is rewritten a few times in all and
not with every batch, and the number of parts grows with the logarithm of the number of batches.

An entry of the table's log names its parts and the last batch in them, in one step. A batch that
is run again after a failure is therefore either in the table, and is passed over, or it is not, and
what its first run may have written is named nowhere.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from tocsin.sources.versions import Conflict, VersionLog

#: Parts of one size that are merged into one of the next.
PARTS_OF_A_SIZE = 4

#: Rows that one task merges: what it holds of them does not grow with a batch or the table.
ROWS_OF_A_TASK = 500_000


class MaintainedTable:
    """Rows in the columns of ``schema`` (a DDL text) that ``merge`` adds up.

    With ``keys``, the columns by which it groups, rows are dealt to as many tasks as their number
    asks for before they are merged. Without, a task merges what it reads first, however much.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: str,
        merge: Callable[[DataFrame], DataFrame],
        parts_of_a_size: int = PARTS_OF_A_SIZE,
        keys: Sequence[str] = (),
    ):
        self.spark, self.schema, self.merge, self.most = spark, schema, merge, parts_of_a_size
        self.keys = keys
        self.log = VersionLog(spark, path)

    def exists(self) -> bool:
        return self.log.latest()[0] > 0

    def add(self, batch: DataFrame, batch_id: int) -> bool:
        """Take in a batch; False if it is in the table already.

        Batches come one after the other, in the order of their ids.
        """
        number, entry = self.log.latest()
        if batch_id <= entry.get("through", -1):
            return False
        folders, sizes = [*entry["folders"]], [*entry.get("sizes", [])]
        folders.append(self._written(batch))
        sizes.append(0)
        written = folders[-1:]
        while len(sizes) >= self.most and len({*sizes[-self.most :]}) == 1:
            together = folders[-self.most :]
            written.append(self._written(self._rows(together)))
            folders = [*folders[: -self.most], written[-1]]
            sizes = [*sizes[: -self.most], sizes[-1] + 1]
        entry = {"folders": folders, "sizes": sizes, "through": batch_id}
        committed = self.log.commit(max(number + 1, self.log.next_number()), entry)
        for folder in written:
            if not (committed and folder in folders):  # merged already, or in vain
                self.log.storage.delete(folder)
        if not committed:
            raise Conflict("another writer extends this table")
        self.log.expire()
        return True

    def read(self) -> DataFrame:
        """The rows of all batches, merged."""
        _, entry = self.log.latest()
        return self._merged(self._rows(entry["folders"]))

    def _merged(self, rows: DataFrame) -> DataFrame:
        if self.keys:
            tasks = -(-rows.count() // ROWS_OF_A_TASK)
            if tasks > 1:
                rows = rows.repartition(tasks, *self.keys)
        return self.merge(rows)

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        paths = self.log.paths({"folders": folders})
        return self.spark.read.schema(self.schema).parquet(*paths)

    def _written(self, rows: DataFrame) -> str:
        folder = self.log.fresh_folder()
        self._merged(rows).write.parquet(f"{self.log.storage.path}/{folder}")
        return folder
