"""The shared test tables seen as entities, event reports and volumes.

Suppliers stand for the monitored products, order lines for event reports and
the quantities on those lines for units sold.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tocsin.config import ScoringConfig
from tocsin.functions.periods import quarter_label, year_month
from tocsin.operators.staging import is_serious_outcome

# Declared, so that no job reads the footers to find the schema.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

AS_OF = date(2001, 10, 31)
SCORING = ScoringConfig(current_quarter="2001-Q3", as_of=AS_OF)

OUTCOME_OF_PRIORITY = {
    "1-URGENT": "Death",
    "2-HIGH": "Disability",
    "3-MEDIUM": "Hospitalization",
    "4-NOT SPECIFIED": "Moderate",
    "5-LOW": "Non-serious",
}


def _outcome(priority: Column) -> Column:
    mapped = F.lit(None).cast("string")
    for source, outcome in OUTCOME_OF_PRIORITY.items():
        mapped = F.when(priority == source, outcome).otherwise(mapped)
    return mapped


def _age_group(balance: Column) -> Column:
    return (
        F.when(balance < 2500, "18-44")
        .when(balance < 5000, "45-64")
        .when(balance < 7500, "65-74")
        .when(balance >= 7500, "75+")
    )


def _event_day() -> Column:
    return F.col("l_shipdate").cast("date")


def _event_outcome() -> Column:
    return _outcome(F.col("o_orderpriority"))


EVENT_COLUMNS: dict[str, Callable[[], Column]] = {
    "report_id": lambda: F.col("l_orderkey") * 10 + F.col("l_linenumber"),
    "drug_id": lambda: F.col("l_suppkey"),
    "event_date": _event_day,
    "quarter": lambda: quarter_label(_event_day()),
    "reaction": lambda: F.col("p_name"),
    "outcome": _event_outcome,
    "is_serious": lambda: is_serious_outcome(_event_outcome()).cast("int"),
    "reporter_type": lambda: F.col("c_mktsegment"),
    "country": lambda: F.col("n_name"),
    "age_group": lambda: F.col("age"),
    "sex": lambda: F.col("l_returnflag"),
}


def _shipped_between(lines: DataFrame, start: date | None, end: date | None) -> DataFrame:
    """Half-open range on the ship date, in the column's own type so that it is pushed down."""
    if start is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(_midnight(start)).cast("timestamp_ntz"))
    if end is not None:
        lines = lines.filter(F.col("l_shipdate") < F.lit(_midnight(end)).cast("timestamp_ntz"))
    return lines


def _midnight(day: date) -> str:
    return datetime(day.year, day.month, day.day).isoformat(sep=" ")


class TestTables:
    """Raw feeds built from the Parquet tables of one folder."""

    __test__ = False  # not a test class, whatever its name suggests to pytest

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A table; its files are listed once per instance."""
        if name not in self._tables:
            self._tables[name] = self._read(name)
        return self._tables[name]

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def entities(self) -> DataFrame:
        return self._entities

    @cached_property
    def _entities(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                key.alias("drug_id"),
                F.col("s_name").alias("drug_name"),
                F.col("r_name").alias("therapeutic_area"),
                F.col("n_name").alias("indication"),
                F.make_date(
                    (key % 3 + 1995).cast("int"), (key % 12 + 1).cast("int"), F.lit(1)
                ).alias("launch_date"),
                ((F.col("r_regionkey") + 3).cast("double") / 10).alias("class_avg_serious_rate"),
            )
        )

    def events(
        self,
        *columns: str,
        start: date | None = None,
        end: date | None = None,
        flagged: Callable[[DataFrame], DataFrame] | None = None,
    ) -> DataFrame:
        """Event reports with the named columns; only the tables they come from are joined.

        Report ids repeat, as order lines have no key. Whether a reaction is
        novel is not in the feed: it is derived (``operators.novelty``), by
        ``flagged``, from rows that have ``drug_id`` and ``reaction``. They meet
        it before the columns of orders and customers widen them.
        """
        lines = _shipped_between(self.table("lineitem"), start, end)
        wanted = set(columns)
        if "reaction" in wanted:
            part = self.table("part").select("p_partkey", "p_name")
            lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        derived = [EVENT_COLUMNS[c]().alias(c) for c in columns]
        if flagged is not None:
            names = {"l_suppkey": "drug_id", "p_name": "reaction"}
            back = {new: old for old, new in names.items()}
            lines = flagged(lines.withColumnsRenamed(names)).withColumnsRenamed(back)
            derived.append(F.col("is_novel_reaction"))
        by_customer = wanted & {"reporter_type", "age_group", "country"}
        if by_customer or wanted & {"outcome", "is_serious"}:
            orders = self._orders_of_customers() if by_customer else self.table("orders")
            lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        if "country" in wanted:
            nation = self.table("nation")
            lines = lines.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return lines.select(*derived)

    def _orders_of_customers(self) -> DataFrame:
        """Orders meet their customers by themselves, so that no event row is shuffled for it."""
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        customer = self.table("customer").select(
            "c_custkey", "c_nationkey", "c_mktsegment", _age_group(F.col("c_acctbal")).alias("age")
        )
        return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")

    def sales(self, start: date | None = None, end: date | None = None) -> DataFrame:
        """Volume lines."""
        lines = _shipped_between(self.table("lineitem"), start, end)
        return lines.select(
            F.col("l_suppkey").alias("drug_id"),
            year_month(F.col("l_shipdate").cast("date")).alias("year_month"),
            F.col("l_quantity").cast("bigint").alias("units_sold"),
        )
