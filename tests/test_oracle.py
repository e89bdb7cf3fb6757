"""Every registered query against its SQL equivalent, to the last digit."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from tocsin.plans.oracle import ORACLE
from tocsin.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, con, ORACLE[name]) is None


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "drug_id" and df.columns[-1] == "signal_flag"
