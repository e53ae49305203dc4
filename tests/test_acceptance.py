"""Every registered query against its SQL, on the smallest tables."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from sieveframe.plans.acceptance import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple("nan" if isinstance(v, float) and math.isnan(v) else float(f"{v:.9g}") if isinstance(v, float) else v
              for v in (row[i] for i in order)) for row in rows
    )


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    result = db.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, [tuple(r) for r in df.collect()]) == bag(columns, result.fetchall())


def test_contract_lists_all_queries():
    assert contract.queries().items() >= QUERIES.items() and contract.oracle_sql().items() >= ORACLE.items()
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    assert contract.entry(spark).count() == 10
