"""Every registered query against its SQL, on the smallest given tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from barlake.plans.oracle import ORACLE  # noqa: E402
from barlake.plans.registry import REGISTRY  # noqa: E402
from tools.compare import rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLE) and set(REGISTRY) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, oracle, name):
    frame = contract.queries()[name](spark, FOLDER)
    answer = oracle.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, answer.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 200
