"""Every query against its SQL, over the whole smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import differences
from tests.conftest import SMALL

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        connection.sql(f"create view {path.stem} as from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, database, name):
    actual = QUERIES[name](spark, SMALL).toPandas()
    assert differences(actual, database.sql(ORACLES[name]).df()) == []


def test_all_queries_of_the_sales_model_have_sql():
    own = {name for name in QUERIES if not name.startswith("op") and name != "pipeline"}
    assert own <= set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "n_sales", "revenue", "mean_ticket"]
