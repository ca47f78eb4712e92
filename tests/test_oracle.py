"""Every registered query against its SQL, value by value and type by type."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from lakehist.plans.oracle import ORACLE
from lakehist.plans.queries import QUERIES

# Spark type -> the DuckDB types that hold the same values.
SAME_TYPE = {
    "bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"},
}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR)
    want = con.execute(ORACLE[name])
    types = {column[0]: str(column[1]) for column in want.description}
    assert sorted(got.columns) == sorted(types)
    assert all(types[c] in SAME_TYPE[t] for c, t in got.dtypes), (types, got.dtypes)
    columns = list(types)
    assert Counter(map(tuple, got.select(*columns).collect())) == Counter(want.fetchall())


def test_the_snapshot_is_all_customers(spark):
    assert QUERIES["raw_snapshot"](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/customer.parquet").count()


def test_entry_returns_the_ranking(spark):
    assert entry.entry(spark).count() == 20
