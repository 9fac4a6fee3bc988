"""Every registered query against its SQL, on whole tables."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract
from quayside.oracle import statements
from quayside.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
# Without SQL: digests of files.
ROWS_ONLY = {"file_manifest"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    return value


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql_or_a_reason():
    assert set(REGISTRY) - set(statements()) == ROWS_ONLY
    assert set(statements()) <= set(REGISTRY)
    assert set(REGISTRY) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(statements()))
def test_query_matches_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    answer = duck.execute(statements()[name])
    expected = comparable([d[0] for d in answer.description], answer.fetchall())
    actual = comparable(df.columns, df.collect())
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_query_without_sql_returns_rows(spark, name):
    assert REGISTRY[name](spark, SF).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
