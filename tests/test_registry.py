"""Every registered query against its SQL twin on the smallest given tables."""

import os

import pytest
from oracle import connect, oracle_rows, spark_rows

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_matches_its_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    rows = spark_rows(df)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    names, expected = oracle_rows(con, sql)
    assert sorted(df.columns) == names
    assert rows == expected


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_is_the_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_functions_hold_their_edge_cases(spark):
    from pyspark.sql import functions as F
    from stopwise.functions import round_half_away

    df = spark.createDataFrame([(1.005,), (-2.5,), (0.125,), (None,)], "x double")
    two = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert two == [1.0, -2.5, 0.13, None]
    zero = [r[0] for r in df.select(round_half_away(F.col("x"), 0)).collect()]
    assert zero[1] == -3.0
