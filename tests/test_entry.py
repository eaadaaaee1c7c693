import duckdb
import pytest

import __spark_entry__ as repo
from check import compare, register
from pagequarry.plans.oracles import ORACLES
from pagequarry.plans.queries import QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(repo.queries()) and set(ORACLES) <= set(repo.oracle_sql())


def test_entry(spark):
    assert repo.entry(spark).columns == ["qid", "prompt"]


@pytest.fixture(scope="module")
def con(testdata):
    connection = duckdb.connect()
    register(connection, testdata)
    return connection


@pytest.mark.parametrize("query", list(QUERIES))
def test_query_matches_sql(spark, testdata, con, query):
    got = QUERIES[query](spark, testdata).toPandas()
    if query in ORACLES:
        want = con.sql(ORACLES[query].replace("/root/testdata/sf0.01", testdata)).df()
        assert compare(got, want) is None
    else:
        assert len(got)
