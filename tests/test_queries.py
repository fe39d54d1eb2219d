"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as repo
from compare import compare, connect
from quernstone.plans.catalog import QUERIES

SQL = repo.oracle_sql()


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, small, name):
    rows, problem = compare(spark, con, repo.queries()[name], SQL.get(name), small)
    assert rows > 0 and not problem


def test_only_recall_reports_and_token_chunks_lack_sql():
    assert set(QUERIES) - set(SQL) == {"knn_cells_recall", "knn_codes_recall", "token_chunks"}


def test_flagship(spark):
    df = repo.entry(spark)
    assert {"qid", "result", "token_f1"} <= set(df.columns) and df.count() > 0
