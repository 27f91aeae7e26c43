"""Every registered query against its SQL, whole tables, smallest scale."""

import pytest

import __spark_entry__ as entry
from registered import catalog
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.all_queries(), catalog.all_sql()
SCORED = {"sentiment_score", "sentiment_accuracy", "sentiment_other_columns", "link_intelligence_scored", "message_analysis_scored", "stream_scored"}


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_only_model_results_have_no_sql():
    assert set(QUERIES) - set(SQL) == SCORED
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["city", "location", "n"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connection, name):
    assert difference(entry.queries()[name](spark, SF), connection, SQL[name]) is None
