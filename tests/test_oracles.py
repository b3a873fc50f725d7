"""Every registered query against its SQL twin."""

import pytest
from check import compare, connect

import __spark_entry__ as entry
from tidewatch.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, sf, name):
    verdict, size, _ = compare(spark, con, sf, name)
    assert verdict == ("ok" if name in entry.oracle_sql() else "rows only")
    assert size > 0 or name == "new_keyword_names" or name == "extend_dimension"


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == [
        "keyword", "period_start", "period_end", "post_count", "avg_sentiment_score", "sentiment_label",
    ]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
