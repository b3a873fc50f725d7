"""Registered queries against their SQL; those without SQL have tests against brute force beside this one."""

import re

import pytest
from check import compare, connect

import __spark_entry__ as entry
from tidewatch.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, sf, name):
    assert compare(spark, connect(sf), sf, name)[0] == "ok"


def test_all_ten_and_the_pipeline_are_registered():
    names = entry.queries()
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11))
    assert "pipeline" in names and set(QUERIES) <= set(names)
