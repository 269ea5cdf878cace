"""Every registered query against its SQL form on the smallest test data."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
QUERIES, TEXTS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in TEXTS:
        assert compare(df, duck, TEXTS[name]) == ""
    else:
        assert df.count() >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["day_of_week", "hour", "cnt"] and df.count() > 0


def test_every_text_has_a_query():
    assert set(TEXTS) <= set(QUERIES)
