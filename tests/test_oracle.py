"""Every registered query against its SQL twin."""

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql
from registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_twin(spark, con, sf_dir, name):
    same, note = compare(spark, con, name, sf_dir)
    assert same, note


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["year", "month", "day", "production_type", "total_daily_production"]
    assert df.count() > 0
