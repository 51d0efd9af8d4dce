"""Every registered query against its SQL oracle."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences
from pixeltally.workload.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def duck(tmp_path):
    """One for each test: a failure in one can't spoil the next."""
    with connect(SF_DIR, str(tmp_path / "duck")) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR).toArrow()
    assert result.num_rows > 0
    assert differences(result, duck.sql(ORACLES[name]).to_arrow_table()) == []


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    assert entry_module.entry(spark).columns == [
        "continent", "genre_name", "release_year", "nb_games", "total_sales_m", "avg_critic_score"]
