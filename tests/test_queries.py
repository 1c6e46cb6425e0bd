"""Every registered query against its SQL twin on the smallest test data."""

import pytest

import __spark_entry__ as entry
from checks.compare import compare, connect
from checks.oracle import SQL
from checks.registry import QUERIES

# A single-pass sketch has no exact twin; health_distribution_rank_error tests its bound.
WITHOUT_TWIN = {"health_distribution_approximate"}


@pytest.fixture(scope="module")
def duck(request):
    return connect("/root/testdata/sf0.001")


def test_every_query_has_a_twin():
    assert set(QUERIES) - set(SQL) == WITHOUT_TWIN and set(SQL) <= set(QUERIES)
    assert set(entry.queries()) >= set(QUERIES) and set(entry.oracle_sql()) >= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, sf, name):
    assert compare(spark, duck, name, sf) == ""


@pytest.mark.parametrize("name", sorted(WITHOUT_TWIN))
def test_query_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() == 1


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["start_slot", "end_slot", "slots_missed"]
    assert df.first().slots_missed == 91022
