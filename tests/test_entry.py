"""Driver contract: entry smoke run, registry/oracle agreement and every
registered query against its DuckDB oracle on the smallest scale."""

import pytest

import __spark_entry__ as E
from parcelstream.plans import catalog
from parcelstream.plans.verify import compare, duck

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["cur_date", "cargo_type", "cargo_type_name", "order_amount_base",
                          "order_count_base", "ts"]


def test_every_query_has_an_oracle():
    assert set(catalog.REGISTRY) <= set(E.queries())
    assert set(catalog.REGISTRY) <= set(E.oracle_sql())
    assert len(catalog.REGISTRY) >= 60


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(catalog.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF_SMALL), con, E.oracle_sql()[name])
    assert ok, msg
