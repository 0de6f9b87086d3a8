"""Every registered query against its SQL twin."""

import compare
import pytest

import __spark_entry__ as entry_points
from kpiloom.plans.catalog import QUERIES
from kpiloom.plans.oracle import ORACLE


@pytest.fixture(scope="module")
def con(src):
    return compare.connect(src)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, src, con, name):
    assert compare.differences(QUERIES[name](spark, src), con, ORACLE[name]) == []


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[:2] == ["date_id", "date"] and df.count() > 0
