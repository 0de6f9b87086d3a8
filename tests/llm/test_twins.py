"""Registered queries against their SQL twins, and their registration."""

import compare
import pytest

import __spark_entry__ as entry_points
from kpiloom.llm.oracle import ORACLE
from kpiloom.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_twin(spark, src, name):
    assert compare.differences(QUERIES[name](spark, src), compare.connect(src), ORACLE[name]) == []


def test_all_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())
