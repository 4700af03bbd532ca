"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from workload import ALL
from tests.harness import SF_DIR, differences


@pytest.mark.parametrize("name", sorted(ALL))
def test_query_agrees_with_sql(spark, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    assert differences(result, entry_point.oracle_sql()[name], SF_DIR) == []


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).count() > 0
