"""Every registered query against its SQL, on the smallest data set."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from masthead.workload.oracles import oracles
from masthead.workload.queries import registered
from tests.compare import connection, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF_DIR)


def test_every_query_has_sql():
    assert set(registered()) == set(oracles())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(registered()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, con, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    assert differences(result, con, entry_points.oracle_sql()[name]) == []


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == ["id", "scraped_at", "headline", "valid", "reason"]
    assert result.count() > 0
