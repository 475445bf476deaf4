"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import SF_DIR

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import check  # noqa: E402
from jobloom.plans import catalog  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, SF_DIR, name, con)
    assert ok, note


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["role_title", "skill", "frequency", "rank"]
    assert set(catalog.queries()) <= set(entry.queries()) and set(catalog.queries()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
