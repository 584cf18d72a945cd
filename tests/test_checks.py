"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from check import compare, connection  # noqa: E402

from conftest import SMALL  # noqa: E402
from vellum.plans import CHECKS, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return connection(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, SMALL, name)
    assert ok, message


def test_every_query_has_sql():
    assert set(CHECKS) <= set(QUERIES)
    assert len(CHECKS) >= 100


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
