"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_module
from oracle import compare, database

SF = "/root/testdata/sf0.001"
EMPTY_HERE = {"q2_unique_kept", "q2_violations_kept"}


@pytest.fixture(scope="module")
def con():
    return database(SF)


# The text operators have tests of their own.
OWN = sorted(n for n, q in entry_module.queries().items() if q.__module__.startswith("driftline.plans."))


def test_every_query_has_sql():
    assert set(OWN) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    problems = compare(entry_module.queries()[name](spark, SF), con, entry_module.oracle_sql()[name])
    # Only where the smallest tables hold nothing to find may a result be empty.
    assert [p for p in problems if not (p.startswith("no rows") and name in EMPTY_HERE)] == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
