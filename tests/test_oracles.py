"""Every registered query against its DuckDB twin, on the smallest test data."""

import re

import pytest

import __spark_entry__ as entry
import oracle_queries
from eventloom.operators import checks
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


# The corpus operators have tests of their own.
OWN = [name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name)]


def test_every_query_has_a_twin():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", OWN)
def test_query_equals_twin(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) is None


def test_both_lists_of_column_checks_are_the_same():
    """The oracle has a list of its own, so a check that is dropped on one side is noticed."""
    theirs = {(dataset, kind, column) for dataset, kind, column, _ in oracle_queries.column_checks()}
    mine = set()
    for dataset, wanted in checks.GENERIC_CHECKS.items():
        for kind, key in (("not_null", "not_null"), ("unique", "unique"), ("accepted_values", "accepted"), ("relationships", "relationships")):
            mine |= {(dataset, kind, c) for c in wanted.get(key, [])}
    assert mine == theirs and len(oracle_queries.column_checks()) == 137


def test_every_check_finds_something_in_faulty_data(duck):
    rows = [r for name, sql in entry.oracle_sql().items() if name.startswith("faulty_") for r in duck.execute(sql).fetchall()]
    assert len(rows) == 151 and all(failing > 0 for _, failing in rows)
