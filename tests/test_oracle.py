"""Every registered query against its SQL, on the smallest dataset."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
import check

SF = "/root/testdata/sf0.001"
pytestmark = [
    pytest.mark.oracle,
    pytest.mark.skipif(not Path(SF).is_dir(), reason="no test tables"),
]

# At this scale no span lies inside a fault window, and the sample has no join partners.
NAMES = sorted(spark_entry.queries())


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() > 0


def test_every_check_belongs_to_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())
