"""Every registered query with an SQL twin returns the twin's rows."""

import pytest

import __spark_entry__ as entry
from tests.oracle import difference

ORACLES = entry.oracle_sql()
# These write tables or train models several times; the contract check covers them as well.
NAMES = sorted(ORACLES)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, sf_dir, duck, name):
    assert difference(entry.queries()[name](spark, sf_dir), ORACLES[name], duck) == ""


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
