"""Every registered query against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import check


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, small, name):
    assert check(spark, name, small, queries(), oracle_sql()) is None


def test_entry(spark, small):
    rows = entry(spark).collect()
    assert rows and all(0 <= r.effectiveness <= 100 for r in rows)
