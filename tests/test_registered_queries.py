"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import SMALL, entry, oracle_sql, queries
from checks.compare import connect, difference

ORACLES = oracle_sql()
REGISTERED = queries()


@pytest.fixture(scope="module")
def tables():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_matches_sql(spark, tables, name):
    got = REGISTERED[name](spark, SMALL).toPandas()
    if name in ORACLES:
        assert difference(got, tables.execute(ORACLES[name]).df()) is None
    else:
        assert len(got)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(REGISTERED)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
