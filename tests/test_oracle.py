"""Every query with a SQL twin, compared on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

ORACLE = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    verdict, detail = compare(QUERIES[name](spark, SF_DIR), duck, ORACLE[name])
    assert verdict in ("exact", "close"), detail


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
