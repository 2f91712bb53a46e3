"""Every query against its SQL, and the coverage of the catalog."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences
from crawlframe.plans.catalog import QUERIES
from crawlframe.plans.oracles import ORACLES

# SHA-512 is not in the SQL engine; the digest is tested against hashlib.
ROWS_ONLY = {"content_hash"}


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_entry_has_the_catalog():
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and not set(ORACLES) - set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    n, diff = differences(QUERIES[name](spark, sf), con, ORACLES[name])
    assert not diff
    assert n > 0


def test_entry(spark):
    assert entry(spark).count() == 8
