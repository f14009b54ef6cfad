"""Every registered query against its independent SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from workload.compare import difference, duck_connection

# Optional queries have tests of their own.
ENTRIES = {key: pair for module in entry._MODULES for key, pair in module.ENTRIES.items()}
QUERIES = {key: run for key, (run, _) in ENTRIES.items()}
ORACLE = {key: sql for key, (_, sql) in ENTRIES.items() if sql}
ROWS_ONLY = {"s08_sizes"}


@pytest.fixture(scope="module")
def connection():
    return duck_connection(SF_SMALL)


def test_every_query_has_an_oracle_but_the_named_ones():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY


def test_driver_contract():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 28


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, connection, key):
    df = QUERIES[key](spark, SF_SMALL)
    if key in ORACLE:
        assert difference(df, connection, ORACLE[key]) is None
    else:
        assert df.count() > 0
