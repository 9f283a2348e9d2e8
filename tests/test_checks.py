"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from checks.support import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.conftest import SF_DIR

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    sql = ORACLES.get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, sql) is None


def test_every_query_has_rows_on_both_sides_or_is_random():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) - set(entry.oracle_sql()) == {"id_oid", "id_uuid", "cdc_nopk_insert"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0
