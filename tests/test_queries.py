"""Every registered query against its SQL."""

import __spark_entry__ as entry
import pytest
from oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(entry.QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["geo_id_insee", "window_start", "avg_temp", "avg_wind", "avg_humidity"]
