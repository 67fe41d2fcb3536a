"""Every registered query against its SQL on whole tables."""

import __spark_entry__ as entry
import pytest
from side_by_side import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    sql = entry.oracle_sql().get(name)
    frame = entry.queries()[name](spark, FOLDER)
    if sql is None:
        assert frame.count() > 0
        return
    _, problems = compare(frame, con, sql)
    assert not problems


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1500
