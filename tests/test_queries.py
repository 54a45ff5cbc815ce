"""Every registered query against its SQL statement."""

import pytest
from compare import differences

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(entry.queries().keys() - entry.MORE.keys()))  # the others have tests of their own
def test_query(spark, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    assert sql is not None
    assert differences(df, sql, FOLDER) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["list_a", "size", "list_b", "pct"]
    assert df.count() > 0
