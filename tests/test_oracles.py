"""Every query of the library that has SQL gives the same rows."""

import pytest

from linecurate import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows(name, same_as_sql):
    same_as_sql(catalog.QUERIES[name], catalog.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_runs(name, spark, small):
    assert catalog.QUERIES[name](spark, small).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
