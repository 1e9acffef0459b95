"""One local session for all tests, and a comparison with DuckDB."""

from __future__ import annotations

import math
import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

from pyspark.sql import SparkSession  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "3g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not Path(SMALL).exists():
        pytest.skip("no test tables")
    return SMALL


def plain(rows, columns):
    """Rows as comparable tuples, columns in order of name, floats to 6 digits."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(x):
        if hasattr(x, "item"):
            x = x.item()
        if x is None or isinstance(x, float) and math.isnan(x) or x != x:
            return None
        if isinstance(x, bool):
            return x
        return round(float(x), 6) + 0.0 if isinstance(x, (int, float)) else str(x)

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture
def same_as_sql(spark, small):
    import duckdb

    def check(query, sql):
        ours = query(spark, small)
        con = duckdb.connect()
        for table in Path(small).glob("*.parquet"):
            con.sql(f"create view {table.stem} as select * from '{table}'")
        theirs = con.sql(sql)
        columns = list(theirs.columns)
        assert sorted(ours.columns) == sorted(columns)
        assert plain(ours.collect(), ours.columns) == plain(theirs.fetchall(), columns)

    return check
