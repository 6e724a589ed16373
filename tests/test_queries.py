"""Every registered query against its DuckDB text, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SF = Path(entry.SMOKE_DIR)
pytestmark = pytest.mark.skipif(not SF.exists(), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in sorted(SF.glob("*.parquet")):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def test_flagship(spark):
    assert entry.entry(spark).columns == ["event_class", "hour", "n_events"]


@pytest.mark.parametrize("name", entry.queries())
def test_query(spark, con, name):
    df = entry.queries()[name](spark, str(SF))
    names = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*names).collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = con.sql(sql)
    assert sorted(found.columns) == names
    order = [found.columns.index(c) for c in names]
    assert got == sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
