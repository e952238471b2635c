"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pathlib

import pytest

import __spark_entry__ as entry
from tools.check_oracles import same_type, table

SMALL = pathlib.Path("/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(SMALL))
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    assert table(df.columns, df.collect()) == table(columns, cursor.fetchall())
    assert all(same_type(f.dataType.simpleString(), kinds[f.name]) for f in df.schema)
