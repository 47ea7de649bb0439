import duckdb
import pytest
from check import TABLES, compare

from __spark_entry__ import entry, oracle_sql, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, con, sf_dir, name):
    ok, note = compare(spark, con, name, sf_dir)
    assert ok, note


def test_entry_and_names(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
