"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive value hash); rows-only queries must run."""
import pytest

from tidewater.plans import all_oracles, all_queries
from tidewater.plans.check import compare, duck_connection

NAMES = sorted(all_queries())


def test_every_query_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())



@pytest.fixture(scope="module")
def con(sf):
    return duck_connection(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf, con, name):
    r = compare(spark, name, sf, con)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_contract(spark):
    import __spark_entry__ as E
    assert set(E.oracle_sql()) <= set(E.queries())
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "url", "n", "rank"]
    assert df.count() > 0
