"""Every registered query equals its DuckDB oracle on the sf0.001 data."""
import pytest

from conftest import SF_SMALL
from weekwise.oracle.compare import compare
from weekwise.registry import oracle_sql, queries

QUERIES = queries()
ORACLES = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(QUERIES[name](spark, SF_SMALL), duck_small, ORACLES[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert len(df.columns) == 22 + 16
