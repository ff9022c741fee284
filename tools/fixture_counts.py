"""Print fixture row counts from Spark and DuckDB for one scale factor."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from weekwise.session import build_session
from weekwise.sources.fixture import fixture_tables
from weekwise.oracle.fixture_sql import FIXTURE_TABLES, with_fixture
from weekwise.oracle.compare import compare, duckdb_with_views

sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = build_session()
t = fixture_tables(spark, sf_dir).as_dict()
con = duckdb_with_views(sf_dir)
for name in FIXTURE_TABLES:
    r = compare(t[name], con, with_fixture(f" SELECT * FROM {name}"))
    print(name, r)
