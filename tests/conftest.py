import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from weekwise.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, app="weekwise-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck_small():
    from weekwise.oracle.compare import duckdb_with_views
    return duckdb_with_views(SF_SMALL)


def make_tables(spark, **rows):
    """Tables from hand-written rows; tables not given are empty."""
    from weekwise.sources.schema import SCHEMAS
    from weekwise.sources.tables import tables_from
    return tables_from({name: spark.createDataFrame(rows.get(name, []), schema)
                        for name, schema in SCHEMAS.items()})
