"""The derived source tables have the row counts of FIXTURES.md section 4 and
equal the DuckDB derivation."""
import pytest

from conftest import SF_SMALL
from weekwise.oracle.compare import compare
from weekwise.oracle.fixture_sql import FIXTURE_TABLES, with_fixture
from weekwise.sources.fixture import fixture_tables

EXPECTED_SF0001 = {
    "report_trading_deal_real": 64, "bo_client_deposit_proposal": 202, "report_transaction_deposit": 68,
    "rebate_user_task_detail": 83, "smart_reward_client_event": 94, "report_business": 397,
    "crm_customer_base": 15,
}


@pytest.mark.parametrize("name", FIXTURE_TABLES)
def test_fixture_table(spark, duck_small, name):
    df = fixture_tables(spark, SF_SMALL).as_dict()[name]
    r = compare(df, duck_small, with_fixture(f" SELECT * FROM {name}"))
    assert r["ok"], r
    assert r["rows_spark"] == EXPECTED_SF0001[name]
