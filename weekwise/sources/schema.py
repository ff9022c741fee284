"""Declared schemas of the seven source tables (columns the reports read)."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

REPORT_BUSINESS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("report_timeframe", T.StringType()),
    T.StructField("report_time", T.DateType()),
    T.StructField("deposit_success_customer_cc", T.LongType()),
    T.StructField("rt_active_trader_open_cc", T.LongType()),
])

REPORT_TRADING_DEAL_REAL = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("report_timeframe", T.StringType()),
    T.StructField("report_time", T.DateType()),
    T.StructField("rt_lot_open_sa", MONEY),
    T.StructField("rt_active_trader_all_cc", T.LongType()),
])

REPORT_TRANSACTION_DEPOSIT = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("report_timeframe", T.StringType()),
    T.StructField("report_time", T.DateType()),
    T.StructField("deposit_success_amount_inusd_sa", MONEY),
])

REBATE_USER_TASK_DETAIL = T.StructType([
    T.StructField("client_id", T.LongType()),
    T.StructField("task_type", T.IntegerType()),
    T.StructField("task_status", T.IntegerType()),
    T.StructField("group_name", T.StringType()),
    T.StructField("start_date", T.TimestampType()),
    T.StructField("end_date", T.TimestampType()),
    T.StructField("award_period", T.StringType()),
])

BO_CLIENT_DEPOSIT_PROPOSAL = T.StructType([
    T.StructField("client_id", T.LongType()),
    T.StructField("create_date", T.TimestampType()),
    T.StructField("proposal_status", T.IntegerType()),
    T.StructField("amount_converted", MONEY),
])

SMART_REWARD_CLIENT_EVENT = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("week_group", T.StringType()),
    T.StructField("click_count", T.LongType()),
])

CRM_CUSTOMER_BASE = T.StructType([
    T.StructField("client_id", T.LongType()),
    T.StructField("first_deposit_time", T.LongType()),
])

SCHEMAS: dict[str, T.StructType] = {
    "report_business": REPORT_BUSINESS,
    "report_trading_deal_real": REPORT_TRADING_DEAL_REAL,
    "report_transaction_deposit": REPORT_TRANSACTION_DEPOSIT,
    "rebate_user_task_detail": REBATE_USER_TASK_DETAIL,
    "bo_client_deposit_proposal": BO_CLIENT_DEPOSIT_PROPOSAL,
    "smart_reward_client_event": SMART_REWARD_CLIENT_EVENT,
    "crm_customer_base": CRM_CUSTOMER_BASE,
}

TABLE_NAMES = tuple(SCHEMAS)
