"""Derive the seven source tables from the driver's ``events`` table.

The driver's test data has no incentive-programme tables, so each one is a
deterministic function of ``events`` (rules in FIXTURES.md section 3).  The
same rules are written in DuckDB SQL in ``weekwise.oracle.fixture_sql``; both
sides therefore start from identical rows.

Every table is a filter + projection or a filter + group-by over ``events``:
no joins, no windows, so the derivation scales with the events table and the
group-bys combine map-side before their shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.config import DAILY, WEEKLY
from weekwise.sources.schema import MONEY
from weekwise.sources.tables import Tables, tables_from

# Fixed values of the fixture rules: 700 days = 100 whole weeks, so weekdays
# are kept and 2024-01-01 (Monday) becomes 2025-12-01 (Monday).
SHIFT_DAYS = 700
OLD_CUSTOMER_SHIFT_DAYS = 35


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _client_id(user_id: Column) -> Column:
    prefix = F.when(user_id % 10 == 9, F.lit("96")).otherwise(F.lit("95"))
    return F.concat(prefix, F.lpad(user_id.cast("string"), 6, "0")).cast("bigint")


def _prepared(events: DataFrame) -> DataFrame:
    ts2 = F.col("ts").cast("timestamp") + F.make_interval(days=F.lit(SHIFT_DAYS))
    return (events
            .select("event_id", "user_id", "event_type", "value",
                    ts2.alias("ts2"), _client_id(F.col("user_id")).alias("client_id"))
            .withColumns({
                "mon": F.to_date(F.date_trunc("week", "ts2")),
                "sun": F.date_sub(F.to_date(F.date_trunc("week", F.col("ts2") + F.expr("INTERVAL 1 DAY"))), 1),
                "money": F.col("value").cast(MONEY),
            }))


def derive_tables(events: DataFrame) -> Tables:
    ev = _prepared(events)
    cid = F.col("client_id").cast("string")
    zero = F.lit(0).cast(MONEY)

    views = ev.where(F.col("event_type") == "view")
    trading = (views.groupBy(cid.alias("customer_id"), F.col("mon").alias("report_time"))
               .agg(F.sum(F.when(F.col("event_id") % 3 == 0, F.col("money")).otherwise(zero))
                    .cast(MONEY).alias("rt_lot_open_sa"),
                    F.count_if(F.col("event_id") % 3 == 0).alias("rt_active_trader_all_cc"))
               .withColumn("report_timeframe", F.lit(WEEKLY)))

    purchases = ev.where(F.col("event_type") == "purchase")
    proposals = purchases.select(
        "client_id",
        F.col("ts2").alias("create_date"),
        (F.col("event_id") % 3 + 1).cast("int").alias("proposal_status"),
        F.col("money").alias("amount_converted"))

    weekly_deposits = (purchases.groupBy(cid.alias("customer_id"), F.col("mon").alias("report_time"))
                       .agg(F.sum(F.when(F.col("event_id") % 3 == 1, F.col("money")).otherwise(zero))
                            .cast(MONEY).alias("deposit_success_amount_inusd_sa"))
                       .withColumn("report_timeframe", F.lit(WEEKLY)))

    week_end = F.date_add("sun", 6)
    tasks = (ev.where((F.col("event_type") == "signup") & (F.expr("event_id div 4") % 5 < 2))
             .select(
                 "client_id",
                 (F.col("event_id") % 2 + 1).cast("int").alias("task_type"),
                 (F.expr("event_id div 2") % 4).cast("int").alias("task_status"),
                 F.concat(F.lit("G"), (F.expr("event_id div 8") % 3).cast("string")).alias("group_name"),
                 F.date_add("sun", (F.col("event_id") % 3).cast("int")).cast("timestamp").alias("start_date"),
                 (week_end.cast("timestamp") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")).alias("end_date"),
                 F.date_format(week_end, "yyyyMMdd").alias("award_period")))

    clicks = (ev.where((F.col("event_type") == "click") & (F.col("event_id") % 2 == 0))
              .select(cid.alias("user_id"),
                      F.date_format(week_end, "yyyyMMdd").alias("week_group"),
                      (F.col("event_id") % 3 + 1).alias("click_count")))

    day = F.to_date("ts2")
    business_day = F.when(F.col("user_id") % 3 == 0, F.date_sub(day, OLD_CUSTOMER_SHIFT_DAYS)).otherwise(day)
    business = (ev.groupBy(cid.alias("customer_id"), business_day.alias("report_time"))
                .agg(F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).cast("bigint")
                     .alias("deposit_success_customer_cc"),
                     F.max(F.when(F.col("event_type") == "view", 1).otherwise(0)).cast("bigint")
                     .alias("rt_active_trader_open_cc"))
                .withColumn("report_timeframe", F.lit(DAILY)))

    first_success = F.min(F.when((F.col("event_type") == "purchase") & (F.col("event_id") % 3 == 1), F.col("ts2")))
    crm = (ev.groupBy("client_id")
           .agg(first_success.alias("first_ts"))
           .select("client_id",
                   F.when(F.col("client_id") % 7 == 0, F.lit(0).cast("bigint"))
                   .otherwise(F.unix_millis("first_ts")).alias("first_deposit_time")))

    return tables_from({
        "report_business": business,
        "report_trading_deal_real": trading,
        "report_transaction_deposit": weekly_deposits,
        "rebate_user_task_detail": tasks,
        "bo_client_deposit_proposal": proposals,
        "smart_reward_client_event": clicks,
        "crm_customer_base": crm,
    })


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return derive_tables(read_events(spark, sf_dir))
