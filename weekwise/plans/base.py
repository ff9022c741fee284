"""Shared base relations: M1 first_active, M2 award_weeks, M3 trading_weeks.

Customer keys: report tables carry a string ``customer_id``; task, deposit and
crm tables a numeric ``client_id``.  The reports compare
``client_id::string = customer_id``, so plans add ``cid`` (the string form)
to numeric-keyed rows and use it as the one partitioning key: windows, the
new/old label join and the per-customer aggregations then share a single
hash partitioning instead of re-shuffling per step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekwise.config import DAILY, WEEKLY, ReportConfig
from weekwise.operators.joins import CalendarSide, null_safe_key
from weekwise.sources.tables import Tables


def cid(col: str = "client_id") -> Column:
    """String customer key of a numeric client id."""
    return F.col(col).cast("string")


def daily_activity(report_business: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Daily rows with a successful deposit or an open trade, of the programme's customers."""
    active = ((F.col("deposit_success_customer_cc") > 0) | (F.col("rt_active_trader_open_cc") > 0))
    return report_business.where(F.col("customer_id").startswith(cfg.id_prefix)
                                 & (F.col("report_timeframe") == DAILY) & active)


def first_active(t: Tables, cfg: ReportConfig) -> DataFrame:
    """M1: per customer, first day with a successful deposit or an open trade."""
    return (daily_activity(t.report_business, cfg)
            .groupBy("customer_id").agg(F.min("report_time").alias("first_active")))


def award_bounds(t: Tables, cfg: ReportConfig) -> CalendarSide:
    """Earliest start and latest end of every ``award_period``."""
    bounds = (t.rebate_user_task_detail.groupBy(*null_safe_key(F.col("award_period"), "_ap"))
              .agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")))
    return CalendarSide(bounds, cfg.broadcast_max_rows)


def _of_periods(tasks: DataFrame, bounds: DataFrame) -> DataFrame:
    """Task rows of the periods in ``bounds``, by a list that reaches the scan."""
    found = bounds.select("_ap", "_ap_null").collect()
    listed = F.col("award_period").isin(sorted(r._ap for r in found if not r._ap_null))
    return tasks.where(listed | F.col("award_period").isNull() if any(r._ap_null for r in found) else listed)


def award_weeks(t: Tables, bounds: CalendarSide, first: dt.date | None = None) -> DataFrame:
    """M2: task rows with ``start_date``/``end_date`` replaced by the earliest
    start and latest end of their ``award_period`` (W1).

    With ``first``, only periods that start on that day or later: the periods
    are known from their bounds before any task row is read, so they go to the
    task scan as a list (row groups, or partitions of a table laid out by
    ``award_period``, are skipped).  Bounds beyond the size of a calendar are
    not listed; the join leaves the other periods out.

    A window partitioned by ``award_period`` would put a whole week of
    assignments into one task; instead the per-period bounds (one row per
    award period) are aggregated and joined back.  The join is NULL-safe
    because the window groups NULL periods together.
    """
    tasks = t.rebate_user_task_detail
    if first is not None:
        kept = F.col("start_date") >= F.lit(first).cast("timestamp")
        if bounds.small:
            tasks = _of_periods(tasks, bounds.df.where(kept))
        bounds = bounds.where(kept)
    keyed = tasks.drop("start_date", "end_date").select("*", *null_safe_key(F.col("award_period"), "_ap"))
    columns = [c for c in tasks.columns if c not in ("start_date", "end_date")]
    return (bounds.join(keyed, ["_ap", "_ap_null"], ["client_id", "task_type", "group_name"])
            .select(*columns, "start_date", "end_date"))


def trading_weeks(t: Tables, cfg: ReportConfig) -> DataFrame:
    """M3: active weekly trading rows with the customer's next active week.

    One output row per source row.  The rows of a customer are ordered by
    week, then by lots (NULL first); a row's lead is the week of the row after it,
    so of several rows of one week only the last one leads to another week.

    Equal rows (customer, week, lots) are counted map-side first.  The lead
    is taken over each customer's weeks, whose number the calendar bounds,
    and comes back to the rows by an equi-join; no window sees raw rows.
    """
    r = t.report_trading_deal_real
    rows = (r.where((F.col("report_timeframe") == WEEKLY)
                    & (F.col("report_time") >= F.lit(cfg.trading_from))
                    & F.col("customer_id").startswith(cfg.id_prefix)
                    & (F.col("rt_active_trader_all_cc") > 0))
            .groupBy("customer_id", "report_time", "rt_lot_open_sa").agg(F.count(F.lit(1)).alias("_n")))
    weeks = rows.groupBy("customer_id", "report_time").agg(F.max("rt_lot_open_sa").alias("_last"))
    w = Window.partitionBy("customer_id").orderBy("report_time")
    weeks = weeks.withColumn("_next", F.lead("report_time").over(w))
    copies = rows.join(weeks, ["customer_id", "report_time"]).withColumn(
        "_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    last = F.col("rt_lot_open_sa").eqNullSafe(F.col("_last")) & (F.col("_k") == F.col("_n"))
    return copies.select("customer_id", "report_time", "rt_lot_open_sa",
                         F.when(last, F.col("_next")).otherwise(F.col("report_time")).alias("lead_time"))
