"""Trading growth (M11-M12) and deposit growth."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.config import DEPOSIT_TASK, SUCCESS_PROPOSAL_STATUS, TRADING_TASK
from weekwise.functions.scalar import plus_days, plus_days_ts
from weekwise.operators.cohort import label_customer, with_subtotal
from weekwise.operators.joins import CalendarSide
from weekwise.operators.temporal import day_buckets, prev_before, range_join
from weekwise.plans.base import cid
from weekwise.plans.retention import Base


def _avg_when(cond: Column, value: str, name: str) -> Column:
    """``avg(case when cond then ifnull(value, 0) end)``.

    The sum is an exact decimal, so the result does not depend on the order of the tasks.
    """
    v = F.coalesce(F.col(value).cast("decimal(28,2)"), F.lit(0).cast("decimal(28,2)"))
    return F.try_divide(F.sum(F.when(cond, v)).cast("double"), F.count(F.when(cond, 1)).cast("double")).alias(name)


def trading_growth_base(b: Base) -> DataFrame:
    """Per (client, award week start) from the first award week on:
    best task status, whether the client also had a trading task the week
    before (also where that week is before the first), lots traded in the Monday week before
    (start - 6) and the Monday week inside (start + 1); labelled by the
    month of the week start."""
    cfg = b.cfg
    t1 = b.task_weeks.where(F.col("task_type") == TRADING_TASK).withColumn("_day", F.to_date("start_date"))
    weeks = (t1.where(F.col("_day") >= F.lit(cfg.tasks_from))
             .groupBy("cid", "client_id", F.col("_day").alias("start_date"))
             .agg(F.max("task_status").alias("task_status")))
    prev = t1.select("cid", F.date_add("_day", 7).alias("start_date")).distinct() \
        .withColumn("last_week", F.lit(1))
    lots = (b.trading_weeks.groupBy(F.col("customer_id").alias("cid"), "report_time")
            .agg(F.sum("rt_lot_open_sa").cast("decimal(28,2)").alias("rt_lot_open_sa")))
    last = lots.select("cid", F.date_add("report_time", 6).alias("start_date"),
                       F.col("rt_lot_open_sa").alias("lot_last_week"))
    this = lots.select("cid", F.date_sub("report_time", 1).alias("start_date"),
                       F.col("rt_lot_open_sa").alias("lot_this_week"))
    joined = (weeks.join(prev, ["cid", "start_date"], "left")
              .join(last, ["cid", "start_date"], "left")
              .join(this, ["cid", "start_date"], "left"))
    return label_customer(joined, "cid", F.col("start_date"), b.first_active).drop("cid")


def _growth_aggs(prefix: str, non_task: Column, completed: tuple[int, ...],
                 last_col: str, this_col: str) -> list[Column]:
    done = F.col("task_status").isin(*completed)
    not_done = ~F.col("task_status").isin(*completed)
    out = []
    for label, cond in (("non_task", non_task), ("completed", done), ("uncompleted", not_done)):
        out.append(_avg_when(cond, last_col, f"{prefix}_{label}_last_week"))
        out.append(_avg_when(cond, this_col, f"{prefix}_{label}_this_week"))
    return out


def trading_growth(b: Base) -> DataFrame:
    """Average lots last/this week of three groups - no trading task
    the week before, task completed, task not completed - per (period,
    customer type) and 'All customer'."""
    base = trading_growth_base(b).withColumnRenamed("start_date", "period")
    aggs = _growth_aggs("task_1", F.col("last_week").isNull(), b.cfg.completed_statuses,
                        "lot_last_week", "lot_this_week")
    return with_subtotal(base, ["period"], "customer_type", aggs)


def deposit_growth_base(b: Base) -> DataFrame:
    """Distinct deposit-task rows (one per status, N7) from
    ``growth_tasks_from`` on, with successful deposit amounts inside the
    award week and in the 7 days up to its start, whether the client's
    previous deposit-task week started exactly 7 days earlier (J13);
    labelled by the month of the week start.

    The amounts are computed per (client, award week) against the few
    distinct award weeks (broadcast, day-bucketed), combined map-side, then
    joined to the task rows on (client, week): no per-client fan-out of
    deposits x task weeks.
    """
    cfg = b.cfg
    tasks = (b.task_weeks.where((F.col("task_type") == DEPOSIT_TASK)
                                 & (F.to_date("start_date") >= F.lit(cfg.growth_tasks_from)))
             .select("cid", "client_id", "task_status", "start_date", "end_date").distinct())
    weeks = tasks.select("start_date", "end_date").distinct()
    # no window starts before this, so older deposits need not be read
    first = cfg.growth_tasks_from - dt.timedelta(days=7)
    deposits = (b.t.bo_client_deposit_proposal
                .where((F.col("proposal_status") == SUCCESS_PROPOSAL_STATUS)
                       & (F.col("create_date") >= F.lit(first).cast("timestamp")))
                .select(cid().alias("cid"), "create_date", "amount_converted"))
    # Both windows of every award week in one day-bucketed, size-checked
    # broadcast side: the deposits are scanned and joined once.
    windows = weeks.select("start_date", "end_date", F.lit(True).alias("_this"),
                           F.col("start_date").alias("_lo"), F.col("end_date").alias("_hi")).unionByName(
        weeks.select("start_date", "end_date", F.lit(False).alias("_this"),
                     plus_days_ts("start_date", -7).alias("_lo"), F.col("start_date").alias("_hi")))
    buckets = b.memo("deposit_growth_buckets", lambda: CalendarSide(
        day_buckets(windows, "_lo", "_hi"), cfg.broadcast_max_rows))
    sums = b.by_customer("deposit_sums", lambda: (
        range_join(deposits, "create_date", buckets, "_lo", "_hi").groupBy("cid", "start_date", "end_date")
        .agg(F.sum(F.when(F.col("_this"), F.col("amount_converted"))).alias("amount_this_week"),
             F.sum(F.when(~F.col("_this"), F.col("amount_converted"))).alias("amount_last_week"))))
    keys = ["cid", "start_date", "end_date"]
    with_amounts = (tasks.join(sums, keys, "left")
                    .withColumn("amount_this_week", F.coalesce("amount_this_week", F.lit(0).cast("decimal(28,2)")))
                    .withColumn("amount_last_week", F.coalesce("amount_last_week", F.lit(0).cast("decimal(28,2)"))))
    prev = prev_before(with_amounts, "cid", "start_date", "_prev")
    flagged = prev.withColumn(
        "last_week",
        F.when(F.to_date("_prev") == plus_days("start_date", -7), 1).otherwise(0)).drop("_prev")
    return label_customer(flagged, "cid", F.col("start_date"), b.first_active).drop("cid")


def deposit_growth(b: Base) -> DataFrame:
    """As M12 for deposit amounts, period = date of the week start."""
    base = deposit_growth_base(b).withColumn("period", F.to_date("start_date"))
    aggs = _growth_aggs("task_2", F.col("last_week") == 0, b.cfg.completed_statuses,
                        "amount_last_week", "amount_this_week")
    return with_subtotal(base, ["period"], "customer_type", aggs)
