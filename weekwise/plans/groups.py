"""Task-group click report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.functions.scalar import epoch_ms_to_ts, safe_div
from weekwise.operators.joins import possible_keys
from weekwise.plans.retention import Base


def task_group_base(b: Base) -> DataFrame:
    """Per (client, group, award period) from ``group_period_from`` on:
    the client's own earliest start and latest end (raw dates, N11), first
    deposit time from the CRM table (epoch ms, 0 = never) and the number of
    click rows of that award week (0 when none, J7).

    Click rows match on the numeric value of ``user_id`` (string vs number
    comparison, F6); text that is not a number matches nothing.  Both
    lookups are cut to rows of possible clients of the report and
    pre-aggregated to one row per key before the join, so what is shuffled
    follows the tasks and not the length of the tables.
    """
    tasks = b.kept("group_tasks", lambda: (
        b.t.rebate_user_task_detail
        .where(F.col("award_period") >= F.lit(b.cfg.group_period_from))
        .groupBy("client_id", "group_name", "award_period")
        .agg(F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date"))))
    crm = (possible_keys(b.t.crm_customer_base, "client_id", tasks, "client_id").groupBy("client_id")
           .agg(F.min(epoch_ms_to_ts("first_deposit_time")).alias("first_deposit_time")))
    events = b.t.smart_reward_client_event.where(F.col("week_group") >= F.lit(b.cfg.group_period_from)).withColumn(
        "_uid", F.expr("try_cast(user_id AS BIGINT)"))
    clicks = (possible_keys(events, "_uid", tasks, "client_id").groupBy("_uid", "week_group")
              .agg(F.count(F.lit(1)).alias("_n")))
    out = (tasks.join(crm, "client_id", "left")
           .join(clicks, (F.col("client_id") == F.col("_uid")) & (F.col("award_period") == F.col("week_group")),
                 "left")
           .withColumn("click_c", F.coalesce(F.col("_n"), F.lit(0).cast("bigint")))
           .drop("_uid", "week_group", "_n"))
    return out.select("client_id", "group_name", "start_date", "end_date", "award_period",
                      "first_deposit_time", "click_c")


def task_group_clicks(b: Base, sort: bool = True) -> DataFrame:
    """Per (award period, group): clients whose first deposit falls in
    their task dates ('activated this week') and those whose first deposit
    falls outside; clients without a deposit are in neither (N10).  Clickers
    have at least one click row (N9)."""
    base = task_group_base(b)
    inside = F.col("first_deposit_time").between(F.col("start_date"), F.col("end_date"))
    outside = ~inside
    ok = F.col("client_id").isNotNull()
    clicked = F.col("click_c") > 0

    def n(cond):
        return F.sum(F.when(ok & F.coalesce(cond, F.lit(False)), 1).otherwise(0)).cast("bigint")

    # One row per (client, group, period) already, so distinct counts are
    # plain conditional counts and need no second aggregation.
    out = base.groupBy("award_period", "group_name").agg(
        n(inside).alias("active_this_week"),
        n(inside & clicked).alias("active_click_this_week_user"),
        F.sum(F.when(inside, F.col("click_c"))).alias("active_click_this_week_count"),
        n(outside).alias("non_active_this_week"),
        n(outside & clicked).alias("non_active_click_this_week_user"),
        F.sum(F.when(outside, F.col("click_c"))).alias("non_active_click_this_week_count"))
    return out.orderBy("award_period", "group_name") if sort else out


def with_group_derived(report: DataFrame) -> DataFrame:
    """Click rates of both groups."""
    return report.withColumns({
        "active_click_rate": safe_div("active_click_this_week_user", "active_this_week"),
        "non_active_click_rate": safe_div("non_active_click_this_week_user", "non_active_this_week"),
    })


def task_group_clicks_derived(b: Base, sort: bool = True) -> DataFrame:
    return with_group_derived(task_group_clicks(b, sort))
