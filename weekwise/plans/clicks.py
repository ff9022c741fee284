"""Click report (M17-M26): click-through of eight customer populations.

The populations of both task types are the rows of one relation, tagged with
task type and part.  Clicks of the award week and the new/old label are
looked up once for all of them, the rows collapse to one per (period, type,
part, customer) with flags and click sums, and one aggregation gives every
block its own columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekwise.config import DEPOSIT_TASK, TRADING_TASK, WEEKLY
from weekwise.functions.scalar import safe_div, yyyymmdd
from weekwise.operators.cohort import label_customer
from weekwise.plans.retention import Base

# Parts of a task type's customers: assigned to it, free of it though active,
# newly assigned, and assigned by task status.
ASSIGNED, FREE, NEW, STATUS = "assigned", "free", "new", "status"


def _rows(df: DataFrame, part: str, ref: str = "start_date", status: Column | None = None) -> DataFrame:
    return df.select("task_type", F.lit(part).alias("part"), "cid", F.col("period"), F.to_date(ref).alias("ref_date"),
                     (F.lit(None) if status is None else status).cast("int").alias("task_status"))


def _assignments(b: Base, types: Sequence[int]) -> DataFrame:
    """Task rows of the types by (client, week, status), with their number."""
    return (b.task_weeks.where(F.col("task_type").isin(*types) & (F.col("start_date") >= F.lit(b.cfg.tasks_from)))
            .groupBy("task_type", "cid", "start_date", "end_date", F.col("award_period").alias("period"), "task_status")
            .agg(F.sum("_n").alias("_n")))


def _free(b: Base, types: Sequence[int], assigned: DataFrame) -> DataFrame:
    """Weekly traders (task 1, ``rt_lot_open_sa > 0``) or depositors (task 2,
    deposit amount > 0) of the Monday week before the award week, without a
    task of that type in that award week (J14)."""
    cfg = b.cfg
    sources = {TRADING_TASK: (b.t.report_trading_deal_real, "rt_lot_open_sa"),
               DEPOSIT_TASK: (b.t.report_transaction_deposit, "deposit_success_amount_inusd_sa")}
    out = None
    for n in types:
        src, measure = sources[n]
        weekly = (src.where((F.col("report_timeframe") == WEEKLY)
                            & (F.col("report_time") >= F.lit(cfg.trading_from))
                            & F.col("customer_id").startswith(cfg.id_prefix) & (F.col(measure) > 0))
                  .select(F.lit(n).alias("task_type"), F.col("customer_id").alias("cid"), "report_time").distinct())
        out = weekly if out is None else out.unionByName(weekly)
    out = out.withColumn("period", yyyymmdd(F.date_add("report_time", 12)))
    return (out.join(assigned.select("task_type", "cid", "period"), ["task_type", "cid", "period"], "left_anti")
            .withColumn("start_date", F.date_add("report_time", 7)))


def _newly_assigned(assignments: DataFrame) -> DataFrame:
    """Rows of ``distinct(client, week, lag(start) over client)`` where the
    previous start is not exactly 7 days earlier (or absent).

    The lag runs over the raw task rows before DISTINCT (N8), so a client
    with k > 1 rows in one award week yields two distinct lags for that
    week: the previous week's start and the week's own start.  The same
    rows are produced here from one row per (client, week) with its row
    count - map-side combined, so the window only sees each client's week
    series, never a hot client's raw rows.
    """
    weeks = assignments.groupBy("task_type", "cid", "start_date", "end_date", "period").agg(F.sum("_n").alias("_n"))
    w = Window.partitionBy("task_type", "cid").orderBy("start_date", "end_date", "period")
    weeks = weeks.withColumn("_prev", F.lag("start_date").over(w))
    lags = F.when(F.col("_n") >= 2, F.array("_prev", "start_date")).otherwise(F.array("_prev"))
    rows = weeks.withColumn("lag_date", F.explode(F.array_distinct(lags))).drop("_n", "_prev")
    gap = F.to_date("start_date") != F.date_add(F.to_date("lag_date"), 7)
    return rows.where(gap | F.col("lag_date").isNull())


def members(b: Base, types: Sequence[int] = (TRADING_TASK, DEPOSIT_TASK),
            parts: Sequence[str] = (ASSIGNED, FREE, NEW, STATUS)) -> DataFrame:
    """The rows of the populations asked for."""
    tasks = _assignments(b, types)
    assigned = tasks.select("task_type", "cid", "start_date", "end_date", "period").distinct()
    found = []
    if STATUS in parts:
        found.append(_rows(tasks, STATUS, status=F.col("task_status")))
    if ASSIGNED in parts:
        found.append(_rows(assigned, ASSIGNED))
    if NEW in parts:
        found.append(_rows(_newly_assigned(tasks), NEW))
    if FREE in parts:
        found.append(_rows(_free(b, types, assigned), FREE))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def new_this_week_rows(b: Base, task_type: int) -> DataFrame:
    """(client rows with ``lag_date``) of M21 / M23 before the lookups."""
    return _newly_assigned(_assignments(b, (task_type,)))


def _per_customer(b: Base, rows: DataFrame) -> DataFrame:
    """One row per (period, type, task type, part, customer) with flags and click sums."""
    clicks = b.click_sums
    joined = rows.join(clicks, (rows["cid"] == clicks["user_id"]) & (rows["period"] == clicks["week_group"]),
                       "left").drop("user_id", "week_group")
    seen = label_customer(joined, "cid", F.col("ref_date"), b.first_active)
    done = F.coalesce(F.col("task_status").isin(*b.cfg.completed_statuses), F.lit(False))
    open_ = F.coalesce(~F.col("task_status").isin(*b.cfg.completed_statuses), F.lit(False))
    clicked = F.col("click_count").isNotNull()
    zero = F.lit(0).cast("bigint")
    return seen.groupBy("period", "customer_type", "task_type", "part", "cid").agg(
        F.max(clicked).alias("clicked"), F.sum("click_count").alias("clicks"),
        F.max(done).alias("done"), F.max(done & clicked).alias("done_clicked"),
        F.sum(F.when(done, F.col("click_count")).otherwise(zero)).alias("done_clicks"),
        F.max(open_).alias("open"), F.max(open_ & clicked).alias("open_clicked"),
        F.sum(F.when(open_, F.col("click_count")).otherwise(zero)).alias("open_clicks"))


# Block: task type, part, and its columns of _per_customer: member (None: all), clicker, clicks.
_SOURCES = {
    "task1_assigned": (1, ASSIGNED, None, "clicked", "clicks"),
    "task1_non_assigned": (1, FREE, None, "clicked", "clicks"),
    "task2_assigned": (2, ASSIGNED, None, "clicked", "clicks"),
    "task2_non_assigned": (2, FREE, None, "clicked", "clicks"),
    "task1_non_assigned_last_week": (1, NEW, None, "clicked", "clicks"),
    "task1_completed": (1, STATUS, "done", "done_clicked", "done_clicks"),
    "task1_non_completed": (1, STATUS, "open", "open_clicked", "open_clicks"),
    "task2_non_assigned_last_week": (2, NEW, None, "clicked", "clicks"),
    "task2_completed": (2, STATUS, "done", "done_clicked", "done_clicks"),
    "task2_non_completed": (2, STATUS, "open", "open_clicked", "open_clicks"),
}
_BLOCKS = list(_SOURCES)


def _measures(block: str, joined: bool = False) -> list[Column]:
    """Members, clickers and clicks of a block; NULL where it has no row at all.

    ``joined``: as looked up by period from another block, where a NULL period finds nothing.
    """
    n, part, member, clicker, clicks = _SOURCES[block]
    mine = (F.col("task_type") == n) & (F.col("part") == part)
    if joined:
        mine = mine & F.col("period").isNotNull()

    def count(flag):
        hit = F.col("cid").isNotNull() if flag is None else F.col("cid").isNotNull() & F.col(flag)
        return F.sum(F.when(mine, F.when(hit, 1).otherwise(0))).cast("bigint")

    return [count(member).alias(block), count(clicker).alias(f"{block}_click"),
            F.sum(F.when(mine, F.col(clicks))).cast("bigint").alias(f"{block}_click_count")]


def _block_table(b: Base, blocks: Sequence[str]) -> DataFrame:
    """The rows and columns of some blocks of one task type and part."""
    n, part = _SOURCES[blocks[0]][:2]
    rows = _per_customer(b, members(b, (n,), (part,)))
    return rows.groupBy("period", "customer_type").agg(*[m for block in blocks for m in _measures(block)])


def assigned_clicks(b: Base, task_type: int) -> DataFrame:
    """Assignees of the task type, those with clicks, clicks."""
    return _block_table(b, [f"task{task_type}_assigned"])


def non_assigned_clicks(b: Base, task_type: int) -> DataFrame:
    """Active customers without a task of the type."""
    return _block_table(b, [f"task{task_type}_non_assigned"])


def new_this_week_clicks(b: Base, task_type: int) -> DataFrame:
    """Assignees whose previous assignment of the type was not
    the week before."""
    return _block_table(b, [f"task{task_type}_non_assigned_last_week"])


def completion_clicks(b: Base, task_type: int) -> DataFrame:
    """Assignees by completed (status in completed statuses) and
    not completed; NULL status is in neither, click sums are 0-filled for
    rows of the other group (N14)."""
    return _block_table(b, [f"task{task_type}_completed", f"task{task_type}_non_completed"])


CLICK_REPORT_COLUMNS = ["period", "customer_type",
                        *[c for blk in _BLOCKS for c in (blk, f"{blk}_click", f"{blk}_click_count")]]

# Indicator code of each population block.
CLICK_CODES = dict(zip(["a1", "a2", "a3", "a4", "b1", "b2", "b3", "b4", "b5", "b6"], _BLOCKS))


def click_report(b: Base, sort: bool = True) -> DataFrame:
    """One row per (period, customer type) that task-1 assignees have;
    a block without rows there is NULL; no 'All customer' row."""
    driver = F.max((F.col("task_type") == TRADING_TASK) & (F.col("part") == ASSIGNED)).alias("_driver")
    out = (_per_customer(b, members(b)).groupBy("period", "customer_type")
           .agg(driver, *[m for block in _BLOCKS for m in _measures(block, block != _BLOCKS[0])])
           .where("_driver").select(*CLICK_REPORT_COLUMNS))
    return out.orderBy(F.col("period").desc(), F.col("customer_type")) if sort else out


def with_click_derived(report: DataFrame) -> DataFrame:
    """Per code, participants / clickers / clicks / click rate."""
    cols = {}
    for code, blk in CLICK_CODES.items():
        cols[f"{code}_participants"] = F.col(blk)
        cols[f"{code}_clickers"] = F.col(f"{blk}_click")
        cols[f"{code}_clicks"] = F.col(f"{blk}_click_count")
        cols[f"{code}_click_rate"] = safe_div(f"{blk}_click", blk)
    return report.withColumns(cols)


def click_report_derived(b: Base, sort: bool = True) -> DataFrame:
    return with_click_derived(click_report(b, sort))
