"""Weekly report (M15) and its derived indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.functions.scalar import growth, safe_div, yyyymmdd
from weekwise.plans.growth import deposit_growth, trading_growth
from weekwise.plans.retention import Base, deposit_retention, trading_retention

COUNT_COLUMNS = [
    "task1_assigned", "task1_assigned_retention", "task1_non_assigned", "task1_non_assigned_retention",
    "task2_assigned", "task2_assigned_retention", "task2_non_assigned", "task2_non_assigned_retention",
]
AVG_COLUMNS = [f"task_{n}_{g}_{w}" for n in (1, 2) for g in ("non_task", "completed", "uncompleted")
               for w in ("last_week", "this_week")]
REPORT_COLUMNS = ["period", "customer_type", *COUNT_COLUMNS, *AVG_COLUMNS]

# Derived indicator codes and the columns they are built from.
RETENTION_CODES = {
    "a1": ("task1_assigned_retention", "task1_assigned"),
    "a2": ("task1_non_assigned_retention", "task1_non_assigned"),
    "a3": ("task2_assigned_retention", "task2_assigned"),
    "a4": ("task2_non_assigned_retention", "task2_non_assigned"),
}
GROWTH_CODES = {
    "b1": "task_1_non_task", "b2": "task_1_completed", "b3": "task_1_uncompleted",
    "b4": "task_2_non_task", "b5": "task_2_completed", "b6": "task_2_uncompleted",
}
THIS_WEEK_CODES = {
    "c1": "task_1_non_task_this_week", "c2": "task_1_completed_this_week",
    "c3": "task_1_uncompleted_this_week", "c4": "task_2_non_task_this_week",
    "c5": "task_2_completed_this_week", "c6": "task_2_uncompleted_this_week",
}
DERIVED_COLUMNS = [*RETENTION_CODES, *GROWTH_CODES, *THIS_WEEK_CODES]


def weekly_report(b: Base, sort: bool = True) -> DataFrame:
    """Trading retention drives the rows (N13); deposit retention and
    both growth tables are left-joined on (period, customer type).  All four
    inputs are tiny (weeks x 3 rows); Spark broadcasts them at run time."""
    keys = ["period", "customer_type"]
    out = (trading_retention(b)
           .join(deposit_retention(b), keys, "left")
           .join(trading_growth(b), keys, "left")
           .join(deposit_growth(b), keys, "left")
           .withColumn("period", yyyymmdd(F.date_add("period", 6)))
           .select(*REPORT_COLUMNS)
           .distinct())
    return out.orderBy("period", "customer_type") if sort else out


def with_weekly_derived(report: DataFrame) -> DataFrame:
    """Retention ratios a1-a4, growth b1-b6, this-week copies c1-c6.
    Ratios with a zero or NULL denominator are NULL (F10, F11)."""
    cols = {code: safe_div(num, den) for code, (num, den) in RETENTION_CODES.items()}
    cols.update({code: growth(f"{base}_this_week", f"{base}_last_week") for code, base in GROWTH_CODES.items()})
    cols.update({code: F.col(src) for code, src in THIS_WEEK_CODES.items()})
    return report.withColumns(cols)


def weekly_report_derived(b: Base, sort: bool = True) -> DataFrame:
    return with_weekly_derived(weekly_report(b, sort))
