"""Named queries over the driver's test data.

Each entry takes ``(spark, sf_dir)``, derives the source tables from that
folder's ``events`` table, runs one plan of ``weekwise.plans`` with the
fixture calendar and returns it in the canonical output form.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.config import DEPOSIT_TASK, FIXTURE, TRADING_TASK, ReportConfig
from weekwise.functions.canonical import canonical
from weekwise.session import report_session
from weekwise.plans import clicks, groups, growth, present, report, retention
from weekwise.plans.retention import Base
from weekwise.sources.files import work_folder
from weekwise.sources.fixture import fixture_tables
from weekwise.sources.publish import publish_reports
from weekwise.sources.sinks import read_report_json
from weekwise.sources.snapshots import load_snapshot, write_snapshot
from weekwise.sources.state import FirstActiveState


_BASES: dict[tuple, tuple[tuple, Base]] = {}


def _state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files: another state is another snapshot."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(root)))


def fixture_base(spark: SparkSession, sf_dir: str, cfg: ReportConfig = FIXTURE, mode: str = "cache") -> Base:
    """One persisted ``Base`` per (application, folder, config, mode): the source
    tables of a folder are a daily snapshot, so every report query shares the
    award weeks, first-active dates, trading weeks and click totals instead of
    recomputing them per branch.  When the folder's files change, or when
    Spark no longer stores what the base has kept (``clearCache``), that base
    is released and a new one is made."""
    key = (spark.sparkContext.applicationId, sf_dir, cfg, mode)
    state = _state(spark, f"{sf_dir}/events.parquet")
    kept = _BASES.get(key)
    if kept is not None and kept[0] == state and kept[1].is_stored():
        return kept[1]
    if kept is not None:
        kept[1].unpersist()
    base = Base(fixture_tables(spark, sf_dir), cfg).persist(mode)
    _BASES[key] = (state, base)
    return base


def reset() -> None:
    """Drop the memoised bases (and their persisted relations)."""
    for _, base in _BASES.values():
        base.unpersist()
    _BASES.clear()


def _q(fn: Callable[[Base], DataFrame], mode: str = "cache") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return canonical(fn(fixture_base(report_session(spark), sf_dir, mode=mode)))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


WEEKLY: dict[str, Callable[[Base], DataFrame]] = {
    "first_active": lambda b: b.first_active,
    "award_weeks": lambda b: b.award_weeks,
    "trading_weeks": lambda b: b.trading_weeks,
    "trading_task_match": retention.trading_task_match,
    "trading_retention": retention.trading_retention,
    "deposit_boundaries": retention.deposit_boundaries,
    "deposit_week_events": retention.deposit_week_events,
    "next_deposit_week": lambda b: retention.next_deposit_week(b).drop("cid"),
    "deposit_client_weeks": retention.deposit_client_weeks,
    "deposit_retention": retention.deposit_retention,
    "trading_growth_base": growth.trading_growth_base,
    "trading_growth": growth.trading_growth,
    "deposit_growth_base": growth.deposit_growth_base,
    "deposit_growth": growth.deposit_growth,
    "weekly_report": report.weekly_report,
    "weekly_report_derived": report.weekly_report_derived,
}


CLICKS: dict[str, Callable[[Base], DataFrame]] = {
    "click_task1_assigned": lambda b: clicks.assigned_clicks(b, TRADING_TASK),
    "click_task1_non_assigned": lambda b: clicks.non_assigned_clicks(b, TRADING_TASK),
    "click_task2_assigned": lambda b: clicks.assigned_clicks(b, DEPOSIT_TASK),
    "click_task2_non_assigned": lambda b: clicks.non_assigned_clicks(b, DEPOSIT_TASK),
    "click_task1_new_this_week": lambda b: clicks.new_this_week_clicks(b, TRADING_TASK),
    "click_task1_completion": lambda b: clicks.completion_clicks(b, TRADING_TASK),
    "click_task2_new_this_week": lambda b: clicks.new_this_week_clicks(b, DEPOSIT_TASK),
    "click_task2_completion": lambda b: clicks.completion_clicks(b, DEPOSIT_TASK),
    "click_report": clicks.click_report,
    "click_report_derived": clicks.click_report_derived,
}

GROUPS: dict[str, Callable[[Base], DataFrame]] = {
    "task_group_base": groups.task_group_base,
    "task_group_clicks": groups.task_group_clicks,
    "task_group_clicks_derived": groups.task_group_clicks_derived,
}


def _weekly(b: Base) -> DataFrame:
    """The finished weekly report, which the indicator tables read more than once."""
    return b.kept("weekly_report", lambda: report.weekly_report_derived(b, sort=False))


def _clicks(b: Base) -> DataFrame:
    return b.kept("click_report", lambda: clicks.click_report_derived(b, sort=False))


def _groups(b: Base) -> DataFrame:
    return b.kept("group_report", lambda: groups.task_group_clicks_derived(b, sort=False))


# The last queries show fewer periods than the reports have.
PRESENT: dict[str, Callable[[Base], DataFrame]] = {
    "indicator_long": lambda b: present.indicator_long(_weekly(b), b.cfg.weeks),
    "indicator_pivot": lambda b: present.indicator_pivot(_weekly(b), b.cfg.weeks),
    "latest_period": lambda b: present.latest_period(_weekly(b)),
    "click_indicator_long": lambda b: present.click_indicator_long(_clicks(b), b.cfg.weeks),
    "click_indicator_pivot": lambda b: present.click_indicator_pivot(_clicks(b), b.cfg.weeks),
    "task_group_long": lambda b: present.task_group_long(_groups(b), b.cfg.weeks),
    "task_group_pivot": lambda b: present.task_group_pivot(_groups(b), b.cfg.weeks),
    "indicator_long_2_weeks": lambda b: present.indicator_long(_weekly(b), 2),
    "click_indicator_long_2_weeks": lambda b: present.click_indicator_long(_clicks(b), 2),
    "task_group_long_2_weeks": lambda b: present.task_group_long(_groups(b), 2),
}


def _first_active_day_by_day(b: Base) -> DataFrame:
    """M1 as daily runs keep it: an initial load, three days on their own, one of them again, and a compaction."""
    t = b.t.report_business
    last = t.agg(F.max("report_time")).head()[0]
    state = FirstActiveState(t.sparkSession, f"{work_folder(t.sparkSession, 'first-active')}/{uuid.uuid4().hex}", b.cfg)
    for back in (3, 2, 1, 0):
        state.catch_up(t, last - dt.timedelta(days=back))
    state.merge(t, last, last)
    state.compact()
    return state.read()


def _published(name: str, build: Callable[[Base], DataFrame]) -> Callable[[Base], DataFrame]:
    """A report read back from its published array file."""
    def run(b: Base) -> DataFrame:
        out = f"{work_folder(b.t.report_business.sparkSession, 'published')}/{uuid.uuid4().hex}"
        publish_reports(b, out, {name: build})
        return read_report_json(b.t.report_business.sparkSession, f"{out}/{name}", build(b).schema, multi_line=True)
    return run


def _of_snapshot(fn: Callable[[Base], DataFrame]) -> Callable[[Base], DataFrame]:
    """A relation made from a written snapshot of the seven tables."""
    def run(b: Base) -> DataFrame:
        spark = b.t.report_business.sparkSession
        root = f"{work_folder(spark, 'snapshots')}/{uuid.uuid4().hex}"
        write_snapshot(b.t, root, dt.date(2026, 1, 5))
        return fn(Base(load_snapshot(spark, root), b.cfg))
    return run


STORED: dict[str, Callable[[Base], DataFrame]] = {
    "first_active_incremental": _first_active_day_by_day,
    "snapshot_first_active": _of_snapshot(lambda b: b.first_active),
    "snapshot_trading_weeks": _of_snapshot(lambda b: b.trading_weeks),
    "published_weekly_report": _published("data_raw.json", report.weekly_report_derived),
    "published_click_report": _published("data_raw_click.json", clicks.click_report_derived),
    "published_task_groups": _published("task_group_click.json", groups.task_group_clicks_derived),
}
STORED_AS = {"first_active_incremental": "first_active", "snapshot_first_active": "first_active",
             "snapshot_trading_weeks": "trading_weeks", "published_weekly_report": "weekly_report_derived",
             "published_click_report": "click_report_derived", "published_task_groups": "task_group_clicks_derived"}

# The per-customer relations written once in buckets by customer.
BUCKETED: dict[str, Callable[[Base], DataFrame]] = {
    "bucketed_weekly_report": report.weekly_report_derived,
    "bucketed_click_report": clicks.click_report_derived,
    "bucketed_next_deposit_week": lambda b: retention.next_deposit_week(b).drop("cid"),
}
STORED_AS |= {"bucketed_weekly_report": "weekly_report_derived", "bucketed_click_report": "click_report_derived",
              "bucketed_next_deposit_week": "next_deposit_week"}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {}
    for table in (WEEKLY, CLICKS, GROUPS, PRESENT, STORED):
        for name, fn in table.items():
            out[name] = _q(fn)
    out.update({name: _q(fn, "buckets") for name, fn in BUCKETED.items()})
    return out


def oracle_sql() -> dict[str, str]:
    from weekwise.oracle.click_sql import CLICK_QUERIES, GROUP_QUERIES, click_oracle, group_oracle
    from weekwise.oracle.weekly_sql import WEEKLY_QUERIES, weekly_oracle
    out = {name: weekly_oracle(name) for name in WEEKLY_QUERIES}
    out.update({name: click_oracle(name) for name in CLICK_QUERIES})
    out.update({name: group_oracle(name) for name in GROUP_QUERIES})
    from weekwise.oracle.present_sql import PRESENT_QUERIES, present_oracle
    out.update({name: present_oracle(name) for name in PRESENT_QUERIES})
    out.update({name: out[same] for name, same in STORED_AS.items()})
    return out
