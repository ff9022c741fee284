"""Trading retention (M4-M5) and deposit retention."""

from __future__ import annotations

import datetime as dt

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.config import SUCCESS_PROPOSAL_STATUS, TRADING_TASK, WEEKLY, ReportConfig
from weekwise.functions.scalar import plus_days, plus_days_ts, yyyymmdd
from weekwise.operators.cohort import count_flags, entity_flags, label_customer, with_subtotal
from weekwise.operators.joins import CalendarSide
from weekwise.operators.temporal import day_buckets, next_after, range_join
from weekwise.plans.base import award_bounds, award_weeks, cid, first_active, trading_weeks
from weekwise.sources.buckets import BucketedTables
from weekwise.sources.tables import Tables

# The shared relations and their customer key; each has few rows per customer and week.
PER_CUSTOMER = {"first_active": "customer_id", "task_weeks": "cid", "trading_weeks": "customer_id",
                "click_sums": "user_id"}


class Base:
    """The shared relations of one report run, built once per run.

    ``persist()`` keeps them for the run: ``"cache"`` (executor memory and
    disk; lost blocks are recomputed from lineage), ``"checkpoint"``
    (written to the cluster's ``spark.checkpoint.dir``, lineage cut, so a
    lost executor costs no recomputation of the source scans) or
    ``"buckets"`` (written there too, all in the same buckets by customer, so
    that windows, joins and aggregations by customer need no exchange).
    """

    def __init__(self, t: Tables, cfg: ReportConfig, first_active: DataFrame | None = None):
        """``first_active`` is a kept M1 (``sources.state.FirstActiveState``); without it, M1 is made from the tables."""
        self.t, self.cfg = t, cfg
        self._given_fa = self._fa = first_active
        self._aw = self._rw = self._tk = self._tw = self._cs = None
        self._memo: dict[str, DataFrame | CalendarSide] = {}
        self._persisted: list[DataFrame] = []
        self._buckets: BucketedTables | None = None

    def memo(self, key: str, build) -> DataFrame | CalendarSide:
        """A cached relation built once per run; ``unpersist`` releases it."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def kept(self, key: str, build) -> DataFrame:
        """``memo`` of a relation that several plans of the run read."""
        return self.memo(key, lambda: build().persist(StorageLevel.MEMORY_AND_DISK))

    def by_customer(self, key: str, build) -> DataFrame:
        """A relation with a ``cid``, kept in the buckets of the others; as it is where there are none."""
        if not self.in_buckets:
            return build()
        return self.memo(key, lambda: self._buckets.write(build(), key, "cid"))

    @property
    def in_buckets(self) -> bool:
        return self._buckets is not None

    @property
    def is_persisted(self) -> bool:
        return bool(self._persisted) or self.in_buckets

    def unpersist(self) -> None:
        for df in self._persisted:
            df.unpersist()
        for df in self._memo.values():
            df.unpersist()
        if self._buckets is not None:
            self._buckets.drop()
        self._persisted.clear()
        self._memo.clear()
        self._buckets = None
        self._fa = self._given_fa
        self._aw = self._rw = self._tk = self._tw = self._cs = None

    def is_stored(self) -> bool:
        """Whether Spark still holds every relation that this base has asked it to keep."""
        kept = [*self._persisted, *(x.df if isinstance(x, CalendarSide) else x for x in self._memo.values())]
        asked = [df for df in kept if self._buckets is None or not self._buckets.has(df)]
        return (all(df.storageLevel.useMemory or df.storageLevel.useDisk for df in asked)
                and (self._buckets is None or self._buckets.are_stored()))

    def persist(self, mode: str = "cache", buckets: int | None = None) -> "Base":
        """Keep the shared relations; ``"checkpoint"`` needs the session's ``spark.checkpoint.dir``.

        ``"buckets"`` writes ``buckets`` files a relation; by default, as many as the session has shuffle partitions.
        """
        if mode not in ("cache", "checkpoint", "buckets"):
            raise ValueError(f"no such mode: {mode}")
        if mode == "buckets":
            self._buckets = BucketedTables(self.t.report_business.sparkSession, buckets)
        for attr, key in PER_CUSTOMER.items():
            df = getattr(self, attr)
            if mode == "buckets":
                df = self._buckets.write(df, attr, key)
            elif mode == "checkpoint":
                df = df.checkpoint(eager=True)
            else:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
                self._persisted.append(df)
            setattr(self, "_" + {"first_active": "fa", "task_weeks": "tk",
                                 "trading_weeks": "tw", "click_sums": "cs"}[attr], df)
        return self

    @property
    def click_sums(self) -> DataFrame:
        """Total clicks per (user, award week); NULL when every click
        count is NULL.  Only weeks that a population of the report can have
        are read on; the sum is combined map-side, so one very active user
        does not skew the shuffle."""
        if self._cs is None:
            periods = self.memo("click_periods", lambda: CalendarSide(
                click_periods(self), self.cfg.broadcast_max_rows))
            rows = periods.join(self.t.smart_reward_client_event, ["week_group"], ["user_id"], "left_semi")
            self._cs = rows.groupBy("user_id", "week_group").agg(F.sum("click_count").alias("click_count"))
        return self._cs

    @property
    def first_active(self) -> DataFrame:
        if self._fa is None:
            self._fa = first_active(self.t, self.cfg)
        return self._fa

    @property
    def award_bounds(self) -> CalendarSide:
        """Earliest start and latest end of every award period, of the whole table."""
        return self.memo("award_bounds", lambda: award_bounds(self.t, self.cfg))

    @property
    def award_weeks(self) -> DataFrame:
        """M2 of all task rows ever; the reports read ``report_weeks``."""
        if self._aw is None:
            self._aw = award_weeks(self.t, self.award_bounds)
        return self._aw

    @property
    def report_weeks(self) -> DataFrame:
        """M2 of the award weeks that a report can look at: the first report week and the one before it, and later."""
        if self._rw is None:
            first = min(self.cfg.tasks_from, self.cfg.growth_tasks_from) - dt.timedelta(days=7)
            self._rw = award_weeks(self.t, self.award_bounds, first)
        return self._rw

    @property
    def task_weeks(self) -> DataFrame:
        """``report_weeks`` without groups: one row per (client, type, status, award week), with the number ``_n`` of
        its task rows, which are combined map-side, so that a client with very many task rows holds few rows here."""
        if self._tk is None:
            self._tk = (self.report_weeks.groupBy(cid().alias("cid"), "client_id", "task_type", "task_status",
                                                  "award_period", "start_date", "end_date")
                        .agg(F.count(F.lit(1)).alias("_n")))
        return self._tk

    @property
    def trading_weeks(self) -> DataFrame:
        if self._tw is None:
            self._tw = trading_weeks(self.t, self.cfg)
        return self._tw


def click_periods(b: Base) -> DataFrame:
    """(week_group): award weeks of the assignments and of the weekly rows that the click report counts."""
    t, cfg = b.t, b.cfg
    weeks = b.award_bounds.df.where((F.col("start_date") >= F.lit(cfg.tasks_from)) & ~F.col("_ap_null")).select(
        F.col("_ap").alias("week_group"))
    for src in (t.report_trading_deal_real, t.report_transaction_deposit):
        weekly = src.where((F.col("report_timeframe") == WEEKLY) & (F.col("report_time") >= F.lit(cfg.trading_from)))
        weeks = weeks.unionByName(weekly.select("report_time").distinct().select(
            yyyymmdd(F.date_add("report_time", 12)).alias("week_group")))
    return weeks.where("week_group is not null").distinct()


def assigned_tasks(b: Base, task_type: int | None) -> DataFrame:
    """Distinct (client, award week) assignments from the first award week
    on; ``task_type=None`` keeps every type."""
    aw = b.task_weeks.where(F.col("start_date") >= F.lit(b.cfg.tasks_from))
    if task_type is not None:
        aw = aw.where(F.col("task_type") == task_type)
    return aw.select("cid", "client_id", "start_date", "end_date", "award_period").distinct()


def trading_task_match(b: Base) -> DataFrame:
    """M4: each active trader-week, left-matched to the trading task whose
    award week contains the following Monday, labelled new/old by the month
    of ``report_time + 6``."""
    tw = b.trading_weeks
    tasks = assigned_tasks(b, TRADING_TASK).withColumnRenamed("cid", "_cid")
    next_monday = plus_days("report_time", 7)
    matched = tw.join(tasks, (tw["customer_id"] == tasks["_cid"])
                      & (F.to_date(tasks["start_date"]) <= next_monday)
                      & (F.to_date(tasks["end_date"]) >= next_monday), "left").drop("_cid")
    return label_customer(matched, "customer_id", plus_days("report_time", 6), b.first_active)


def trading_retention(b: Base) -> DataFrame:
    """M5: per (period = report_time + 6, customer type) and 'All customer':
    traders with a task, those active again next week, traders without a
    task, and those active again next week."""
    m = trading_task_match(b)
    retained = F.col("lead_time") == plus_days("report_time", 7)
    flags = entity_flags(
        m.withColumn("period", plus_days("report_time", 6)),
        ["period", "customer_type"], "customer_id",
        {"assigned": F.col("client_id").isNotNull(),
         "assigned_ret": F.col("client_id").isNotNull() & retained,
         "non_assigned": F.col("client_id").isNull(),
         "non_assigned_ret": F.col("client_id").isNull() & retained})
    aggs = count_flags("customer_id", {
        "task1_assigned": "assigned", "task1_assigned_retention": "assigned_ret",
        "task1_non_assigned": "non_assigned", "task1_non_assigned_retention": "non_assigned_ret"})
    return with_subtotal(flags, ["period"], "customer_type", aggs)


def deposit_boundaries(b: Base) -> DataFrame:
    """M6: award week starts from the first award week on, plus one week
    after the latest start of all weeks (no cut-off for the latter)."""
    weeks = b.award_bounds.df     # one row per award period: the task rows need not be read
    starts = weeks.where(F.col("start_date") >= F.lit(b.cfg.tasks_from)).select("start_date").distinct()
    extra = weeks.agg(plus_days_ts(F.max("start_date"), 7).alias("start_date"))
    return starts.unionByName(extra)


def _client_events(b: Base) -> DataFrame:
    """The rows of M7 that belong to a client, with ``cid``: boundaries with a
    successful deposit in the closed 7 days up to them, and assignments.

    Kept, as the boundaries without a deposit are found from the same pass.
    """
    cfg = b.cfg
    deposits = (b.t.bo_client_deposit_proposal
                .where((F.col("proposal_status") == SUCCESS_PROPOSAL_STATUS)
                       & (F.col("create_date") >= F.lit(cfg.deposits_from)))
                .select("create_date", "client_id"))
    windows = deposit_boundaries(b).select("start_date", plus_days_ts("start_date", -7).alias("_lo"))
    days = b.memo("deposit_week_buckets", lambda: CalendarSide(
        day_buckets(windows, "_lo", "start_date"), cfg.broadcast_max_rows))

    def events() -> DataFrame:
        hits = (range_join(deposits, "create_date", days, "_lo", "start_date")
                .select(cid().alias("cid"), "client_id", "start_date").distinct())
        assigned = (b.task_weeks.where(F.col("start_date") >= F.lit(cfg.tasks_from))
                    .select("cid", "client_id", "start_date").distinct())
        return hits.withColumn("deposit", F.lit(1)).unionByName(assigned.withColumn("deposit", F.lit(0)))

    return b.by_customer("client_events", events) if b.in_buckets else b.kept("client_events", events)


def _boundaries_without_deposit(b: Base) -> DataFrame:
    """The rows of M7 that belong to no client."""
    bounds = deposit_boundaries(b)
    hit_bounds = _client_events(b).where(F.col("deposit") == 1).select("start_date").distinct()
    empty = bounds.join(hit_bounds, bounds["start_date"] == hit_bounds["start_date"], "left_anti")
    return empty.select(F.lit(None).cast("string").alias("cid"), F.lit(None).cast("bigint").alias("client_id"),
                        "start_date", F.lit(1).alias("deposit"))


def deposit_week_events(b: Base) -> DataFrame:
    """M7: (boundary, client, 1) for every client with a successful deposit in
    the closed 7 days up to the boundary (boundaries without one keep a row
    with NULL client, N5), plus (week start, client, 0) for every assignment
    of any task type (N3)."""
    events = _client_events(b)
    return events.unionByName(_boundaries_without_deposit(b)).select("start_date", "client_id", "deposit")


def next_deposit_week(b: Base) -> DataFrame:
    """M8: M7 plus ``lead_time``, the client's next later boundary at which
    they had deposited (J12).  Rows without a client have none, so they join after the window."""
    events = next_after(_client_events(b), "cid", "start_date", "lead_time", only_if=F.col("deposit") == 1)
    none = _boundaries_without_deposit(b).withColumn("lead_time", F.lit(None).cast("timestamp"))
    return events.unionByName(none).select("start_date", "client_id", "deposit", "cid", "lead_time")


def deposit_client_weeks(b: Base) -> DataFrame:
    """M9: per (week, client): deposited, assigned, and how many of its rows
    have the next deposit exactly one week later; labelled new/old."""
    nd = next_deposit_week(b)
    day = F.to_date("start_date")
    weeks = (nd.groupBy(day.alias("period"), "cid", "client_id")
             .agg(F.when(F.max("deposit") == 1, 1).otherwise(0).alias("deposit"),
                  F.when(F.min("deposit") == 0, 1).otherwise(0).alias("task"),
                  F.sum(F.when(F.to_date("lead_time") == F.date_add(day, 7), 1).otherwise(0))
                  .cast("bigint").alias("lead_time")))
    return label_customer(weeks, "cid", F.col("period"), b.first_active).drop("cid")


def deposit_retention(b: Base) -> DataFrame:
    """Per (period, customer type) and 'All customer': assigned clients
    (any task type), assigned and depositing again next week, not assigned,
    not assigned and depositing again next week."""
    w = deposit_client_weeks(b)
    ret = F.col("lead_time") > 0
    assigned = F.col("task") == 1
    flags = entity_flags(w, ["period", "customer_type"], "client_id", {
        "a": assigned, "ar": ret & assigned, "n": ~assigned, "nr": ret & ~assigned})
    aggs = count_flags("client_id", {
        "task2_assigned": "a", "task2_assigned_retention": "ar",
        "task2_non_assigned": "n", "task2_non_assigned_retention": "nr"})
    return with_subtotal(flags, ["period"], "customer_type", aggs)
