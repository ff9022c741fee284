"""M1 kept between daily runs."""
import datetime as dt
import os
import random

import pytest

from conftest import make_tables
from weekwise.config import DEFAULT
from weekwise.plans.base import first_active
from weekwise.plans.report import weekly_report
from weekwise.plans.retention import Base
from weekwise.sources.state import FirstActiveState

DAY0 = dt.date(2026, 1, 1)
DAYS = [DAY0 + dt.timedelta(days=k) for k in range(6)]


def business(n=400, seed=1):
    r = random.Random(seed)
    rows = [(r.choice(["95", "95", "12"]) + str(r.randint(0, 60)), r.choice(["daily", "daily", "weekly"]), r.choice(DAYS),
             r.choice([0, 1, None]), r.choice([0, 0, 2])) for _ in range(n)]
    return rows + [(None, "daily", DAYS[1], 1, 1), ("95x", "daily", None, 1, 1)]


@pytest.fixture(scope="module")
def tables(spark):
    return make_tables(spark, report_business=business())


def rows(df):
    return sorted(map(tuple, df.collect()))


def whole(t, until):
    """M1 of one full run over the days up to ``until``."""
    return rows(first_active(type(t)(**{**t.as_dict(), "report_business": t.report_business.where(
        t.report_business.report_time <= until)}), DEFAULT))


def test_day_by_day_equals_one_full_run(spark, tables, tmp_path):
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    assert rows(state.read()) == []
    for day in DAYS:
        assert rows(state.catch_up(tables.report_business, day)) == whole(tables, day)
    assert state.merged_until() == DAYS[-1] and len(state.ranges()) == 1


def test_a_repeated_day_changes_nothing(spark, tables, tmp_path):
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    state.catch_up(tables.report_business, DAYS[3])
    before = rows(state.read())
    assert rows(state.catch_up(tables.report_business, DAYS[3])) == before
    assert rows(state.merge(tables.report_business, DAYS[2], DAYS[3])) == before
    assert state.smaller_minima(tables.report_business, DAYS[2], DAYS[3]).count() == 0


def test_days_in_any_order(spark, tables, tmp_path):
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    for day in (DAYS[4], DAYS[0], DAYS[5], DAYS[1]):
        state.merge(tables.report_business, day, day)
    assert state.ranges() == [(DAYS[0], DAYS[1]), (DAYS[4], DAYS[5])]
    for day in (DAYS[3], DAYS[2]):
        state.merge(tables.report_business, day, day)
    assert rows(state.read()) == whole(tables, DAYS[-1])
    state.compact()
    assert rows(state.read()) == whole(tables, DAYS[-1]) and state.ranges() == [(DAYS[0], DAYS[-1])]
    assert len(state._deltas()) == 1


def test_an_unfinished_delta_is_not_read(spark, tables, tmp_path):
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    state.catch_up(tables.report_business, DAYS[1])
    state.catch_up(tables.report_business, DAYS[2])
    latest = state._deltas()[-1]
    os.remove(tmp_path / "s" / latest / "_SUCCESS")
    assert state.merged_until() == DAYS[1]
    assert rows(state.catch_up(tables.report_business, DAYS[2])) == whole(tables, DAYS[2])


def test_only_the_new_days_are_scanned(spark, tables, tmp_path):
    tables.report_business.write.partitionBy("report_time").parquet(str(tmp_path / "business"))
    table = spark.read.parquet(str(tmp_path / "business"))
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    state.catch_up(table, DAYS[4])
    new = state.smaller_minima(table, DAYS[5], DAYS[5])
    scan = new._jdf.queryExecution().executedPlan().toString()
    assert f"report_time#" in scan and f">= {DAYS[5]}" in scan.split("PartitionFilters: [")[1].split("]")[0]
    read = {f.split("report_time=")[1].split("/")[0] for f in table.where(
        (table.report_time >= DAYS[5]) & (table.report_time <= DAYS[5])).inputFiles() if "report_time=" in f}
    assert DAYS[5].isoformat() in read
    assert rows(state.catch_up(table, DAYS[5])) == whole(tables, DAYS[5])


def test_a_base_takes_the_kept_state(spark, tables, tmp_path):
    state = FirstActiveState(spark, str(tmp_path / "s"), DEFAULT)
    given = Base(tables, DEFAULT, first_active=state.catch_up(tables.report_business, DAYS[-1]))
    assert rows(given.first_active) == rows(Base(tables, DEFAULT).first_active.where("first_active is not null"))
    assert weekly_report(given).collect() == weekly_report(Base(tables, DEFAULT)).collect()
    given.unpersist()
    assert given.first_active is not None and rows(given.first_active) == whole(tables, DAYS[-1])
