"""Snapshots of one day, laid out by timeframe and date."""
import datetime as dt
import re

import pytest

from conftest import SF_SMALL, make_tables
from weekwise.config import FIXTURE
from weekwise.plans import clicks, groups, report
from weekwise.plans.base import first_active, trading_weeks
from weekwise.plans.retention import Base
from weekwise.sources.fixture import fixture_tables
from weekwise.sources.snapshots import load_snapshot, pinned_day, snapshot_days, write_snapshot
from weekwise.sources.state import FirstActiveState

DAY = dt.date(2026, 1, 5)


@pytest.fixture(scope="module")
def tables(spark):
    return fixture_tables(spark, SF_SMALL)


@pytest.fixture(scope="module")
def root(tables, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("snapshots"))
    write_snapshot(tables, root, DAY)
    return root


def filters(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return " ".join(re.findall(r"PartitionFilters: \[[^\]]*\]", plan))


def test_a_snapshot_holds_the_tables(spark, tables, root):
    again = load_snapshot(spark, root)
    for name, df in tables.as_dict().items():
        found = getattr(again, name)
        assert found.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, found.collect())) == sorted(map(str, df.collect())), name


def test_timeframe_and_date_choose_folders(spark, root, tmp_path):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")      # else a plan's filters are cut
    t = load_snapshot(spark, root, DAY)
    assert "report_timeframe" in filters(first_active(t, FIXTURE)) and "= daily" in filters(first_active(t, FIXTURE))
    weekly = filters(trading_weeks(t, FIXTURE))
    assert "= weekly" in weekly and re.search(r"report_time#\d+ >= 2025-12-01", weekly)
    state = FirstActiveState(spark, str(tmp_path / "state"), FIXTURE)
    one_day = state.smaller_minima(t.report_business, DAY, DAY)
    assert re.search(r"report_time#\d+ (>=|=) 2026-01-05", filters(one_day))
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_reports_of_a_snapshot(spark, tables, root):
    b, of_day = Base(tables, FIXTURE), Base(load_snapshot(spark, root, DAY), FIXTURE)
    for build in (report.weekly_report_derived, clicks.click_report_derived, groups.task_group_clicks_derived):
        expected = sorted(map(str, build(b, sort=False).collect()))
        assert expected and sorted(map(str, build(of_day, sort=False).collect())) == expected
    b.unpersist()
    of_day.unpersist()


def test_mixed_days_raise(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="newest snapshots differ"):
        load_snapshot(spark, root)
    t = make_tables(spark, crm_customer_base=[(1, 5)])
    write_snapshot(t, root, DAY)
    later = DAY + dt.timedelta(days=1)
    t.crm_customer_base.write.parquet(f"{root}/crm_customer_base/snapshot={later}")
    with pytest.raises(ValueError, match="newest snapshots differ.*crm_customer_base 2026-01-06"):
        load_snapshot(spark, root)
    with pytest.raises(ValueError, match="no snapshot of 2026-01-06 for bo_client"):
        load_snapshot(spark, root, later)
    assert load_snapshot(spark, root, DAY).crm_customer_base.collect() == [(1, 5)]      # the older day is whole


def test_an_unfinished_snapshot_does_not_count(spark, tmp_path):
    root = str(tmp_path)
    write_snapshot(make_tables(spark), root, DAY)
    (tmp_path / "crm_customer_base" / "snapshot=2026-01-06").mkdir()
    assert snapshot_days(spark, root)["crm_customer_base"] == [DAY]
    assert pinned_day(snapshot_days(spark, root)) == DAY


def test_odd_values_come_back(spark, tmp_path):
    rows = [("95", "0012", DAY, 1, 1), ("95", None, None, 1, None), (None, "daily", DAY, None, 1)]
    t = make_tables(spark, report_business=rows)
    write_snapshot(t, str(tmp_path), DAY)
    write_snapshot(t, str(tmp_path), DAY)
    found = load_snapshot(spark, str(tmp_path)).report_business.collect()
    assert sorted(map(str, found)) == sorted(map(str, t.report_business.collect()))
    files = str(tmp_path / "report_business" / f"snapshot={DAY}")
    t.report_business.drop("customer_id").write.mode("overwrite").partitionBy("report_timeframe").parquet(files)
    with pytest.raises(ValueError, match="missing columns .'customer_id'"):
        load_snapshot(spark, str(tmp_path))
