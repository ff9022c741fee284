"""Plan shape and hot-key behaviour of the reports."""
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from weekwise.config import FIXTURE
from weekwise.functions.canonical import canonical
from weekwise import registry
from weekwise.operators.joins import CalendarSide, possible_keys
from weekwise.plans import clicks, groups, growth, report
from weekwise.plans.retention import Base
from weekwise.sources.fixture import fixture_tables
from weekwise.sources.tables import Tables, load_tables


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def base(spark):
    return Base(fixture_tables(spark, SF_SMALL), FIXTURE)


@pytest.mark.parametrize("build", [report.weekly_report_derived, clicks.click_report_derived,
                                   groups.task_group_clicks_derived])
def test_no_nested_loop_or_cartesian_join(base, build):
    plan = _plan(build(base))
    assert "BroadcastNestedLoopJoin" not in plan
    assert "CartesianProduct" not in plan


def test_filters_reach_the_scan(base):
    df = report.weekly_report_derived(base)
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan          # pushed into the Parquet scan


def _logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory, base):
    root = str(tmp_path_factory.mktemp("tables"))
    for name, df in base.t.as_dict().items():
        df.write.parquet(f"{root}/{name}")
    return root


def test_deposits_are_pruned_and_read_twice_at_most(spark, folders):
    b = Base(load_tables(spark, folders), FIXTURE)
    growth_plan = growth.deposit_growth(b)
    assert re.search(r"create_date#\d+ >= 2025-11-13 00:00:00", _logical(growth_plan))
    assert re.search(r"PushedFilters: \[IsNotNull\(proposal_status\), IsNotNull\(create_date\), .*GreaterThan",
                     _plan(growth_plan))
    whole = _logical(report.weekly_report_derived(b))
    # one pass makes the kept hits, one the growth
    assert whole.count("amount_converted#") and len(re.findall(r"Relation \[client_id#\d+L?,create_date", whole)) <= 2
    b.unpersist()


def test_clicks_are_cut_to_the_populations_weeks(spark, folders):
    b = Base(load_tables(spark, folders), FIXTURE)
    plan = _plan(b.click_sums)
    assert "LeftSemi" in plan
    b.unpersist()


def test_click_report_reads_half_of_what_eight_pipelines_read(spark, folders):
    b = Base(load_tables(spark, folders), FIXTURE).persist("cache")
    leaves = clicks.click_report(b)._jdf.queryExecution().optimizedPlan().collectLeaves().size()
    assert leaves <= 13
    b.unpersist()


def test_calendar_joins_without_broadcast_give_the_same_report(spark, base):
    shuffled = Base(base.t, FIXTURE.with_overrides(broadcast_max_rows=0))
    expected = sorted(canonical(report.weekly_report_derived(base, sort=False)).collect())
    assert sorted(canonical(report.weekly_report_derived(shuffled, sort=False)).collect()) == expected
    assert not any(x.small for x in shuffled._memo.values() if isinstance(x, CalendarSide))
    expected = sorted(map(str, canonical(clicks.click_report(base, sort=False)).collect()))
    assert sorted(map(str, canonical(clicks.click_report(shuffled, sort=False)).collect())) == expected
    shuffled.unpersist()


def test_a_report_reads_its_award_periods_only(spark, base, tmp_path):
    """The list of periods reaches the task scan; M2's own query stays whole."""
    late = FIXTURE.with_overrides(tasks_from=dt.date(2025, 12, 21), growth_tasks_from=dt.date(2025, 12, 21))
    for name, df in base.t.as_dict().items():
        df.write.parquet(f"{tmp_path}/{name}")
    b = Base(load_tables(spark, str(tmp_path)), late)
    plan = _plan(b.report_weeks)
    periods = {r[0] for r in b.award_weeks.where("start_date >= '2025-12-14'").select("award_period").distinct().collect()}
    pushed = re.search(r"PushedFilters: \[(?:[^\[\]]|\[[^\]]*\])*(In\(award_period, \[([^\]]*)\]\)|EqualTo\(award_period,([^)]*)\))", plan)
    assert pushed, plan
    assert set((pushed[2] or pushed[3]).split(",")) == periods
    every = b.award_weeks.select("award_period").distinct().count()
    assert 0 < len(periods) < every
    whole = Base(base.t, late)
    whole._rw = whole.award_weeks
    for build in (report.weekly_report_derived, clicks.click_report_derived):
        assert sorted(map(str, build(b, sort=False).collect())) == sorted(map(str, build(whole, sort=False).collect()))
    b.unpersist()
    whole.unpersist()


def test_a_cleared_cache_is_noticed(spark):
    registry.reset()
    query = registry.queries()["weekly_report"]
    expected = sorted(map(str, query(spark, SF_SMALL).collect()))
    spark.catalog.clearCache()
    assert sorted(map(str, query(spark, SF_SMALL).collect())) == expected
    assert spark.sparkContext._jsc.getPersistentRDDs().size() > 0
    registry.reset()


def test_pivot_is_one_pass_over_the_kept_report(spark):
    registry.reset()
    above = _logical(registry.queries()["indicator_pivot"](spark, SF_SMALL)).split("InMemoryRelation")[0]
    assert above.count("Aggregate") == 1 and "Join" not in above and "Pivot" not in above
    registry.reset()


@pytest.mark.parametrize("name", ["indicator_long", "indicator_long_2_weeks"])
def test_indicators_read_the_kept_report_once(spark, name):
    registry.reset()
    above = _logical(registry.queries()[name](spark, SF_SMALL))
    assert above.count("+- InMemoryRelation [period#") == 1, above
    top = above.split("InMemoryRelation")[0]
    assert "Join" not in top and "Expand" not in top
    registry.reset()


def test_nothing_stays_persisted_after_a_reset(spark):
    registry.reset()
    spark.catalog.clearCache()
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for name in ("weekly_report", "click_report", "task_group_pivot"):
        registry.queries()[name](spark, SF_SMALL).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() > before
    registry.reset()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_callers_settings_are_left_alone(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    got = registry.queries()["latest_period"](other, SF_SMALL).collect()
    assert other.conf.get("spark.sql.session.timeZone") == "Asia/Jakarta"
    assert got == registry.queries()["latest_period"](spark, SF_SMALL).collect()
    registry.reset()


def test_checkpoint_needs_a_shared_folder(spark, base):
    if spark.sparkContext.getCheckpointDir() is None:
        with pytest.raises(Exception, match="(?i)checkpoint"):
            Base(base.t, FIXTURE).persist("checkpoint")


def test_reports_come_sorted(base):
    weekly = [(r.period, r.customer_type) for r in report.weekly_report(base).collect()]
    assert weekly == sorted(weekly)
    click = [(r.period, r.customer_type) for r in clicks.click_report(base).collect()]
    assert click == sorted(sorted(click, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)
    group = [(r.award_period, r.group_name) for r in groups.task_group_clicks(base).collect()]
    assert group == sorted(group)


def test_hot_client_duplicates_do_not_change_weekly_report(spark, base):
    """One client's task rows copied 40 times (a hot key) leave the weekly
    report unchanged: every per-customer step collapses them first."""
    t = base.t
    tasks = t.rebate_user_task_detail
    hot = tasks.where(F.col("client_id").isNotNull()).select("client_id").limit(1)
    copies = (tasks.join(hot, "client_id", "left_semi")
              .withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("_k"))
    skewed = Tables(**{**t.as_dict(), "rebate_user_task_detail": tasks.unionByName(copies)})
    expected = sorted(canonical(report.weekly_report_derived(base, sort=False)).collect())
    got = sorted(canonical(report.weekly_report_derived(Base(skewed, FIXTURE), sort=False)).collect())
    assert got == expected


def test_lookups_of_the_group_report_follow_the_tasks(spark, base):
    """A crm and a click table of mostly other clients: the rows grouped are about the report's."""
    t = base.t
    other = spark.range(50_000).select((F.col("id") + 7_000_000_000).alias("client_id"))
    crm = t.crm_customer_base.unionByName(other.withColumn("first_deposit_time", F.lit(5).cast("long")))
    events = t.smart_reward_client_event.unionByName(other.select(
        F.col("client_id").cast("string").alias("user_id"), F.lit("20251220").alias("week_group"),
        F.lit(1).cast("long").alias("click_count")))
    long = Base(Tables(**{**t.as_dict(), "crm_customer_base": crm, "smart_reward_client_event": events}), FIXTURE)
    expected = sorted(map(str, groups.task_group_clicks(base).collect()))
    assert sorted(map(str, groups.task_group_clicks(long).collect())) == expected
    tasks = long._memo["group_tasks"]
    clients = tasks.select("client_id").distinct().count()
    assert possible_keys(crm, "client_id", tasks, "client_id").count() <= clients + 50
    plan = _logical(groups.task_group_base(base))
    assert plan.count("Join LeftSemi") == 2
    long.unpersist()
