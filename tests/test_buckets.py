"""The shared relations in buckets by customer: same rows, no exchange by customer above them."""
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from weekwise import registry
from weekwise.config import FIXTURE
from weekwise.functions.canonical import canonical
from weekwise.plans import clicks, growth, report, retention
from weekwise.plans.retention import Base
from weekwise.sources.buckets import BucketedTables
from weekwise.sources.files import Folder
from weekwise.sources.fixture import fixture_tables
from weekwise.sources.tables import Tables


@pytest.fixture(scope="module")
def bucketed(spark):
    b = Base(fixture_tables(spark, SF_SMALL), FIXTURE).persist("buckets", 5)
    yield b
    b.unpersist()


@pytest.fixture()
def no_broadcast(spark):
    """As for relations too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange (\w+\([^)]*\))", plan.split("InMemoryRelation")[0])


def _rows(df) -> list[str]:
    return sorted(map(str, canonical(df).collect()))


@pytest.mark.parametrize("build", [
    retention.trading_task_match, growth.trading_growth_base, growth.deposit_growth_base], ids=lambda f: f.__name__)
def test_no_exchange_before_the_first_aggregation(bucketed, no_broadcast, build):
    assert _exchanges(build(bucketed)) == []


@pytest.mark.parametrize("build", [retention.trading_retention, growth.trading_growth, growth.deposit_growth],
                         ids=lambda f: f.__name__)
def test_only_the_reports_own_groups_are_exchanged(bucketed, no_broadcast, build):
    found = _exchanges(build(bucketed))
    assert len(found) == 1 and "period" in found[0], found


def test_window_of_deposits_needs_no_exchange(bucketed, no_broadcast):
    assert _exchanges(retention.next_after(retention._client_events(bucketed), "cid", "start_date", "x")) == []


def test_click_populations_are_dealt_once(bucketed, no_broadcast):
    """Lookups of clicks and labels, and the rows per customer, follow one dealing of the populations."""
    rows = clicks.members(bucketed)
    assert len(_exchanges(clicks._per_customer(bucketed, rows))) <= len(_exchanges(rows)) + 1


@pytest.mark.parametrize("build", [report.weekly_report_derived, clicks.click_report_derived,
                                   retention.deposit_week_events, retention.next_deposit_week,
                                   retention.deposit_client_weeks], ids=lambda f: f.__name__)
def test_rows_are_the_same(spark, bucketed, build):
    plain = Base(bucketed.t, FIXTURE)
    assert _rows(build(bucketed)) == _rows(build(plain))
    plain.unpersist()


def test_hot_and_null_clients(spark, bucketed):
    """A client with most task rows, and rows without a client: few rows reach a bucket, the report is the same."""
    t = bucketed.t
    tasks = t.rebate_user_task_detail
    hot = tasks.where("client_id is not null").select("client_id").limit(1)
    copies = tasks.join(hot, "client_id", "left_semi").withColumn(
        "_k", F.explode(F.sequence(F.lit(1), F.lit(300)))).drop("_k").select(*tasks.columns)
    nobody = tasks.limit(20).withColumn("client_id", F.lit(None).cast(tasks.schema["client_id"].dataType))
    skewed = Tables(**{**t.as_dict(), "rebate_user_task_detail": tasks.unionByName(copies).unionByName(nobody)})
    b, plain = Base(skewed, FIXTURE).persist("buckets", 3), Base(skewed, FIXTURE)
    assert b.task_weeks.groupBy("cid").count().agg(F.max("count")).head()[0] <= 100
    for build in (report.weekly_report_derived, clicks.click_report_derived, retention.next_deposit_week):
        assert _rows(build(b)) == _rows(build(plain))
    b.unpersist()
    plain.unpersist()


def test_empty_relation_and_one_file_a_bucket(spark):
    tables = BucketedTables(spark, 4)
    empty = tables.write(spark.createDataFrame([], "k string, v long"), "empty", "k")
    full = tables.write(spark.range(1000).select(F.col("id").cast("string").alias("k")), "full", "k")
    assert empty.count() == 0 and full.count() == 1000 and len(full.inputFiles()) == 4
    assert tables.are_stored()
    tables.drop()
    assert not Folder(spark, tables._folder.root).exists("")


def test_a_lost_table_is_noticed(spark):
    registry.reset()
    query = registry.queries()["bucketed_next_deposit_week"]
    expected = sorted(map(str, query(spark, SF_SMALL).collect()))
    (_, base), = registry._BASES.values()
    base._buckets._folder.delete("trading_weeks")
    assert not base.is_stored()
    assert sorted(map(str, query(spark, SF_SMALL).collect())) == expected
    registry.reset()


def test_no_other_mode(spark, bucketed):
    with pytest.raises(ValueError, match="mode"):
        Base(bucketed.t, FIXTURE).persist("disk")
