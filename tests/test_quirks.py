"""Hand-sized golden tests for the semantics the reports must keep
"""
import datetime as dt
from decimal import Decimal

from conftest import make_tables
from weekwise.config import FIXTURE
from weekwise.plans import clicks, groups, retention
from weekwise.plans.retention import Base

D = dt.datetime
A, B, C = 95000001, 95000002, 95000003


def _task(client, ttype, status, start, end, period, group="G0"):
    return (client, ttype, status, group, start, end, period)


WEEK1 = (D(2025, 12, 7), D(2025, 12, 13, 23, 59, 59), "20251213")
WEEK2 = (D(2025, 12, 14), D(2025, 12, 20, 23, 59, 59), "20251220")


def _base(spark, **rows):
    return Base(make_tables(spark, **rows), FIXTURE)


def test_boundary_deposit_counts_in_two_weeks_and_empty_boundary_kept(spark):
    b = _base(spark, rebate_user_task_detail=[
        _task(A, 1, 1, *WEEK1), _task(B, 2, 0, *WEEK2)],
        bo_client_deposit_proposal=[(C, D(2025, 12, 14), 2, Decimal("10.00"))])
    rows = {(r.start_date, r.client_id, r.deposit) for r in retention.deposit_week_events(b).collect()}
    assert rows == {
        (D(2025, 12, 7), None, 1),            # no deposit in [11-30, 12-07]: kept, NULL client (N5)
        (D(2025, 12, 14), C, 1), (D(2025, 12, 21), C, 1),  # exactly on a boundary: both weeks (N4)
        (D(2025, 12, 7), A, 0), (D(2025, 12, 14), B, 0),
    }


def test_deposit_retention_counts_any_task_type_as_assigned(spark):
    b = _base(spark, rebate_user_task_detail=[_task(A, 1, 1, *WEEK1)])
    r = {(x.period, x.customer_type): x.task2_assigned for x in retention.deposit_retention(b).collect()}
    assert r[(dt.date(2025, 12, 7), "All customer")] == 1   # a trading task counts (N3)


def test_next_deposit_week_ignores_null_client(spark):
    b = _base(spark, rebate_user_task_detail=[_task(A, 1, 1, *WEEK1), _task(A, 1, 1, *WEEK2)],
              bo_client_deposit_proposal=[(A, D(2025, 12, 13, 10), 2, Decimal("5.00"))])
    got = {(r.start_date, r.client_id, r.deposit): r.lead_time
           for r in retention.next_deposit_week(b).collect()}
    assert got[(D(2025, 12, 7), A, 0)] == D(2025, 12, 14)
    assert got[(D(2025, 12, 14), A, 1)] is None
    assert got[(D(2025, 12, 21), None, 1)] is None          # NULL client matches nothing (N6)


def test_lag_runs_before_distinct_and_doubles_clicks(spark):
    b = _base(spark, rebate_user_task_detail=[
        _task(A, 1, 1, *WEEK1), _task(A, 1, 2, *WEEK1), _task(A, 1, 1, *WEEK2)],
        smart_reward_client_event=[(str(A), "20251213", 5)])
    rows = clicks.new_this_week_rows(b, 1).collect()
    assert {(r.start_date, r.lag_date) for r in rows} == {
        (D(2025, 12, 7), None), (D(2025, 12, 7), D(2025, 12, 7))}   # week 2 follows week 1: not new
    assert len(rows) == 2
    out = {(r.period, r.customer_type): r for r in clicks.new_this_week_clicks(b, 1).collect()}
    row = out[("20251213", "Old Customer")]
    assert row.task1_non_assigned_last_week == 1
    assert row.task1_non_assigned_last_week_click_count == 10         # counted twice (N8)


def test_completion_sums_zero_fill_and_null_status(spark):
    b = _base(spark, rebate_user_task_detail=[
        _task(A, 1, 1, *WEEK1), _task(B, 1, None, *WEEK1), _task(C, 1, 3, *WEEK1)],
        smart_reward_client_event=[(str(A), "20251213", 2), (str(B), "20251213", 7)])
    r = clicks.completion_clicks(b, 1).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.task1_completed, r.task1_completed_click, r.task1_completed_click_count) == (1, 1, 2)
    # NULL status is in neither group, its clicks count as 0 in both sums
    assert (r.task1_non_completed, r.task1_non_completed_click, r.task1_non_completed_click_count) == (1, 0, 0)


def test_group_report_row_count_clicks_and_never_deposited(spark):
    start, end = D(2025, 12, 14), D(2025, 12, 20, 23, 59, 59)
    in_week = int(D(2025, 12, 15, 12).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    before = int(D(2025, 11, 1).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    b = _base(spark, rebate_user_task_detail=[
        _task(A, 1, 1, start, end, "20251220"), _task(B, 1, 1, start, end, "20251220"),
        _task(C, 1, 1, start, end, "20251220")],
        crm_customer_base=[(A, in_week), (B, 0), (C, before)],
        smart_reward_client_event=[(str(A), "20251220", None), (str(A), "20251220", None),
                                   ("0" + str(C), "20251220", 4)])
    r = groups.task_group_clicks_derived(b).collect()[0]
    assert (r.active_this_week, r.active_click_this_week_user, r.active_click_this_week_count) == (1, 1, 2)
    # B never deposited: in neither group (N10); C's zero-padded id still matches numerically
    assert (r.non_active_this_week, r.non_active_click_this_week_user, r.non_active_click_this_week_count) == (1, 1, 1)
    assert r.active_click_rate == 1.0


def test_duplicate_weekly_rows_stay_rows(spark):
    def week(day, lots, active=1):
        return (str(A), "weekly", dt.date(2025, 12, day), None if lots is None else Decimal(lots), active)

    b = _base(spark, report_trading_deal_real=[week(1, "2.00"), week(1, "1.00"), week(1, "2.00"), week(8, None),
                                               week(15, "3.00"), week(22, "9.00", 0)])
    rows = sorted((r.report_time.day, str(r.rt_lot_open_sa), r.lead_time and r.lead_time.day)
                  for r in b.trading_weeks.collect())
    assert rows == [(1, "1.00", 1), (1, "2.00", 1), (1, "2.00", 8), (8, "None", 15), (15, "3.00", None)]
    assert retention.trading_task_match(b).count() == 5


def test_group_table_keeps_old_groups_and_empty_cells(spark):
    from weekwise.plans import present
    kind = ("award_period string, group_name string, active_this_week long, active_click_this_week_user long, "
            "active_click_this_week_count long, non_active_this_week long, non_active_click_this_week_user long, "
            "non_active_click_this_week_count long, active_click_rate double, non_active_click_rate double")
    df = spark.createDataFrame([("20251213", "G_OLD", 1, 1, 3, 0, 0, None, 1.0, None),
                                ("20251220", "G_NEW", 2, 1, 1, 1, 0, None, 0.5, 0.0),
                                ("20251227", "G_NEW", 3, 0, None, 0, 0, None, 0.0, None)], kind)
    wide = present.task_group_pivot(df, 2)
    assert wide.columns[3:] == [f"{p}_{t}" for p in ("2025-12-20", "2025-12-27")
                                for t in ("participants", "rate", "clickers", "clicks")]
    rows = [tuple(r) for r in wide.collect()]
    assert [r[:2] for r in rows] == [("G_NEW", 1), ("G_NEW", 2), ("G_OLD", 1), ("G_OLD", 2)]
    assert rows[0][3:] == ("2", "50.0%", "1", "1", "3", "0.0%", "0", "—")
    assert set(rows[2][3:]) == set(rows[3][3:]) == {"—"}
    assert present.task_group_long(df, 2).count() == 2 * 2 * 2


def test_indicator_cells_without_or_with_several_report_rows(spark):
    from weekwise.plans import present
    codes = sorted({r[6] for r in present.weekly_layout()})
    row = lambda period, kind, value: (period, kind, *[value] * len(codes))
    df = spark.createDataFrame(
        [row("20251213", "New customer", 9.0), row("20251220", "New customer", 0.5), row("20251220", None, 7.0),
         row("20251227", "All customer", 2.0), row("20251227", "All customer", 3.0), row(None, "New customer", 8.0)],
        "period string, customer_type string, " + ", ".join(f"{c} double" for c in codes))
    rows = present.indicator_long(df, 2).collect()
    assert {r.period for r in rows} == {"20251220", "20251227"}
    cells = sorted((r.period, r.customer_type, r.value) for r in rows if r.value is not None)
    assert cells == [("20251220", "New customer", 0.5)] * 10 + [("20251227", "All customer", x)
                                                               for x in (2.0, 3.0) for _ in range(6)]
    assert len(rows) == 26 + 26 + 6
    assert present.indicator_long(df, 0).count() == 3 * 26 + 6


def test_layouts_are_the_dashboards(spark):
    from weekwise.plans import present
    new, old, every = "New customer", "Old Customer", "All customer"
    weekly = [(r[5], r[7], r[8]) for r in present.weekly_layout()]
    pairs = [(c, f) for c, f in [("A1", "pct"), ("A2", "pct"), ("A3", "pct"), ("A4", "pct"), ("B1", "growth"),
                                 ("B2", "growth"), ("B3", "growth"), ("B4", "growth"), ("B5", "growth"), ("B6", "growth")]]
    assert weekly == [(c, t, f) for c, f in pairs for t in (new, old)] + [
        ("C1", every, "lot"), ("C2", every, "lot"), ("C3", every, "lot"),
        ("C4", every, "amount"), ("C5", every, "amount"), ("C6", every, "amount")]
    clicks_ = [(r[5], r[7]) for r in present.click_layout()]
    assert clicks_ == [(c, t) for c in ("a1", "a2", "a3", "a4", "b1", "b2", "b3", "b4", "b5", "b6") for t in (new, old)]
    assert [r[0] for r in present.weekly_layout()] == list(range(1, 27))
    assert [r[3] for r in present.weekly_layout()][::2][:4] == [
        "Task-Assigned Group", "Non-Task Group", "Task-Assigned Group", "Non-Task Group"]


def test_missing_first_active_is_old_customer(spark):
    b = _base(spark, rebate_user_task_detail=[_task(A, 1, 1, *WEEK1)],
              report_business=[(str(B), "daily", dt.date(2025, 12, 3), 1, 0)])
    r = clicks.assigned_clicks(b, 1).collect()
    assert [(x.customer_type, x.task1_assigned, x.task1_assigned_click) for x in r] == [("Old Customer", 1, 0)]


def test_empty_tables_give_empty_reports(spark):
    from weekwise.plans import present, report
    b = _base(spark)
    assert report.weekly_report_derived(b).count() == 0
    assert clicks.click_report_derived(b).count() == 0
    assert groups.task_group_clicks_derived(b).count() == 0
    assert present.indicator_long(report.weekly_report_derived(b, sort=False), 8).count() == 0
    # the synthetic boundary after the latest week is NULL and matches nothing
    assert [tuple(r) for r in retention.deposit_week_events(b).collect()] == [(None, None, 1)]


def test_number_texts_are_exact_at_extremes(spark):
    """Every magnitude shows the digits of its exact binary value, ties up; none overflows."""
    import random
    from decimal import ROUND_HALF_UP, Decimal
    from pyspark.sql import functions as F
    from weekwise.functions import scalar as S
    r = random.Random(1)
    values = [0.49999999999999994, 4503599627370497.0, 0.5, 2.5, 1e17, -1e17, -0.3, 0.0, 1e15 - 0.5, 9.2e18, 1e20, 0.285,
              1.005, 999999.5, None] + [r.uniform(-1, 1) * 10 ** r.randint(-3, 20) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", S.lot_text("v").alias("lot"), S.amount_text("v").alias("amount"),
                         S.format_by("v", F.lit("amount")).alias("by")).collect():
        if row.v is None:
            assert (row.lot, row.amount, row.by) == (None, None, "—")
            continue
        sign, x = "-" if row.v < 0 else "", Decimal(abs(row.v))
        assert row.lot == sign + format(x.quantize(Decimal("0.01"), ROUND_HALF_UP), "f")
        whole = format(int(x.quantize(Decimal(1), ROUND_HALF_UP)), ",").replace(",", ".")
        assert row.amount == row.by == sign + whole
    huge = spark.createDataFrame([(1.5e22,)], "v double")
    assert huge.select(S.lot_text("v"), S.growth_text("v")).head() == ("1.5e+22", "+1.5e+24%")
