"""DuckDB oracle for the click report (M17-M26) and the task-group report.

One relation holds the rows of all populations of both task types, tagged
with the block they count for.  Clicks and the new/old label are looked up
once for all of them, and each block is one filtered aggregate.
"""

from weekwise.oracle.canon import canon
from weekwise.oracle.fixture_sql import with_fixture
from weekwise.oracle.weekly_sql import RELATIONS, kind, needed

GROUP_CUTOFF = "20251213"
CODES = ["a1", "a2", "a3", "a4", "b1", "b2", "b3", "b4", "b5", "b6"]
BLOCKS = [
    "task1_assigned", "task1_non_assigned", "task2_assigned", "task2_non_assigned",
    "task1_non_assigned_last_week", "task1_completed", "task1_non_completed",
    "task2_non_assigned_last_week", "task2_completed", "task2_non_completed",
]


def _block(name: str) -> list[str]:
    """Members, clickers and clicks of a block: a customer clicked if any click count is known."""
    if name.endswith("completed"):
        done = "NOT IN" if name.endswith("non_completed") else "IN"
        mine = f"part = 'status' AND task_status {done} (1, 2)"
        clicks = f"sum(if(coalesce(task_status {done} (1, 2), false), clicks, 0)) FILTER (part = 'status')"
    else:
        part = "new" if name.endswith("_week") else "free" if "non" in name else "assigned"
        mine = f"part = '{part}'"
        clicks = f"sum(clicks) FILTER ({mine})"
    n = name[4]
    mine, clicks = f"task_type = {n} AND {mine}", clicks.replace("FILTER (", f"FILTER (task_type = {n} AND ")
    return [f"count(DISTINCT who) FILTER ({mine}) AS {name}",
            f"count(DISTINCT who) FILTER ({mine} AND clicks IS NOT NULL) AS {name}_click",
            f"CAST({clicks} AS BIGINT) AS {name}_click_count"]


def _query(blocks: list[str], rows: str) -> str:
    return ("SELECT period, customer_type, " + ", ".join(x for b in blocks for x in _block(b))
            + f" FROM seen WHERE {rows} GROUP BY ALL")


_OF = {
    "click_task1_assigned": (1, "assigned", BLOCKS[0:1]), "click_task1_non_assigned": (1, "free", BLOCKS[1:2]),
    "click_task2_assigned": (2, "assigned", BLOCKS[2:3]), "click_task2_non_assigned": (2, "free", BLOCKS[3:4]),
    "click_task1_new_this_week": (1, "new", BLOCKS[4:5]), "click_task1_completion": (1, "status", BLOCKS[5:7]),
    "click_task2_new_this_week": (2, "new", BLOCKS[7:8]), "click_task2_completion": (2, "status", BLOCKS[8:10]),
}

CLICK_RELATIONS = {k: RELATIONS[k] for k in ("active", "task", "recent")} | {
    "clicked": """
        SELECT user_id, week_group, sum(click_count) AS clicks FROM smart_reward_client_event GROUP BY ALL""",
    "busy": """
        SELECT 1 AS task_type, customer_id AS who, report_time FROM report_trading_deal_real
        WHERE report_timeframe = 'weekly' AND rt_lot_open_sa > 0
        UNION ALL
        SELECT 2, customer_id, report_time FROM report_transaction_deposit
        WHERE report_timeframe = 'weekly' AND deposit_success_amount_inusd_sa > 0""",
    "member": """
        SELECT DISTINCT 'assigned' AS part, task_type, who, award_period AS period, CAST(start_date AS DATE) AS ref,
               start_date, end_date, NULL AS task_status, NULL AS before FROM recent
        UNION ALL
        SELECT DISTINCT 'status', task_type, who, award_period, CAST(start_date AS DATE), start_date, end_date, task_status,
               NULL FROM recent
        UNION ALL
        SELECT DISTINCT 'new', * FROM (
            SELECT task_type, who, award_period, CAST(start_date AS DATE), start_date, end_date, NULL,
                   lag(start_date) OVER (PARTITION BY task_type, who ORDER BY start_date) AS before FROM recent)
        WHERE date_diff('day', before, start_date) IS DISTINCT FROM 7
        UNION ALL
        SELECT DISTINCT 'free', b.task_type, b.who, strftime(b.report_time + 12, '%Y%m%d'), b.report_time + 7, NULL, NULL,
               NULL, NULL
        FROM busy b ANTI JOIN recent r ON r.task_type = b.task_type AND r.who = b.who
         AND r.award_period = strftime(b.report_time + 12, '%Y%m%d')
        WHERE b.report_time >= DATE '2025-12-01' AND starts_with(b.who, '95')""",
    "seen": f"""
        SELECT m.part, m.task_type, m.who, m.period, m.task_status, c.clicks, {kind('m.ref')}
        FROM member m LEFT JOIN clicked c ON c.user_id = m.who AND c.week_group = m.period
        LEFT JOIN active a ON a.customer_id = m.who""",
    **{name: _query(blocks, f"task_type = {n} AND part = '{part}'") for name, (n, part, blocks) in _OF.items()},
    "click_report": ("SELECT period, customer_type, "
                     + ", ".join(f"{b}, {b}_click, {b}_click_count" for b in BLOCKS)
                     + " FROM click_task1_assigned "
                     + " ".join(f"LEFT JOIN {name} USING (period, customer_type)" for name in list(_OF)[1:])),
    "click_report_derived": "SELECT *, " + ", ".join(
        f"{b} AS {code}_participants, {b}_click AS {code}_clickers, {b}_click_count AS {code}_clicks, "
        f"{b}_click / nullif({b}, 0) AS {code}_click_rate" for code, b in zip(CODES, BLOCKS)) + " FROM click_report",
}


def _side(name: str, condition: str) -> list[str]:
    return [f"count(DISTINCT client_id) FILTER ({condition}) AS {name}_this_week",
            f"count(DISTINCT client_id) FILTER ({condition} AND click_c > 0) AS {name}_click_this_week_user",
            f"CAST(sum(click_c) FILTER ({condition}) AS BIGINT) AS {name}_click_this_week_count"]


GROUP_RELATIONS = {
    "first_paid": """
        SELECT client_id, min(make_timestamp(nullif(first_deposit_time, 0) * 1000)) AS first_deposit_time
        FROM crm_customer_base GROUP BY ALL""",
    "click_rows": """
        SELECT TRY_CAST(user_id AS BIGINT) AS client_id, week_group AS award_period, count(*) AS n
        FROM smart_reward_client_event GROUP BY ALL""",
    "group_member": f"""
        SELECT g.*, f.first_deposit_time, coalesce(c.n, 0) AS click_c
        FROM (SELECT client_id, group_name, award_period, min(start_date) AS start_date, max(end_date) AS end_date
              FROM rebate_user_task_detail WHERE award_period >= '{GROUP_CUTOFF}' GROUP BY ALL) g
        LEFT JOIN first_paid f USING (client_id) LEFT JOIN click_rows c USING (client_id, award_period)""",
    "group_count": "SELECT award_period, group_name, " + ", ".join(
        _side("active", "first_deposit_time BETWEEN start_date AND end_date")
        + _side("non_active", "first_deposit_time NOT BETWEEN start_date AND end_date"))
    + " FROM group_member GROUP BY ALL",
    "group_derived": "SELECT *, " + ", ".join(
        f"{s}_click_this_week_user / nullif({s}_this_week, 0) AS {s}_click_rate" for s in ("active", "non_active"))
    + " FROM group_count",
}

CLICK_QUERIES = {name: [] for name in [*_OF, "click_report"]} | {
    "click_report_derived": [f"{c}_click_rate" for c in CODES]}

GROUP_QUERIES = {
    "task_group_base": ("group_member", ["start_date", "end_date", "first_deposit_time"], []),
    "task_group_clicks": ("group_count", [], []),
    "task_group_clicks_derived": ("group_derived", [], ["active_click_rate", "non_active_click_rate"]),
}


def click_oracle(name: str) -> str:
    return with_fixture(needed(CLICK_RELATIONS, name) + canon(name, (), (), CLICK_QUERIES[name]))


def group_oracle(name: str) -> str:
    relation, stamps, nums = GROUP_QUERIES[name]
    return with_fixture(needed(GROUP_RELATIONS, relation) + canon(relation, (), stamps, nums))
