"""DuckDB SQL deriving the seven source tables from the ``events`` view.

Mirror of ``weekwise.sources.fixture`` (FIXTURES.md section 3).  ``FIXTURE_CTES``
is the body of a ``WITH`` clause: every oracle query is
``WITH <FIXTURE_CTES>, <its own CTEs> SELECT ...``.
"""

FIXTURE_CTES = """
fx_ev AS (
    SELECT event_id, user_id, event_type, value,
           CAST(value AS DECIMAL(18,2)) AS money,
           ts + INTERVAL 700 DAY AS ts2,
           CAST(CASE WHEN user_id % 10 = 9 THEN '96' ELSE '95' END
                || lpad(CAST(user_id AS VARCHAR), 6, '0') AS BIGINT) AS client_id
    FROM events
),
fx AS (
    SELECT *,
           CAST(date_trunc('week', ts2) AS DATE) AS mon,
           CAST(date_trunc('week', ts2 + INTERVAL 1 DAY) AS DATE) - 1 AS sun
    FROM fx_ev
),
report_trading_deal_real AS (
    SELECT CAST(client_id AS VARCHAR) AS customer_id, 'weekly' AS report_timeframe, mon AS report_time,
           CAST(sum(CASE WHEN event_id % 3 = 0 THEN money ELSE 0 END) AS DECIMAL(18,2)) AS rt_lot_open_sa,
           CAST(count(*) FILTER (WHERE event_id % 3 = 0) AS BIGINT) AS rt_active_trader_all_cc
    FROM fx WHERE event_type = 'view'
    GROUP BY client_id, mon
),
bo_client_deposit_proposal AS (
    SELECT client_id, ts2 AS create_date, CAST(1 + event_id % 3 AS INTEGER) AS proposal_status,
           money AS amount_converted
    FROM fx WHERE event_type = 'purchase'
),
report_transaction_deposit AS (
    SELECT CAST(client_id AS VARCHAR) AS customer_id, 'weekly' AS report_timeframe, mon AS report_time,
           CAST(sum(CASE WHEN event_id % 3 = 1 THEN money ELSE 0 END) AS DECIMAL(18,2)) AS deposit_success_amount_inusd_sa
    FROM fx WHERE event_type = 'purchase'
    GROUP BY client_id, mon
),
rebate_user_task_detail AS (
    SELECT client_id,
           CAST(1 + event_id % 2 AS INTEGER) AS task_type,
           CAST((event_id // 2) % 4 AS INTEGER) AS task_status,
           'G' || CAST((event_id // 8) % 3 AS VARCHAR) AS group_name,
           CAST(sun + CAST(event_id % 3 AS INTEGER) AS TIMESTAMP) AS start_date,
           CAST(sun + 6 AS TIMESTAMP) + INTERVAL '23:59:59' AS end_date,
           strftime(sun + 6, '%Y%m%d') AS award_period
    FROM fx WHERE event_type = 'signup' AND (event_id // 4) % 5 < 2
),
smart_reward_client_event AS (
    SELECT CAST(client_id AS VARCHAR) AS user_id, strftime(sun + 6, '%Y%m%d') AS week_group,
           CAST(1 + event_id % 3 AS BIGINT) AS click_count
    FROM fx WHERE event_type = 'click' AND event_id % 2 = 0
),
report_business AS (
    SELECT CAST(client_id AS VARCHAR) AS customer_id, 'daily' AS report_timeframe,
           CASE WHEN user_id % 3 = 0 THEN CAST(ts2 AS DATE) - 35 ELSE CAST(ts2 AS DATE) END AS report_time,
           CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS deposit_success_customer_cc,
           CAST(max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS rt_active_trader_open_cc
    FROM fx
    GROUP BY 1, 3
),
crm_customer_base AS (
    SELECT client_id,
           CASE WHEN client_id % 7 = 0 THEN CAST(0 AS BIGINT)
                ELSE epoch_us(min(ts2) FILTER (WHERE event_type = 'purchase' AND event_id % 3 = 1)) // 1000 END
               AS first_deposit_time
    FROM fx
    GROUP BY client_id
)"""

FIXTURE_TABLES = (
    "report_business", "report_trading_deal_real", "report_transaction_deposit",
    "rebate_user_task_detail", "bo_client_deposit_proposal", "smart_reward_client_event",
    "crm_customer_base",
)


def with_fixture(body: str) -> str:
    """``body`` starts with its own CTE list (``name AS (...), ...``) or is
    empty; the result is one runnable statement."""
    return "WITH " + FIXTURE_CTES + body
