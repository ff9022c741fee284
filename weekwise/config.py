"""Report parameters.

Every literal the reports depend on lives here, so a run for another
programme calendar or another id range changes one object, not SQL text.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace


# Fixed values the reports must reproduce exactly (cohort labels, id prefix,
# completed task statuses, cut-off dates of the production calendar).
NEW_CUSTOMER = "New customer"
OLD_CUSTOMER = "Old Customer"
ALL_CUSTOMER = "All customer"
ID_PREFIX = "95"
COMPLETED_STATUSES = (1, 2)
TRADING_TASK = 1
DEPOSIT_TASK = 2
SUCCESS_PROPOSAL_STATUS = 2
DAILY = "daily"
WEEKLY = "weekly"


@dataclass(frozen=True)
class ReportConfig:
    """Cut-offs and switches of the three reports.

    ``trading_from``   first weekly trading/deposit report week (a Monday).
    ``tasks_from``     first award week start (a Sunday).
    ``deposits_from``  first deposit proposal kept for deposit retention.
    ``growth_tasks_from`` first deposit-task week kept for deposit growth.
    ``group_period_from`` first ``award_period`` (yyyyMMdd) of the group report.
    ``weeks``          periods shown by the indicator tables, 0 = all.
    """

    id_prefix: str = ID_PREFIX
    trading_from: dt.date = dt.date(2025, 12, 1)
    tasks_from: dt.date = dt.date(2025, 12, 7)
    deposits_from: dt.date = dt.date(2025, 11, 21)
    growth_tasks_from: dt.date = dt.date(2025, 11, 20)
    group_period_from: str = "20260509"
    completed_statuses: tuple[int, ...] = COMPLETED_STATUSES
    weeks: int = 8
    # Upper bound on rows of a calendar-sized side (award periods, week
    # boundaries, period grids) that may be broadcast; above it the join
    # falls back to a shuffle join.
    broadcast_max_rows: int = 100_000

    def with_overrides(self, **kw) -> "ReportConfig":
        return replace(self, **kw)


DEFAULT = ReportConfig()

# The driver fixture only covers a few weeks around 2025-12, so the group
# report cut-off is moved into that range (FIXTURES.md section 3).
FIXTURE = DEFAULT.with_overrides(group_period_from="20251213")
