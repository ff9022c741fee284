"""M1 kept between daily runs: each customer's first active day as an incremental minimum.

The first-active day of a customer is a minimum over a table that only grows,
so it need not be taken from the whole table every day.  The state is a folder
of deltas.  A delta holds the customers whose minimum a range of days has made
smaller, mostly new ones, and its name says which days it has seen.

Minima may be merged in any order and any number of times, so a rerun of a day,
a day merged late and two runs at once all lead to the same state.  A delta
counts once its write has been completed (``_SUCCESS``); one that a lost driver
left unfinished is not read, and its days are merged again by the next run.
Rows of a day may be added later and the day merged again; rows taken back from
a merged day need a new state.  Rows without a day belong to none; a customer
who has only such rows is not in the state (M1 gives them a null day, which
labels them as it labels a customer without a row).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weekwise.config import ReportConfig
from weekwise.plans.base import daily_activity
from weekwise.sources.files import Folder

SCHEMA = "customer_id string, first_active date"
PREFIX = "days-"
FIRST_DAY = dt.date(1, 1, 1)    # of an initial load without a lower bound


class FirstActiveState:
    """The kept M1 under ``root``, a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str, cfg: ReportConfig) -> None:
        self.spark, self.cfg, self.folder = spark, cfg, Folder(spark, root)

    def _deltas(self) -> list[str]:
        return [n for n in self.folder.names() if n.startswith(PREFIX) and self.folder.exists(f"{n}/_SUCCESS")]

    def ranges(self) -> list[tuple[dt.date, dt.date]]:
        """The days merged so far, as ranges without gaps."""
        seen = sorted(tuple(map(dt.date.fromisoformat, r.split("..")))
                      for n in self._deltas() for r in n[len(PREFIX):].split("_")[0].split("+"))
        out: list[tuple[dt.date, dt.date]] = []
        for first, last in seen:
            if out and first <= out[-1][1] + dt.timedelta(days=1):
                out[-1] = out[-1][0], max(last, out[-1][1])
            else:
                out.append((first, last))
        return out

    def merged_until(self) -> dt.date | None:
        """Last day up to which all days since the first one are merged."""
        ranges = self.ranges()
        return ranges[0][1] if ranges else None

    def read(self) -> DataFrame:
        """M1 (customer_id, first_active) over the merged days."""
        deltas = self._deltas()
        if not deltas:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[self.folder.path(n) for n in deltas])
        return rows.groupBy("customer_id").agg(F.min("first_active").alias("first_active"))

    def _write(self, rows: DataFrame, ranges: list[tuple[dt.date, dt.date]]) -> str:
        days = "+".join(f"{a.isoformat()}..{b.isoformat()}" for a, b in ranges)
        name = f"{PREFIX}{days}_{uuid.uuid4().hex}"
        rows.write.parquet(self.folder.path(name))
        return name

    def smaller_minima(self, report_business: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
        """Customers whose minimum the days ``first`` to ``last`` make smaller; rows of these days alone are read."""
        rows = daily_activity(report_business, self.cfg)
        if first is not None:
            rows = rows.where(F.col("report_time") >= F.lit(first))
        rows = rows.where(F.col("report_time") <= F.lit(last))
        new = rows.groupBy("customer_id").agg(F.min("report_time").alias("first_active"))
        known = self.read().withColumnRenamed("first_active", "_known")
        smaller = F.col("_known").isNull() | (F.col("first_active") < F.col("_known"))
        return new.join(known, "customer_id", "left").where(smaller).select("customer_id", "first_active")

    def merge(self, report_business: DataFrame, first: dt.date | None, last: dt.date) -> DataFrame:
        """Merge the days ``first`` to ``last``; the state afterwards."""
        self._write(self.smaller_minima(report_business, first, last), [(first or FIRST_DAY, last)])
        return self.read()

    def catch_up(self, report_business: DataFrame, today: dt.date) -> DataFrame:
        """Merge the days after the last merged one, ``today`` included; all of them on the first run."""
        done = self.merged_until()
        if done is not None and done >= today:
            return self.read()
        return self.merge(report_business, done and done + dt.timedelta(days=1), today)

    def compact(self) -> None:
        """One delta in place of all; those that it replaces go once it is complete."""
        old = self._deltas()
        if len(old) > 1:
            self._write(self.read(), self.ranges())
            for name in old:
                self.folder.delete(name)
