"""Temporal operators Spark has no single built-in for.

* ``next_after`` / ``prev_before`` (J12/J13): as-of lookups "first later /
  last earlier value with the same key", as RANGE windows over the key's own
  rows instead of an inequality-correlated subquery (which Spark plans as a
  nested-loop join without the key).
* ``range_join`` (J2/R3): points x closed intervals, equi-joined on day
  buckets of a calendar-sized interval table, or on ranges of time where
  that table is too large for a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekwise.operators.joins import PARTS, CalendarSide


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c))


def next_after(df: DataFrame, key: str, order_ts: str, out: str,
               only_if: Column | None = None) -> DataFrame:
    """``out`` = smallest ``order_ts`` of a row with the same ``key``, a
    strictly later ``order_ts`` and ``only_if`` true; NULL when the key is
    NULL (a NULL key matches nothing)."""
    w = (Window.partitionBy(key).orderBy(_micros(order_ts))
         .rangeBetween(1, Window.unboundedFollowing))
    candidate = F.col(order_ts) if only_if is None else F.when(only_if, F.col(order_ts))
    return df.withColumn(out, F.when(F.col(key).isNotNull() & F.col(order_ts).isNotNull(),
                                     F.min(candidate).over(w)))


def prev_before(df: DataFrame, key: str, order_ts: str, out: str,
                only_if: Column | None = None) -> DataFrame:
    """``out`` = largest ``order_ts`` of a row with the same ``key`` and a
    strictly earlier ``order_ts``."""
    w = (Window.partitionBy(key).orderBy(_micros(order_ts))
         .rangeBetween(Window.unboundedPreceding, -1))
    candidate = F.col(order_ts) if only_if is None else F.when(only_if, F.col(order_ts))
    return df.withColumn(out, F.when(F.col(key).isNotNull() & F.col(order_ts).isNotNull(),
                                     F.max(candidate).over(w)))


def day_buckets(intervals: DataFrame, lo: str, hi: str, out: str = "_day") -> DataFrame:
    """One row per interval and calendar day it touches."""
    return (intervals.where(F.col(lo) <= F.col(hi))
            .withColumn(out, F.explode(F.sequence(F.to_date(F.col(lo)), F.to_date(F.col(hi))))))


def range_join(points: DataFrame, ts: str, buckets: CalendarSide, lo: str, hi: str) -> DataFrame:
    """Inner join of ``points`` with every interval where
    ``lo <= points.ts <= hi`` (closed on both ends).

    ``buckets`` holds ``day_buckets(intervals, lo, hi)``.  The points are
    joined on the day with the exact range as residual filter; a point on a
    shared boundary matches both intervals.  Buckets beyond a broadcast are
    joined by ranges of time (``TimeParts``).
    """
    pts = points.withColumn("_day", F.to_date(F.col(ts)))
    if buckets.small:
        joined = buckets.join(pts, ["_day"], points.columns)
    else:
        parts = TimeParts(points, ts)
        joined = parts.deal(pts, ts).join(parts.repeat(buckets.df, lo, hi), ["_day", "_range", "_share"])
        joined = joined.drop("_range", "_share")
    return joined.where((F.col(ts) >= F.col(lo)) & (F.col(ts) <= F.col(hi))).drop("_day")


class TimeParts:
    """Ranges of time that hold about as many points each, for a shuffled interval join.

    The borders are quantiles of the points' times, at most ``parts - 1``
    longs in the driver.  A time that is a border several times holds that
    many parts' worth of points, so its range has as many shares: the points
    are dealt to them by a hash, and an interval is in each.  An interval's
    day is repeated only in the ranges that it touches, wherever the borders
    are, so they decide the balance of the tasks and never the result.
    """

    def __init__(self, points: DataFrame, ts: str, parts: int = PARTS) -> None:
        at = [k / parts for k in range(1, parts)]
        found = points.agg(F.percentile_approx(_micros(ts), at, 10 * parts)).head()[0] or []
        self.borders = sorted(set(found))
        self.shares = [1, *(found.count(b) for b in self.borders)]

    def _range(self, micros: Column) -> Column:
        """Number of borders up to this time."""
        borders = F.array(*map(F.lit, self.borders)).cast("array<bigint>")
        return F.size(F.filter(borders, lambda b: b <= micros))

    def _shares(self, number: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, self.shares)), number + 1)

    def deal(self, points: DataFrame, ts: str) -> DataFrame:
        """``points`` with their range and share; equal points of one input partition share a part."""
        dealt = points.withColumn("_range", self._range(_micros(ts)))
        spread = F.xxhash64(F.spark_partition_id(), *points.columns)
        return dealt.withColumn("_share", F.pmod(spread, self._shares(F.col("_range"))).cast("int"))

    def repeat(self, buckets: DataFrame, lo: str, hi: str) -> DataFrame:
        """Each interval's day once in every share of every range that it touches."""
        first = F.greatest(_micros(lo), F.unix_micros(F.col("_day").cast("timestamp")))
        after = F.unix_micros(F.date_add("_day", 1).cast("timestamp"))
        last = F.least(_micros(hi), after - 1)
        ranged = buckets.withColumn("_range", F.explode(F.sequence(self._range(first), self._range(last))))
        return ranged.withColumn("_share", F.explode(F.sequence(F.lit(0), self._shares(F.col("_range")) - 1)))
