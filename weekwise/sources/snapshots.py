"""Dated snapshots of the seven source tables, laid out by partition columns.

``<root>/<table>/snapshot=<day>/report_timeframe=<t>/report_time=<d>/...``

A report run reads one day's snapshot of every table.  The timeframe and the
date of the report tables are partition columns, so a plan's filters on them
choose folders (``PartitionFilters``) and a day's run opens a day's files;
the tasks and clicks lie sorted by their award week, so that row groups of
other weeks are skipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from weekwise.sources.files import Folder
from weekwise.sources.schema import SCHEMAS
from weekwise.sources.tables import Tables, tables_from

PREFIX = "snapshot="
PARTITIONED_BY = {name: ["report_timeframe", "report_time"]
                  for name in ("report_business", "report_trading_deal_real", "report_transaction_deposit")}
SORTED_BY = {"rebate_user_task_detail": "award_period", "smart_reward_client_event": "week_group",
             "bo_client_deposit_proposal": "create_date"}


def _folder(root: str, table: str, day: dt.date) -> str:
    return f"{root.rstrip('/')}/{table}/{PREFIX}{day.isoformat()}"


def write_snapshot(t: Tables, root: str, day: dt.date) -> None:
    """Write all seven tables as the snapshot of ``day``; a repeated call replaces it.

    Rows are rebalanced by their partition columns: small days share a task,
    and AQE splits the files of a hot one.  A table's snapshot counts once its
    ``_SUCCESS`` is there.  An empty ``report_timeframe`` is read back as NULL,
    as folders know no empty name; no report tells them apart.
    """
    for name, df in t.as_dict().items():
        by = PARTITIONED_BY.get(name, [])
        if by:
            df = df.hint("rebalance", *by)
        elif name in SORTED_BY:
            df = df.repartitionByRange(SORTED_BY[name]).sortWithinPartitions(SORTED_BY[name])
        df.write.mode("overwrite").partitionBy(*by).parquet(_folder(root, name, day))


def snapshot_days(spark: SparkSession, root: str) -> dict[str, list[dt.date]]:
    """Days of the finished snapshots of every table, ascending."""
    out = {}
    for name in SCHEMAS:
        folder = Folder(spark, f"{root.rstrip('/')}/{name}")
        out[name] = sorted(dt.date.fromisoformat(n[len(PREFIX):]) for n in folder.names()
                           if n.startswith(PREFIX) and folder.exists(f"{n}/_SUCCESS"))
    return out


def pinned_day(days: dict[str, list[dt.date]], day: dt.date | None = None) -> dt.date:
    """The one day to read: ``day`` if every table has it, or the newest one if it is the same for all.

    Tables of different days would count a customer's task in one state and
    their deposits in another, so that is an error.
    """
    if day is not None:
        without = sorted(name for name, found in days.items() if day not in found)
        if without:
            raise ValueError(f"no snapshot of {day} for {', '.join(without)}")
        return day
    newest = {name: max(found, default=None) for name, found in days.items()}
    if None in newest.values() or len(set(newest.values())) != 1:
        raise ValueError("newest snapshots differ: " + ", ".join(f"{n} {d}" for n, d in sorted(newest.items())))
    return next(iter(newest.values()))


def _read(spark: SparkSession, root: str, table: str, day: dt.date) -> DataFrame:
    """One table's snapshot, its partition columns with the declared types (not guessed from folder names)."""
    path = _folder(root, table, day)
    if all(n.startswith(("_", ".")) for n in Folder(spark, path).names()):
        return spark.createDataFrame([], SCHEMAS[table])      # an empty table has no partition folders
    found = spark.read.parquet(path).schema
    by = PARTITIONED_BY.get(table, [])
    schema = T.StructType([SCHEMAS[table][f.name] if f.name in by else f for f in found.fields])
    return spark.read.schema(schema).parquet(path)


def load_snapshot(spark: SparkSession, root: str, day: dt.date | None = None) -> Tables:
    """The seven tables as of ``day``, or of their common newest day; mixed days raise ``ValueError``."""
    pinned = pinned_day(snapshot_days(spark, root), day)
    return tables_from({name: _read(spark, root, name, pinned) for name in SCHEMAS})
