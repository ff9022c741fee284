"""K1-K3 as the dashboard reads them: three files that each hold one JSON array, published together.

All three reports are written to a staging folder first.  Nothing that readers
see has changed until then, so a report that fails leaves the old three.  A
mark in the staging folder then decides: from it on the new files replace the
old ones, each in one step of the file system.  If the driver is lost between
two of those steps, the next publication (or ``recover``) finds the mark and
ends what was begun, so the three never stay mixed.

A report is weeks x customer types (or task groups) long, whatever the size of
the tables, so its array is made in one row.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weekwise.sources.files import Folder
from weekwise.sources.sinks import CLICK_OUT, GROUP_OUT, WEEKLY_OUT

STAGING = "_staging-"
COMMITTED = "_COMMITTED"
ABANDONED_HOURS = 24     # after which a staging folder without a mark is removed


def array_json(df: DataFrame) -> DataFrame:
    """(value): the rows of ``df``, in their order, as one JSON array with explicit nulls."""
    lines = df.coalesce(1).select(
        F.monotonically_increasing_id().alias("n"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("line"))
    rows = F.array_sort(F.collect_list(F.struct("n", "line")))["line"]
    return lines.agg(F.concat(F.lit("["), F.array_join(rows, ",\n"), F.lit("]")).alias("value"))


class Publication:
    """Files that replace those of ``out_dir`` together."""

    def __init__(self, spark: SparkSession, out_dir: str) -> None:
        self.folder = Folder(spark, out_dir)
        recover(self.folder)
        self.stage_name = f"{STAGING}{uuid.uuid4().hex}"

    def stage(self, df: DataFrame, name: str) -> int:
        """Write ``df`` as the array file ``name``; its row count (K4), observed during the write."""
        observed = Observation()
        parts = f"{self.stage_name}/_parts-{name}"
        rows = df.observe(observed, F.count(F.lit(1)).alias("n"))
        array_json(rows).coalesce(1).write.text(self.folder.path(parts))
        part, = (n for n in self.folder.names(parts) if n.startswith("part-"))
        self.folder.replace(f"{parts}/{part}", f"{self.stage_name}/{name}")
        self.folder.delete(parts)
        return int(observed.get["n"])

    def commit(self) -> None:
        self.folder.touch(f"{self.stage_name}/{COMMITTED}")
        _finish(self.folder, self.stage_name)

    def abort(self) -> None:
        self.folder.delete(self.stage_name)


def _finish(folder: Folder, stage: str) -> None:
    for name in folder.names(stage):
        if not name.startswith("_") and not name.startswith("."):
            folder.replace(f"{stage}/{name}", name)
    folder.delete(stage)


def recover(folder: Folder) -> None:
    """End publications that were decided but not carried out, oldest first; remove abandoned ones."""
    now = int(time.time() * 1000)
    for stage in [n for n in folder.names() if n.startswith(STAGING)]:
        if folder.exists(f"{stage}/{COMMITTED}"):
            _finish(folder, stage)
        elif folder.age_ms(stage, now) > ABANDONED_HOURS * 3_600_000:
            folder.delete(stage)


def reports() -> dict[str, Callable]:
    """File name -> the report it holds."""
    from weekwise.plans.clicks import click_report_derived
    from weekwise.plans.groups import task_group_clicks_derived
    from weekwise.plans.report import weekly_report_derived
    return {f"{WEEKLY_OUT}.json": weekly_report_derived, f"{CLICK_OUT}.json": click_report_derived,
            f"{GROUP_OUT}.json": task_group_clicks_derived}


def publish_reports(base, out_dir: str, builders: dict[str, Callable] | None = None) -> dict[str, int]:
    """Publish the three reports, sorted as the reference sorts them; rows per file.

    A base that is not persisted is, for the time of the publication.
    """
    own = not base.is_persisted
    if own:
        base.persist("cache")
    publication = Publication(base.t.report_business.sparkSession, out_dir)
    try:
        counts = {name: publication.stage(build(base), name) for name, build in (builders or reports()).items()}
    except BaseException:
        publication.abort()
        raise
    finally:
        if own:
            base.unpersist()
    publication.commit()
    return counts
