"""Report sinks (K1-K5) and read-back.

Reports are weeks x 3 rows, so each is written as one JSON-lines file with
explicit ``null`` fields (Spark drops NULL fields unless told otherwise).
Numbers stay numbers (K5); dates are already ``yyyyMMdd`` text.  Writes
overwrite, so a daily rerun is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output names of the three reports.
WEEKLY_OUT = "data_raw"
CLICK_OUT = "data_raw_click"
GROUP_OUT = "task_group_click"


def write_report_json(df: DataFrame, path: str) -> int:
    """Write ``df`` as one JSON-lines file under ``path``; return the row
    count observed during the write (K4), without a second pass."""
    obs = Observation("rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("n"))
    (observed.coalesce(1).write.mode("overwrite")
     .option("ignoreNullFields", "false").json(path))
    return int(obs.get["n"])


def read_report_json(spark: SparkSession, path: str, schema: T.StructType | None = None,
                     multi_line: bool = False) -> DataFrame:
    """Read a report back (the dashboard's input).

    JSON lines as ``write_report_json`` writes them; ``multi_line`` for files
    that each hold one array of rows, over one line or several.
    """
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def export_reports(base, out_dir: str) -> dict[str, int]:
    """K1-K3: the three reports with their derived columns, sorted as the
    reference sorts them.  Returns rows written per report.  A base that is
    not persisted is, for the time of the export."""
    from weekwise.plans.clicks import click_report_derived
    from weekwise.plans.groups import task_group_clicks_derived
    from weekwise.plans.report import weekly_report_derived
    own = not base.is_persisted
    if own:
        base.persist("cache")
    try:
        return {
            WEEKLY_OUT: write_report_json(weekly_report_derived(base), f"{out_dir}/{WEEKLY_OUT}"),
            CLICK_OUT: write_report_json(click_report_derived(base), f"{out_dir}/{CLICK_OUT}"),
            GROUP_OUT: write_report_json(task_group_clicks_derived(base), f"{out_dir}/{GROUP_OUT}"),
        }
    finally:
        if own:
            base.unpersist()
