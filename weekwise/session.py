"""SparkSession helpers.

The library never creates a session behind the caller's back; these helpers
are for tests, the bench and command-line use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the reports rely on: UTC session zone (dates are derived from
# timestamps), ANSI mode (overflow and bad casts raise), AQE with skew-join
# splitting and partition coalescing.  Joins on (customer, week) use a
# partitioning by customer where both sides have one: the relations hold few
# rows per customer by then.
REPORT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "weekwise", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**REPORT_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_SESSIONS: dict[tuple, SparkSession] = {}


def report_session(spark: SparkSession) -> SparkSession:
    """A session with the reports' settings.

    It is the caller's if that has them; otherwise one of the same
    application with the caller's other SQL settings, so that the caller's
    are left alone.
    """
    if all(spark.conf.get(k, None) == v for k, v in REPORT_CONF.items()):
        return spark
    settings = {k: v for k, v in spark.conf.getAll.items() if k.startswith("spark.sql.")} | REPORT_CONF
    key = (spark.sparkContext.applicationId, tuple(sorted(settings.items())))
    if key not in _SESSIONS:
        session = spark.newSession()
        for k, v in settings.items():
            if session.conf.isModifiable(k):
                session.conf.set(k, v)
        _SESSIONS[key] = session
    return _SESSIONS[key]
