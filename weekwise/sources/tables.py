"""Source-table registry (scans S1-S8).

``Tables`` is what every plan takes: seven DataFrames with the declared
schemas.  Production reads them from Parquet folders or catalog tables;
tests and the driver derive them from the ``events`` table
(``weekwise.sources.fixture``).  Casting at the boundary turns
``TIMESTAMP_NTZ`` Parquet columns into session-zone timestamps and pins the
numeric types, so plans never see a surprise type.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekwise.sources.schema import SCHEMAS


@dataclass(frozen=True)
class Tables:
    report_business: DataFrame
    report_trading_deal_real: DataFrame
    report_transaction_deposit: DataFrame
    rebate_user_task_detail: DataFrame
    bo_client_deposit_proposal: DataFrame
    smart_reward_client_event: DataFrame
    crm_customer_base: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {f.name: getattr(self, f.name) for f in fields(self)}

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(prefix + name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in declared order, cast to declared types.

    Missing columns are an error: a silent NULL column would turn every
    cohort count into zero.
    """
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def tables_from(frames: dict[str, DataFrame]) -> Tables:
    return Tables(**{name: conform(frames[name], schema) for name, schema in SCHEMAS.items()})


def load_tables(spark: SparkSession, root: str, fmt: str = "parquet") -> Tables:
    """Read ``<root>/<table>`` for the seven tables (Parquet by default).

    Only the declared columns are selected, so the scans prune everything
    else and filters of the plans reach the file reader.
    """
    return tables_from({name: spark.read.format(fmt).load(f"{root}/{name}") for name in SCHEMAS})


def load_catalog_tables(spark: SparkSession, database: str | None = None) -> Tables:
    """Read the seven tables from the session catalog (Hive/Unity/JDBC-backed
    catalogs all surface here)."""
    qualify = (lambda n: f"{database}.{n}") if database else (lambda n: n)
    return tables_from({name: spark.table(qualify(name)) for name in SCHEMAS})
