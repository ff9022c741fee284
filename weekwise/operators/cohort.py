"""Cohort operators: new/old labelling (J5), subtotals (G10), distinct
counts of flagged entities (G6/G7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.config import ALL_CUSTOMER, NEW_CUSTOMER, OLD_CUSTOMER
from weekwise.functions.scalar import month_key


def label_customer(df: DataFrame, key: str, ref_date: Column, first_active: DataFrame,
                   out: str = "customer_type") -> DataFrame:
    """Add ``out``: 'New customer' when the customer's first active month
    equals the month of ``ref_date``, else 'Old Customer' (also when the
    customer has no first-active row).

    ``first_active`` has one row per ``customer_id`` (string), so this is a
    left equi-join that never multiplies rows; both sides are partitioned by
    the customer key, which the surrounding plans reuse.
    """
    fa = first_active.select(F.col("customer_id").alias("_fa_key"),
                             month_key("first_active").alias("_fa_month"))
    joined = df.withColumn("_ref_month", month_key(ref_date)).join(
        fa, F.col(key) == F.col("_fa_key"), "left")
    label = F.when(F.col("_fa_month") == F.col("_ref_month"), F.lit(NEW_CUSTOMER)).otherwise(F.lit(OLD_CUSTOMER))
    return joined.withColumn(out, label).drop("_fa_key", "_fa_month", "_ref_month")


def with_subtotal(df: DataFrame, keys: Sequence[str], type_col: str,
                  aggs: Sequence[Column], label: str = ALL_CUSTOMER) -> DataFrame:
    """Aggregate by ``keys + [type_col]`` and by ``keys`` alone in one pass
    (GROUPING SETS); the subtotal rows carry ``label`` in ``type_col``."""
    grouped = df.groupingSets([[*keys, type_col], [*keys]], *keys, type_col).agg(
        *aggs, F.grouping(type_col).alias("_g"))
    return grouped.withColumn(
        type_col, F.when(F.col("_g") == 1, F.lit(label)).otherwise(F.col(type_col))).drop("_g")


def entity_flags(df: DataFrame, keys: Sequence[str], entity: str,
                 flags: Mapping[str, Column | None],
                 sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Collapse rows to one per ``keys + entity``.

    Each flag is ``max(condition)`` (``None`` = always true), each sum is
    ``sum(expr)`` over the collapsed rows.  Followed by ``count_flags`` this
    computes ``count(distinct case when condition then entity end)`` without
    an Expand per distinct expression: the first aggregation runs where the
    data is already partitioned by the entity, the second is tiny.
    """
    aggs = [F.max(F.coalesce(cond, F.lit(False)) if cond is not None else F.lit(True)).alias(name)
            for name, cond in flags.items()]
    aggs += [F.sum(expr).alias(name) for name, expr in (sums or {}).items()]
    return df.groupBy(*keys, entity).agg(*aggs)


def count_flags(entity: str, flags: Mapping[str, str]) -> list[Column]:
    """Aggregates over ``entity_flags`` output: ``out_name -> flag column``.
    NULL entities are never counted (as ``count(distinct ...)``)."""
    ok = F.col(entity).isNotNull()
    return [F.sum(F.when(ok & F.col(flag), 1).otherwise(0)).cast("bigint").alias(out)
            for out, flag in flags.items()]
