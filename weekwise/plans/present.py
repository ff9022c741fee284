"""Indicator tables (M30-M34): the reports laid out as the dashboard shows
them - layout rows x periods, long or pivoted by period, with display text.

The layouts are fixed dimension tables (26 and 20 rows).  Each period row
generates the layout rows with ``inline`` over a literal array (a bounded
generator, not a join), then the report values are looked up among the
period's own rows, or with an equi-join on (period, customer type, field).
Every input here is a finished report of weeks x 3 rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekwise.config import ALL_CUSTOMER, NEW_CUSTOMER, OLD_CUSTOMER
from weekwise.functions.scalar import NULL_TEXT, format_by, format_value, growth_class, period_label

# Dashboard labels (section, metric, comparison) and row codes.
SEC_RETENTION_PCT = "I.\nRetention\nRate (%)"
SEC_GROWTH_PCT = "II.\nGrowth\nRate (%)"
SEC_KBI = "III.\nKey\nBehavioral\nIndicators"
SEC_RETENTION = "I.\nRetention\nRate"
SEC_GROWTH = "II.\nGrowth\nRate"
MET_TRADING_RET = "Trading\nRetention Rate"
MET_DEPOSIT_RET = "Deposit\nRetention Rate"
MET_TRADING_GROWTH = "Trading\nGrowth Rate"
MET_DEPOSIT_GROWTH = "Deposit\nGrowth Rate"
MET_LOTS = "Avg Open\nPositions\n(This Week)"
MET_AMOUNT = "Avg Deposit\nAmount\n(This Week)"
CMP_ASSIGNED = "Task-Assigned Group"
CMP_NON_TASK = "Non-Task Group"
CMP_NON_TASK_LW = "Non-Task LW → Task TW"
CMP_COMPLETED = "Task-Completed Group"
CMP_UNCOMPLETED = "Task-Uncompleted Group"
GROUP_NEW, GROUP_OLD, GROUP_NONE = "New", "Old", "—"
SUB_ACTIVE = "Activated This Week"
SUB_NON_ACTIVE = "Activated Not This Week"

_RET = [(MET_TRADING_RET, [(CMP_ASSIGNED, "a1"), (CMP_NON_TASK, "a2")]),
        (MET_DEPOSIT_RET, [(CMP_ASSIGNED, "a3"), (CMP_NON_TASK, "a4")])]
_GROWTH = [(MET_TRADING_GROWTH, [(CMP_NON_TASK_LW, "b1"), (CMP_COMPLETED, "b2"), (CMP_UNCOMPLETED, "b3")]),
           (MET_DEPOSIT_GROWTH, [(CMP_NON_TASK_LW, "b4"), (CMP_COMPLETED, "b5"), (CMP_UNCOMPLETED, "b6")])]
_KBI = [(MET_LOTS, [(CMP_NON_TASK_LW, "c1"), (CMP_COMPLETED, "c2"), (CMP_UNCOMPLETED, "c3")], "lot"),
        (MET_AMOUNT, [(CMP_NON_TASK_LW, "c4"), (CMP_COMPLETED, "c5"), (CMP_UNCOMPLETED, "c6")], "amount")]

LAYOUT_FIELDS = ["row_order", "section", "metric", "comparison", "group_label", "code", "field",
                 "customer_type", "fmt"]


def _new_old(section, metric, comparison, field, fmt):
    return [(section, metric, comparison, GROUP_NEW, field.upper(), field, NEW_CUSTOMER, fmt),
            (section, metric, comparison, GROUP_OLD, field.upper(), field, OLD_CUSTOMER, fmt)]


def weekly_layout() -> list[tuple]:
    """26 rows of the weekly indicator table, in display order."""
    rows = []
    for metric, comps in _RET:
        for comp, field in comps:
            rows += _new_old(SEC_RETENTION_PCT, metric, comp, field, "pct")
    for metric, comps in _GROWTH:
        for comp, field in comps:
            rows += _new_old(SEC_GROWTH_PCT, metric, comp, field, "growth")
    for metric, comps, fmt in _KBI:
        for comp, field in comps:
            rows.append((SEC_KBI, metric, comp, GROUP_NONE, field.upper(), field, ALL_CUSTOMER, fmt))
    return [(i + 1, *r) for i, r in enumerate(rows)]


def click_layout() -> list[tuple]:
    """20 rows of the click indicator table (codes stay lower case)."""
    rows = []
    for section, blocks in ((SEC_RETENTION, _RET), (SEC_GROWTH, _GROWTH)):
        for metric, comps in blocks:
            for comp, code in comps:
                for grp, ct in ((GROUP_NEW, NEW_CUSTOMER), (GROUP_OLD, OLD_CUSTOMER)):
                    rows.append((section, metric, comp, grp, code, code, ct, "pct"))
    return [(i + 1, *r) for i, r in enumerate(rows)]


def _layout_literal(rows: list[tuple]) -> Column:
    """The layout as an array of structs, generated per period with inline."""
    def struct(r):
        return F.struct(*[F.lit(v).alias(n) for v, n in zip(r, LAYOUT_FIELDS)])
    return F.array(*[struct(r) for r in rows])


def last_periods(periods: DataFrame, col: str, weeks: int) -> DataFrame:
    """The ``weeks`` newest distinct periods (all when 0)."""
    d = periods.select(col).where(F.col(col).isNotNull()).distinct()
    return d.orderBy(F.col(col).desc()).limit(weeks) if weeks > 0 else d


def _grid(report: DataFrame, layout: list[tuple], weeks: int) -> DataFrame:
    periods = last_periods(report, "period", weeks)
    return periods.select("period", F.inline(_layout_literal(layout)))


def _grid_with_rows(report: DataFrame, layout: list[tuple], weeks: int, values: Column) -> DataFrame:
    """``_grid`` left-joined to the report's rows of each cell's period and customer type, as ``values``.

    The report is read once: a period's rows, one per customer type, are gathered
    next to it.  In a self-join Spark renames the second side, may then fail
    to see that it is the kept report, and computes it again.
    """
    row = F.struct(F.col("customer_type").alias("of"), values.alias("values"))
    periods = report.where("period is not null").groupBy("period").agg(F.collect_list(row).alias("rows"))
    if weeks > 0:
        periods = periods.orderBy(F.col("period").desc()).limit(weeks)
    cells = periods.select("period", "rows", F.inline(_layout_literal(layout)))
    found = F.filter("rows", lambda r: r["of"] == F.col("customer_type"))
    return cells.withColumn("row", F.explode_outer(found)).select(
        "period", *LAYOUT_FIELDS, F.col("row.values").alias("values"))


def indicator_long(report_derived: DataFrame, weeks: int) -> DataFrame:
    """One row per weekly layout row and period: the value of the
    row's field for the row's customer type (NULL if that report row does
    not exist, J15), its display text, and the class of the cell: a growth is
    classed by its sign, any other missing value as null."""
    fields = sorted({r[6] for r in weekly_layout()})
    values = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("double"))])
    out = _grid_with_rows(report_derived, weekly_layout(), weeks, values).withColumn(
        "value", F.try_element_at("values", F.col("field")))
    return out.select(
        "row_order", "section", "metric", "comparison", "group_label", "code", "customer_type", "fmt",
        "period", period_label("period").alias("period_label"),
        "value", format_by("value", "fmt").alias("text"),
        F.when((F.col("fmt") == "growth") | F.col("value").isNull(), growth_class("value")).alias("cls"))


def click_indicator_long(click_derived: DataFrame, weeks: int) -> DataFrame:
    """M32 (long): per click layout row and period: click rate, clickers,
    clicks and their texts."""
    codes = sorted({r[6] for r in click_layout()})
    measures = {"click_rate": "double", "clickers": "bigint", "clicks": "bigint"}
    stacked = F.expr("stack({n}, {args}) AS (field, click_rate, clickers, clicks)".format(
        n=len(codes),
        args=", ".join(f"'{c}', CAST({c}_click_rate AS DOUBLE), CAST({c}_clickers AS BIGINT), "
                       f"CAST({c}_clicks AS BIGINT)" for c in codes)))
    values = click_derived.select("period", "customer_type", stacked)
    grid = _grid(click_derived, click_layout(), weeks)
    out = grid.join(values, ["period", "customer_type", "field"], "left")
    return out.select(
        "row_order", "section", "metric", "comparison", "group_label", "code", "customer_type",
        "period", period_label("period").alias("period_label"),
        *[F.col(m).cast(t).alias(m) for m, t in measures.items()],
        format_value("click_rate", "pct").alias("rate_text"),
        format_value("clickers", "count").alias("clickers_text"),
        format_value("clicks", "count").alias("clicks_text"))


# Sub-rows of the task-group table and their source columns.
GROUP_SUB_ROWS = [
    (1, SUB_ACTIVE, "active_this_week", "active_click_rate",
     "active_click_this_week_user", "active_click_this_week_count"),
    (2, SUB_NON_ACTIVE, "non_active_this_week", "non_active_click_rate",
     "non_active_click_this_week_user", "non_active_click_this_week_count"),
]


def _labels(report: DataFrame, col: str, weeks: int) -> list[str]:
    """The periods shown, oldest first.  They are calendar weeks, so they may come to the driver."""
    return sorted(r[0] for r in last_periods(report, col, weeks).collect())


def task_group_long(group_derived: DataFrame, weeks: int, periods: list[str] | None = None) -> DataFrame:
    """M33 (long): every group of the whole report x sub-row x period shown:
    participants, click rate, clickers, clicks and texts.

    The limit cuts the periods only: a group without a row in them keeps its
    cells, which are NULL and show the em dash.
    """
    periods = _labels(group_derived, "award_period", weeks) if periods is None else periods
    shown = F.array(*[F.lit(p) for p in periods]).cast("array<string>")
    grid = (group_derived.select("group_name").distinct()
            .select("group_name", F.explode(shown).alias("award_period")))
    values = group_derived.withColumnsRenamed({"group_name": "_group", "award_period": "_period"})
    cells = grid.join(values, (F.col("award_period") == F.col("_period"))
                      & F.col("group_name").eqNullSafe(F.col("_group")), "left")
    subs = F.array(*[F.struct(F.lit(o).alias("sub_order"), F.lit(lbl).alias("sub_label"),
                              F.col(p).cast("bigint").alias("participants"),
                              F.col(r).cast("double").alias("click_rate"),
                              F.col(u).cast("bigint").alias("clickers"),
                              F.col(c).cast("bigint").alias("clicks"))
                     for o, lbl, p, r, u, c in GROUP_SUB_ROWS])
    out = cells.select("award_period", "group_name", F.inline(subs))
    return out.select(
        "group_name", "sub_order", "sub_label", F.col("award_period").alias("period"),
        period_label("award_period").alias("period_label"),
        "participants", "click_rate", "clickers", "clicks",
        format_value("participants", "count").alias("participants_text"),
        format_value("click_rate", "pct").alias("rate_text"),
        format_value("clickers", "count").alias("clickers_text"),
        format_value("clicks", "count").alias("clicks_text"))


def pivot_by_period(long: DataFrame, keys: list[str], texts: dict[str, str], periods: list[str]) -> DataFrame:
    """M31 / M32 / M33 (pivot): one column per period shown (per text when
    several), named by its label; missing cells show the em dash."""
    aggs = [F.first(src).alias(alias) for alias, src in texts.items()]
    wide = long.groupBy(*keys).pivot("period", periods).agg(*aggs)
    names = {c: label for p in periods for c, label in (
        [(p, label_of(p))] if len(texts) == 1 else [(f"{p}_{t}", f"{label_of(p)}_{t}") for t in texts])}
    wide = wide.withColumnsRenamed(names)
    fill = [c for c in wide.columns if c not in keys]
    return wide.fillna(NULL_TEXT, subset=fill) if fill else wide


def label_of(period: str) -> str:
    """F12 on the driver, for column names."""
    return f"{period[:4]}-{period[4:6]}-{period[6:]}" if len(period) == 8 else period


def _cells(report: DataFrame, periods: list[str], values: Column) -> DataFrame:
    """(cells): one row with the map from ``period|customer type`` to the values of that report row."""
    key = F.concat_ws("|", "period", "customer_type")
    shown = report.where(F.col("period").isin(periods))
    return shown.agg(F.map_from_entries(F.collect_list(F.struct(key, values))).alias("cells"))


LAYOUT_KEYS = ["row_order", "section", "metric", "comparison", "group_label", "code"]


def _layout_pivot(report: DataFrame, layout: list[tuple], weeks: int, value_of, texts,
                  names: dict[str, str]) -> DataFrame:
    """The layout rows with a column per period and text, from one aggregation of the report.

    ``value_of`` gives a report row's value for a field; ``texts`` the struct
    of display texts of a cell's value, and ``names`` their column suffixes.
    Missing cells show the em dash.
    """
    periods = _labels(report, "period", weeks)
    fields = sorted({r[6] for r in layout})
    values = F.create_map(*[x for f in fields for x in (F.lit(f), value_of(f))])
    rows = _cells(report, periods, values).select("cells", F.inline(_layout_literal(layout)))

    def shown(period: Column) -> Column:
        row = F.try_element_at("cells", F.concat_ws("|", period, "customer_type"))
        return texts(F.try_element_at(row, F.col("field")))

    rows = rows.withColumn("texts", F.transform(F.array(*[F.lit(p) for p in periods]).cast("array<string>"), shown))
    return rows.where(F.lit(bool(periods))).select(*LAYOUT_KEYS, *[
        F.col("texts")[k][name].alias(label_of(p) + suffix) for k, p in enumerate(periods)
        for name, suffix in names.items()]).orderBy("row_order")


def indicator_pivot(report_derived: DataFrame, weeks: int) -> DataFrame:
    """The weekly layout rows with one text per period shown."""
    return _layout_pivot(report_derived, weekly_layout(), weeks, lambda f: F.col(f).cast("double"),
                         lambda cell: F.struct(format_by(cell, F.col("fmt")).alias("text")), {"text": ""})


def click_indicator_pivot(click_derived: DataFrame, weeks: int) -> DataFrame:
    """M32 (pivot): the click layout rows with rate, clickers and clicks per period shown."""
    def value(code: str) -> Column:
        return F.struct(F.col(f"{code}_click_rate").cast("double").alias("rate"),
                        F.col(f"{code}_clickers").cast("bigint").alias("clickers"),
                        F.col(f"{code}_clicks").cast("bigint").alias("clicks"))
    measures = ("rate", "clickers", "clicks")
    return _layout_pivot(click_derived, click_layout(), weeks, value, lambda cell: F.struct(
        *[format_value(cell[m], "pct" if m == "rate" else "count").alias(m) for m in measures]),
        {m: f"_{m}" for m in measures})


def task_group_pivot(group_derived: DataFrame, weeks: int) -> DataFrame:
    keys = ["group_name", "sub_order", "sub_label"]
    periods = _labels(group_derived, "award_period", weeks)
    return pivot_by_period(task_group_long(group_derived, weeks, periods), keys,
                           {"participants": "participants_text", "rate": "rate_text",
                            "clickers": "clickers_text", "clicks": "clicks_text"}, periods
                           ).orderBy("group_name", "sub_order")


def latest_period(report: DataFrame) -> DataFrame:
    """Newest period of the weekly report and its label."""
    return report.agg(F.max("period").alias("latest_period")).select(
        "latest_period", period_label("latest_period").alias("latest_period_label"))


__all__ = ["indicator_long", "indicator_pivot", "click_indicator_long", "click_indicator_pivot",
           "task_group_long", "task_group_pivot", "latest_period", "weekly_layout", "click_layout"]
