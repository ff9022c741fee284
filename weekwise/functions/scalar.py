"""Column expressions (F1-F19): calendar keys, safe ratios, display text.

All of them are built-in Spark expressions, so they stay inside whole-stage
code generation; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text shown for a missing number (em dash).
NULL_TEXT = "—"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_key(c) -> Column:
    """First day of the month of a date or timestamp (F1: ``left(x, 7)``)."""
    return F.trunc(F.to_date(_c(c)), "month")


def yyyymmdd(c) -> Column:
    """date -> ``yyyyMMdd`` text."""
    return F.date_format(_c(c), "yyyyMMdd")


def plus_days(c, n: int) -> Column:
    """F3 on dates; returns a DATE (SQL ``dateadd`` would give a timestamp)."""
    return F.date_add(F.to_date(_c(c)), n)


def plus_days_ts(c, n: int) -> Column:
    """F3 on timestamps: keeps the time of day."""
    return _c(c) + F.make_interval(days=F.lit(n))


def safe_div(a, b) -> Column:
    """``a / b`` as double, NULL when either is NULL or ``b`` is 0."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def growth(this_week, last_week) -> Column:
    """``(this - last) / last``, NULL when either is NULL or last is 0."""
    t, l = _c(this_week).cast("double"), _c(last_week).cast("double")
    return F.try_divide(t - l, l)


def epoch_ms_to_ts(c) -> Column:
    """F7 + F8: epoch milliseconds to timestamp, 0 meaning 'never'."""
    return F.timestamp_millis(F.nullif(_c(c), F.lit(0).cast("bigint")))


def period_label(c) -> Column:
    """``yyyyMMdd`` -> ``yyyy-MM-dd``; other lengths unchanged."""
    p = _c(c).cast("string")
    return F.when(F.length(p) == 8,
                  F.concat_ws("-", F.substring(p, 1, 4), F.substring(p, 5, 2), F.substring(p, 7, 2))
                  ).otherwise(p)


def _whole(x: Column) -> Column:
    """The integer of a double without a fraction, below 1e21, exactly."""
    high = F.floor(x / F.lit(4294967296.0))
    low = x - high.cast("double") * F.lit(4294967296.0)
    return (high.cast("decimal(20,0)") * F.lit(4294967296).cast("decimal(10,0)") + low.cast("decimal(10,0)")
            ).cast("decimal(31,0)")


def _rounded(x: Column, scale: Column) -> Column:
    """``x`` (0 <= x < 1) times ``scale``, a power of ten, as the nearest integer; a tie goes up.

    The product with a power of ten is rounded, so the error of the product
    (exact, by splitting the factor into halves) decides the half case.
    """
    product = x * scale
    spread = x * F.lit(134217729.0)          # 2**27 + 1
    high = spread - (spread - x)
    error = (high * scale - product) + (x - high) * scale
    whole = F.floor(product)
    over = ((product - whole.cast("double")) - F.lit(0.5)) + error
    return (whole + F.when(over >= 0, 1).otherwise(0)).cast("bigint")


def _fixed(v: Column, decimals: int | Column) -> Column:
    """Magnitude of the exact binary value of ``v`` with ``decimals`` digits; a tie goes up.

    The integer and the fraction of a double are doubles themselves, so each
    is exact on its own.  From 1e21 on the shortest text is shown, as the
    page does.
    """
    digits = F.lit(decimals) if isinstance(decimals, int) else decimals
    scale = F.pow(F.lit(10.0), digits)
    x = F.abs(v)
    fits = x < F.lit(1e21)
    frac = F.pmod(F.when(fits, x), F.lit(1.0))
    part = _rounded(frac, scale)
    whole = (_whole(F.when(fits, x) - frac) + F.floor(part / scale).cast("decimal(1,0)")).cast("string")
    after = F.lpad((part % scale.cast("bigint")).cast("string"), digits, F.lit("0"))
    whole = F.when(digits > 0, F.concat(whole, F.lit("."), after)).otherwise(whole)
    huge = F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0E", "E"), "E", "e+")
    return F.when(fits, whole).when(v.isNotNull(), huge)


def _signed(v: Column, decimals: int) -> Column:
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), _fixed(v, decimals))


def pct_text(c) -> Column:
    """``12.3%`` (value x 100, one decimal)."""
    v = _c(c).cast("double") * 100
    return F.concat(_signed(v, 1), F.lit("%"))


def growth_text(c) -> Column:
    """``+12.3%`` / ``-4.0%``."""
    v = _c(c).cast("double")
    return F.concat(F.when(v >= 0, F.lit("+")).otherwise(F.lit("")), _signed(v * 100, 1), F.lit("%"))


def growth_class(c) -> Column:
    """``pos`` / ``neg`` / ``neu`` by sign; ``null`` for NULL."""
    v = _c(c)
    return (F.when(v.isNull(), F.lit("null")).when(v > 0, F.lit("pos"))
            .when(v < 0, F.lit("neg")).otherwise(F.lit("neu")))


def lot_text(c) -> Column:
    """two decimals, no grouping."""
    return _signed(_c(c).cast("double"), 2)


def _grouped(whole: Column) -> Column:
    """'.' between each three digits of an integer's text."""
    return F.regexp_replace(whole, r"(?<=\d)(?=(\d{3})+$)", ".")


def amount_text(c) -> Column:
    """F16: whole number with '.' as thousands separator (id-ID)."""
    v = _c(c).cast("double")
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), _grouped(_fixed(v, 0)))


def count_text(c) -> Column:
    """F17 default: ``String(v)``."""
    return _c(c).cast("string")


FORMATTERS = {
    "pct": pct_text,
    "growth": growth_text,
    "lot": lot_text,
    "amount": amount_text,
    "count": count_text,
}


def format_value(c, fmt: str) -> Column:
    """Display text of a number by layout format, em dash for NULL."""
    return F.coalesce(FORMATTERS.get(fmt, count_text)(c), F.lit(NULL_TEXT))


def format_by(c, fmt_col) -> Column:
    """Like ``format_value`` with the format read from a column; the number is rounded once for all of them."""
    v, f = _c(c), _c(fmt_col)
    percent = f.isin("pct", "growth")
    n = F.when(percent, v.cast("double") * 100).otherwise(v.cast("double"))
    size = _fixed(n, F.when(percent, 1).when(f == "lot", 2).otherwise(0))
    text = F.concat(F.when((f == "growth") & (v >= 0), F.lit("+")).when(n < 0, F.lit("-")).otherwise(F.lit("")),
                    F.when(f == "amount", _grouped(size)).otherwise(size),
                    F.when(percent, F.lit("%")).otherwise(F.lit("")))
    known = f.isin("pct", "growth", "lot", "amount")
    return F.coalesce(F.when(known, text).otherwise(count_text(v)), F.lit(NULL_TEXT))


# formats the design notes document for the dashboard (no reference
# code).  Fixed values: Indonesian short month names, January first.
ID_MONTHS = ["Jan", "Feb", "Mar", "Apr", "Mei", "Jun", "Jul", "Agu", "Sep", "Okt", "Nov", "Des"]


def rupiah_text(c) -> Column:
    """``Rp 1.234.567``."""
    return F.when(_c(c).isNotNull(), F.concat(F.lit("Rp "), amount_text(c)))


def pct_text_comma(c) -> Column:
    """``+12,5%``: signed percent with a decimal comma."""
    v = _c(c).cast("double")
    return F.when(v.isNotNull(), F.translate(growth_text(v), ".", ","))


def date_text_id(c) -> Column:
    """``22 Mei 2026``."""
    d = F.to_date(_c(c))
    months = F.array(*[F.lit(m) for m in ID_MONTHS])
    return F.concat_ws(" ", F.dayofmonth(d).cast("string"),
                       F.element_at(months, F.month(d)), F.year(d).cast("string"))


def date_text_slash(c) -> Column:
    """``22/05/2026``."""
    return F.date_format(F.to_date(_c(c)), "dd/MM/yyyy")


def compact_text(c, style: str = "id") -> Column:
    """Numbers of a million or more shortened: ``1,2 Jt`` (id) or ``1.2M``
    (en); smaller numbers as ``amount_text``."""
    v = _c(c).cast("double")
    millions = _signed(v / 1_000_000, 1)
    short = (F.concat(F.translate(millions, ".", ","), F.lit(" Jt")) if style == "id"
             else F.concat(millions, F.lit("M")))
    return F.when(F.abs(v) >= 1_000_000, short).otherwise(amount_text(v))
