"""Output contract of registered queries.

Dates and timestamps become fixed-format text and fractional numbers
doubles rounded to 6 decimals, so a result compares equal across engines
and client libraries (the DuckDB oracle applies the same projection).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DATE_FMT = "yyyy-MM-dd"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def canonical(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DateType):
            c = F.date_format(c, DATE_FMT)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, TS_FMT)
        elif isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        cols.append(c.alias(f.name))
    return df.select(cols)
