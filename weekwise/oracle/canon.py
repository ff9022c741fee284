"""Final projection shared by every oracle query: the same text form for
dates and timestamps, and numbers as doubles rounded to 6 decimals, as
``weekwise.functions.canonical.canonical`` does on the Spark side."""

DATE_FMT = "%Y-%m-%d"
TS_FMT = "%Y-%m-%d %H:%M:%S.%f"


def canon(cte: str, dates=(), stamps=(), nums=()) -> str:
    repl = [f"strftime({c}, '{DATE_FMT}') AS {c}" for c in dates]
    repl += [f"strftime({c}, '{TS_FMT}') AS {c}" for c in stamps]
    repl += [f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in nums]
    star = f"* REPLACE ({', '.join(repl)})" if repl else "*"
    return f" SELECT {star} FROM {cte}"
