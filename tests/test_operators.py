"""Reusable operators and scalar functions."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from weekwise.functions import scalar as S
from weekwise.operators.cohort import count_flags, entity_flags, with_subtotal
from weekwise.operators.joins import CalendarSide, possible_keys
from weekwise.operators.temporal import TimeParts, day_buckets, next_after, prev_before, range_join

D = dt.datetime


def test_next_after_and_prev_before_strict(spark):
    df = spark.createDataFrame(
        [("k", D(2025, 1, 1), 1), ("k", D(2025, 1, 1), 0), ("k", D(2025, 1, 8), 0),
         ("k", D(2025, 1, 15), 1), (None, D(2025, 1, 1), 1), (None, D(2025, 1, 8), 1)],
        "key string, ts timestamp, flag int")
    out = next_after(df, "key", "ts", "nxt", only_if=F.col("flag") == 1)
    out = prev_before(out, "key", "ts", "prv")
    got = sorted((r.key or "", r.ts, r.flag, r.nxt, r.prv) for r in out.collect())
    assert got == [
        ("", D(2025, 1, 1), 1, None, None), ("", D(2025, 1, 8), 1, None, None),
        ("k", D(2025, 1, 1), 0, D(2025, 1, 15), None), ("k", D(2025, 1, 1), 1, D(2025, 1, 15), None),
        ("k", D(2025, 1, 8), 0, D(2025, 1, 15), D(2025, 1, 1)),
        ("k", D(2025, 1, 15), 1, None, D(2025, 1, 8)),
    ]


@pytest.mark.parametrize("max_rows", [1000, 0])
def test_range_join_is_closed_on_both_ends(spark, max_rows):
    pts = spark.createDataFrame(
        [("a", D(2025, 1, 8), 1.0), ("a", D(2025, 1, 8, 0, 0, 1), 2.0), ("b", D(2025, 1, 20), 5.0)],
        "key string, ts timestamp, v double")
    iv = spark.createDataFrame([(D(2025, 1, 1), D(2025, 1, 8)), (D(2025, 1, 8), D(2025, 1, 15))],
                               "lo timestamp, hi timestamp")
    side = CalendarSide(day_buckets(iv, "lo", "hi"), max_rows)
    assert side.small == (max_rows > 0)
    hits = range_join(pts, "ts", side, "lo", "hi").collect()
    assert sorted((r.key, r.v, r.lo.day) for r in hits) == [("a", 1.0, 1), ("a", 1.0, 8), ("a", 2.0, 8)]
    assert not CalendarSide(iv, 1000, max_bytes=10).small
    side.unpersist()


def test_two_stage_distinct_counts_and_subtotal(spark):
    df = spark.createDataFrame(
        [("p", "New", "x", True), ("p", "New", "x", False), ("p", "Old", "y", True), ("p", "Old", None, True)],
        "period string, t string, who string, ok boolean")
    flags = entity_flags(df, ["period", "t"], "who", {"any": None, "ok": F.col("ok")})
    out = with_subtotal(flags, ["period"], "t", count_flags("who", {"n": "any", "n_ok": "ok"}))
    got = {r.t: (r.n, r.n_ok) for r in out.collect()}
    assert got == {"New": (1, 1), "Old": (1, 1), "All customer": (2, 2)}


def test_safe_ratios(spark):
    r = spark.range(1).select(
        S.safe_div(F.lit(1), F.lit(0)).alias("z"), S.safe_div(F.lit(None), F.lit(2)).alias("n"),
        S.safe_div(F.lit(1), F.lit(4)).alias("q"), S.growth(F.lit(3.0), F.lit(0.0)).alias("g0"),
        S.growth(F.lit(3.0), F.lit(2.0)).alias("g")).first()
    assert (r.z, r.n, r.q, r.g0, r.g) == (None, None, 0.25, None, 0.5)


def test_display_text(spark):
    vals = spark.createDataFrame([(0.0625,), (-0.0001,), (0.0,), (1.005,), (1234567.5,), (None,)], "v double")
    out = vals.select(S.format_value("v", "pct").alias("p"), S.format_value("v", "growth").alias("g"),
                      S.format_value("v", "lot").alias("l"), S.format_value("v", "amount").alias("a")).collect()
    assert [tuple(r) for r in out] == [
        ("6.3%", "+6.3%", "0.06", "0"),
        ("-0.0%", "-0.0%", "-0.00", "-0"),
        ("0.0%", "+0.0%", "0.00", "0"),
        ("100.5%", "+100.5%", "1.00", "1"),
        ("123456750.0%", "+123456750.0%", "1234567.50", "1.234.568"),
        ("—", "—", "—", "—"),
    ]


def test_text_rounds_the_exact_binary_value(spark):
    """Literal texts; 51 of 2000 is 2.55 % less a little, 1.115 lies below its digits, 1.25 is a tie."""
    vals = spark.createDataFrame([(0.0255, 1.115), (0.0125, 1.25), (-0.01, -0.01), (0.3, 2.675), (0.00125, 0.125),
                                  (1e12, 1e12), (None, None)], "p double, l double")
    got = [tuple(r) for r in vals.select(S.format_value("p", "pct"), S.format_value("l", "lot")).collect()]
    assert got == [("2.5%", "1.11"), ("1.3%", "1.25"), ("-1.0%", "-0.01"), ("30.0%", "2.67"), ("0.1%", "0.13"),
                   ("100000000000000.0%", "1000000000000.00"), ("—", "—")]
    cls = spark.createDataFrame([(0.1,), (-0.1,), (0.0,), (None,)], "v double").select(S.growth_class("v")).collect()
    assert [r[0] for r in cls] == ["pos", "neg", "neu", "null"]


def test_period_label(spark):
    r = spark.createDataFrame([("20251213",), ("2025-12",)], "p string").select(S.period_label("p").alias("x"))
    assert [x.x for x in r.collect()] == ["2025-12-13", "2025-12"]


def test_documented_formats(spark):
    r = spark.createDataFrame([(1234567.0, 0.125, dt.date(2026, 5, 22))], "v double, p double, d date").select(
        S.rupiah_text("v").alias("rp"), S.pct_text_comma("p").alias("pc"), S.date_text_id("d").alias("di"),
        S.date_text_slash("d").alias("ds"), S.compact_text("v").alias("ci"),
        S.compact_text("v", "en").alias("ce"), S.compact_text(F.lit(999.0)).alias("small")).first()
    assert tuple(r) == ("Rp 1.234.567", "+12,5%", "22 Mei 2026", "22/05/2026", "1,2 Jt", "1.2M", "999")


def test_range_join_by_ranges_of_time(spark):
    """Equal rows whichever way it runs; a day is repeated in the ranges it touches; a hot time has shares."""
    r = random.Random(3)
    start = D(2025, 1, 1)
    times = [start + dt.timedelta(seconds=r.randint(0, 30 * 86400)) for _ in range(300)] + [D(2025, 1, 8)] * 300
    pts = spark.createDataFrame([(k % 7, ts) for k, ts in enumerate(times)] + [(9, None)], "key int, ts timestamp")
    ivs = [(start + dt.timedelta(days=k), start + dt.timedelta(days=k + r.randint(0, 9))) for k in range(25)]
    ivs += [ivs[3], (D(2025, 1, 5), D(2025, 1, 4)), (None, start)]
    iv = spark.createDataFrame(ivs, "lo timestamp, hi timestamp")
    expected = sorted((k % 7, ts, lo, hi) for k, ts in enumerate(times) for lo, hi in ivs if lo and lo <= ts <= hi)
    for max_rows in (100_000, 0):
        side = CalendarSide(day_buckets(iv, "lo", "hi"), max_rows)
        assert sorted(map(tuple, range_join(pts, "ts", side, "lo", "hi").collect())) == expected
    parts = TimeParts(pts, "ts", 16)
    hot = max(parts.shares)
    assert 6 <= hot <= 9 and sum(parts.shares) == 16
    dealt = parts.deal(pts.withColumn("_day", F.to_date("ts")), "ts")
    sizes = dealt.where("ts is not null").groupBy("_range", "_share").count().toPandas()["count"]
    assert sizes.max() < 300
    borders = [None, *parts.borders, None]
    for row in parts.repeat(side.df, "lo", "hi").collect():
        day = D.combine(row["_day"], dt.time())
        first, last = (int(x.replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
                       for x in (max(row.lo, day), min(row.hi, day + dt.timedelta(days=1))))
        low, high = borders[row["_range"]], borders[row["_range"] + 1]
        assert (low is None or last >= low) and (high is None or first < high)
    empty = range_join(pts.where("false"), "ts", side, "lo", "hi")
    assert empty.collect() == [] and TimeParts(pts.where("false"), "ts").shares == [1]
    side.unpersist()


def test_possible_keys_keep_all_members_and_few_others(spark):
    members = spark.range(2000).select((F.col("id") * 7).alias("m")).unionByName(
        spark.createDataFrame([(None,), (-5,)], "m bigint"))
    rows = spark.range(200_000).withColumnRenamed("id", "k").unionByName(
        spark.createDataFrame([(None,), (-5,), (-5,)], "k bigint"))
    kept = possible_keys(rows, "k", members, "m", words=1024)
    wanted = rows.join(members, rows.k == members.m, "left_semi")
    assert kept.join(wanted.distinct(), "k", "left_semi").count() == wanted.count() == 2002
    assert wanted.count() <= kept.count() < wanted.count() + 2000            # under one of a hundred others
    assert kept.where("k is null").count() == 0
    assert possible_keys(rows, "k", members, "m", words=1).join(wanted, "k", "left_anti").count() >= 0
    assert possible_keys(rows, "k", members.where("false"), "m").count() == 0
    with pytest.raises(ValueError, match="StringType"):
        possible_keys(rows.withColumn("k", F.col("k").cast("string")), "k", members, "m")
