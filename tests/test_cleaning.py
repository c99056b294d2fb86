from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from shopstar.functions.cleaning import date_key, dedupe_first, trim_strings, utc_naive
from shopstar.functions.money import half_up_ratio, idiv


def test_trim_strips_tabs_newlines_and_keeps_other_types(spark):
    df = spark.createDataFrame([(" \ta b\n", 1, None)], "s string, n int, t string")
    row = trim_strings(df).collect()[0]
    assert row.s == "a b" and row.n == 1 and row.t is None


def test_dedupe_first_is_deterministic_and_keeps_null_key(spark):
    df = spark.createDataFrame(
        [(1, "b"), (1, "a"), (2, None), (2, "z"), (None, "x"), (None, "y")], "k long, v string")
    got = sorted(dedupe_first(df, "k").collect(), key=lambda r: (r.k is None, r.k or 0))
    assert [(r.k, r.v) for r in got] == [(1, "a"), (2, None), (None, "x")]


def test_date_key_and_utc_parse(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30), "2024-01-01T05:00:00+02:00"),
                                (dt.date(2027, 1, 1), "bad")], "d date, s string")
    rows = df.select(date_key(F.col("d")).alias("k"), utc_naive(F.col("s")).alias("t")).collect()
    assert [r.k for r in rows] == [20241230, 20270101]
    assert rows[0].t == dt.datetime(2024, 1, 1, 3, 0) and rows[1].t is None


def test_half_up_integer_rounding(spark):
    df = spark.createDataFrame([(1, 8), (5, 1000), (2, 0), (7, 3)], "a long, b long")
    rows = df.select(half_up_ratio(F.col("a"), F.col("b"), 2, 100).alias("p"),
                     idiv(F.col("a"), F.col("b")).alias("q")).collect()
    assert [r.p for r in rows] == [12.5, 0.5, None, 233.33]
    assert [r.q for r in rows] == [0, 0, None, 2]


def test_upsert_takes_one_change_per_key(spark):
    from shopstar.plans.upsert import upsert
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    new = spark.createDataFrame([(2, "z", 5), (2, "y", 9), (2, "y", 9), (3, "c", 1)], "k int, v string, at int")
    assert sorted(map(tuple, upsert(old, new, ["k"]).collect())) == [(1, "a", 0), (2, "y", 9), (3, "c", 1)]
    newer = new.union(spark.createDataFrame([(2, "m", 10)], "k int, v string, at int"))
    assert sorted(map(tuple, upsert(old, newer, ["k"], latest_by="at").collect())) == [
        (1, "a", 0), (2, "m", 10), (3, "c", 1)]


def test_ratios_round_halves_away_from_zero(spark):
    from pyspark.sql import functions as F
    from shopstar.functions.money import half_up_ratio
    rows = [(1, 8), (-1, 8), (1, -8), (-1, -8), (-3, 200), (5, 0), (0, 7), (-1, 3)]
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r.x for r in df.select(half_up_ratio(F.col("n"), F.col("d")).alias("x")).collect()]
    assert got == [0.13, -0.13, -0.13, 0.13, -0.02, None, 0.0, -0.33]
