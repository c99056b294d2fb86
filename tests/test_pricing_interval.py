"""Promotion pricing against a brute-force line loop, and the interval join."""

from __future__ import annotations

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from shopstar.operators.interval_join import cover, interval_join, lowest_active
from shopstar.plans.pricing import price_order_lines

D = Decimal
PROMOS = [(1, "PCT", "percentage", D("12.50")), (2, "FIX", "fixed_amount", D("30.00")),
          (3, "EQ", "fixed_amount", D("20.00")), (4, "BIG", "fixed_amount", D("9999.00"))]


def _loop(lines, promo):
    """The generator's sequential rule, line by line."""
    out, budget = {}, promo[3] if promo and promo[2] == "fixed_amount" else D(0)
    for item_id, qty, unit in sorted(lines):
        gross = (qty * unit).quantize(D("0.01"))
        if promo and promo[2] == "percentage":
            disc = (gross * promo[3] / 100).quantize(D("0.01"), ROUND_HALF_UP)
        else:
            disc = min(budget, gross)
            budget -= disc
        out[item_id] = (gross, disc, gross - disc)
    return out


def test_price_order_lines_matches_loop(spark):
    rnd = random.Random(11)
    orders, items, expected = [], [], {}
    item_id = 0
    for order_id in range(60):
        promo = rnd.choice([None, *PROMOS])
        orders.append((order_id, promo[0] if promo else None))
        lines = []
        for _ in range(rnd.randint(1, 5)):
            item_id += 1
            lines.append((item_id, rnd.randint(1, 4), D(rnd.randint(100, 3000)) / 100))
        if order_id == 0:  # first line exactly uses the whole budget of EQ
            orders[-1] = (order_id, 3)
            promo = PROMOS[2]
            lines[0] = (lines[0][0], 1, D("20.00"))
        items += [(i, order_id, q, u) for i, q, u in lines]
        expected.update(_loop(lines, promo))
    it = spark.createDataFrame(items, "order_item_id long, order_id long, quantity int, "
                                      "unit_price decimal(10,2)")
    od = spark.createDataFrame(orders, "order_id long, promotion_id long")
    pr = spark.createDataFrame(PROMOS, "promotion_id long, promotion_code string, "
                                       "discount_type string, discount_value decimal(10,2)")
    got = {r.order_item_id: (r.gross_amount, r.promo_discount, r.line_total)
           for r in price_order_lines(it, od, pr).collect()}
    assert got == expected


def test_interval_join_inclusive_and_lowest(spark):
    rows = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 10, 23)),
         (3, dt.datetime(2024, 1, 11)), (4, dt.datetime(2023, 12, 31))],
        "id long, ts timestamp_ntz")
    windows = spark.createDataFrame(
        [(5, dt.date(2024, 1, 1), dt.date(2024, 1, 10)), (3, dt.date(2024, 1, 10),
                                                          dt.date(2024, 1, 20)),
         (9, dt.date(2024, 2, 1), dt.date(2024, 1, 1))],  # empty window
        "pid long, s date, e date")
    pairs = sorted((r.id, r.pid) for r in interval_join(rows, "ts", windows, "s", "e", "pid")
                   .collect())
    assert pairs == [(1, 5), (2, 3), (2, 5), (3, 3)]
    low = {r.id: r.best for r in lowest_active(rows, "ts", windows, "s", "e", "pid", "best")
           .collect()}
    assert low == {1: 5, 2: 3, 3: 3, 4: None}


def _pairs(points, windows, low, high):
    return sorted((i, w) for i, p in points for w, a, b in windows
                  if p is not None and (low if a is None else a) <= p <= (high if b is None else b))


def test_open_and_long_windows(spark):
    """Random windows, open ones and one of 8000 years against every pair, on days and on microseconds."""
    rnd = random.Random(3)
    start = dt.date(2000, 1, 1)
    days = [(k, start + dt.timedelta(days=rnd.randint(-900, 900))) for k in range(150)] + [(999, None)]
    windows = [(k, a if rnd.random() > 0.1 else None, a + dt.timedelta(days=rnd.choice([-3, 0, 0, 1, 7, 500]))
                if rnd.random() > 0.1 else None) for k in range(80)
               for a in [start + dt.timedelta(days=rnd.randint(-900, 900))]]
    windows += [(900, dt.date(1, 1, 1), dt.date(9999, 12, 31)), (901, None, None), (902, None, dt.date(1999, 2, 3))]
    rows = spark.createDataFrame(days, "id long, p date")
    w = spark.createDataFrame(windows, "pid long, s date, e date")
    want = _pairs(days, windows, dt.date.min, dt.date.max)
    assert sorted((r.id, r.pid) for r in interval_join(rows, "p", w, "s", "e", "pid").collect()) == want
    best = {i: min((p for j, p in want if j == i), default=None) for i, _ in days}
    assert {r.id: r.best for r in lowest_active(rows, "p", w, "s", "e", "pid", "best").collect()} == best

    moments = [(k, dt.datetime(2024, 3, 31, 1, 59, 59) + dt.timedelta(microseconds=rnd.randint(0, 40))) for k in range(60)]
    spans = [(k, a if k % 9 else None, a + dt.timedelta(microseconds=rnd.randint(-1, 9)) if k % 7 else None)
             for k in range(40) for a in [dt.datetime(2024, 3, 31, 1, 59, 59) + dt.timedelta(microseconds=rnd.randint(0, 40))]]
    for kind in ("timestamp_ntz", "timestamp"):
        got = interval_join(spark.createDataFrame(moments, f"id long, p {kind}"), "p",
                            spark.createDataFrame(spans, f"pid long, s {kind}, e {kind}"), "s", "e", "pid")
        assert sorted((r.id, r.pid) for r in got.collect()) == _pairs(moments, spans, dt.datetime.min, dt.datetime.max)


def test_a_cover_is_small_and_exact(spark):
    for low, high in [(0, 0), (-5, 9), (7, 7), (-(1 << 61), (1 << 61) - 1), (1, (1 << 60) + 3), (-1, 0), (-4097, -2)]:
        got = spark.range(1).select(F.inline(cover(F.lit(low).cast("long"), F.lit(high).cast("long")))).collect()
        spans = sorted((r.node << r.level, ((r.node + 1) << r.level) - 1) for r in got)
        assert spans[0][0] == low and spans[-1][1] == high and len(spans) <= 124
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:]))
