"""Weighted selection against a sort, and the plan of the Pareto threshold."""

from __future__ import annotations

import random

import pytest

from shopstar.operators.selection import rank_reaching
from shopstar.plans import analytics as A


@pytest.mark.parametrize("values", [
    [5], [3, 3, 3, 3], [10, 1, 1, 1, 1], [-5, 7, 0, 2, 2, -1], [1 << 61, 1, 5, 1 << 40, 1 << 40],
    [random.Random(k).randint(-100, 10 ** (k % 17)) for k in range(300)], []])
def test_rank_equals_a_sorted_running_sum(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    above = sorted((v for v in values if v > 0), reverse=True)
    total = sum(above)
    for target in {1, 2, total // 3 + 1, total - 1, total, total + 1} - {0, -1}:
        sums = [sum(above[:k + 1]) for k in range(len(above))]
        want = next((k + 1 for k, s in enumerate(sums) if s >= target), None)
        assert rank_reaching(df, "v", target) == want


@pytest.mark.parametrize("entity", ["product", "customer"])
def test_threshold_is_where_the_curve_crosses(spark, small_warehouse, entity):
    curve = A.revenue_concentration(small_warehouse.star, entity).collect()
    for share in (0.01, 10.0, 33.333, 50.0, 80.0, 99.99, 100.0):
        want = next(r for r in curve if r.cumulative_revenue_pct >= share)
        got = A.pareto_threshold(small_warehouse.star, entity, share).first()
        assert (got.entities, got.entity_pct) == (want.rank, want.entity_pct)
    assert A.pareto_threshold(small_warehouse.star, entity, 100.5).first().entities is None
