"""Benchmark: build the warehouse once (sources -> staging -> star, each
table written as Parquet and read back), then time every headline query
over the written star (best of two runs; the sum of first runs is reported
as ``cold_queries_total``). Prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shopstar import catalog as C  # noqa: E402
from shopstar.catalog import SLICE  # noqa: E402
from shopstar.plans import analytics as A  # noqa: E402
from shopstar.plans import quality as Q  # noqa: E402
from shopstar.plans.guarded_sql import guarded_sql  # noqa: E402
from shopstar.plans.pricing import price_order_lines  # noqa: E402
from shopstar.plans.warehouse import Warehouse  # noqa: E402
from shopstar.session import local_session, scratch_folder, scratch_scope  # noqa: E402
from shopstar.sources.store import CachedStore, ParquetStore  # noqa: E402

import datetime as dt  # noqa: E402


class TimedStore(ParquetStore):
    """Notes the seconds of each table's write (independent ones overlap)."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        self.seconds: dict[str, float] = {}

    def put(self, name, df, months=None, unique=None):
        began = time.perf_counter()
        out = super().put(name, df, months, unique)
        self.seconds[name] = time.perf_counter() - began
        return out


def run(df) -> None:
    """Execute fully without shipping rows to the driver."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="shopstar-bench")
    root = scratch_folder(spark, "shopstar-bench")  # under spark.checkpoint.dir
    times: dict[str, float] = {}

    t0 = time.perf_counter()
    store = TimedStore(spark, root)
    wh = Warehouse(spark, sf_dir, store, source_store=CachedStore())
    times["build_sources"] = -t0 + (wh.sources and time.perf_counter())
    star = wh.star  # sources cached once; staging and star tables written
    times["build_warehouse"] = time.perf_counter() - t0 - times["build_sources"]

    stg = wh.staged
    headline = {
        "n2_kpi_summary": lambda: A.kpi_summary(star),
        "n2_kpi_summary_filtered": lambda: A.kpi_summary(star, SLICE),
        "n3_revenue_by_category": lambda: A.revenue_by_category(star),
        "n4_revenue_by_product": lambda: A.revenue_by_product(star),
        "n5_sales_trend_month": lambda: A.sales_trend(star),
        "n5_sales_trend_day": lambda: A.sales_trend(star, "day"),
        "n6_category_trend": lambda: A.category_trend(star),
        "n7_customer_segments": lambda: A.customer_segments(star),
        "n8_repeat_vs_one_time": lambda: A.repeat_vs_one_time(star),
        "n9_top_customers": lambda: A.top_customers(star),
        "n10_concentration_product": lambda: A.revenue_concentration(star),
        "n10_concentration_customer": lambda: A.revenue_concentration(star, "customer"),
        "n11_clv_distribution": lambda: A.clv_distribution(star),
        "n12_channel_performance": lambda: A.channel_performance(star),
        "n13_channel_product_matrix": lambda: A.channel_product_matrix(star),
        "n14_promotion_performance": lambda: A.promotion_performance(star),
        "n16_promo_vs_baseline": lambda: A.promo_vs_baseline(star),
        "n17_clv_histogram": lambda: A.clv_histogram(star),
        "n20_pareto_threshold": lambda: A.pareto_threshold(star),
        "n21_price_order_lines": lambda: price_order_lines(
            stg["stg_order_items"], stg["stg_orders"], stg["stg_promotions"]),
        "dq_staging_gate": lambda: Q.staging_checks(stg),
        "dq_analytics_gate": lambda: Q.analytics_checks(star, as_of=dt.date(2002, 1, 1)),
        "dq_star_suite": lambda: Q.star_suite(star),
        "dq_staging_suite": lambda: Q.staging_suite(stg),
        "n22_price_returns": lambda: C.price_staged_returns(stg),
        "j12_interval_join": lambda: C.active_promotions(stg),
        "w1_w2_rank": lambda: C.ranked_lines(star),
        "w6_running_sum": lambda: C.running_sums(star),
        "s13_upsert_customers": lambda: C.moved_customers(stg),
        "g_guarded_sql": lambda: guarded_sql(spark, C.GUARDED_SQL, star),
    }
    cold = 0.0
    for name, build in headline.items():
        runs = []
        for _ in range(2):  # the first run also pays JIT / codegen warm-up
            with scratch_scope(spark):
                t = time.perf_counter()
                run(build())
                runs.append(time.perf_counter() - t)
        cold += runs[0]
        times[name] = min(runs)

    total = sum(times.values())
    print(json.dumps({
        "metric": "warehouse_build_plus_queries", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "cold_queries_total": round(cold, 3),
        "tables": {k: round(v, 3) for k, v in store.seconds.items()},
        "sf": os.path.basename(sf_dir).replace("sf", ""),
    }))


if __name__ == "__main__":
    main()
