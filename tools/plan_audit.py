"""Explain every registered query and flag plan shapes that do not scale:
single-partition exchanges, nested-loop / cartesian joins, Python
evaluation. With ``--build``, the build itself instead: each table's plan as
it is written, with broadcast joins off (as if every dimension were large).
Usage: python tools/plan_audit.py [sf_dir] [--build]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstar.catalog import queries  # noqa: E402
from shopstar.plans import warehouse as W  # noqa: E402
from shopstar.session import local_session, scratch_folder  # noqa: E402
from shopstar.sources.store import CachedStore, ParquetStore  # noqa: E402

FLAGS = {
    "single-partition exchange": re.compile(r"Exchange SinglePartition"),
    "nested-loop join": re.compile(r"BroadcastNestedLoopJoin"),
    "cartesian product": re.compile(r"CartesianProduct"),
    "coalesce to one task": re.compile(r"\bCoalesce 1\b"),
    "python evaluation": re.compile(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas"
                                    r"|MapInPandas|MapInArrow|FlatMapGroupsInArrow)"),
}


def line(name: str, df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = {k: len(p.findall(plan)) for k, p in FLAGS.items() if p.search(plan)}
    exchanges = plan.count("Exchange hashpartitioning") + plan.count("Exchange rangepartitioning")
    return (f"{name:40s} shuffles={exchanges:3d} broadcasts={plan.count('BroadcastExchange'):3d} "
            f"scans={plan.count('FileScan'):3d} {found or ''}")


class AuditStore(ParquetStore):
    def put(self, name, df, months=None, unique=None):
        print(line(name, df), flush=True)
        return super().put(name, df, months, unique)


def main() -> None:
    args = [a for a in sys.argv[1:] if a != "--build"]
    sf_dir = (args[0] if args else "/root/testdata/sf0.01").rstrip("/")
    build = "--build" in sys.argv
    spark = local_session(extra={"spark.sql.autoBroadcastJoinThreshold": "-1"} if build else None)
    root = scratch_folder(spark, "shopstar-audit")
    if build:
        W.Warehouse(spark, sf_dir, AuditStore(spark, root, parallel=1)).star
        return
    # staging and star written as Parquet, so every plan starts at its own scans
    W._CACHE[(id(spark), sf_dir)] = W.Warehouse(
        spark, sf_dir, ParquetStore(spark, root), source_store=CachedStore()), W._stamp(spark, sf_dir)
    for name, fn in queries().items():
        print(line(name, fn(spark, sf_dir)), flush=True)


if __name__ == "__main__":
    main()
