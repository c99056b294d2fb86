"""The batch run (N23): load sources -> stage -> staging gate -> star ->
analytics gate -> publish, stopping at the first failed gate.

Every layer is written as Parquet under ``root`` (cut lineage: a lost
executor recomputes from files, not from the sources). A build goes to its
own folder ``root/builds/<build id>`` and passes the analytics gate there,
whatever steps were asked for; only then is it published, by one row appended
to ``root/_published``. Readers take the newest row, so they see the old build
until the append is complete and the new one after it. Each step appends to
the run log ``root/pipeline_runs``, loads append to ``root/etl_audit``.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.plans import quality as Q
from shopstar.plans.staging import stage_all
from shopstar.plans.star import build_star
from shopstar.session import scratch_scope
from shopstar.sources.bucketed import open_bucketed, write_bucketed
from shopstar.sources.io import RELATIONAL, load, read_landing, record_audit
from shopstar.sources.schemas import DIMENSIONS, FACTS
from shopstar.sources.store import ParquetStore

#: Staged tables that meet on their order: laid out by its hash.
BY_ORDER = ("stg_orders", "stg_order_items", "stg_payments", "stg_returns")

STEPS = ("load-sources", "stage", "quality-staging", "transform", "quality-analytics")


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def log_run(spark: SparkSession, root: str, step: str, counts: dict) -> None:
    """Append one row to the run log."""
    spark.range(1).select(
        F.lit(int(time.time() * 1000)).cast("long").alias("run_id"),
        F.lit(step).alias("step_name"), F.lit(json.dumps(counts)).alias("row_counts"),
        F.lit(_now()).cast("timestamp_ntz").alias("completed_at"),
    ).write.mode("append").parquet(f"{root}/pipeline_runs")


def last_refresh(spark: SparkSession, root: str) -> DataFrame:
    """The latest run-log row (N15): a top-1, combined per task."""
    runs = spark.read.parquet(f"{root}/pipeline_runs")
    return runs.orderBy(F.desc("completed_at"), F.desc("run_id")).limit(1) \
        .select("step_name", "completed_at")


def publish(spark: SparkSession, root: str, build: str) -> None:
    """Make ``build`` the current one: append its row."""
    spark.range(1).coalesce(1).select(
        F.lit(build).alias("build"), F.lit(time.time_ns()).alias("version"),
    ).write.mode("append").parquet(f"{root}/_published")


def current_build(spark: SparkSession, root: str) -> str:
    rows = spark.read.schema("build string, version long").parquet(f"{root}/_published")
    return rows.agg(F.max_by("build", "version")).first()[0]


def published_star(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The star tables of the published build."""
    build = current_build(spark, root)
    return {name: spark.read.parquet(f"{build}/{name}") for name in (*DIMENSIONS, *FACTS)}


def _load_all(tables: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Independent loads overlap; each writes its own folder."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        futures = {n: pool.submit(load, df, f"{folder}/{n}") for n, df in tables.items()}
        return {n: f.result() for n, f in futures.items()}


def write_staging(spark: SparkSession, staged: dict[str, DataFrame], folder: str,
                  buckets: int | None = None) -> dict[str, int]:
    """Write the staged tables; those of ``BY_ORDER`` in ``buckets`` (default:
    the session's shuffle partitions) by order, so that the joins and sums per
    order behind the gate and the facts need no shuffle."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = _load_all({n: df for n, df in staged.items() if n not in BY_ORDER}, folder)
    return {**counts, **{n: write_bucketed(staged[n], folder, n, "order_id", buckets) for n in BY_ORDER}}


def read_staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {n: open_bucketed(spark, folder, n) if n in BY_ORDER else spark.read.parquet(f"{folder}/{n}")
            for n in _staged_names()}


def run_pipeline(spark: SparkSession, sources: dict[str, DataFrame] | str, root: str,
                 steps: tuple[str, ...] = ("all",), as_of: dt.date | None = None) -> dict[str, int]:
    """Run ``steps`` (or all of them); return row counts. ``sources`` is a
    folder of landing files or the source tables themselves; ``load-sources``
    lands them under ``root``, where ``stage`` reads them."""
    run = set(STEPS) if "all" in steps else set(steps)
    unknown = run - set(STEPS)
    if unknown:
        raise ValueError(f"unknown steps: {sorted(unknown)}")
    with scratch_scope(spark):  # all results are under ``root`` at its end
        return _run_steps(spark, sources, root, run, as_of or _now().date())


def _run_steps(spark: SparkSession, sources: dict[str, DataFrame] | str, root: str, run: set[str],
               as_of: dt.date) -> dict[str, int]:
    counts: dict[str, int] = {}
    landed_path, staged_path = f"{root}/landed", f"{root}/staging"

    if "load-sources" in run:
        tables = read_landing(spark, sources) if isinstance(sources, str) else sources
        counts.update(_load_all(tables, landed_path))
        record_audit(spark, f"{root}/etl_audit", counts)
        log_run(spark, root, "load_sources", counts)
    if "stage" in run:
        landed = {n: spark.read.parquet(f"{landed_path}/{n}") for n in (*RELATIONAL, "products")}
        loaded = write_staging(spark, stage_all(landed), staged_path)
        counts.update(loaded)
        record_audit(spark, f"{root}/etl_audit", loaded)  # one append for all tables
        log_run(spark, root, "stage", loaded)

    if run & {"quality-staging", "transform"}:
        staged = read_staging(spark, staged_path)
    if "quality-staging" in run:
        Q.gate(Q.staging_checks(staged), "staging")
    if "transform" in run:
        build = f"{root}/builds/{time.time_ns()}"
        star = build_star(staged, ParquetStore(spark, build))
        built = {name: star[name].count() for name in (*DIMENSIONS, *FACTS)}  # footer counts
        Q.gate(Q.analytics_checks(star, as_of=as_of), "analytics")  # before anyone can see it
        publish(spark, root, build)
        counts.update(built)
        log_run(spark, root, "build_analytics", built)
    elif "quality-analytics" in run:
        Q.gate(Q.analytics_checks(published_star(spark, root), as_of=as_of), "analytics")
    return counts


def _staged_names() -> list[str]:
    from shopstar.plans.staging import PLAIN_TABLES
    return [f"stg_{n}" for n in PLAIN_TABLES] + ["stg_customers", "stg_products"]


__all__ = ["run_pipeline", "last_refresh", "published_star", "publish", "current_build", "log_run"]
