"""Guarded ad-hoc SQL over an allow-list of tables.

Spark's own parser reads the text (one statement) and nothing runs before the
parsed plan has passed, node by node:

* only query operators may occur (fail closed: commands, inserts, DDL, SET and
  script transforms are no query operators);
* a table name must be unqualified, and either allowed or a CTE in scope: a
  CTE's body sees the outer scopes and the siblings before it, its name is
  visible inside its own WITH only;
* table-valued functions and the reflection functions are refused.

Accepted text runs in a session of its own, which holds the allowed tables as
views and nothing else and cannot read files by path; the caller's views stay
as they are. ``run_guarded`` reports whether the row cap cut the result, and
cancels the query's jobs when its time is up.
"""

from __future__ import annotations

import threading
import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, Row, SparkSession

from shopstar.sources.schemas import DIMENSIONS, FACTS

APPROVED_TABLES = frozenset((*DIMENSIONS, *FACTS))

QUERY_NODES = frozenset({
    "Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Offset", "Tail",
    "Join", "LateralJoin", "Union", "Distinct", "Deduplicate", "Except", "Intersect",
    "SubqueryAlias", "UnresolvedRelation", "UnresolvedWith", "WithCTE", "CTERelationRef",
    "CTERelationDef", "Window", "WithWindowDefinition", "UnresolvedHaving", "OneRowRelation",
    "Generate", "UnresolvedSubqueryColumnAliases", "Pivot", "Unpivot", "Sample",
    "UnresolvedInlineTable", "LocalRelation", "RepartitionByExpression", "Repartition",
    "Expand", "UnresolvedTVFAliases",
})
SUBQUERY_EXPRESSIONS = frozenset({"ScalarSubquery", "ListQuery", "Exists", "LateralSubquery",
                                  "FunctionTableSubqueryArgumentExpression"})
DENIED_FUNCTIONS = frozenset({"reflect", "java_method", "try_reflect"})


class SQLValidationError(ValueError):
    pass


class GuardedResult(NamedTuple):
    rows: list[Row]
    truncated: bool


def _seq(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _name(obj) -> str:
    return obj.getClass().getSimpleName()


class _Walker:
    """Checks a parsed plan; ``scope`` is the set of CTE names visible at a node."""

    def __init__(self, allowed: set[str]):
        self.allowed = allowed
        self.tables = 0

    def plan(self, node, scope: frozenset[str]) -> None:
        kind = _name(node)
        if kind not in QUERY_NODES:
            raise SQLValidationError(f"{kind} is not part of a read-only query")
        if kind == "UnresolvedRelation":
            self.relation([str(p) for p in _seq(node.multipartIdentifier())], scope)
        if kind == "UnresolvedWith":
            for pair in _seq(node.cteRelations()):
                own = frozenset({str(pair._1()).lower()})
                self.plan(pair._2(), scope | own if node.allowRecursion() else scope)
                scope = scope | own
        for expression in _seq(node.expressions()):
            self.expression(expression, scope)
        for child in _seq(node.children()):
            self.plan(child, scope)

    def relation(self, parts: list[str], scope: frozenset[str]) -> None:
        name = parts[0].lower()
        if len(parts) > 1:
            raise SQLValidationError(f"write {parts[-1]} without a qualifier")
        if name in scope:
            return
        if name not in self.allowed:
            raise SQLValidationError(f"{name} is not one of the tables open to queries")
        self.tables += 1

    def expression(self, node, scope: frozenset[str]) -> None:
        kind = _name(node)
        if kind == "UnresolvedFunction":
            function = str(_seq(node.nameParts())[-1]).lower()
            if function in DENIED_FUNCTIONS:
                raise SQLValidationError(f"{function}() may not be called")
        if kind in SUBQUERY_EXPRESSIONS:
            self.plan(node.plan(), scope)
        for child in _seq(node.children()):
            self.expression(child, scope)


def validate(spark: SparkSession, sql: str, tables=APPROVED_TABLES) -> None:
    """Raise :class:`SQLValidationError` unless ``sql`` is one read-only
    query that reads at least one of ``tables`` and no other table."""
    if not sql or not sql.strip():
        raise SQLValidationError("there is no statement")
    try:
        # no public call gives the plan before it is resolved
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    except Exception as exc:  # noqa: BLE001 - parser errors are py4j errors
        raise SQLValidationError(f"this does not parse as one statement: {str(exc)[:200]}") from None
    walker = _Walker({t.lower() for t in tables})
    walker.plan(plan, frozenset())
    if not walker.tables:
        raise SQLValidationError("the query reads none of the open tables")


def _isolated(spark: SparkSession, tables: dict[str, DataFrame]) -> SparkSession:
    """A session with ``tables`` as its only views."""
    session = spark.newSession()
    session.conf.set("spark.sql.runSQLOnFiles", "false")
    of_rows = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows
    for name, df in tables.items():
        of_rows(session._jsparkSession, df._jdf.queryExecution().analyzed()).createOrReplaceTempView(name)
    return session


def _accepted(spark: SparkSession, sql: str, tables: dict[str, DataFrame]) -> DataFrame:
    exposed = {k: v for k, v in tables.items() if k in APPROVED_TABLES}
    validate(spark, sql, exposed.keys())
    return _isolated(spark, exposed).sql(sql)


def guarded_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame],
                max_rows: int = 500) -> DataFrame:
    """Validate ``sql`` and return it as a DataFrame over ``tables`` (names of
    the allow-list only), its outermost result limited to ``max_rows``. It is
    lazy: time and truncation are watched by :func:`run_guarded`."""
    if max_rows <= 0:
        raise ValueError("max_rows must be positive")
    return _accepted(spark, sql, tables).limit(max_rows)


def run_guarded(spark: SparkSession, sql: str, tables: dict[str, DataFrame],
                max_rows: int = 500, timeout_s: float = 30.0) -> GuardedResult:
    """At most ``max_rows`` rows of a guarded query and whether there are more
    (one row over the cap is fetched to know). After ``timeout_s`` seconds its
    jobs are cancelled and TimeoutError is raised."""
    df = guarded_sql(spark, sql, tables, max_rows + 1)
    sc, group = spark.sparkContext, f"guarded-{uuid.uuid4().hex}"
    over, done = threading.Event(), threading.Event()

    def watch() -> None:
        if not done.wait(timeout_s):
            over.set()
            while not done.wait(0.2):  # a query runs several jobs one after another
                sc.cancelJobGroup(group)

    before = {k: sc.getLocalProperty(k) for k in (
        "spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")}
    sc.setJobGroup(group, "guarded SQL", interruptOnCancel=True)
    watcher = threading.Thread(target=watch, daemon=True)
    started = time.monotonic()
    watcher.start()
    try:
        rows = df.collect()
    except Exception as exc:  # noqa: BLE001
        if over.is_set():
            raise TimeoutError(f"cancelled after {time.monotonic() - started:.1f} s "
                               f"(limit {timeout_s} s)") from exc
        raise
    finally:
        done.set()
        watcher.join()
        for key, value in before.items():
            sc.setLocalProperty(key, value)
    return GuardedResult(rows[:max_rows], len(rows) > max_rows)
