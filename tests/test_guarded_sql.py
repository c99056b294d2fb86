"""The guard: what passes, what does not, isolation, cap and time limit."""

from __future__ import annotations

import time

import pytest

from shopstar.plans.guarded_sql import (APPROVED_TABLES, SQLValidationError, guarded_sql,
                                        run_guarded, validate)


@pytest.mark.parametrize("sql", [
    "SELECT COUNT(order_id) AS n FROM fact_sales",
    "SELECT d.year, SUM(f.quantity) AS q FROM fact_sales AS f INNER JOIN dim_date AS d "
    "ON d.date_key = f.order_date_key GROUP BY d.year ORDER BY q DESC",
    "WITH big AS (SELECT * FROM fact_sales WHERE quantity > 3), few AS (SELECT * FROM big) "
    "SELECT COUNT(*) FROM few",
    "SELECT * FROM (WITH a AS (SELECT 1 AS x FROM dim_date) SELECT x FROM a) AS s",
    "SELECT channel_name, RANK() OVER (ORDER BY channel_name) AS r FROM dim_channel",
    "SELECT customer_key FROM dim_customer EXCEPT SELECT customer_key FROM fact_returns",
    "SELECT REPLACE(channel_name, 'delete', 'update') AS t FROM dim_channel",
    "SELECT (SELECT MAX(quantity) FROM fact_sales) AS m FROM dim_category",
    "SELECT * FROM FACT_SALES LIMIT 7",
    "WITH fact_sales AS (SELECT * FROM fact_returns) SELECT * FROM fact_sales",
])
def test_accepted(spark, sql):
    validate(spark, sql)


@pytest.mark.parametrize("sql", [
    "", "  \n ", "SELECT order_id FROM fact_sales; SELECT 2", "SELECT FROM WHERE", "SELECT 5 AS five",
    "DELETE FROM dim_channel WHERE channel_key = 1", "INSERT INTO dim_channel VALUES (9, 9, 'a', 'b')",
    "UPDATE dim_channel SET channel_name = 'z'", "DROP VIEW fact_sales", "CREATE VIEW v AS SELECT 1",
    "CREATE TABLE t2 AS SELECT * FROM fact_sales", "SET spark.sql.ansi.enabled = false", "SHOW TABLES",
    "DESCRIBE fact_sales", "EXPLAIN SELECT * FROM fact_sales", "CACHE TABLE fact_sales", "USE default",
    "SELECT TRANSFORM (order_id) USING 'cat' AS (x) FROM fact_sales",
    "SELECT reflect('java.lang.System', 'nanoTime') FROM dim_channel",
    "SELECT java_method('java.util.UUID', 'randomUUID') FROM dim_channel",
    "SELECT * FROM range(10)", "SELECT * FROM fact_sales, range(3)",
    "SELECT * FROM parquet.`/tmp/any`", "SELECT * FROM default.fact_sales", "SELECT * FROM stg_orders",
    "SELECT * FROM fact_sales a, stg_orders b", "SELECT * FROM `stg_orders`",
    "SELECT * FROM fact_sales WHERE order_id IN (SELECT order_id FROM stg_orders)",
    "SELECT (SELECT MAX(total_amount) FROM stg_orders) FROM fact_sales",
    "WITH x AS (SELECT * FROM stg_orders) SELECT * FROM x",
    # a CTE name counts only where it is in scope
    "WITH secret AS (SELECT * FROM secret) SELECT * FROM secret",
    "SELECT * FROM secret WHERE EXISTS (WITH secret AS (SELECT * FROM fact_sales) SELECT 1 FROM secret)",
    "WITH a AS (SELECT * FROM b), b AS (SELECT * FROM fact_sales) SELECT * FROM a",
    "SELECT * FROM (WITH h AS (SELECT * FROM fact_sales) SELECT * FROM h) s JOIN h ON true",
])
def test_refused(spark, sql):
    with pytest.raises(SQLValidationError):
        validate(spark, sql)


def test_only_the_star_is_open(spark):
    assert {"fact_sales", "fact_returns", "dim_date"} <= APPROVED_TABLES and len(APPROVED_TABLES) == 9


def test_the_session_is_isolated(spark):
    spark.range(3).createOrReplaceTempView("fact_sales")  # the caller's own view
    spark.range(4).createOrReplaceTempView("secret")
    tables = {"fact_sales": spark.range(10).withColumnRenamed("id", "order_id"), "other": spark.range(2)}
    got = guarded_sql(spark, "SELECT order_id FROM fact_sales WHERE order_id > 6", tables)
    assert sorted(r.order_id for r in got.collect()) == [7, 8, 9]
    assert spark.table("fact_sales").columns == ["id"] and spark.table("fact_sales").count() == 3
    with pytest.raises(SQLValidationError):
        guarded_sql(spark, "SELECT * FROM other", tables)
    with pytest.raises(SQLValidationError):
        guarded_sql(spark, "SELECT * FROM dim_date", tables)  # approved, but not given
    spark.catalog.dropTempView("fact_sales")
    spark.catalog.dropTempView("secret")


def test_row_cap_is_reported(spark):
    tables = {"fact_sales": spark.range(50)}
    cut = run_guarded(spark, "SELECT id FROM fact_sales ORDER BY id DESC LIMIT 40", tables, max_rows=20)
    assert [r.id for r in cut.rows] == list(range(49, 29, -1)) and cut.truncated
    whole = run_guarded(spark, "SELECT id FROM fact_sales LIMIT 20", tables, max_rows=20)
    assert len(whole.rows) == 20 and not whole.truncated
    with pytest.raises(ValueError):
        guarded_sql(spark, "SELECT id FROM fact_sales", tables, max_rows=0)


def test_time_limit_cancels_the_jobs(spark):
    tables = {"fact_sales": spark.range(0, 300_000, 1, 8)}
    sql = "SELECT SUM(hash(a.id, b.id) % 7) AS s FROM fact_sales a JOIN fact_sales b ON a.id <> b.id"
    started = time.monotonic()
    with pytest.raises(TimeoutError):
        run_guarded(spark, sql, tables, timeout_s=1.0)
    assert time.monotonic() - started < 6
    assert run_guarded(spark, "SELECT COUNT(*) AS n FROM fact_sales", tables).rows[0].n == 300_000
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
