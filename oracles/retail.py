"""DuckDB oracle: the same retail tables, staging and star built in plain
SQL over the TPC-H-ish views (region nation customer part orders lineitem),
then each business question as a final SELECT.

``with_star(sql)`` prefixes a query with every CTE; DuckDB only evaluates
the ones the query reaches. Surrogate keys follow the same rule as the Spark
build (dense from 1 in business-key order), money is rounded half-up on
integer cents, and every ranking has a unique last sort key.
"""

from __future__ import annotations

import re

PAYMENT_METHODS_SQL = ("['credit_card', 'debit_card', 'paypal', 'apple_pay', 'gift_card', "
                       "'bank_transfer']")
RETURN_REASONS_SQL = ("['Defective item', 'Wrong size', 'Not as described', 'Changed mind', "
                      "'Arrived late', 'Better price found', 'Damaged in transit']")


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


CTES: list[tuple[str, str]] = [
    # ------------------------------------------------------------ sources
    ("src_sales_channels", """
        SELECT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id,
               substr(o_orderpriority, 3) AS channel_name,
               CASE WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) <= 2 THEN 'web'
                    WHEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) = 3 THEN 'mobile'
                    ELSE 'marketplace' END AS channel_type
        FROM (SELECT DISTINCT o_orderpriority FROM orders)"""),
    ("src_promotions", """
        SELECT CAST(n_nationkey + 1 AS BIGINT) AS promotion_id,
               'PROMO' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 3, '0') AS promotion_code,
               n_name AS description,
               CASE WHEN n_nationkey % 10 < 7 THEN 'percentage' ELSE 'fixed_amount' END
                   AS discount_type,
               CAST(5 * (n_nationkey % 6 + 1) AS DECIMAL(10,2)) AS discount_value,
               DATE '1995-01-01' + CAST(60 * n_nationkey AS INTEGER) AS start_date,
               DATE '1995-01-01' + CAST(60 * n_nationkey + 30 + 3 * n_nationkey AS INTEGER)
                   AS end_date
        FROM nation"""),
    ("src_customers", """
        SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
               split_part(c_name, '#', 2) AS last_name,
               '  ' || upper(replace(c_name, '#', '.')) || '@Example.com ' AS email,
               CAST(NULL AS VARCHAR) AS phone,
               DATE '1995-01-01' - CAST(c_custkey % 365 AS INTEGER) AS signup_date
        FROM customer"""),
    ("src_geo", """
        SELECT c_custkey, n_name, r_name FROM customer
        JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    ("src_customer_addresses", """
        SELECT 2 * c_custkey + 1 AS address_id, c_custkey AS customer_id,
               'billing' AS address_type, CAST(c_custkey AS VARCHAR) || ' Market Street' AS street,
               n_name AS city, 'STATE_' || CAST(c_custkey % 50 AS VARCHAR) AS state,
               r_name AS country, lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS postal_code
        FROM src_geo WHERE c_custkey % 20 <> 0
        UNION ALL
        SELECT 2 * c_custkey + 2, c_custkey, 'shipping',
               CAST(c_custkey AS VARCHAR) || ' Harbor Road', n_name,
               'STATE_' || CAST(c_custkey % 50 AS VARCHAR), r_name,
               lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')
        FROM src_geo"""),
    ("src_lines", """
        SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
                   l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                   l_linestatus, l_shipdate) AS order_item_id,
               l_orderkey AS order_id,
               'P' || lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS product_id,
               CAST(l_quantity AS INTEGER) AS quantity,
               CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS INTEGER)
                   AS unit_cents,
               CAST(l_discount AS DECIMAL(4,2)) AS disc_rate,
               l_returnflag, l_linenumber
        FROM lineitem"""),
    ("src_lines_priced", """
        SELECT *, CAST(round(gross * disc_rate, 2) AS DECIMAL(12,2)) AS discount
        FROM (SELECT *, CAST(CAST(unit_cents / 100.0 AS DECIMAL(10,2)) * quantity
                             AS DECIMAL(12,2)) AS gross FROM src_lines)"""),
    ("src_line_totals", """
        SELECT order_id, sum(CAST(gross - discount AS DECIMAL(12,2))) AS lines_total
        FROM src_lines_priced GROUP BY order_id"""),
    ("src_orders", """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS channel_id,
               CASE WHEN o_orderkey % 10 < 3 THEN
                   (SELECT min(p.promotion_id) FROM src_promotions p
                    WHERE CAST(o_orderdate AS DATE) BETWEEN p.start_date AND p.end_date)
               END AS promotion_id,
               CAST(o_orderdate AS TIMESTAMP) AS order_date,
               CASE WHEN o_orderkey % 25 = 0 THEN 'cancelled'
                    WHEN o_orderstatus = 'F' THEN 'delivered'
                    WHEN o_orderstatus = 'O' THEN 'processing'
                    WHEN o_orderstatus = 'P' THEN 'shipped' END AS status,
               coalesce(CAST(lines_total AS DECIMAL(12,2)), CAST(o_totalprice AS DECIMAL(12,2)))
                   AS total_amount
        FROM orders LEFT JOIN src_line_totals ON o_orderkey = order_id"""),
    ("src_order_items", """
        SELECT order_item_id, order_id, product_id, quantity,
               CAST(unit_cents / 100.0 AS DECIMAL(10,2)) AS unit_price,
               CAST(discount AS DECIMAL(10,2)) AS discount_amount,
               CAST(gross - discount AS DECIMAL(12,2)) AS line_total
        FROM src_lines_priced"""),
    ("src_payments", f"""
        SELECT order_id AS payment_id, order_id,
               {PAYMENT_METHODS_SQL}[CAST(order_id % 6 AS INTEGER) + 1] AS payment_method,
               total_amount AS amount, order_date AS payment_date,
               CASE WHEN status = 'cancelled' THEN 'refunded' ELSE 'completed' END AS status
        FROM src_orders WHERE order_id % 50 <> 7
        UNION ALL
        SELECT order_id + 1000000000, order_id,
               {PAYMENT_METHODS_SQL}[CAST((order_id + 1) % 6 AS INTEGER) + 1],
               total_amount, order_date,
               CASE WHEN status = 'cancelled' THEN 'refunded' ELSE 'completed' END
        FROM src_orders WHERE order_id % 40 = 3"""),
    ("src_returns", f"""
        SELECT l.order_item_id AS return_id, l.order_id, l.order_item_id,
               CAST(least(CAST(o.order_date AS DATE) + CAST(l.l_linenumber + 3 AS INTEGER),
                          (SELECT max(CAST(order_date AS DATE)) FROM src_orders))
                    AS TIMESTAMP) AS return_date,
               l.quantity // 2 + 1 AS quantity,
               CAST((2 * CAST(i.line_total * 100 AS BIGINT) * (l.quantity // 2 + 1) + l.quantity)
                    // (2 * l.quantity) / 100.0 AS DECIMAL(12,2)) AS refund_amount,
               {RETURN_REASONS_SQL}[CAST(l.order_item_id % 7 AS INTEGER) + 1] AS reason
        FROM src_lines l JOIN src_order_items i USING (order_item_id)
        JOIN src_orders o ON o.order_id = l.order_id
        WHERE l.l_returnflag = 'R' AND o.status = 'delivered'"""),
    ("src_products_flat", """
        SELECT 'P' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS product_id,
               p_name AS product_name, p_brand AS brand,
               CASE WHEN p_partkey % 100 = 0 THEN 'Unknown' ELSE p_type || ' ' || p_brand END
                   AS category_name,
               p_type AS parent_category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS price,
               CAST((CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * 100) AS BIGINT) // 2)
                    / 100.0 AS DECIMAL(10,2)) AS cost,
               array_to_string(string_split(p_name, ' '), ',') AS tags,
               '{"size": ' || CAST(p_size AS VARCHAR) || '}' AS attributes,
               CAST(p_size % 4 AS INTEGER) AS variant_count,
               CASE WHEN p_partkey % 10 = 0 THEN NULL
                    ELSE TIMESTAMP '2024-01-01 00:00:00' END AS created_at
        FROM part"""),
    # ------------------------------------------------------------ staging
    ("stg_sales_channels", """
        SELECT channel_id, channel_name, channel_type FROM (
          SELECT channel_id, {s1} AS channel_name, {s2} AS channel_type FROM src_sales_channels)
        QUALIFY row_number() OVER (PARTITION BY channel_id
                  ORDER BY channel_name NULLS FIRST, channel_type NULLS FIRST) = 1""".format(
        s1=_strip("channel_name"), s2=_strip("channel_type"))),
    ("stg_promotions", """
        SELECT * FROM (
          SELECT promotion_id, {a} AS promotion_code, {b} AS description,
                 {c} AS discount_type, discount_value, start_date, end_date
          FROM src_promotions)
        QUALIFY row_number() OVER (PARTITION BY promotion_id
                  ORDER BY promotion_code NULLS FIRST, description NULLS FIRST) = 1""".format(
        a=_strip("promotion_code"), b=_strip("description"), c=_strip("discount_type"))),
    ("stg_customer_addresses", """
        SELECT * FROM (SELECT address_id, customer_id, {a} AS address_type, {b} AS street, {c} AS city,
               {d} AS state, {e} AS country, {f} AS postal_code
        FROM src_customer_addresses)
        QUALIFY row_number() OVER (PARTITION BY address_id ORDER BY customer_id NULLS FIRST, address_type NULLS FIRST, street NULLS FIRST, city NULLS FIRST, state NULLS FIRST, country NULLS FIRST, postal_code NULLS FIRST) = 1""".format(
        a=_strip("address_type"), b=_strip("street"), c=_strip("city"), d=_strip("state"),
        e=_strip("country"), f=_strip("postal_code"))),
    ("stg_orders", """
        SELECT * FROM (SELECT order_id, customer_id, channel_id, promotion_id, order_date,
               {a} AS status, total_amount FROM src_orders)
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id NULLS FIRST, channel_id NULLS FIRST, promotion_id NULLS FIRST, order_date NULLS FIRST, status NULLS FIRST, total_amount NULLS FIRST) = 1""".format(a=_strip("status"))),
    ("stg_order_items", """
        SELECT * FROM (SELECT order_item_id, order_id, {a} AS product_id, quantity, unit_price,
               discount_amount, line_total FROM src_order_items)
        QUALIFY row_number() OVER (PARTITION BY order_item_id ORDER BY order_id NULLS FIRST, product_id NULLS FIRST, quantity NULLS FIRST, unit_price NULLS FIRST, discount_amount NULLS FIRST, line_total NULLS FIRST) = 1""".format(a=_strip("product_id"))),
    ("stg_payments", """
        SELECT * FROM (SELECT payment_id, order_id, {a} AS payment_method, amount, payment_date,
               {b} AS status FROM src_payments)
        QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY order_id NULLS FIRST, payment_method NULLS FIRST, amount NULLS FIRST, payment_date NULLS FIRST, status NULLS FIRST) = 1""".format(
        a=_strip("payment_method"), b=_strip("status"))),
    ("stg_returns", """
        SELECT * FROM (SELECT return_id, order_id, order_item_id, return_date, quantity, refund_amount,
               {a} AS reason FROM src_returns)
        QUALIFY row_number() OVER (PARTITION BY return_id ORDER BY order_id NULLS FIRST, order_item_id NULLS FIRST, return_date NULLS FIRST, quantity NULLS FIRST, refund_amount NULLS FIRST, reason NULLS FIRST) = 1""".format(a=_strip("reason"))),
    ("stg_customers", """
        SELECT c.customer_id, {a} AS first_name, {b} AS last_name, lower({c}) AS email,
               {d} AS phone, c.signup_date, {e} AS city, {f} AS state, {g} AS country
        FROM src_customers c LEFT JOIN (
            SELECT customer_id, arg_min(city, address_id) AS city,
                   arg_min(state, address_id) AS state, arg_min(country, address_id) AS country
            FROM src_customer_addresses WHERE address_type = 'billing' GROUP BY customer_id
        ) a USING (customer_id)""".format(
        a=_strip("c.first_name"), b=_strip("c.last_name"), c=_strip("c.email"),
        d=_strip("c.phone"), e=_strip("a.city"), f=_strip("a.state"), g=_strip("a.country"))),
    ("stg_products", """
        SELECT product_id, {a} AS product_name, brand, {b} AS category_name,
               {c} AS parent_category, price, cost, tags, attributes, variant_count, created_at
        FROM src_products_flat""".format(
        a=_strip("product_name"), b=_strip("category_name"), c=_strip("parent_category"))),
    # ---------------------------------------------------------------- star
    ("dim_customer", """
        SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, customer_id,
               first_name || ' ' || last_name AS full_name, email, city, state, country,
               signup_date
        FROM stg_customers"""),
    ("dim_category", """
        SELECT row_number() OVER (ORDER BY parent_category, category_name) AS category_key,
               category_name, parent_category
        FROM (SELECT DISTINCT category_name, parent_category FROM stg_products)"""),
    ("dim_product", """
        SELECT row_number() OVER (ORDER BY p.product_id) AS product_key, p.product_id,
               p.product_name, p.brand, c.category_key, p.category_name,
               p.price AS unit_price, p.cost AS unit_cost
        FROM stg_products p JOIN dim_category c
          ON p.category_name = c.category_name AND p.parent_category = c.parent_category"""),
    ("dim_channel", """
        SELECT row_number() OVER (ORDER BY channel_id) AS channel_key, channel_id,
               channel_name, channel_type FROM stg_sales_channels"""),
    ("dim_promotion", """
        SELECT CAST(1 AS BIGINT) AS promotion_key, CAST(NULL AS BIGINT) AS promotion_id,
               'NONE' AS promotion_code, 'No promotion applied' AS description,
               'none' AS discount_type, CAST(0 AS DECIMAL(10,2)) AS discount_value
        UNION ALL
        SELECT row_number() OVER (ORDER BY promotion_id) + 1, promotion_id, promotion_code,
               description, discount_type, discount_value FROM stg_promotions"""),
    ("dim_payment_method", """
        SELECT CAST(0 AS BIGINT) AS payment_method_key, 'UNKNOWN' AS payment_method
        UNION ALL
        SELECT row_number() OVER (ORDER BY payment_method), payment_method
        FROM (SELECT DISTINCT payment_method FROM stg_payments
              WHERE payment_method IS NOT NULL)"""),
    ("dim_date", """
        SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key,
               d AS full_date, CAST(year(d) AS INTEGER) AS year,
               CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
               monthname(d) AS month_name, CAST(day(d) AS INTEGER) AS day,
               CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
               CAST(weekofyear(d) AS INTEGER) AS week_of_year, isodow(d) >= 6 AS is_weekend
        FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                                 INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(d) AS lo, max(d) AS hi FROM (
                      SELECT CAST(order_date AS DATE) AS d FROM stg_orders
                      UNION ALL SELECT CAST(return_date AS DATE) FROM stg_returns))
              WHERE lo IS NOT NULL)"""),
    ("fact_sales", """
        SELECT row_number() OVER (ORDER BY i.order_item_id) AS sales_key,
               i.order_id, i.order_item_id,
               CAST(year(o.order_date) * 10000 + month(o.order_date) * 100 + day(o.order_date)
                    AS INTEGER) AS order_date_key,
               c.customer_key, p.product_key, p.category_key, ch.channel_key,
               coalesce(pr.promotion_key, 1) AS promotion_key,
               coalesce(pm.payment_method_key, 0) AS payment_method_key,
               i.quantity, i.unit_price,
               CAST(round(i.quantity * i.unit_price, 2) AS DECIMAL(12,2)) AS gross_revenue,
               CAST(i.discount_amount AS DECIMAL(12,2)) AS discount_amount,
               i.line_total AS net_revenue
        FROM stg_order_items i
        JOIN stg_orders o ON o.order_id = i.order_id
        LEFT JOIN (SELECT order_id, arg_min(payment_method, payment_id) AS payment_method
                   FROM stg_payments GROUP BY order_id) pay ON pay.order_id = i.order_id
        JOIN dim_customer c ON c.customer_id = o.customer_id
        JOIN dim_product p ON p.product_id = i.product_id
        JOIN dim_channel ch ON ch.channel_id = o.channel_id
        LEFT JOIN (SELECT * FROM dim_payment_method WHERE payment_method_key <> 0) pm
          ON pm.payment_method = pay.payment_method
        LEFT JOIN (SELECT promotion_key, promotion_id FROM dim_promotion
                   WHERE promotion_id IS NOT NULL) pr ON pr.promotion_id = o.promotion_id"""),
    ("fact_returns", """
        SELECT row_number() OVER (ORDER BY r.return_id) AS return_key, r.return_id,
               r.order_id, r.order_item_id,
               CAST(year(r.return_date) * 10000 + month(r.return_date) * 100
                    + day(r.return_date) AS INTEGER) AS return_date_key,
               s.customer_key, s.product_key, s.channel_key,
               r.quantity AS quantity_returned, r.refund_amount, r.reason
        FROM stg_returns r JOIN fact_sales s ON s.order_item_id = r.order_item_id"""),
]


def _planted(name: str, plant) -> str:
    """Definition of ``name`` with its planted errors, over ``<name>_clean``."""
    changes = ", ".join(f"{plant.expression(c)} AS {c}" for c in plant.changes)
    rows = [f"SELECT * {f'REPLACE ({changes})' if changes else ''} FROM {name}_clean"]
    rows += [f"SELECT * FROM {name}_clean WHERE {c}" for c in plant.copies]
    return f"{name} AS ({' UNION ALL '.join(rows)})"


def with_star(final_sql: str, plants: dict | None = None, prefix: str = "",
              derived: bool = True) -> str:
    """``WITH <all CTEs> <final_sql>``; tables of ``plants`` (their names after
    ``prefix``) hold planted errors. ``derived``: tables built from them see
    the errors too; else only ``final_sql`` does."""
    plants = {prefix + name: plant for name, plant in (plants or {}).items()}
    body, last = [], []
    for name, sql in CTES:
        if not derived:
            for other in plants:
                sql = re.sub(rf"\b{other}\b", f"{other}_clean", sql)
        body.append(f"{name}_clean AS ({sql})" if name in plants else f"{name} AS ({sql})")
        if name in plants:
            (body if derived else last).append(_planted(name, plants[name]))
    return "WITH " + ",\n".join(body + last) + f"\n{final_sql}"
