"""DuckDB SQL for every registered query (same names, same column names)."""

from __future__ import annotations

from oracles.retail import with_star
from shopstar.sources import planted as P
from shopstar.sources import schemas as S

# A slice is the text of two CTEs: ``sold`` (sales) and ``sent_back`` (returns).
_WANTED = """, cats AS (FROM dim_category SELECT category_key WHERE parent_category IN ('ECONOMY', 'STANDARD')),
chans AS (FROM dim_channel SELECT channel_key WHERE channel_name IN ('URGENT', 'HIGH', 'LOW'))"""
WHOLE = ", sold AS (FROM fact_sales), sent_back AS (FROM fact_returns)"
SLICE = _WANTED + """,
sold AS (FROM fact_sales SEMI JOIN cats USING (category_key) SEMI JOIN chans USING (channel_key)
         WHERE order_date_key BETWEEN 19960101 AND 19991231),
wares AS (FROM dim_product SEMI JOIN cats USING (category_key) SELECT product_key),
sent_back AS (FROM fact_returns SEMI JOIN wares USING (product_key) SEMI JOIN chans USING (channel_key)
              WHERE return_date_key BETWEEN 19960101 AND 19991231)"""
NOTHING = """, sold AS (FROM fact_sales WHERE order_date_key >= 20300101),
sent_back AS (FROM fact_returns WHERE return_date_key >= 20300101)"""


def _edge(table: str, schema, plants: dict | None = None, prefix: str = "") -> str:
    """Project a table like ``catalog.edge``: dates/timestamps as text,
    decimals as doubles, other columns cast to the Spark type."""
    from pyspark.sql import types as T
    cols = []
    for f in schema.fields:
        n, t = f.name, f.dataType
        if isinstance(t, T.DateType):
            cols.append(f"strftime({n}, '%Y-%m-%d') AS {n}")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            cols.append(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}")
        elif isinstance(t, T.DecimalType):
            cols.append(f"CAST({n} AS DOUBLE) AS {n}")
        elif isinstance(t, T.LongType):
            cols.append(f"CAST({n} AS BIGINT) AS {n}")
        elif isinstance(t, T.IntegerType):
            cols.append(f"CAST({n} AS INTEGER) AS {n}")
        elif isinstance(t, T.BooleanType):
            cols.append(f"CAST({n} AS BOOLEAN) AS {n}")
        else:
            cols.append(f"CAST({n} AS VARCHAR) AS {n}")
    return with_star(f"SELECT {', '.join(cols)} FROM {table}", plants, prefix)


def ratio(num: str, den: str, scale: int = 1, places: int = 2) -> str:
    """``round(scale * num / den, places)``, halves away from zero, on integers, as double."""
    f = 2 * scale * 10 ** places
    n, d = f"CAST({num} AS HUGEINT)", f"CAST({den} AS HUGEINT)"
    return (f"(sign({n}) * sign({d}) * CAST((abs({n}) * {f} + abs({d})) // "
            f"NULLIF(abs({d}) * 2, 0) AS DOUBLE) / {float(10 ** places)})")


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def _sums(*names: str) -> str:
    """Sums of the fact's measures under their own names."""
    return ", ".join(f"sum({n}) AS {n}" for n in names)


def kpi(part: str) -> str:
    return with_star(f"""{part},
        a AS (FROM sold SELECT count(DISTINCT order_id) AS orders, count(DISTINCT customer_key) AS customers,
              {_sums('gross_revenue', 'discount_amount', 'net_revenue', 'quantity')}),
        b AS (FROM sent_back SELECT sum(refund_amount) AS refunds)
        SELECT orders, customers, {_d('gross_revenue')} AS gross_revenue, {_d('discount_amount')} AS total_discounts,
               {_d('net_revenue')} AS net_revenue, CAST(quantity AS BIGINT) AS units_sold,
               {_d('ifnull(refunds, 0)')} AS refunds
        FROM a POSITIONAL JOIN b""")


def by_category(part: str) -> str:
    return with_star(f"""{part},
        k AS (FROM sold SELECT category_key, {_sums('gross_revenue', 'discount_amount', 'net_revenue', 'quantity')}
              GROUP BY ALL)
        FROM dim_category JOIN k USING (category_key)
        SELECT parent_category, category_name, {_d('sum(gross_revenue)')} AS gross_revenue,
               {_d('sum(discount_amount)')} AS discounts, {_d('sum(net_revenue)')} AS net_revenue,
               CAST(sum(quantity) AS BIGINT) AS quantity_sold
        GROUP BY ALL""")


def by_product(part: str, limit: int) -> str:
    return with_star(f"""{part},
        k AS (FROM sold SELECT product_key, {_sums('net_revenue', 'gross_revenue', 'quantity')} GROUP BY ALL),
        named AS (FROM k JOIN dim_product USING (product_key)
                  SELECT product_name, brand, category_name, {_sums('net_revenue', 'gross_revenue', 'quantity')}
                  GROUP BY ALL)
        SELECT product_name, brand, category_name, {_d('net_revenue')} AS net_revenue,
               {_d('gross_revenue')} AS gross_revenue, CAST(quantity AS BIGINT) AS quantity_sold
        FROM named QUALIFY row_number() OVER (ORDER BY named.net_revenue DESC, product_name NULLS FIRST,
               brand NULLS FIRST, category_name NULLS FIRST) <= {limit}""")


# A date key is yyyymmdd: its text gives the day and the month without the calendar.
_DAY = "strftime(strptime(CAST(order_date_key AS VARCHAR), '%Y%m%d'), '%Y-%m-%d')"
_MONTH = "strftime(strptime(CAST(order_date_key // 100 AS VARCHAR), '%Y%m'), '%Y-%m-01')"


def trend(part: str, day: bool) -> str:
    return with_star(f"""{part}
        FROM (FROM sold SELECT *, {_DAY if day else _MONTH} AS period)
        SELECT period, {_d('sum(net_revenue)')} AS net_revenue, {_d('sum(gross_revenue)')} AS gross_revenue,
               CAST(sum(quantity) AS BIGINT) AS quantity_sold, count(DISTINCT order_id) AS orders
        GROUP BY ALL""")


def category_trend(part: str) -> str:
    return with_star(f"""{part},
        k AS (FROM sold SELECT category_key, {_MONTH} AS period, {_sums('net_revenue')} GROUP BY ALL)
        FROM k NATURAL JOIN (FROM dim_category SELECT category_key, parent_category)
        SELECT period, parent_category, {_d('sum(net_revenue)')} AS net_revenue GROUP BY ALL""")


_BUYERS = """buyers AS (FROM sold SELECT customer_key, count(DISTINCT order_id) AS orders,
                        sum(net_revenue) AS spent GROUP BY ALL)"""


def segments(part: str) -> str:
    return with_star(f"""{part}, {_BUYERS},
        placed AS (FROM buyers SELECT spent, CASE WHEN spent >= 5000 THEN 'VIP (5k+)' WHEN spent >= 1000 THEN 'High (1k-5k)'
                   WHEN spent >= 250 THEN 'Mid (250-1k)' ELSE 'Low (<250)' END AS spending_tier)
        FROM placed SELECT spending_tier, count(*) AS customers, {_d('sum(spent)')} AS net_revenue GROUP BY ALL""")


def repeat(part: str) -> str:
    return with_star(f"""{part}, {_BUYERS}
        FROM buyers SELECT if(orders = 1, 'One-time buyers', 'Repeat buyers') AS buyer_type,
             count(*) AS customers, {_d('sum(spent)')} AS net_revenue, {ratio('sum(orders)', 'count(*)')} AS avg_orders
        GROUP BY buyer_type""")


def top_customers(part: str, limit: int) -> str:
    return with_star(f"""{part}, {_BUYERS},
        named AS (FROM buyers JOIN dim_customer USING (customer_key)
                  SELECT full_name, country, CAST(sum(orders) AS BIGINT) AS orders, sum(spent) AS spent GROUP BY ALL)
        FROM named SELECT full_name, country, orders, {_d('spent')} AS lifetime_value
        QUALIFY row_number() OVER (ORDER BY spent DESC, full_name NULLS FIRST, country NULLS FIRST) <= {limit}""")


def _curve(part: str, key: str) -> str:
    """CTE ``curve``: rank and exact running cents, then shares of the last row's."""
    return f"""{part},
        cents AS (FROM sold SELECT {key} AS k, CAST(100 * sum(net_revenue) AS HUGEINT) AS c GROUP BY ALL),
        steps AS (FROM cents SELECT row_number() OVER w AS rank, sum(c) OVER w AS so_far
                  WINDOW w AS (ORDER BY c DESC, k ROWS UNBOUNDED PRECEDING)),
        ends AS (FROM cents SELECT count(*) AS entities, sum(c) AS everything),
        curve AS (FROM steps, ends SELECT rank, {ratio('rank', 'entities', 100)} AS entity_pct,
                  {ratio('so_far', 'everything', 100)} AS cumulative_revenue_pct)"""


def concentration(part: str, key: str) -> str:
    return with_star(f"{_curve(part, key)} FROM curve")


def pareto(entity: str, key: str) -> str:
    return with_star(f"""{_curve(WHOLE, key)}
        FROM curve SELECT '{entity}' AS entity, 80.0::DOUBLE AS revenue_share, min(entity_pct) AS entity_pct,
             min(rank) AS entities
        WHERE cumulative_revenue_pct >= 80""")


def clv(part: str) -> str:
    return with_star(f"{part}, {_BUYERS} FROM buyers SELECT customer_key, {_d('spent')} AS lifetime_value")


def channels(part: str) -> str:
    return with_star(f"""{part},
        k AS (FROM sold SELECT channel_key, count(DISTINCT order_id) AS orders, {_sums('net_revenue', 'quantity')}
              GROUP BY ALL)
        FROM k JOIN dim_channel USING (channel_key)
        SELECT channel_name, channel_type, {_d('sum(net_revenue)')} AS net_revenue,
               CAST(sum(quantity) AS BIGINT) AS quantity_sold, CAST(sum(orders) AS BIGINT) AS orders
        GROUP BY ALL""")


def matrix(part: str, limit: int) -> str:
    return with_star(f"""{part},
        k AS (FROM sold SELECT channel_key, product_key, {_sums('net_revenue', 'quantity')} GROUP BY ALL),
        cells AS (FROM k JOIN dim_channel USING (channel_key) JOIN dim_product USING (product_key)
                  SELECT channel_name, product_name, {_sums('net_revenue', 'quantity')} GROUP BY ALL)
        FROM (FROM cells SELECT *, row_number() OVER (PARTITION BY channel_name
                ORDER BY net_revenue DESC, product_name NULLS FIRST) AS rank)
        SELECT channel_name, product_name, {_d('net_revenue')} AS net_revenue,
               CAST(quantity AS BIGINT) AS quantity_sold, rank
        WHERE rank <= {limit}""")


def _offers(part: str) -> str:
    """CTE ``offers``: totals per promotion, the no-promotion member included."""
    return f"""{part},
        k AS (FROM sold SELECT promotion_key, count(DISTINCT order_id) AS orders, count(*) AS lines,
              {_sums('quantity', 'gross_revenue', 'discount_amount', 'net_revenue')} GROUP BY ALL),
        offers AS (FROM dim_promotion JOIN k USING (promotion_key)
                   SELECT promotion_code, discount_type, discount_value, {_sums('orders', 'lines', 'quantity',
                   'gross_revenue', 'discount_amount', 'net_revenue')} GROUP BY ALL)"""


def promotions(part: str) -> str:
    return with_star(f"""{_offers(part)}
        FROM offers SELECT promotion_code, discount_type, {_d('discount_value')} AS discount_value,
             CAST(orders AS BIGINT) AS orders, CAST(quantity AS BIGINT) AS quantity_sold,
             {_d('gross_revenue')} AS gross_revenue, {_d('discount_amount')} AS discounts,
             {_d('net_revenue')} AS net_revenue, {ratio('quantity', 'lines')} AS avg_items_per_line""")


def promo_vs_baseline() -> str:
    return with_star(f"""{_offers(WHOLE)},
        h AS (FROM offers SELECT *, promotion_code = 'NONE' AS plain,
              (CAST(quantity AS HUGEINT) * 200 + lines) // (2 * lines) AS hundredths),
        m AS (FROM h SELECT CAST(sum(orders) FILTER (WHERE NOT plain) AS BIGINT) AS promo_orders,
              {_d('sum(discount_amount) FILTER (WHERE NOT plain)')} AS promo_discounts,
              {ratio('sum(hundredths) FILTER (WHERE NOT plain)', 'count(*) FILTER (WHERE NOT plain) * 100')} AS avg_items_promo,
              {ratio('sum(hundredths) FILTER (WHERE plain)', 'count(*) FILTER (WHERE plain) * 100')} AS avg_items_baseline)
        FROM m SELECT *, round(avg_items_promo * 100 - avg_items_baseline * 100) / 100.0 AS avg_items_delta""")


def clv_histogram(bins: int = 50) -> str:
    return with_star(f"""{WHOLE}, {_BUYERS},
        v AS (FROM buyers SELECT CAST(spent * 100 AS BIGINT) AS c),
        e AS (FROM v SELECT min(c) AS lo, max(c) AS hi)
        FROM v, e SELECT CAST(if(hi = lo, 1, least({bins}, (c - lo) * {bins} // nullif(hi - lo, 0) + 1)) AS INTEGER)
               AS bucket, count(*) AS customers, min(c) / 100.0 AS min_value, max(c) / 100.0 AS max_value
        GROUP BY bucket""")


def gross_net_long() -> str:
    one = "FROM c SELECT category_name, '{0}' AS measure, CAST({0} AS DOUBLE) AS revenue"
    return with_star(f"""{WHOLE},
        c AS (FROM sold JOIN dim_category USING (category_key)
              SELECT parent_category, category_name, {_sums('gross_revenue', 'net_revenue')} GROUP BY ALL)
        {one.format('gross_revenue')} UNION ALL {one.format('net_revenue')}""")


def price_order_lines() -> str:
    return with_star("""
        SELECT order_item_id, order_id, promotion_code, gross_c / 100.0 AS gross_amount,
               disc_c / 100.0 AS promo_discount, (gross_c - disc_c) / 100.0 AS line_total
        FROM (SELECT *, CASE
                WHEN discount_type = 'percentage'
                  THEN (gross_c * CAST(discount_value * 100 AS BIGINT) * 2 + 10000) // 20000
                WHEN discount_type = 'fixed_amount'
                  THEN greatest(0, least(gross_c, CAST(discount_value * 100 AS BIGINT)
                                                  - coalesce(before_c, 0)))
                ELSE 0 END AS disc_c
              FROM (SELECT *, SUM(gross_c) OVER (PARTITION BY order_id ORDER BY order_item_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before_c
                    FROM (SELECT i.order_item_id, i.order_id,
                                 coalesce(p.promotion_code, 'NONE') AS promotion_code,
                                 p.discount_type, p.discount_value,
                                 CAST(i.quantity * i.unit_price * 100 AS BIGINT) AS gross_c
                          FROM stg_order_items i JOIN stg_orders o USING (order_id)
                          LEFT JOIN stg_promotions p ON p.promotion_id = o.promotion_id)))""")


def _check(layer: str, dim: str, name: str, observed: str, threshold: int = 0) -> str:
    return (f"SELECT '{layer}' AS layer, '{dim}' AS dimension, '{name}' AS check_name, "
            f"CAST(({observed}) AS BIGINT) AS observed, "
            f"CAST(({observed}) AS BIGINT) <= {threshold} AS passed")


def _orphans(child: str, fk: str, parent: str, pk: str, nullable: bool = False) -> str:
    extra = f" AND c.{fk} IS NOT NULL" if nullable else ""
    return (f"SELECT COUNT(*) FROM {child} c LEFT JOIN (SELECT DISTINCT {pk} AS k FROM {parent})"
            f" p ON c.{fk} = p.k WHERE p.k IS NULL{extra}")


def _dup(table: str, key: str) -> str:
    return f"SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM {table}"


def _count(table: str, cond: str) -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {cond}"


def _union(checks: list[str], plants: dict | None = None, derived: bool = False) -> str:
    return with_star("\nUNION ALL\n".join(checks), plants, derived=derived)


def dq_staging(plants: dict | None = None) -> str:
    L = "staging"
    return _union([
        _check(L, "completeness", "every customer has an e-mail",
               _count("stg_customers", "email IS NULL OR email = ''")),
        _check(L, "completeness", "every order has a date", _count("stg_orders", "order_date IS NULL")),
        _check(L, "uniqueness", "no order id twice", _dup("stg_orders", "order_id")),
        _check(L, "consistency", "lines belong to a staged order",
               _orphans("stg_order_items", "order_id", "stg_orders", "order_id")),
        _check(L, "consistency", "lines name a staged product",
               _orphans("stg_order_items", "product_id", "stg_products", "product_id")),
        _check(L, "accuracy", "order total is the sum of its lines",
               "SELECT count(*) FROM (FROM stg_order_items SELECT order_id, sum(line_total) AS lines "
               "GROUP BY ALL) NATURAL JOIN stg_orders WHERE lines NOT BETWEEN total_amount - 0.01 "
               "AND total_amount + 0.01"),
    ], plants)


def dq_analytics(plants: dict | None = None) -> str:
    L = "analytics"
    return _union([
        _check(L, "completeness", "sales rows carry their keys",
               _count("fact_sales", "customer_key IS NULL OR product_key IS NULL "
                                    "OR order_date_key IS NULL")),
        _check(L, "uniqueness", "one sales row per order line", _dup("fact_sales", "order_item_id")),
        _check(L, "accuracy", "net is gross less discount",
               _count("fact_sales", "abs(gross_revenue - discount_amount - net_revenue) > 0.01")),
        _check(L, "consistency", "sold products are in the product dimension",
               _orphans("fact_sales", "product_key", "dim_product", "product_key")),
        _check(L, "timeliness", "newest sale is recent enough",
               "SELECT ifnull(DATE '2002-01-01' - max(full_date), 99999) FROM dim_date "
               "WHERE date_key IN (SELECT order_date_key FROM fact_sales)", 400),
    ], plants)


ACCEPTED_SQL = {
    ("stg_promotions", "discount_type"): "'percentage', 'fixed_amount'",
    ("stg_customer_addresses", "address_type"): "'billing', 'shipping'",
    ("stg_orders", "status"): "'processing', 'shipped', 'delivered', 'cancelled'",
    ("stg_payments", "payment_method"): ("'credit_card', 'debit_card', 'paypal', 'apple_pay', "
                                         "'gift_card', 'bank_transfer'"),
    ("stg_payments", "status"): "'completed', 'pending', 'failed', 'refunded'",
}


def _accepted(table: str, col: str) -> str:
    return _check("staging", "validity", f"{col} in accepted values",
                  _count(table, f"{col} IS NOT NULL AND {col} NOT IN "
                                f"({ACCEPTED_SQL[(table, col)]})"))


def dq_staging_suite(plants: dict | None = None) -> str:
    L = "staging"
    u = "uniqueness"
    v = "validity"
    c = "consistency"
    return _union([
        _check(L, u, "stg_sales_channels.channel_id unique", _dup("stg_sales_channels", "channel_id")),
        _check(L, u, "channel name unique", _dup("stg_sales_channels", "channel_name")),
        _check(L, u, "stg_promotions.promotion_id unique", _dup("stg_promotions", "promotion_id")),
        _check(L, u, "promotion code unique", _dup("stg_promotions", "promotion_code")),
        _check(L, v, "promotion end after start", _count("stg_promotions", "end_date < start_date")),
        _check(L, v, "promotion value positive", _count("stg_promotions", "discount_value <= 0")),
        _accepted("stg_promotions", "discount_type"),
        _check(L, u, "stg_customer_addresses.address_id unique",
               _dup("stg_customer_addresses", "address_id")),
        _accepted("stg_customer_addresses", "address_type"),
        _check(L, v, "order total not negative", _count("stg_orders", "total_amount < 0")),
        _accepted("stg_orders", "status"),
        _check(L, u, "stg_order_items.order_item_id unique", _dup("stg_order_items", "order_item_id")),
        _check(L, v, "item quantity positive", _count("stg_order_items", "quantity <= 0")),
        _check(L, v, "item price not negative", _count("stg_order_items", "unit_price < 0")),
        _check(L, u, "stg_payments.payment_id unique", _dup("stg_payments", "payment_id")),
        _check(L, v, "payment amount not negative", _count("stg_payments", "amount < 0")),
        _accepted("stg_payments", "payment_method"),
        _accepted("stg_payments", "status"),
        _check(L, u, "stg_returns.return_id unique", _dup("stg_returns", "return_id")),
        _check(L, v, "return quantity positive", _count("stg_returns", "quantity <= 0")),
        _check(L, u, "stg_customers.customer_id unique", _dup("stg_customers", "customer_id")),
        _check(L, u, "customer email unique", _dup("stg_customers", "email")),
        _check(L, "accuracy", "emails have valid format",
               _count("stg_customers", "email IS NULL OR NOT regexp_matches(email, "
                                       "'^[\\w.+-]+@[\\w-]+\\.[\\w.-]+$')")),
        _check(L, u, "stg_products.product_id unique", _dup("stg_products", "product_id")),
        _check(L, "completeness", "product categories present",
               _count("stg_products", "category_name IS NULL OR category_name = '' "
                                      "OR parent_category IS NULL OR parent_category = ''")),
        _check(L, "accuracy", "payments match order totals",
               "SELECT COUNT(*) FROM stg_orders o JOIN (SELECT order_id, SUM(amount) AS paid "
               "FROM stg_payments GROUP BY 1) p USING (order_id) "
               "WHERE abs(o.total_amount - p.paid) > 0.01"),
        _check(L, c, "orders reference customers",
               _orphans("stg_orders", "customer_id", "stg_customers", "customer_id")),
        _check(L, c, "orders reference channels",
               _orphans("stg_orders", "channel_id", "stg_sales_channels", "channel_id")),
        _check(L, c, "orders reference promotions",
               _orphans("stg_orders", "promotion_id", "stg_promotions", "promotion_id", True)),
        _check(L, c, "payments reference orders",
               _orphans("stg_payments", "order_id", "stg_orders", "order_id")),
        _check(L, c, "returns reference orders",
               _orphans("stg_returns", "order_id", "stg_orders", "order_id")),
        _check(L, c, "returns reference order items",
               _orphans("stg_returns", "order_item_id", "stg_order_items", "order_item_id")),
        _check(L, c, "addresses reference customers",
               _orphans("stg_customer_addresses", "customer_id", "stg_customers", "customer_id")),
    ], plants)


def dq_star_suite(plants: dict | None = None) -> str:
    L = "analytics"
    surrogate = {"dim_date": "date_key", "dim_customer": "customer_key",
                 "dim_category": "category_key", "dim_product": "product_key",
                 "dim_channel": "channel_key", "dim_promotion": "promotion_key",
                 "dim_payment_method": "payment_method_key"}
    checks = [_check(L, "uniqueness", f"{t}.{k} unique", _dup(t, k)) for t, k in surrogate.items()]
    fs = ["order_date_key", "customer_key", "product_key", "category_key", "channel_key",
          "promotion_key", "payment_method_key"]
    fr = ["return_date_key", "customer_key", "product_key", "channel_key"]
    checks += [
        _check(L, "completeness", "fact_sales foreign keys not null",
               _count("fact_sales", " OR ".join(f"{k} IS NULL" for k in fs))),
        _check(L, "validity", "sold quantities positive", _count("fact_sales", "quantity <= 0")),
        _check(L, "uniqueness", "fact_sales.sales_key unique", _dup("fact_sales", "sales_key")),
        _check(L, "completeness", "fact_returns foreign keys not null",
               _count("fact_returns", " OR ".join(f"{k} IS NULL" for k in fr))),
        _check(L, "validity", "returned quantities positive",
               _count("fact_returns", "quantity_returned <= 0")),
        _check(L, "uniqueness", "fact_returns.return_id unique", _dup("fact_returns", "return_id")),
        _check(L, "accuracy", "refunds within line net revenue",
               "SELECT COUNT(*) FROM fact_returns r JOIN fact_sales s USING (order_item_id) "
               "WHERE r.refund_amount > s.net_revenue + 0.01"),
    ]
    dims = {"order_date_key": ("dim_date", "date_key"),
            "customer_key": ("dim_customer", "customer_key"),
            "product_key": ("dim_product", "product_key"),
            "category_key": ("dim_category", "category_key"),
            "channel_key": ("dim_channel", "channel_key"),
            "promotion_key": ("dim_promotion", "promotion_key"),
            "payment_method_key": ("dim_payment_method", "payment_method_key")}
    checks += [_check(L, "consistency", f"fact_sales.{fk} resolves in {d}",
                      _orphans("fact_sales", fk, d, pk)) for fk, (d, pk) in dims.items()]
    rdims = {"return_date_key": ("dim_date", "date_key"),
             "customer_key": ("dim_customer", "customer_key"),
             "product_key": ("dim_product", "product_key"),
             "channel_key": ("dim_channel", "channel_key")}
    checks += [_check(L, "consistency", f"fact_returns.{fk} resolves in {d}",
                      _orphans("fact_returns", fk, d, pk)) for fk, (d, pk) in rdims.items()]
    checks += [
        _check(L, "consistency", "dim_product.category_key resolves in dim_category",
               _orphans("dim_product", "category_key", "dim_category", "category_key")),
        _check(L, "consistency", "category names trimmed",
               _count("dim_category", "category_name <> trim(category_name)")),
        _check(L, "consistency", "category names unique ignoring case",
               "SELECT COUNT(*) - COUNT(DISTINCT lower(category_name)) FROM dim_category"),
        _check(L, "consistency", "one customer id per email",
               "SELECT COUNT(*) FROM (SELECT email FROM dim_customer GROUP BY email "
               "HAVING COUNT(DISTINCT customer_id) > 1)"),
    ]
    return _union(checks, plants)


def dq_cross_layer(plants: dict | None = None) -> str:
    return _union([_check("cross", "consistency", "staged items equal fact rows",
                          "SELECT abs((SELECT COUNT(*) FROM stg_order_items) - "
                          "(SELECT COUNT(*) FROM fact_sales))")], plants)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    for name in ("sales_channels", "promotions", "customer_addresses", "orders", "order_items",
                 "payments", "returns"):
        q[f"b1_stg_{name}"] = _edge(f"stg_{name}", S.SOURCE[name])
    q["b2_stg_customers"] = _edge("stg_customers", S.STG_CUSTOMERS)
    q["b3_stg_products"] = _edge("stg_products", S.STG_PRODUCTS)
    for i, name in enumerate(("dim_customer", "dim_category", "dim_product", "dim_channel",
                              "dim_promotion", "dim_payment_method", "dim_date",
                              "fact_sales", "fact_returns"), start=4):
        q[f"b{i}_{name}"] = _edge(name, S.STAR[name])
    q["n1_date_bounds"] = with_star(
        "FROM dim_date SEMI JOIN fact_sales ON date_key = order_date_key "
        "SELECT CAST(min(full_date) AS VARCHAR) AS min_date, CAST(max(full_date) AS VARCHAR) AS max_date")
    q["n1_categories"] = with_star("SELECT DISTINCT parent_category FROM dim_category")
    q["n1_channels"] = with_star("SELECT channel_name FROM dim_channel")
    for suffix, part in (("", WHOLE), ("_filtered", SLICE)):
        q[f"n2_kpi_summary{suffix}"] = kpi(part)
        q[f"n3_revenue_by_category{suffix}"] = by_category(part)
        q[f"n4_revenue_by_product{suffix}"] = by_product(part, 20)
        q[f"n5_sales_trend_month{suffix}"] = trend(part, False)
        q[f"n6_category_trend{suffix}"] = category_trend(part)
        q[f"n7_customer_segments{suffix}"] = segments(part)
        q[f"n8_repeat_vs_one_time{suffix}"] = repeat(part)
        q[f"n9_top_customers{suffix}"] = top_customers(part, 20)
        q[f"n10_concentration_product{suffix}"] = concentration(part, "product_key")
        q[f"n11_clv_distribution{suffix}"] = clv(part)
        q[f"n12_channel_performance{suffix}"] = channels(part)
        q[f"n13_channel_product_matrix{suffix}"] = matrix(part, 5)
        q[f"n14_promotion_performance{suffix}"] = promotions(part)
    q["n2_kpi_summary_empty"] = kpi(NOTHING)
    q["n4_revenue_by_product_1000"] = by_product(WHOLE, 1000)
    q["n5_sales_trend_day"] = trend(WHOLE, True)
    q["n9_top_customers_5"] = top_customers(WHOLE, 5)
    q["n10_concentration_customer"] = concentration(WHOLE, "customer_key")
    q["n13_channel_product_matrix_50"] = matrix(WHOLE, 50)
    q["n16_promo_vs_baseline"] = promo_vs_baseline()
    q["n17_clv_histogram"] = clv_histogram()
    q["n18_gross_net_long"] = gross_net_long()
    q["n19_top_products_by_quantity"] = by_product(WHOLE, 15)
    q["n20_pareto_threshold_product"] = pareto("product", "product_key")
    q["n20_pareto_threshold_customer"] = pareto("customer", "customer_key")
    q["n21_price_order_lines"] = price_order_lines()
    q["n22_price_returns"] = with_star(
        ", w AS (FROM stg_orders SELECT max(CAST(order_date AS DATE)) AS last) "
        "FROM stg_returns r JOIN stg_order_items i USING (order_item_id) JOIN stg_orders o "
        "ON o.order_id = i.order_id, w SELECT return_id, order_item_id, "
        "CAST((200 * CAST(line_total * 100 AS HUGEINT) * r.quantity + 100 * i.quantity) // (200 * i.quantity) "
        "AS DOUBLE) / 100 AS refund_amount, strftime(least(CAST(order_date AS DATE) + 30, last), "
        "'%Y-%m-%d %H:%M:%S') AS return_date")
    q["j12_interval_join"] = with_star(
        "SELECT o.order_id, p.promotion_id FROM stg_orders o JOIN stg_promotions p "
        "ON CAST(o.order_date AS DATE) BETWEEN p.start_date AND p.end_date")
    q["j12_open_windows"] = with_star(
        ", w AS (FROM stg_promotions SELECT promotion_id, CASE WHEN promotion_id % 4 <> 1 THEN start_date END AS since, "
        "CASE promotion_id % 4 WHEN 2 THEN start_date + INTERVAL 1200 MONTH WHEN 0 THEN NULL ELSE end_date END AS until) "
        "SELECT w.promotion_id, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS total_amount, "
        "min(order_id) AS first_order, strftime(max(order_date), '%Y-%m-%d %H:%M:%S') AS last_at "
        "FROM stg_orders, w WHERE CAST(order_date AS DATE) >= coalesce(since, DATE '0001-01-01') "
        "AND CAST(order_date AS DATE) <= coalesce(until, DATE '9999-12-31') GROUP BY w.promotion_id")
    q["a2_sketched_counts"] = with_star(
        " FROM fact_sales JOIN dim_date ON date_key = order_date_key JOIN dim_channel USING (channel_key) "
        "SELECT year, month, channel_name, count(DISTINCT order_id) AS orders, count(DISTINCT customer_key) AS customers, "
        "CAST(sum(net_revenue) AS DOUBLE) AS net_revenue, true AS orders_close, true AS customers_close GROUP BY ALL")
    q["p6_attribute_counts"] = with_star(
        ", a AS (SELECT parent_category, key AS attribute, value, CASE WHEN j.type IN ('BIGINT', 'UBIGINT', 'DOUBLE') "
        "THEN 'number' WHEN j.type = 'VARCHAR' THEN 'text' WHEN j.type = 'BOOLEAN' THEN 'boolean' ELSE 'other' END AS kind "
        "FROM stg_products, json_each(attributes) j) "
        "FROM a SELECT parent_category, attribute, kind, count(*) AS products, "
        "count(DISTINCT CAST(value AS VARCHAR)) AS distinct_values, "
        "min(CASE kind WHEN 'number' THEN CAST(value AS DOUBLE) END) AS least, "
        "max(CASE kind WHEN 'number' THEN CAST(value AS DOUBLE) END) AS most GROUP BY ALL")
    q["w1_w2_bucketed_rank"] = with_star(
        "SELECT ROW_NUMBER() OVER (ORDER BY net_revenue DESC, order_item_id) AS rank, "
        "order_item_id, CAST(net_revenue AS DOUBLE) AS net, "
        "CAST(SUM(net_revenue) OVER (ORDER BY net_revenue DESC, order_item_id "
        "ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running_net FROM fact_sales")
    q["w6_segmented_running_sum"] = with_star(
        "SELECT order_id, order_item_id, CAST(net_revenue AS DOUBLE) AS net_revenue, "
        "CAST(SUM(net_revenue) OVER (PARTITION BY order_id ORDER BY order_item_id "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS net_before "
        "FROM fact_sales")
    q["s13_upsert_channels"] = with_star(
        ", ch_changes AS (SELECT channel_id * 2 AS channel_id, 'NEW ' || channel_name "
        "AS channel_name, 'partner' AS channel_type FROM stg_sales_channels) "
        "SELECT * FROM ch_changes UNION ALL SELECT * FROM stg_sales_channels s "
        "WHERE NOT EXISTS (SELECT 1 FROM ch_changes c WHERE c.channel_id = s.channel_id)")
    q["s13_upsert_customers"] = with_star(
        ", cu_changes AS (SELECT customer_id * 2 AS customer_id, first_name, last_name, "
        "email, phone, signup_date, 'MOVED ' || city AS city, state, country "
        "FROM stg_customers), cu_all AS (SELECT * FROM cu_changes UNION ALL "
        "SELECT * FROM stg_customers s WHERE NOT EXISTS "
        "(SELECT 1 FROM cu_changes c WHERE c.customer_id = s.customer_id)) "
        "SELECT CAST(customer_id AS BIGINT) AS customer_id, first_name, last_name, email, "
        "phone, strftime(signup_date, '%Y-%m-%d') AS signup_date, city, state, country "
        "FROM cu_all")
    q["dq_staging_gate"] = dq_staging()
    q["dq_analytics_gate"] = dq_analytics()
    q["dq_staging_suite"] = dq_staging_suite()
    q["dq_star_suite"] = dq_star_suite()
    q["dq_cross_layer"] = dq_cross_layer()
    q["dq_staging_gate_planted"] = dq_staging(P.STAGING)
    q["dq_staging_suite_planted"] = dq_staging_suite(P.STAGING)
    q["dq_analytics_gate_planted"] = dq_analytics(P.STAR)
    q["dq_star_suite_planted"] = dq_star_suite(P.STAR)
    q["dq_cross_layer_planted"] = _union([_check(
        "cross", "consistency", "staged items equal fact rows",
        "SELECT abs((SELECT count(*) FROM stg_order_items) - (SELECT count(*) FROM fact_sales))")], P.DANGLING, True)
    q["b11_fact_sales_dangling"] = _edge("fact_sales", S.STAR["fact_sales"], P.DANGLING)
    for name in P.REPEATED:
        q[f"b1_stg_{name}_repeated"] = _edge(f"stg_{name}", S.SOURCE[name], P.REPEATED, "src_")
    q["s4_billing_addresses"] = with_star(
        "SELECT customer_id, city, state, country FROM src_customer_addresses WHERE address_type = 'billing'")
    q["k3_latest_order"] = with_star(
        "SELECT order_id, strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date FROM stg_orders "
        "ORDER BY stg_orders.order_date DESC, order_id DESC LIMIT 1")
    q["u3_products_never_returned"] = with_star(
        "SELECT product_id FROM stg_products EXCEPT "
        "SELECT product_id FROM stg_order_items JOIN stg_returns USING (order_item_id)")
    q["g5_capped_rows"] = with_star(
        "SELECT order_item_id, CAST(net_revenue AS DOUBLE) AS net_revenue FROM fact_sales "
        "ORDER BY fact_sales.net_revenue DESC, order_item_id LIMIT 100")
    q["g_guarded_sql"] = with_star(
        ", sold AS (FROM fact_sales SELECT category_key, order_id, net_revenue WHERE quantity > 0) "
        "FROM sold JOIN dim_category USING (category_key) SELECT parent_category, count(DISTINCT order_id) AS orders, "
        f"{_d('sum(net_revenue)')} AS net_revenue GROUP BY ALL")
    return q
