"""Data-quality checks (D1-D28) and the blocking gate.

Every check yields one row ``(layer, dimension, check_name, observed,
passed)``: ``observed`` is the number of violating rows (for timeliness, the
age in days). Checks on one table share one scan: a single aggregate with a
conditional count per rule, unpivoted into rows. Foreign keys are anti joins
of the child's counted (link, key) rows against the distinct parent keys, one
scan and one join for all links of a table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECK_SCHEMA = "layer string, dimension string, check_name string, observed long, passed boolean"

# Accepted values of the enumerated source columns
ACCEPTED = {
    ("stg_promotions", "discount_type"): ["percentage", "fixed_amount"],
    ("stg_customer_addresses", "address_type"): ["billing", "shipping"],
    ("stg_orders", "status"): ["processing", "shipped", "delivered", "cancelled"],
    ("stg_payments", "payment_method"): ["credit_card", "debit_card", "paypal", "apple_pay",
                                         "gift_card", "bank_transfer"],
    ("stg_payments", "status"): ["completed", "pending", "failed", "refunded"],
}
# Fixed value: e-mail shape
EMAIL_PATTERN = r"^[\w.+-]+@[\w-]+\.[\w.-]+$"
MAX_STALENESS_DAYS = 400


class DataQualityError(RuntimeError):
    pass


@dataclass(frozen=True)
class Rule:
    dimension: str
    name: str
    observed: Column          # aggregate expression over the table
    threshold: int = 0        # passed when observed <= threshold


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def dup_count(*cols: str) -> Column:
    """``COUNT(*) - COUNT(DISTINCT key)``; NULL keys count as violations."""
    return F.count(F.lit(1)) - F.count_distinct(*[F.col(c) for c in cols])


def table_checks(layer: str, df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All ``rules`` over ``df`` in one aggregate, one row per rule."""
    agg = df.agg(*[F.coalesce(r.observed, F.lit(0)).cast("long").alias(f"r{i}")
                   for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(layer).alias("layer"), F.lit(r.dimension).alias("dimension"),
                 F.lit(r.name).alias("check_name"), F.col(f"r{i}").alias("observed"),
                 (F.col(f"r{i}") <= r.threshold).alias("passed"))
        for i, r in enumerate(rules)])
    return agg.select(F.inline(rows))


def orphan_rule_rows(layer: str, child: DataFrame, links: list[tuple[str, str, DataFrame, str]],
                     dimension: str = "consistency") -> DataFrame:
    """Rows of ``child`` whose ``fk`` has no match in ``parent.pk`` (J10), one
    row per link (name, fk, parent, pk), from one scan of the child: its keys
    are unpivoted to (link, key) and counted, combined map-side, so a key held
    by a third of the rows ships as one row per task; the distinct keys then
    meet all parents' distinct keys in one anti join. A NULL foreign key counts
    as dangling, as in ``LEFT JOIN ... WHERE parent.key IS NULL``; links whose
    name ends in '?' skip NULL keys. Whole-number links keep their keys as
    numbers, the others compare them as text, each kind in a scan of its own."""
    rules, kinds = [], {}
    for k, (name, fk, parent, pk) in enumerate(links):
        kind = _key_kind((child, fk), (parent, pk))
        pairs, parents = kinds.setdefault(kind, ([], []))
        pairs.append(F.struct(F.lit(k).alias("link"), F.col(fk).cast(kind).alias("key")))
        parents.append(parent.select(F.lit(k).alias("link"), F.col(pk).cast(kind).alias("key")))
        hit = F.col("link") == k
        if name.endswith("?"):
            name, hit = name[:-1], hit & F.col("known")
        rules.append(Rule(dimension, name, F.sum(F.when(hit, F.col("n")))))
    missing = []
    for pairs, parents in kinds.values():
        keys = child.select(F.inline(F.array(*pairs))).groupBy("link", "key").agg(F.count(F.lit(1)).alias("n"))
        missing.append(keys.join(union_all(parents).distinct(), ["link", "key"], "left_anti")
                       .select("link", "n", F.col("key").isNotNull().alias("known")))
    return table_checks(layer, union_all(missing), rules)


def _key_kind(*columns: tuple[DataFrame, str]) -> str:
    """The type that keys are compared in: a number takes less of a task's
    hash table than its text."""
    whole = all(isinstance(df.schema[c].dataType, T.IntegralType) for df, c in columns)
    return "bigint" if whole else "string"


def duplicate_rule_rows(layer: str, keys: list[tuple[str, DataFrame, str]],
                        dimension: str = "uniqueness") -> DataFrame:
    """``COUNT(*) - COUNT(DISTINCT key)`` for several (check, table, key) at
    once: all keys are counted by (check, key), combined map-side, in one
    shuffle of the whole numbers and one of the other keys, as text. NULL keys
    count as violations."""
    kinds: dict[str, list[DataFrame]] = {}
    for k, (_, df, key) in enumerate(keys):
        kind = _key_kind((df, key))
        kinds.setdefault(kind, []).append(df.select(F.lit(k).alias("link"), F.col(key).cast(kind).alias("key")))
    counted = union_all([
        union_all(frames).groupBy("link", "key").agg(F.count(F.lit(1)).alias("n"))
        .select("link", "n", F.col("key").isNotNull().alias("known")) for frames in kinds.values()])
    return table_checks(layer, counted, [
        Rule(dimension, name, F.sum(F.when(F.col("link") == k, F.col("n")))
             - F.count(F.when((F.col("link") == k) & F.col("known"), 1)))
        for k, (name, _, _) in enumerate(keys)])


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def gate(results: DataFrame, layer: str = "") -> list[tuple]:
    """The check rows, if all passed; else :class:`DataQualityError`, which
    names each failed check with what it found. Collects one row per check (a
    fixed, small set)."""
    rows = results.collect()
    if failed := [r for r in rows if not r.passed]:
        lines = [f"  {r.check_name} ({r.dimension}): found {r.observed}" for r in failed]
        raise DataQualityError(
            f"{len(failed)} of {len(rows)} checks failed in {layer or rows[0].layer}\n" + "\n".join(lines))
    return [tuple(r) for r in rows]


# ------------------------------------------------------------------ gates
def staging_checks(stg: dict[str, DataFrame]) -> DataFrame:
    """The staging gate."""
    L = "staging"
    emails = table_checks(L, stg["stg_customers"], [
        Rule("completeness", "every customer has an e-mail",
             count_if(F.col("email").isNull() | (F.col("email") == ""))),
    ])
    orders = table_checks(L, stg["stg_orders"], [
        Rule("completeness", "every order has a date", count_if(F.col("order_date").isNull())),
        Rule("uniqueness", "no order id twice", dup_count("order_id")),
    ])
    items = orphan_rule_rows(L, stg["stg_order_items"], [
        ("lines belong to a staged order", "order_id", stg["stg_orders"], "order_id"),
        ("lines name a staged product", "product_id", stg["stg_products"], "product_id"),
    ])
    return union_all([emails, orders, items, order_total_check(L, stg)])


def order_total_check(layer: str, stg: dict[str, DataFrame]) -> DataFrame:
    """Orders whose total differs from the sum of their lines by > 0.01."""
    sums = stg["stg_order_items"].groupBy("order_id").agg(F.sum("line_total").alias("s"))
    j = stg["stg_orders"].select("order_id", "total_amount").join(sums, "order_id")
    return table_checks(layer, j, [Rule(
        "accuracy", "order total is the sum of its lines",
        count_if(F.abs(F.col("total_amount") - F.col("s")) > F.lit(0.01)))])


def analytics_checks(star: dict[str, DataFrame], as_of: dt.date,
                     max_staleness_days: int = MAX_STALENESS_DAYS) -> DataFrame:
    """The analytics gate (D8-D12); ``as_of`` replaces the clock."""
    L = "analytics"
    f = star["fact_sales"]
    facts = table_checks(L, f, [
        Rule("completeness", "sales rows carry their keys",
             count_if(F.col("customer_key").isNull() | F.col("product_key").isNull()
                      | F.col("order_date_key").isNull())),
        Rule("uniqueness", "one sales row per order line", dup_count("order_item_id")),
        Rule("accuracy", "net is gross less discount",
             count_if(F.abs(F.col("gross_revenue") - F.col("discount_amount")
                            - F.col("net_revenue")) > F.lit(0.01))),
    ])
    product = orphan_rule_rows(L, f, [
        ("sold products are in the product dimension", "product_key", star["dim_product"],
         "product_key")])
    return union_all([facts, product, staleness_check(L, star, as_of, max_staleness_days)])


def staleness_check(layer: str, star: dict[str, DataFrame], as_of: dt.date,
                    max_days: int) -> DataFrame:
    """Days from the latest sold day to ``as_of``; 99999 without sales."""
    days = F.broadcast(star["dim_date"].select("date_key", "full_date"))  # a row per calendar day
    latest = star["fact_sales"].select("order_date_key").join(days, F.col("order_date_key") == F.col("date_key"))
    return table_checks(layer, latest, [Rule(
        "timeliness", "newest sale is recent enough",
        F.coalesce(F.datediff(F.lit(as_of), F.max("full_date")), F.lit(99999)), max_days)])


# ------------------------------------------------------------------ suites
def staging_suite(stg: dict[str, DataFrame]) -> DataFrame:
    """Staging checks of the test suite and the source constraints (D4,
    D13, D14, D17, D25-D28)."""
    L = "staging"
    s = stg
    frames = [
        duplicate_rule_rows(L, [
            ("stg_sales_channels.channel_id unique", s["stg_sales_channels"], "channel_id"),
            ("channel name unique", s["stg_sales_channels"], "channel_name"),
            ("stg_promotions.promotion_id unique", s["stg_promotions"], "promotion_id"),
            ("promotion code unique", s["stg_promotions"], "promotion_code"),
            ("stg_customer_addresses.address_id unique", s["stg_customer_addresses"], "address_id"),
            ("stg_order_items.order_item_id unique", s["stg_order_items"], "order_item_id"),
            ("stg_payments.payment_id unique", s["stg_payments"], "payment_id"),
            ("stg_returns.return_id unique", s["stg_returns"], "return_id"),
            ("stg_customers.customer_id unique", s["stg_customers"], "customer_id"),
            ("customer email unique", s["stg_customers"], "email"),
            ("stg_products.product_id unique", s["stg_products"], "product_id"),
        ]),
        table_checks(L, s["stg_promotions"], [
            Rule("validity", "promotion end after start",
                 count_if(F.col("end_date") < F.col("start_date"))),
            Rule("validity", "promotion value positive", count_if(F.col("discount_value") <= 0)),
            _accepted("stg_promotions", "discount_type"),
        ]),
        table_checks(L, s["stg_customer_addresses"], [
            _accepted("stg_customer_addresses", "address_type"),
        ]),
        table_checks(L, s["stg_orders"], [
            Rule("validity", "order total not negative", count_if(F.col("total_amount") < 0)),
            _accepted("stg_orders", "status"),
        ]),
        table_checks(L, s["stg_order_items"], [
            Rule("validity", "item quantity positive", count_if(F.col("quantity") <= 0)),
            Rule("validity", "item price not negative", count_if(F.col("unit_price") < 0)),
        ]),
        table_checks(L, s["stg_payments"], [
            Rule("validity", "payment amount not negative", count_if(F.col("amount") < 0)),
            _accepted("stg_payments", "payment_method"),
            _accepted("stg_payments", "status"),
        ]),
        table_checks(L, s["stg_returns"], [
            Rule("validity", "return quantity positive", count_if(F.col("quantity") <= 0)),
        ]),
        table_checks(L, s["stg_customers"], [
            Rule("accuracy", "emails have valid format",
                 count_if(F.col("email").isNull() | ~F.col("email").rlike(EMAIL_PATTERN))),
        ]),
        table_checks(L, s["stg_products"], [
            Rule("completeness", "product categories present",
                 count_if(F.col("category_name").isNull() | (F.col("category_name") == "")
                          | F.col("parent_category").isNull()
                          | (F.col("parent_category") == ""))),
        ]),
        payment_total_check(L, s),
        orphan_rule_rows(L, s["stg_orders"], [
            ("orders reference customers", "customer_id", s["stg_customers"], "customer_id"),
            ("orders reference channels", "channel_id", s["stg_sales_channels"], "channel_id"),
            ("orders reference promotions?", "promotion_id", s["stg_promotions"],
             "promotion_id"),
        ]),
        orphan_rule_rows(L, s["stg_payments"], [
            ("payments reference orders", "order_id", s["stg_orders"], "order_id")]),
        orphan_rule_rows(L, s["stg_returns"], [
            ("returns reference orders", "order_id", s["stg_orders"], "order_id"),
            ("returns reference order items", "order_item_id", s["stg_order_items"],
             "order_item_id"),
        ]),
        orphan_rule_rows(L, s["stg_customer_addresses"], [
            ("addresses reference customers", "customer_id", s["stg_customers"],
             "customer_id")]),
    ]
    return union_all(frames)


def _accepted(table: str, col: str) -> Rule:
    values = ACCEPTED[(table, col)]
    return Rule("validity", f"{col} in accepted values",
                count_if(F.col(col).isNotNull() & ~F.col(col).isin(*values)))


def payment_total_check(layer: str, stg: dict[str, DataFrame]) -> DataFrame:
    """Orders whose payments do not add up to the total."""
    paid = stg["stg_payments"].groupBy("order_id").agg(F.sum("amount").alias("paid"))
    j = stg["stg_orders"].select("order_id", "total_amount").join(paid, "order_id")
    return table_checks(layer, j, [Rule(
        "accuracy", "payments match order totals",
        count_if(F.abs(F.col("total_amount") - F.col("paid")) > F.lit(0.01)))])


def star_suite(star: dict[str, DataFrame]) -> DataFrame:
    """Star checks of the test suite and the declared keys (D4, D8, D15,
    D16, D18-D20, D28)."""
    L = "analytics"
    s = star
    surrogate = {"dim_date": "date_key", "dim_customer": "customer_key",
                 "dim_category": "category_key", "dim_product": "product_key",
                 "dim_channel": "channel_key", "dim_promotion": "promotion_key",
                 "dim_payment_method": "payment_method_key"}
    frames = [duplicate_rule_rows(L, [
        *((f"{t}.{k} unique", s[t], k) for t, k in surrogate.items()),
        ("fact_sales.sales_key unique", s["fact_sales"], "sales_key"),
        ("fact_returns.return_id unique", s["fact_returns"], "return_id")])]
    fs_keys = ["order_date_key", "customer_key", "product_key", "category_key", "channel_key",
               "promotion_key", "payment_method_key"]
    frames.append(table_checks(L, s["fact_sales"], [
        Rule("completeness", "fact_sales foreign keys not null",
             count_if(_any_null(fs_keys))),
        Rule("validity", "sold quantities positive", count_if(F.col("quantity") <= 0)),
    ]))
    fr_keys = ["return_date_key", "customer_key", "product_key", "channel_key"]
    frames.append(table_checks(L, s["fact_returns"], [
        Rule("completeness", "fact_returns foreign keys not null", count_if(_any_null(fr_keys))),
        Rule("validity", "returned quantities positive",
             count_if(F.col("quantity_returned") <= 0)),
    ]))
    refunds = s["fact_returns"].select("order_item_id", "refund_amount").join(
        s["fact_sales"].select("order_item_id", "net_revenue"), "order_item_id")
    frames.append(table_checks(L, refunds, [Rule(
        "accuracy", "refunds within line net revenue",
        count_if(F.col("refund_amount") > F.col("net_revenue") + F.lit(0.01)))]))
    dims = {"order_date_key": ("dim_date", "date_key"),
            "customer_key": ("dim_customer", "customer_key"),
            "product_key": ("dim_product", "product_key"),
            "category_key": ("dim_category", "category_key"),
            "channel_key": ("dim_channel", "channel_key"),
            "promotion_key": ("dim_promotion", "promotion_key"),
            "payment_method_key": ("dim_payment_method", "payment_method_key")}
    frames.append(orphan_rule_rows(L, s["fact_sales"], [
        (f"fact_sales.{fk} resolves in {d}", fk, s[d], pk) for fk, (d, pk) in dims.items()]))
    rdims = {"return_date_key": ("dim_date", "date_key"),
             "customer_key": ("dim_customer", "customer_key"),
             "product_key": ("dim_product", "product_key"),
             "channel_key": ("dim_channel", "channel_key")}
    frames.append(orphan_rule_rows(L, s["fact_returns"], [
        (f"fact_returns.{fk} resolves in {d}", fk, s[d], pk) for fk, (d, pk) in rdims.items()]))
    frames.append(orphan_rule_rows(L, s["dim_product"], [
        ("dim_product.category_key resolves in dim_category", "category_key",
         s["dim_category"], "category_key")]))
    frames.append(table_checks(L, s["dim_category"], [
        Rule("consistency", "category names trimmed",
             count_if(F.col("category_name") != F.trim(F.col("category_name")))),
        Rule("consistency", "category names unique ignoring case",
             F.count(F.lit(1)) - F.count_distinct(F.lower(F.col("category_name")))),
    ]))
    shared = s["dim_customer"].groupBy("email").agg(
        F.count_distinct("customer_id").alias("ids")).where(F.col("ids") > 1)  # A10
    frames.append(table_checks(L, shared, [Rule(
        "consistency", "one customer id per email", F.count(F.lit(1)))]))
    return union_all(frames)


def _any_null(cols: list[str]) -> Column:
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond | F.col(c).isNull()
    return cond


def cross_layer_checks(stg: dict[str, DataFrame], star: dict[str, DataFrame]) -> DataFrame:
    """Staged order items and fact rows agree in number."""
    a = stg["stg_order_items"].agg(F.count(F.lit(1)).alias("a"))
    b = star["fact_sales"].agg(F.count(F.lit(1)).alias("b"))
    both = a.crossJoin(b)  # one row each
    return table_checks("cross", both, [Rule(
        "consistency", "staged items equal fact rows",
        F.max(F.abs(F.col("a") - F.col("b"))))])


# Tables whose staging load must be audited
CORE_AUDITED = ["stg_customers", "stg_orders", "stg_order_items", "stg_products"]


def timeliness_checks(audit: DataFrame, runs: DataFrame, as_of: dt.datetime,
                      max_age_days: int = 2) -> DataFrame:
    """Freshness of the last staging load and the last build, and an audit
    entry for every core table (D22-D24; ``as_of`` replaces the clock)."""
    L = "timeliness"
    at = F.lit(as_of).cast("timestamp_ntz")
    age = lambda c: F.coalesce(F.datediff(at, F.max(c)), F.lit(99999))
    loads = table_checks(L, audit, [Rule("timeliness", "last staging load is recent",
                                         age("loaded_at"), max_age_days - 1)])
    build = table_checks(L, runs.where(F.col("step_name") == "build_analytics"), [
        Rule("timeliness", "last build is recent", age("completed_at"), max_age_days - 1)])
    expected = audit.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(t) for t in CORE_AUDITED])).alias("table_name"))
    missing = expected.join(audit.select("table_name").distinct(), "table_name", "left_anti")  # U3
    audited = table_checks(L, missing, [Rule("completeness", "core tables audited",
                                             F.count(F.lit(1)))])
    return union_all([loads, build, audited])
