"""The query catalog: every operator applied to whole tables of a test directory.

A query is a function of ``Tables``; its registered name is its function name.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators import contracts, incremental, joins, layout, marts, quality, values
from ordermill.operators import quarantine as qr
from ordermill.operators.clean import CLEANERS
from ordermill.plans import medallion, validation
from ordermill.sources.contracts import (
    CRITICAL_COLUMNS,
    ORDER_STATUSES,
    SOURCE_TABLES,
    UNIQUE_KEYS,
    contract,
    local_time_contract,
)
from ordermill.sources.ingest import bronze_ingest, rejected_records
from ordermill.sources.marks import write_mark
from ordermill.sources.roles import Roles
from ordermill.sources.tables import (
    materialize,
    read_csv,
    read_csv_permissive,
    scratch_path,
    write_csv,
    write_table,
)
from ordermill.streaming import ingest as streams

# Dates that split the test data: incremental start, stored mark, batch interval, first corrected item.
SINCE = "2001-06-01"
MARK = datetime(2001, 7, 1)
ARRIVED = "2001-07-15"
BATCH = ("2001-07-01", "2001-07-08")
EMPTIED = "2001-07-03"
CORRECTED = "2001-01-01"

# Spend that about three of four persons exceed.
BIG_SPENDER = 1_000_000

PURCHASED = "order_purchase_timestamp"

SALES_METRICS = ("total_items_sold", "total_product_revenue", "total_freight_revenue", "average_item_price")
PRODUCT_METRICS = ("total_orders", "unique_sellers", *SALES_METRICS)
PERSON_METRICS = ("total_orders", "delivered_orders", "total_items", "total_spend", "average_order_value")

# Key and audited metrics of each mart.
MART_METRICS: dict[str, tuple[str | None, tuple[str, ...]]] = {
    "orders": ("order_id", ("product_revenue", "freight_revenue", "total_order_value")),
    "customers": ("customer_id", ("total_orders", "total_spent", "average_order_value", "total_items_purchased")),
    "products": ("product_id", ("unique_orders", "unique_sellers", *SALES_METRICS)),
    "sellers": ("seller_id", ("unique_orders", "unique_products", *SALES_METRICS)),
    "category": (None, ("unique_orders", "unique_products", *SALES_METRICS)),
    "reviews": ("order_id", ("review_count", "average_review_score", "average_response_hours")),
    "payments": (
        "order_id",
        (
            "payment_count",
            "total_payment_value",
            "average_payment_value",
            "total_installments",
            "max_installments",
            "unique_payment_types",
        ),
    ),
    "geolocation": ("geolocation_zip_code_prefix", ("average_latitude", "average_longitude")),
}


class Tables:
    """Lazy source tables, cleaned tables and marts of one test directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.roles = Roles(spark, sf_dir)

    def raw(self, name: str) -> DataFrame:
        return self.roles.raw(name)

    def silver(self, name: str) -> DataFrame:
        return CLEANERS[name](self.raw(name))

    def gold_orders(self) -> DataFrame:
        return marts.gold_orders(self.silver("orders"), self.silver("order_items"), self.silver("order_payments"))

    def enriched(self) -> DataFrame:
        return marts.gold_orders_enriched(
            self.silver("orders"), self.silver("customers"), self.silver("order_items"), self.silver("order_payments")
        )

    def stale_items(self) -> DataFrame:
        """All items as the audited, by now stale, marts saw them.

        Those from a date on stood at another price, and all but the first of an
        order under an order of their own.
        """
        later = F.col("shipping_limit_date") >= incremental.instant(CORRECTED)
        own = F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string"))
        return self.silver("order_items").withColumns(
            {
                "price": F.when(later, F.col("price") + 1).otherwise(F.col("price")),
                "order_id": F.when(later & (F.col("order_item_id") > 1), own).otherwise(F.col("order_id")),
            }
        )

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# -- sources and sinks --------------------------------------------------------


@query
def csv_scan_inferred(t: Tables) -> DataFrame:
    path = t.scratch("customers-csv")
    write_csv(t.silver("customers"), path)
    return read_csv(t.spark, path)


@query
def csv_scan_schema(t: Tables) -> DataFrame:
    path = t.scratch("items-csv")
    write_csv(t.raw("order_items"), path)
    return read_csv(t.spark, path, local_time_contract("order_items"))


@query
def csv_scan_permissive(t: Tables) -> DataFrame:
    """Quoted line breaks stay in their record; a score that is no number becomes NULL."""
    path = t.scratch("reviews-csv")
    score = F.when(F.col("review_score") == 6, "n/a").otherwise(F.col("review_score").cast("string"))
    message = F.concat_ws("\n", "review_comment_message", F.col("review_comment_title"))
    write_csv(t.raw("order_reviews").withColumns({"review_score": score, "review_comment_message": message}), path)
    return read_csv_permissive(t.spark, path, local_time_contract("order_reviews"), multi_line=True)


@query
def bronze_ingest_profile(t: Tables) -> DataFrame:
    """All nine tables through CSV into typed Parquet, then rows and NULLs per column."""
    tables = _ingested({name: t.raw(name) for name in SOURCE_TABLES}, t.scratch("bronze"))
    return quality.union_findings(quality.profile_table(df, name) for name, df in tables.items())


def _ingested(raw: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Raw tables written as CSV and ingested below ``root``."""
    raw_paths = {name: f"{root}/raw/{name}" for name in SOURCE_TABLES}
    for name, path in raw_paths.items():
        write_csv(raw[name], path)
    schemas = {name: local_time_contract(name) for name in SOURCE_TABLES}
    return bronze_ingest(raw["orders"].sparkSession, raw_paths, f"{root}/bronze", schemas)


@query
def bronze_rejects(t: Tables) -> DataFrame:
    """Records per table that did not fit: reviews whose score is a word, products whose weight is."""
    root = t.scratch("bronze-rejects")
    raw = {name: t.raw(name) for name in SOURCE_TABLES}
    for name, column, value in (("order_reviews", "review_score", 6), ("products", "product_weight_g", 10)):
        words = F.when(F.col(column) == value, "n/a").otherwise(F.col(column).cast("string"))
        raw[name] = raw[name].withColumn(column, words)
    _ingested(raw, root)
    return rejected_records(t.spark, f"{root}/bronze").groupBy("table").agg(F.count("*").alias("rows"))


@query
def parquet_overwrite(t: Tables) -> DataFrame:
    """A full overwrite leaves exactly the last write."""
    path = t.scratch("orders")
    write_table(t.raw("orders"), path)
    return write_table(t.raw("orders").select("order_id", "order_status"), path)


# -- cleaned tables -------------------------------------------------------------


def _silver(name: str) -> None:
    def silver_table(t: Tables) -> DataFrame:
        return t.silver(name)

    QUERIES[f"silver_{name}"] = silver_table


for _name in SOURCE_TABLES:
    _silver(_name)


# -- marts ------------------------------------------------------------------------


@query
def gold_orders(t: Tables) -> DataFrame:
    return t.gold_orders()


@query
def gold_orders_enriched(t: Tables) -> DataFrame:
    return t.enriched()


@query
def gold_customers(t: Tables) -> DataFrame:
    return marts.gold_customers(t.silver("customers"), t.gold_orders())


@query
def gold_customers_by_person(t: Tables) -> DataFrame:
    return marts.gold_customers_by_person(t.enriched(), t.silver("customers"))


@query
def gold_products(t: Tables) -> DataFrame:
    return marts.gold_products(t.silver("products"), t.silver("order_items"))


@query
def gold_products_narrow(t: Tables) -> DataFrame:
    return marts.gold_products_narrow(t.silver("products"), t.silver("order_items"))


@query
def gold_sellers(t: Tables) -> DataFrame:
    return marts.gold_sellers(t.silver("sellers"), t.silver("order_items"))


@query
def gold_sellers_narrow(t: Tables) -> DataFrame:
    return marts.gold_sellers_narrow(t.silver("sellers"), t.silver("order_items"))


@query
def gold_category(t: Tables) -> DataFrame:
    return marts.gold_category(t.silver("order_items"), t.silver("products"), t.silver("category_translation"))


@query
def gold_category_translated(t: Tables) -> DataFrame:
    return marts.gold_category_translated(
        t.silver("order_items"), t.silver("products"), t.silver("category_translation")
    )


@query
def gold_reviews(t: Tables) -> DataFrame:
    return marts.gold_reviews(t.silver("order_reviews"))


@query
def gold_payments(t: Tables) -> DataFrame:
    return marts.gold_payments(t.silver("order_payments"))


@query
def gold_geolocation(t: Tables) -> DataFrame:
    return marts.gold_geolocation(t.silver("geolocation"))


@query
def customer_revenue(t: Tables) -> DataFrame:
    return marts.customer_revenue(t.enriched())


@query
def customer_revenue_stored(t: Tables) -> DataFrame:
    """The revenue report written and read back."""
    return write_table(marts.customer_revenue(t.enriched()), t.scratch("customer-revenue"))


@query
def customer_spend_by_person(t: Tables) -> DataFrame:
    return marts.customer_spend_by_person(t.enriched())


@query
def delivered_big_spenders(t: Tables) -> DataFrame:
    return marts.delivered_big_spenders(t.enriched(), over=BIG_SPENDER)


@query
def delivered_spend_by_person(t: Tables) -> DataFrame:
    return marts.delivered_spend_by_person(t.enriched())


@query
def customer_order_counts(t: Tables) -> DataFrame:
    return marts.customer_order_counts(t.enriched())


@query
def delivered_orders(t: Tables) -> DataFrame:
    return marts.delivered_orders(t.silver("orders"), ["order_id", "customer_id", "order_status", PURCHASED])


def _location(t: Tables) -> DataFrame:
    return t.silver("customers").select("customer_id", "customer_city", "customer_state")


def _order_values(t: Tables) -> DataFrame:
    return t.gold_orders().select("order_id", "customer_id", "total_order_value")


@query
def order_with_customer_location(t: Tables) -> DataFrame:
    """Spark's size rule and adaptive execution choose the join."""
    return joins.lookup_join(_order_values(t), _location(t), "customer_id")


@query
def order_with_customer_location_shuffled(t: Tables) -> DataFrame:
    """The same rows through a forced sort-merge join."""
    return joins.shuffle_join(_order_values(t), _location(t), "customer_id")


@query
def order_customer_inner(t: Tables) -> DataFrame:
    """Orders of the feed with their customer; those without a customer id fall out."""
    return t.roles.orders_feed().join(_location(t), "customer_id", "inner").select("order_id", "customer_id", "customer_city")


@query
def person_lookup(t: Tables) -> DataFrame:
    return marts.person_lookup(t.silver("customers"))


@query
def orders_by_value(t: Tables) -> DataFrame:
    return marts.orders_by_value(t.enriched())


@query
def top_orders(t: Tables) -> DataFrame:
    return marts.top_orders(t.enriched(), k=10)


@query
def top_item_counts(t: Tables) -> DataFrame:
    return marts.top_groups(t.silver("order_items"), "order_id", k=10, count_name="item_count")


@query
def top_payment_counts(t: Tables) -> DataFrame:
    return marts.top_groups(t.silver("order_payments"), "order_id", k=10, count_name="payment_count")


@query
def order_status_distribution(t: Tables) -> DataFrame:
    return marts.distribution(t.silver("orders"), "order_status")


@query
def payment_type_distribution(t: Tables) -> DataFrame:
    return marts.distribution(t.silver("order_payments"), "payment_type")


# -- order values -----------------------------------------------------------------


def _value_parts(t: Tables) -> DataFrame:
    """Balances as revenue and a per-nation surcharge as freight: negatives and NULLs occur."""
    return t.roles.table("customer").select(
        F.col("c_custkey").cast("string").alias("order_id"),
        F.col("c_acctbal").alias("product_revenue"),
        (F.nullif(F.col("c_nationkey"), F.lit(0)) * F.lit(1.25).cast("double")).alias("freight_revenue"),
    )


@query
def calculate_order_value(t: Tables) -> DataFrame:
    return _value_parts(t).transform(values.with_order_value)


@query
def invalid_order_values(t: Tables) -> DataFrame:
    return _value_parts(t).transform(values.with_order_value).transform(values.negative_order_values)


@query
def process_orders(t: Tables) -> DataFrame:
    return _value_parts(t).transform(values.valid_order_values)


# -- quality ----------------------------------------------------------------------


@query
def profile_table(t: Tables) -> DataFrame:
    return quality.union_findings(quality.profile_table(t.silver(n), n) for n in SOURCE_TABLES)


@query
def null_key_check(t: Tables) -> DataFrame:
    return quality.union_findings(
        quality.audit(t.silver(n), n, quality.not_null(*CRITICAL_COLUMNS[n])) for n in SOURCE_TABLES
    )


@query
def duplicate_key_check(t: Tables) -> DataFrame:
    keys = {**UNIQUE_KEYS, "order_items": ["order_id", "order_item_id"], "order_reviews": "order_id"}
    return quality.union_findings(
        quality.audit(t.silver(n), n, key=k, key_checks=("duplicate_key",)) for n, k in keys.items()
    )


@query
def surplus_row_check(t: Tables) -> DataFrame:
    keys = {**UNIQUE_KEYS, "order_items": ["order_id", "order_item_id"]}
    return quality.union_findings(
        quality.audit(t.silver(n), n, key=k, key_checks=("surplus_rows", "null_key")) for n, k in keys.items()
    )


@query
def row_count_check(t: Tables) -> DataFrame:
    """Complete rows of all nine tables against the raw ones, and what stale sales marts hold against the entity tables."""
    items = t.stale_items()
    actual = {n: t.silver(n).dropna(subset=CRITICAL_COLUMNS[n]) for n in SOURCE_TABLES}
    expected = {n: t.raw(n) for n in SOURCE_TABLES}
    for name, key in (("products", "product_id"), ("sellers", "seller_id"), ("orders", "order_id")):
        actual[f"sold_{name}"], expected[f"sold_{name}"] = items.select(key).distinct(), t.silver(name)
    return quality.row_count_check(quality.row_counts(actual), quality.row_counts(expected))


@query
def negative_value_check(t: Tables) -> DataFrame:
    return quality.union_findings(
        [
            quality.audit(t.silver("orders"), "orders", quality.not_negative("delivery_days")),
            quality.audit(t.silver("order_items"), "order_items", quality.not_negative("price", "freight_value")),
            quality.audit(t.raw("order_payments"), "order_payments", quality.not_negative("payment_installments")),
            quality.audit(
                marts.gold_reviews(t.silver("order_reviews")),
                "reviews",
                quality.not_negative("review_count", "average_response_hours"),
            ),
        ]
    )


@query
def non_positive_check(t: Tables) -> DataFrame:
    return quality.union_findings(
        [
            quality.audit(
                t.gold_orders(), "orders", quality.positive("total_items", "unique_products", "unique_sellers")
            ),
            quality.audit(t.raw("products"), "products", quality.positive("product_weight_g", "product_length_cm")),
        ]
    )


@query
def range_check(t: Tables) -> DataFrame:
    return quality.union_findings(
        [
            quality.audit(t.raw("order_reviews"), "order_reviews", [quality.within("review_score", 1, 5)]),
            quality.audit(
                t.silver("geolocation"),
                "geolocation",
                [quality.within("geolocation_lat", -90, 90), quality.within("geolocation_lng", -180, 180)],
            ),
        ]
    )


@query
def date_order_check(t: Tables) -> DataFrame:
    return quality.audit(
        t.silver("orders"),
        "orders",
        [
            quality.not_before("order_delivered_customer_date", PURCHASED),
            quality.not_before("order_approved_at", PURCHASED),
            quality.not_before("order_estimated_delivery_date", "order_delivered_customer_date"),
            *quality.not_negative("delivery_days"),
        ],
    )


@query
def domain_values(t: Tables) -> DataFrame:
    return t.silver("orders").select("order_status").distinct().orderBy("order_status")


@query
def domain_check(t: Tables) -> DataFrame:
    return quality.audit(t.silver("orders"), "orders", [quality.one_of("order_status", ORDER_STATUSES)])


@query
def derived_total_check(t: Tables) -> DataFrame:
    """The order system's own total against the total of the items; itemless orders have none."""
    stated = t.roles.table("orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_totalprice").alias("stated_total")
    )
    both = t.enriched().join(stated, "order_id", "left")
    return quality.audit(
        both,
        "orders",
        [
            quality.total_is_sum("stated_total", "product_revenue", "freight_revenue"),
            quality.total_is_sum("total_order_value", "product_revenue", "freight_revenue"),
        ],
    )


@query
def derived_average_check(t: Tables) -> DataFrame:
    """Averages of the payment and person marts; the persons carry planted defects."""
    return quality.union_findings(
        [
            quality.audit(
                marts.gold_payments(t.silver("order_payments")),
                "payments",
                [quality.average_is_ratio("average_payment_value", "total_payment_value", "payment_count")],
            ),
            quality.audit(
                _spoiled_persons(t),
                "persons",
                [quality.average_is_ratio("average_order_value", "total_spend", "total_orders")],
            ),
        ]
    )


@query
def recompute_product_avg(t: Tables) -> DataFrame:
    """A stale product mart's mean price against today's items."""
    stale = marts.gold_products_narrow(t.silver("products"), t.stale_items())
    now = marts.sales_metrics(t.silver("order_items"), ["product_id"], {})
    return quality.compare_metrics(stale, now, "products", ["product_id"], [], ["average_item_price"])


@query
def recompute_seller_metrics(t: Tables) -> DataFrame:
    """All six metrics of a stale seller mart against today's items, in one aggregate and one join."""
    stale = marts.gold_sellers_narrow(t.silver("sellers"), t.stale_items())
    now = marts.sales_metrics(
        t.silver("order_items"), ["seller_id"], {"total_orders": "order_id", "unique_products": "product_id"}
    )
    return quality.compare_metrics(
        stale,
        now,
        "sellers",
        ["seller_id"],
        ["total_orders", "total_items_sold", "unique_products"],
        ["total_product_revenue", "total_freight_revenue", "average_item_price"],
    )


@query
def recompute_category_metrics(t: Tables) -> DataFrame:
    """A stale category mart against today's items, keys matched NULL-safe, and item rows preserved."""
    products, translation = t.silver("products"), t.silver("category_translation")
    stale = marts.gold_category_translated(t.stale_items(), products, translation)
    now = marts.gold_category_translated(t.silver("order_items"), products, translation)
    metrics = quality.compare_metrics(
        stale,
        now,
        "category",
        ["product_category_name", "product_category_name_english"],
        ["unique_products", "total_orders", "total_items_sold", "unique_sellers"],
        ["total_product_revenue", "total_freight_revenue", "average_item_price"],
    )
    groups = quality.row_count_check(
        quality.row_counts({"category": stale}), quality.row_counts({"category": now})
    )
    preserved = quality.row_count_check(
        now.agg(F.sum("total_items_sold").alias("rows")).select(F.lit("order_items").alias("table"), "rows"),
        quality.row_counts({"order_items": t.silver("order_items")}),
    )
    return quality.union_findings([metrics, groups, preserved])


@query
def orphan_check(t: Tables) -> DataFrame:
    """Rows without a partner: children without a parent, and orders and customers nobody refers to."""
    items, orders = t.silver("order_items"), t.silver("orders")
    categories, translation = t.silver("products"), t.silver("category_translation")
    return quality.union_findings(
        [
            quality.orphan_check(items, orders, "order_id", "items -> orders"),
            quality.orphan_check(orders, items, "order_id", "orders -> items"),
            quality.orphan_check(t.silver("order_payments"), orders, "order_id", "payments -> orders"),
            quality.orphan_check(t.silver("order_reviews"), orders, "order_id", "reviews -> orders"),
            quality.orphan_check(items, t.silver("products"), "product_id", "items -> products"),
            quality.orphan_check(t.silver("customers"), orders, "customer_id", "customers -> orders"),
            quality.orphan_check(items, t.silver("sellers"), "seller_id", "items -> sellers"),
            quality.orphan_check(orders, t.silver("customers"), "customer_id", "orders -> customers"),
            quality.orphan_check(categories, translation, "product_category_name", "products -> translation"),
        ]
    )


@query
def join_fanout_audit(t: Tables) -> DataFrame:
    orders, items = t.silver("orders"), t.silver("order_items")
    return quality.union_findings(
        [
            quality.join_fanout(orders, t.silver("customers"), "customer_id", "orders -> customers"),
            quality.join_fanout(orders, items, "order_id", "orders -> items"),
            quality.join_fanout(orders, t.silver("order_payments"), "order_id", "orders -> payments"),
            quality.join_fanout(orders, t.silver("order_reviews"), "order_id", "orders -> reviews"),
            quality.join_fanout(items, t.silver("products"), "product_id", "items -> products"),
            quality.join_fanout(items, t.silver("sellers"), "seller_id", "items -> sellers"),
        ]
    )


@query
def layer_row_counts(t: Tables) -> DataFrame:
    """Rows of stored layers; the category names stand twice in silver, as after an append run twice."""
    bronze = {n: t.raw(n) for n in SOURCE_TABLES}
    silver = medallion.build_silver(bronze, t.scratch("silver"))
    gold = medallion.build_gold(silver, t.scratch("gold"))
    names = silver["category_translation"]
    counts = medallion.layer_row_counts(
        {"bronze": bronze, "silver": {**silver, "category_translation": names.unionByName(names)}, "gold": gold}
    )
    return medallion.layer_growth(counts)


@query
def revenue_reconciliation(t: Tables) -> DataFrame:
    return quality.revenue_reconciliation(t.gold_orders())


@query
def unsold_entities(t: Tables) -> DataFrame:
    """Products and sellers without a sale, customers without an order, orders without an item."""
    items, orders = t.silver("order_items"), t.silver("orders")
    pairs = {
        "product": (t.silver("products"), items, "product_id"),
        "seller": (t.silver("sellers"), items, "seller_id"),
        "customer": (t.silver("customers"), orders, "customer_id"),
        "order": (orders, items, "order_id"),
    }
    return quality.union_findings(
        entities.select(key).join(uses.select(key).distinct(), key, "left_anti").select(F.lit(name).alias("entity"), F.col(key).alias("id"))
        for name, (entities, uses, key) in pairs.items()
    )


@query
def silver_audit(t: Tables) -> DataFrame:
    return validation.audit_silver({n: t.silver(n) for n in SOURCE_TABLES})


@query
def gold_validation_suite(t: Tables) -> DataFrame:
    """The marts are stored once, then audited: 59 checks."""
    silver = {n: t.silver(n) for n in SOURCE_TABLES}
    lines = medallion.build_lines(silver, t.scratch("shared"))
    gold = medallion.build_gold(silver, t.scratch("gold"), lines)
    return validation.validate_gold(gold, validation.gold_expectations(silver, lines))


def _spoiled(df: DataFrame, metrics: tuple[str, ...], key: str | None = None, **changed: Column) -> DataFrame:
    """A mart with every row once more far below zero (and ``changed``), and once more without its key and one higher."""
    out = df.unionByName(df.withColumns({**{m: F.lit(-1000) - F.col(m) for m in metrics}, **changed}))
    if key is None:
        return out
    lost = {key: F.lit(None).cast(df.schema[key].dataType)}
    return out.unionByName(df.withColumns({**{m: F.col(m) + 1 for m in metrics}, **lost}))


@query
def gold_validation_suite_defects(t: Tables) -> DataFrame:
    """The suite over spoiled marts: each of the 59 checks fails."""
    silver = {n: t.silver(n) for n in SOURCE_TABLES}
    lines = medallion.build_lines(silver, t.scratch("shared"))
    gold = medallion.build_gold(silver, t.scratch("gold"), lines)
    spoiled = {name: _spoiled(gold[name], metrics, key) for name, (key, metrics) in MART_METRICS.items()}
    key, metrics = MART_METRICS["orders"]
    strangers = F.concat("customer_id", F.lit("-unknown"))
    spoiled["orders"] = _spoiled(gold["orders"], metrics, key, customer_id=strangers)
    return validation.validate_gold(spoiled, validation.gold_expectations(silver, lines))


def _spoiled_persons(t: Tables) -> DataFrame:
    persons = materialize(gold_customers_by_person(t), "persons")
    early = F.col("first_order_date") - F.make_dt_interval(F.lit(1))
    return _spoiled(persons, PERSON_METRICS, "customer_unique_id", last_order_date=early)


@query
def invalid_metric_check(t: Tables) -> DataFrame:
    """Metrics of spoiled product and person marts that are missing, negative or contradict each other."""
    products = materialize(gold_products_narrow(t), "products")

    def missing_or_below(column: str, least: int) -> Column:
        return F.col(column).isNull() | (F.col(column) < least)

    bad_delivered = missing_or_below("delivered_orders", 0) | (F.col("delivered_orders") > F.col("total_orders"))
    return quality.union_findings(
        [
            quality.audit(
                _spoiled(products, PRODUCT_METRICS),
                "products",
                [
                    quality.any_invalid("negative_revenue", ["total_product_revenue", "total_freight_revenue"]),
                    quality.any_invalid(
                        "negative_metric",
                        ["total_orders", "total_items_sold", "unique_sellers", "average_item_price"],
                    ),
                ],
            ),
            quality.audit(
                _spoiled_persons(t),
                "persons",
                [
                    quality.Rule("invalid_total_orders", "total_orders", missing_or_below("total_orders", 1)),
                    quality.Rule("invalid_delivered_orders", "delivered_orders", bad_delivered),
                    quality.Rule("invalid_total_items", "total_items", missing_or_below("total_items", 0)),
                    quality.Rule("invalid_total_spend", "total_spend", missing_or_below("total_spend", 0)),
                    quality.Rule(
                        "invalid_average_order_value", "average_order_value", missing_or_below("average_order_value", 0)
                    ),
                    quality.Rule(
                        "invalid_order_dates",
                        "first_order_date",
                        F.col("first_order_date").isNull()
                        | F.col("last_order_date").isNull()
                        | (F.col("first_order_date") > F.col("last_order_date")),
                    ),
                ],
            ),
        ]
    )


@query
def numeric_summary(t: Tables) -> DataFrame:
    return quality.numeric_summary(
        gold_products_narrow(t),
        ["total_orders", "total_items_sold", "total_product_revenue", "total_freight_revenue", "average_item_price"],
    )


@query
def customer_summary(t: Tables) -> DataFrame:
    return quality.numeric_summary(gold_customers_by_person(t), PERSON_METRICS)


@query
def blank_id_check(t: Tables) -> DataFrame:
    """The feed's ids are NULL in part; customers of orders in processing are empty strings here."""
    customer = F.when(F.col("order_status") == "processing", "").otherwise(F.col("customer_id"))
    return quality.audit(t.roles.orders_feed().withColumn("customer_id", customer), "orders_feed", quality.not_blank("order_id", "customer_id", "order_status"))


# -- quarantine and contracts -------------------------------------------------------


@query
def quarantine_split(t: Tables) -> DataFrame:
    """Both written outputs read back: every input row in exactly one of them."""
    valid, rejected = medallion.run_quarantine(t.roles.orders_feed(), t.scratch("valid"), t.scratch("quarantine"))
    return valid.withColumn("outcome", F.lit("valid")).unionByName(
        rejected.withColumn("outcome", F.lit("quarantined")), allowMissingColumns=True
    )


@query
def quarantine_balance(t: Tables) -> DataFrame:
    return qr.split_balance(qr.flag_orders(t.roles.orders_feed()))


@query
def rejection_counts(t: Tables) -> DataFrame:
    return qr.rejection_counts(qr.flag_orders(t.roles.orders_feed()))


REQUIRED = ["order_id", "customer_id", "order_status", PURCHASED]


@query
def required_columns_gate(t: Tables) -> DataFrame:
    """Raises unless all columns are there, then lets the delivered orders through."""
    gated = contracts.require_columns(t.silver("orders"), REQUIRED)
    checked = contracts.fail_on_nulls(gated, REQUIRED[:3])
    return marts.delivered_orders(checked, REQUIRED)


@query
def fail_fast_null_gate(t: Tables) -> DataFrame:
    return contracts.null_rows(t.roles.orders_feed(), REQUIRED[:3])


def _drifted_orders(t: Tables) -> DataFrame:
    """The order feed with one column renamed away, one added and one retyped to text."""
    purchased = F.when(F.col("order_status") == "pending", "unknown").otherwise(F.col(PURCHASED).cast("string"))
    return t.roles.orders_feed().withColumns(
        {PURCHASED: purchased, "customer_email": F.concat("customer_id", F.lit("@example.org"))}
    )


@query
def schema_diff(t: Tables) -> DataFrame:
    return contracts.schema_diff(_drifted_orders(t), local_time_contract("orders"))


@query
def schema_evolution_gate(t: Tables) -> DataFrame:
    """Decision per incoming variant, the table's rows after it, and incoming values that would not cast."""
    current = t.silver("orders").select(*contract("orders").fieldNames())
    wider = current.withColumn("customer_email", F.concat("customer_id", F.lit("@example.org")))
    as_text = F.when(F.col("order_status") == "pending", "unknown").otherwise(F.col(PURCHASED).cast("string"))
    scenarios = [
        ("no_change", current, False),
        ("new_column_strict", wider, False),
        ("new_column_allowed", wider, True),
        ("type_change", current.withColumn(PURCHASED, as_text), True),
        ("missing_column", current.drop("order_status"), True),
    ]
    results = []
    for name, incoming, allow_new in scenarios:
        reason = contracts.evolution_decision(current.schema, incoming.schema, allow_new)
        after = current if reason else contracts.evolve(current, incoming, allow_new)
        lost = contracts.schema_diff(incoming, current.schema).filter(F.col("issue") == "uncastable")
        sizes = after.agg(F.count("*").alias("rows_after"), F.lit(0).cast("bigint").alias("uncastable"))
        both = sizes.unionByName(lost.select(F.lit(0).cast("bigint").alias("rows_after"), F.col("rows").alias("uncastable")))
        results.append(
            both.agg(F.sum("rows_after").alias("rows_after"), F.sum("uncastable").alias("uncastable_rows")).select(
                F.lit(name).alias("scenario"),
                F.lit(reason or "accepted").alias("decision"),
                "rows_after",
                "uncastable_rows",
            )
        )
    return quality.union_findings(results)


@query
def schema_widening(t: Tables) -> DataFrame:
    """Order values in cents under a contract of narrow types: what widens, what is refused, and what narrow types would lose."""
    orders = t.gold_orders().select("order_id", "total_items", F.rint(F.col("total_order_value") * 100).cast("bigint").alias("cents"), F.struct("order_status", "total_items").alias("detail"))
    expected = StructType.fromDDL("order_id string, total_items int, cents int, detail struct<order_status: int, total_items: int>, note string")
    return contracts.widening_diff(orders.withColumn("cents", F.col("cents") * 1000), expected)


@query
def evolve_widening(t: Tables) -> DataFrame:
    """Item numbers as int and as long in one table, with a detail that only the later batch has."""
    items = t.silver("order_items").select("order_id", "order_item_id", F.struct("product_id").alias("detail"))
    later = items.select("order_id", F.col("order_item_id").cast("bigint") + 5_000_000_000, F.struct("detail.product_id", F.lit("late").alias("origin")))
    both = contracts.evolve_widening(items, later.toDF("order_id", "order_item_id", "detail"), allow_new_columns=True)
    return both.groupBy("detail.origin").agg(F.count("*").alias("rows"), F.sum("order_item_id").alias("item_ids"), F.min("detail.product_id").alias("first_product"))


# -- incremental, late and idempotent -------------------------------------------------


@query
def incremental_since(t: Tables) -> DataFrame:
    return incremental.incremental_summary(t.silver("orders"), PURCHASED, SINCE)


@query
def incremental_rows(t: Tables) -> DataFrame:
    fresh = incremental.since(t.silver("orders"), PURCHASED, SINCE)
    return fresh.select("order_id", "customer_id", "order_status", PURCHASED).orderBy(PURCHASED, "order_id")


@query
def incremental_high_water_mark(t: Tables) -> DataFrame:
    """Three runs: what had arrived by a date, everything since, and nothing new."""
    marks, out = t.scratch("marks"), t.scratch("incremental")
    orders = t.silver("orders").select("order_id", PURCHASED)
    write_mark(t.spark, marks, 0, MARK)
    arrived = orders.filter(F.col(PURCHASED) < incremental.instant(ARRIVED))
    for available in (arrived, orders, orders):
        medallion.run_incremental(available, PURCHASED, marks, out)
    rows = medallion.incremental_rows(t.spark, marks, out)
    return rows.withColumn("run", F.col("run").cast("int"))


@query
def lookback_window(t: Tables) -> DataFrame:
    orders = incremental.lookback(t.silver("orders"), PURCHASED, MARK)
    return orders.select("order_id", "order_status", PURCHASED)


def _in_lookback(t: Tables) -> DataFrame:
    orders = t.silver("orders").select("order_id", "customer_id", "order_status", PURCHASED)
    return incremental.lookback(orders, PURCHASED, MARK)


def _corrections(orders: DataFrame) -> DataFrame:
    """What was shipped is delivered an hour later."""
    return orders.filter(F.col("order_status") == "shipped").withColumns(
        {"order_status": F.lit("delivered"), PURCHASED: F.col(PURCHASED) + F.make_dt_interval(F.lit(0), F.lit(1))}
    )


def _replays(t: Tables) -> DataFrame:
    """Everything in the lookback window once more, and a later correction of what was shipped."""
    again = _in_lookback(t)
    return again.unionByName(_corrections(again))


@query
def late_dedup(t: Tables) -> DataFrame:
    orders = t.silver("orders").select("order_id", "customer_id", "order_status", PURCHASED)
    return incremental.late_dedup(orders, _replays(t), "order_id", PURCHASED, MARK)


@query
def late_dedup_mark(t: Tables) -> DataFrame:
    return incremental.next_mark(late_dedup(t), PURCHASED, MARK)


@query
def latest_order_per_customer(t: Tables) -> DataFrame:
    orders = t.silver("orders").select("customer_id", "order_id", "order_status", PURCHASED)
    return incremental.latest_per_key(orders, "customer_id", PURCHASED)


@query
def idempotent_batch(t: Tables) -> DataFrame:
    """The same batch written twice; the table holds it once."""
    orders = t.silver("orders").select("order_id", "customer_id", "order_status", PURCHASED)
    return _batches(t, "idempotent", orders, orders)


@query
def idempotent_batch_emptied_day(t: Tables) -> DataFrame:
    """A rerun whose source has lost a whole day; the table loses it too."""
    orders = t.silver("orders").select("order_id", "customer_id", "order_status", PURCHASED)
    return _batches(t, "emptied", orders, orders.filter(F.to_date(PURCHASED) != F.lit(EMPTIED).cast("date")))


def _batches(t: Tables, label: str, *sources: DataFrame) -> DataFrame:
    path = t.scratch(label)
    for source in sources:
        table = medallion.run_idempotent_batch(source, PURCHASED, path, *BATCH)
    return table.withColumn("day", F.col("day").cast("string"))


@query
def stream_late_dedup(t: Tables) -> DataFrame:
    """The rows of ``late_dedup`` from a stream of five arrivals: corrections come before the orders, and both again after."""
    inbox, versions, checkpoint = t.scratch("late-in"), t.scratch("late-versions"), t.scratch("late-checkpoint")
    orders = _in_lookback(t)
    for arrival in (_corrections(orders), orders, orders, _corrections(orders), orders):
        arrival.write.mode("append").parquet(inbox)
        stream = streams.parquet_stream(t.spark, inbox, orders.schema)
        streams.run_newest_versions(stream, "order_id", PURCHASED, versions, checkpoint, buckets=8)
    return streams.newest_versions(t.spark, versions, orders.schema)


@query
def stream_incremental_ingest(t: Tables) -> DataFrame:
    """Two arrivals of order files, each ingested once; batch times and numbers are left out."""
    inbox, valid, rejected = t.scratch("orders-in"), t.scratch("orders-valid"), t.scratch("orders-quarantine")
    checkpoint = t.scratch("orders-checkpoint")
    feed = t.roles.orders_feed()
    first = F.coalesce(F.col("order_status") == "delivered", F.lit(False))
    for arrival in (feed.filter(first), feed.filter(~first)):
        arrival.write.mode("append").parquet(inbox)
        streams.run_order_ingest(
            streams.parquet_stream(t.spark, inbox, feed.schema), valid, rejected, checkpoint
        )
    columns = feed.columns
    return (
        t.spark.read.parquet(valid)
        .select(*columns, F.lit("").alias("rejection_reason"))
        .unionByName(t.spark.read.parquet(rejected).select(*columns, "rejection_reason"))
    )


# -- layout and skew --------------------------------------------------------------------


@query
def partition_profile(t: Tables) -> DataFrame:
    """Rows per partition after hashing on a skewed key; which partition a key lands in is Spark's."""
    return layout.partition_profile(t.silver("orders").repartition(8, "order_status"))


@query
def repartition_layouts(t: Tables) -> DataFrame:
    """Partition counts and rows of each layout; hashing on few keys leaves partitions empty."""
    orders = t.silver("orders")
    layouts = {
        "repartition_4": orders.repartition(4),
        "repartition_12": orders.repartition(12),
        "coalesce_4": orders.repartition(12).coalesce(4),
        "coalesce_2": orders.repartition(4).coalesce(2),
        "coalesce_cannot_grow": orders.repartition(4).coalesce(12),
    }
    parts = [layout.layout_summary(df, name).select("layout", "partitions", "rows") for name, df in layouts.items()]
    return quality.union_findings(parts)


@query
def compact_table(t: Tables) -> DataFrame:
    """Fifty small files rewritten by size, in place."""
    small, compacted = t.scratch("small-files"), t.scratch("compacted")
    for path in (small, compacted):
        write_table(t.silver("orders"), path, files=50)
    layout.compact_table(t.spark, compacted)
    sides = [layout.file_layout(t.spark, p).select("files", "rows") for p in (small, compacted)]
    return quality.union_findings(
        side.withColumn("state", F.lit(state)) for side, state in zip(sides, ("small", "compacted"))
    )


@query
def compact_partitioned_table(t: Tables) -> DataFrame:
    """Orders by status in many files each; compaction is not told of the partitions and keeps them."""
    path = t.scratch("compacted-by-status")
    write_table(t.silver("orders"), path, files=20, partition_by="order_status")
    layout.compact_table(t.spark, path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("order_status").agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files"), F.count("*").alias("rows"), F.min("order_id").alias("first_order")
    )


@query
def key_skew_profile(t: Tables) -> DataFrame:
    return layout.key_skew_profile(t.silver("order_items"), "seller_id", k=10)


@query
def skewed_join(t: Tables) -> DataFrame:
    """Items to sellers, the sellers above one percent of the items salted."""
    items = t.silver("order_items").select("order_id", "order_item_id", "seller_id", "price")
    return joins.salted_join(items, t.silver("sellers"), "seller_id", "inner", spread_by=["order_id"])


@query
def skewed_join_unmatched(t: Tables) -> DataFrame:
    """Reviews to orders; reviews without an order id are kept and spread."""
    reviews = t.silver("order_reviews").select("review_id", "order_id", "review_score")
    orders = t.silver("orders").select("order_id", "order_status")
    return joins.salted_join(reviews, orders, "order_id", "left", spread_by=["review_id"])


@query
def skewed_join_hot_status(t: Tables) -> DataFrame:
    """Orders next to the figures of their status; each status holds a large share of the orders and is cut into parts."""
    orders = t.silver("orders").select("order_id", "order_status", PURCHASED)
    per_status = orders.groupBy("order_status").agg(
        F.count("*").alias("status_orders"), F.min(PURCHASED).alias("status_since"), F.max(PURCHASED).alias("status_until")
    )
    return joins.salted_join(orders, per_status, "order_status", "left", spread_by=["order_id"])


@query
def filter_before_shuffle(t: Tables) -> DataFrame:
    return marts.delivered_orders(t.silver("orders"), ["order_id", "customer_id", PURCHASED]).repartition("customer_id")


@query
def shared_subplan(t: Tables) -> DataFrame:
    """One stored intermediate feeds two reports, so its joins run once."""
    delivered = materialize(
        marts.delivered_orders(t.enriched(), ["customer_unique_id", "customer_state", "total_order_value"]), "delivered"
    )
    reports = [
        delivered.groupBy(F.col(c).alias("key")).agg(
            F.count("*").alias("orders"), marts.money_sum("total_order_value").alias("total_spend")
        )
        for c in ("customer_unique_id", "customer_state")
    ]
    return quality.union_findings(
        r.withColumn("report", F.lit(name)) for r, name in zip(reports, ("person", "state"))
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Name to ``(spark, sf_dir) -> DataFrame`` for every query."""

    def bind(fn: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Tables(spark, sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}
