"""The audit suites over the cleaned tables and over the marts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators import quality as q
from ordermill.operators.marts import items_with_category
from ordermill.sources.contracts import CRITICAL_COLUMNS, SOURCE_TABLES, UNIQUE_KEYS

_SALES = ("total_items_sold", "unique_orders")
_REVENUE = ("total_product_revenue", "total_freight_revenue", "average_item_price")


class ValidationError(RuntimeError):
    """At least one check of a suite failed."""


def audit_silver(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs in critical columns, surplus rows per key and value ranges of all nine tables."""
    business = {
        "orders": q.not_negative("delivery_days"),
        "order_items": q.not_null("price", "freight_value") + q.not_negative("price", "freight_value"),
        "order_payments": q.not_negative("payment_value"),
        "products": q.positive("product_weight_g"),
        "geolocation": [q.within("geolocation_lat", -90, 90), q.within("geolocation_lng", -180, 180)],
        "order_reviews": [q.within("review_score", 1, 5)],
    }
    return q.union_findings(
        q.audit(
            tables[t],
            t,
            q.not_null(*CRITICAL_COLUMNS[t]) + business.get(t, []),
            key=UNIQUE_KEYS.get(t),
            key_checks=("surplus_rows",),
        )
        for t in SOURCE_TABLES
    )


def gold_expectations(silver: Mapping[str, DataFrame], lines: DataFrame | None = None) -> DataFrame:
    """Rows each mart must have, counted from the cleaned tables it is built from; ``lines`` stands in for the items."""
    sold = (silver["order_items"] if lines is None else lines).select("product_id").distinct()
    categories = items_with_category(sold, silver["products"]).select("product_category_name").distinct()
    return q.row_counts({**{t: silver[t] for t in ("orders", "customers", "products", "sellers")}, "category": categories})


def validate_gold(gold: Mapping[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Every check over the eight marts as one findings table with a verdict per row.

    The marts are read once each (orders three times, over different columns),
    so pass stored tables rather than plans.
    """
    keyed = ("duplicate_key", "null_key")
    orders, customers = gold["orders"], gold["customers"]
    row_counts = q.row_counts({t: gold[t] for t in ("orders", "customers", "products", "sellers", "category")})
    revenue = q.revenue_reconciliation(orders).select(
        F.lit("orders").alias("table"),
        F.lit("reconciliation").alias("check"),
        F.lit("total_order_value").alias("column"),
        F.when(F.col("passed"), 0).otherwise(1).cast("bigint").alias("failures"),
    )
    integrity = q.orphan_check(orders, customers, "customer_id", "orders -> customers").select(
        F.lit("orders").alias("table"),
        F.lit("orphan").alias("check"),
        F.lit("customer_id").alias("column"),
        F.col("orphan_keys").alias("failures"),
    )
    findings = q.union_findings(
        [
            q.row_count_check(row_counts, expected),
            q.audit(
                orders,
                "orders",
                q.not_negative("product_revenue", "freight_revenue", "total_order_value")
                + [q.total_is_sum("total_order_value", "product_revenue", "freight_revenue")],
                "order_id",
                keyed,
            ),
            q.audit(
                customers,
                "customers",
                q.not_negative("total_orders", "total_spent", "average_order_value", "total_items_purchased")
                + [q.average_is_ratio("average_order_value", "total_spent", "total_orders")],
                "customer_id",
                keyed,
            ),
            q.audit(
                gold["products"], "products", q.not_negative(*_SALES, "unique_sellers", *_REVENUE), "product_id", keyed
            ),
            q.audit(
                gold["sellers"], "sellers", q.not_negative(*_SALES, "unique_products", *_REVENUE), "seller_id", keyed
            ),
            q.audit(gold["category"], "category", q.not_negative(*_SALES, "unique_products", *_REVENUE)),
            q.audit(
                gold["reviews"],
                "reviews",
                q.not_negative("review_count", "average_response_hours") + [q.within("average_review_score", 1, 5)],
                "order_id",
                keyed,
            ),
            q.audit(
                gold["payments"],
                "payments",
                q.not_negative(
                    "payment_count",
                    "total_payment_value",
                    "average_payment_value",
                    "total_installments",
                    "max_installments",
                    "unique_payment_types",
                ),
                "order_id",
                keyed,
            ),
            q.audit(
                gold["geolocation"],
                "geolocation",
                [q.within("average_latitude", -90, 90), q.within("average_longitude", -180, 180)],
                "geolocation_zip_code_prefix",
                keyed,
            ),
            integrity,
            revenue,
        ]
    )
    return findings.withColumn("passed", F.col("failures") == 0)


def raise_on_failure(findings: DataFrame) -> DataFrame:
    """Abort the job when any finding failed; names all failed checks."""
    failed = findings.filter(F.col("failures") > 0).orderBy("table", "check", "column").collect()
    if failed:
        raise ValidationError("; ".join(f"{r['table']}.{r['column']} {r['check']}={r['failures']}" for r in failed))
    return findings
