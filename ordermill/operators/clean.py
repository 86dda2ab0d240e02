"""Cleaning of the nine source tables: one narrow projection each, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.exact import finite, round2
from ordermill.functions.text import keep_if, tidy, tidy_lower, tidy_upper


def clean_orders(raw: DataFrame) -> DataFrame:
    """Trim ids, normalise the status, add calendar delivery days and a delivered flag.

    The flag is false, not NULL, when the status is missing.
    """
    status = tidy_lower("order_status")
    days = F.date_diff(F.to_date("order_delivered_customer_date"), F.to_date("order_purchase_timestamp"))
    return raw.withColumns(
        {
            "order_id": tidy("order_id"),
            "customer_id": tidy("customer_id"),
            "order_status": status,
            "delivery_days": days,
            "is_delivered": F.coalesce(status == "delivered", F.lit(False)),
        }
    )


def clean_customers(raw: DataFrame) -> DataFrame:
    ids = {c: tidy(c) for c in ("customer_id", "customer_unique_id", "customer_city")}
    return raw.withColumns({**ids, "customer_state": tidy_upper("customer_state")})


def clean_order_items(raw: DataFrame) -> DataFrame:
    """Trim ids and round money; a NaN or infinite amount becomes NULL, which the audit counts."""
    ids = {c: tidy(c) for c in ("order_id", "product_id", "seller_id")}
    return raw.withColumns({**ids, **{c: round2(finite(c)) for c in ("price", "freight_value")}})


def clean_order_payments(raw: DataFrame) -> DataFrame:
    """Installment counts below one carry no information and become NULL."""
    return raw.withColumns(
        {
            "order_id": tidy("order_id"),
            "payment_type": tidy_lower("payment_type"),
            "payment_installments": keep_if("payment_installments", F.col("payment_installments") > 0),
            "payment_value": round2(finite("payment_value")),
        }
    )


def clean_products(raw: DataFrame) -> DataFrame:
    """Dimensions must be positive and text or photo counts non-negative, else NULL."""
    positive = ("product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    non_negative = ("product_name_lenght", "product_description_lenght", "product_photos_qty")
    return raw.withColumns(
        {
            "product_id": tidy("product_id"),
            "product_category_name": tidy_lower("product_category_name"),
            **{c: keep_if(c, F.col(c) > 0) for c in positive},
            **{c: keep_if(c, F.col(c) >= 0) for c in non_negative},
        }
    )


def clean_sellers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "seller_id": tidy("seller_id"),
            "seller_city": tidy("seller_city"),
            "seller_state": tidy_upper("seller_state"),
        }
    )


def clean_order_reviews(raw: DataFrame) -> DataFrame:
    """Scores outside 1 to 5 become NULL; the review itself stays."""
    text = ("review_id", "order_id", "review_comment_title", "review_comment_message")
    score = keep_if("review_score", F.col("review_score").between(1, 5))
    return raw.withColumns({**{c: tidy(c) for c in text}, "review_score": score})


def clean_geolocation(raw: DataFrame) -> DataFrame:
    degrees = {c: finite(c) for c in ("geolocation_lat", "geolocation_lng")}
    return raw.withColumns(
        {**degrees, "geolocation_city": tidy("geolocation_city"), "geolocation_state": tidy_upper("geolocation_state")}
    )


def clean_category_translation(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: tidy_lower(c) for c in ("product_category_name", "product_category_name_english")})


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": clean_customers,
    "geolocation": clean_geolocation,
    "order_items": clean_order_items,
    "order_payments": clean_order_payments,
    "order_reviews": clean_order_reviews,
    "orders": clean_orders,
    "products": clean_products,
    "sellers": clean_sellers,
    "category_translation": clean_category_translation,
}
