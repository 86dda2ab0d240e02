"""Table contracts: column names, types and keys of the nine source tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# The source tables' column names and types.
_DDL = {
    "customers": """
        customer_id STRING NOT NULL, customer_unique_id STRING NOT NULL,
        customer_zip_code_prefix INT NOT NULL, customer_city STRING NOT NULL,
        customer_state STRING NOT NULL""",
    "geolocation": """
        geolocation_zip_code_prefix INT NOT NULL, geolocation_lat DOUBLE NOT NULL,
        geolocation_lng DOUBLE NOT NULL, geolocation_city STRING NOT NULL,
        geolocation_state STRING NOT NULL""",
    "order_items": """
        order_id STRING NOT NULL, order_item_id INT NOT NULL, product_id STRING NOT NULL,
        seller_id STRING NOT NULL, shipping_limit_date TIMESTAMP NOT NULL,
        price DOUBLE NOT NULL, freight_value DOUBLE NOT NULL""",
    "order_payments": """
        order_id STRING NOT NULL, payment_sequential INT NOT NULL, payment_type STRING NOT NULL,
        payment_installments INT NOT NULL, payment_value DOUBLE NOT NULL""",
    "order_reviews": """
        review_id STRING NOT NULL, order_id STRING NOT NULL, review_score INT,
        review_comment_title STRING, review_comment_message STRING,
        review_creation_date TIMESTAMP, review_answer_timestamp TIMESTAMP""",
    "orders": """
        order_id STRING NOT NULL, customer_id STRING NOT NULL, order_status STRING NOT NULL,
        order_purchase_timestamp TIMESTAMP NOT NULL, order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP NOT NULL""",
    "products": """
        product_id STRING NOT NULL, product_category_name STRING, product_name_lenght INT,
        product_description_lenght INT, product_photos_qty INT, product_weight_g INT,
        product_length_cm INT, product_height_cm INT, product_width_cm INT""",
    "sellers": """
        seller_id STRING NOT NULL, seller_zip_code_prefix INT NOT NULL,
        seller_city STRING NOT NULL, seller_state STRING NOT NULL""",
    "category_translation": """
        product_category_name STRING NOT NULL, product_category_name_english STRING NOT NULL""",
}

SOURCE_TABLES = tuple(_DDL)

# Tables with comment columns, whose values may contain line breaks.
FREE_TEXT_TABLES = frozenset({"order_reviews"})


def contract(table: str) -> StructType:
    """The declared schema of a source table."""
    return StructType.fromDDL(_DDL[table])


def columns(table: str) -> list[str]:
    """The column names of a source table, without a session."""
    return [column.split()[0] for column in _DDL[table].split(",")]


def local_time_contract(table: str) -> StructType:
    """The same schema with zone-free timestamps, for sources that carry no zone."""
    return StructType.fromDDL(_DDL[table].replace("TIMESTAMP", "TIMESTAMP_NTZ"))


# Unique keys, and the columns that must not be NULL.
UNIQUE_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "products": "product_id",
    "sellers": "seller_id",
    "category_translation": "product_category_name",
}

CRITICAL_COLUMNS = {
    "customers": ["customer_id", "customer_unique_id"],
    "geolocation": [
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ],
    "order_items": ["order_id", "product_id", "seller_id"],
    "order_payments": ["order_id", "payment_type", "payment_value"],
    "order_reviews": ["review_id"],
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp"],
    "products": ["product_id"],
    "sellers": ["seller_id", "seller_city", "seller_state"],
    "category_translation": ["product_category_name", "product_category_name_english"],
}

# The order statuses the business knows.
ORDER_STATUSES = [
    "approved",
    "canceled",
    "created",
    "delivered",
    "invoiced",
    "processing",
    "shipped",
    "unavailable",
]
