"""Rule-based split of an order feed into valid and quarantined rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.sources.contracts import ORDER_STATUSES

# The flags of the rules, in their order, and the reason that each gives.
FLAGS = (
    "invalid_order_id",
    "invalid_customer_id",
    "invalid_status",
    "invalid_purchase_timestamp",
    "invalid_delivery_date",
)
REASONS = {
    "invalid_order_id": "NULL_ORDER_ID",
    "invalid_customer_id": "NULL_CUSTOMER_ID",
    "invalid_status": "INVALID_ORDER_STATUS",
    "invalid_purchase_timestamp": "NULL_PURCHASE_TIMESTAMP",
    "invalid_delivery_date": "DELIVERY_BEFORE_PURCHASE",
}
MISSING_STATUS = "NULL_ORDER_STATUS"


def flag_orders(feed: DataFrame) -> DataFrame:
    """Add one flag per rule and the text of all reasons, in rule order.

    Every flag is true or false, never NULL, so a row is either valid or
    quarantined: a missing status is invalid under its own reason.
    """
    status = F.col("order_status")
    unknown = F.coalesce(~status.isin(ORDER_STATUSES), F.lit(True))
    early = F.coalesce(F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp"), F.lit(False))
    conditions = {
        "invalid_order_id": F.col("order_id").isNull(),
        "invalid_customer_id": F.col("customer_id").isNull(),
        "invalid_status": unknown,
        "invalid_purchase_timestamp": F.col("order_purchase_timestamp").isNull(),
        "invalid_delivery_date": early,
    }
    texts = {flag: F.lit(text) for flag, text in REASONS.items()}
    texts["invalid_status"] = F.when(status.isNull(), MISSING_STATUS).otherwise(REASONS["invalid_status"])
    reasons = F.concat_ws(", ", *[F.when(F.col(flag), texts[flag]) for flag in FLAGS])
    return feed.withColumns(conditions).withColumn("rejection_reason", reasons)


def _invalid() -> Column:
    return reduce(lambda a, b: a | b, [F.col(f) for f in FLAGS])


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~_invalid()).drop(*FLAGS, "rejection_reason")


def quarantined_rows(flagged: DataFrame, at: Column | None = None) -> DataFrame:
    """Rejected rows with their flags and reasons; ``at`` is NULL unless the job knows the time."""
    at = F.lit(None) if at is None else at
    return flagged.filter(_invalid()).withColumn("quarantine_timestamp", at.cast("timestamp"))


def split_balance(flagged: DataFrame) -> DataFrame:
    """Input, valid and quarantined row counts; the last two must add up to the first."""
    return flagged.agg(
        F.count("*").alias("input_rows"),
        F.count_if(~_invalid()).alias("valid_rows"),
        F.count_if(_invalid()).alias("quarantined_rows"),
    ).withColumn("balanced", F.col("valid_rows") + F.col("quarantined_rows") == F.col("input_rows"))


def rejection_counts(flagged: DataFrame) -> DataFrame:
    """Rows per combination of reasons."""
    return flagged.filter(_invalid()).groupBy("rejection_reason").agg(F.count("*").alias("rows"))
