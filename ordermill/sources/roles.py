"""Bind the generic star-schema test tables to the order-analytics source tables.

The bound tables carry defects on purpose (padded text, wrong case, values out
of range, NULL keys), derived row by row from the given data, so that every
cleaning rule and audit has something to find.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.functions.exact import cents


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _hours_after(ts: str, hours: Column) -> Column:
    return F.col(ts) + F.make_dt_interval(F.lit(0), hours.cast("int"))


class Roles:
    """Raw source tables of one test directory; every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def raw(self, name: str) -> DataFrame:
        bind: Callable[[], DataFrame] = getattr(self, f"_{name}")
        return bind()

    def _orders(self) -> DataFrame:
        status = (
            F.when(F.col("o_orderstatus") == "F", F.lit(" Delivered "))
            .when(F.col("o_orderstatus") == "O", F.lit("SHIPPED"))
            .otherwise(F.lit(" Pending"))
        )
        return self.table("orders").select(
            F.concat(F.lit(" "), _text("o_orderkey")).alias("order_id"),
            F.concat(_text("o_custkey"), F.lit(" ")).alias("customer_id"),
            status.alias("order_status"),
            F.col("o_orderdate").alias("order_purchase_timestamp"),
            _hours_after("o_orderdate", F.col("o_custkey") % 60 - 6).alias("order_approved_at"),
            F.when(
                F.col("o_orderstatus") != "P", _hours_after("o_orderdate", (F.col("o_custkey") % 9) * 24 + 5)
            ).alias("order_delivered_carrier_date"),
            F.when(F.col("o_orderstatus") == "F", _hours_after("o_orderdate", F.col("o_orderkey") % 960 - 47)).alias(
                "order_delivered_customer_date"
            ),
            _hours_after("o_orderdate", F.lit(720)).alias("order_estimated_delivery_date"),
        )

    def orders_feed(self) -> DataFrame:
        """An order feed before quality control: NULL keys, NULL and unknown statuses, early deliveries."""
        status = (
            F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit(None))
            .when(F.col("o_orderstatus") == "F", F.lit("delivered"))
            .when(F.col("o_orderstatus") == "O", F.lit("shipped"))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("pending"))
            .otherwise(F.lit("processing"))
        )
        unassigned = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "4-NOT SPECIFIED")
        return self.table("orders").select(
            F.when(F.col("o_totalprice") >= 5000, _text("o_orderkey")).alias("order_id"),
            F.when(~unassigned, _text("o_custkey")).alias("customer_id"),
            status.alias("order_status"),
            F.when(F.col("o_totalprice") <= 480000, F.col("o_orderdate")).alias("order_purchase_timestamp"),
            _hours_after("o_orderdate", F.col("o_custkey") % 60 - 6).alias("order_approved_at"),
            F.when(F.col("o_orderstatus") == "F", _hours_after("o_orderdate", F.col("o_orderkey") % 960 - 47)).alias(
                "order_delivered_customer_date"
            ),
        )

    def _customers(self) -> DataFrame:
        return self.table("customer").select(
            F.concat(F.lit(" "), _text("c_custkey")).alias("customer_id"),
            F.concat(F.lit("p"), F.call_function("div", "c_custkey", F.lit(2)).cast("string"), F.lit(" ")).alias(
                "customer_unique_id"
            ),
            F.col("c_nationkey").alias("customer_zip_code_prefix"),
            F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("customer_city"),
            F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("customer_state"),
        )

    def _order_items(self) -> DataFrame:
        freight = F.round(F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(4,2)"), 2)
        return self.table("lineitem").select(
            F.concat(_text("l_orderkey"), F.lit(" ")).alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.concat(F.lit(" "), _text("l_partkey")).alias("product_id"),
            F.concat(_text("l_suppkey"), F.lit(" ")).alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            F.col("l_extendedprice").alias("price"),
            freight.cast("double").alias("freight_value"),
        )

    def _order_payments(self) -> DataFrame:
        return self.table("lineitem").select(
            F.concat(F.lit(" "), _text("l_orderkey")).alias("order_id"),
            F.col("l_linenumber").alias("payment_sequential"),
            F.concat(F.lit(" "), F.col("l_returnflag")).alias("payment_type"),
            (F.col("l_quantity").cast("int") - 10).alias("payment_installments"),
            F.col("l_extendedprice").alias("payment_value"),
        )

    def _products(self) -> DataFrame:
        return self.table("part").select(
            F.concat(F.lit(" "), _text("p_partkey")).alias("product_id"),
            F.concat(F.nullif(F.col("p_type"), F.lit("LARGE")), F.lit(" ")).alias("product_category_name"),
            (F.length("p_name") - 9).alias("product_name_lenght"),
            (F.col("p_size") * 10 - 20).alias("product_description_lenght"),
            (F.col("p_size") % 7 - 1).alias("product_photos_qty"),
            (F.col("p_size") - 5).alias("product_weight_g"),
            (F.col("p_size") - 3).alias("product_length_cm"),
            (F.col("p_size") - 2).alias("product_height_cm"),
            (F.col("p_size") - 4).alias("product_width_cm"),
        )

    def _sellers(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return (
            self.table("supplier")
            .join(nation, "s_nationkey", "left")
            .select(
                F.concat(_text("s_suppkey"), F.lit(" ")).alias("seller_id"),
                F.col("s_nationkey").alias("seller_zip_code_prefix"),
                F.concat(F.lit(" "), F.col("s_name")).alias("seller_city"),
                F.concat(F.lit(" "), F.lower("n_name")).alias("seller_state"),
            )
        )

    def _order_reviews(self) -> DataFrame:
        return self.table("events").select(
            F.concat(_text("event_id"), F.lit(" ")).alias("review_id"),
            F.nullif(F.col("event_id") % 1500, F.lit(0)).cast("string").alias("order_id"),
            (F.col("event_id") % 7).cast("int").alias("review_score"),
            F.concat(F.lit(" "), F.col("event_type")).alias("review_comment_title"),
            F.col("props").alias("review_comment_message"),
            F.col("ts").alias("review_creation_date"),
            _hours_after("ts", F.col("event_id") % 48 - 2).alias("review_answer_timestamp"),
        )

    def _geolocation(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
            (cents("c_acctbal") / F.lit(10000.0)).alias("geolocation_lat"),
            (cents("c_acctbal") / F.lit(5000.0)).alias("geolocation_lng"),
            F.concat(F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")), F.lit(" ")).alias("geolocation_city"),
            F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("geolocation_state"),
        )

    def _category_translation(self) -> DataFrame:
        return (
            self.table("part")
            .filter(F.col("p_type") != "PROMO")
            .select("p_type")
            .distinct()
            .select(
                F.concat(F.lit(" "), F.col("p_type")).alias("product_category_name"),
                F.concat(F.lit("EN_"), F.col("p_type"), F.lit(" ")).alias("product_category_name_english"),
            )
        )
