"""Cleaning rules on edge rows."""

from datetime import datetime as dt

from conftest import rows

from ordermill.operators import clean
from ordermill.sources.contracts import SOURCE_TABLES, contract, local_time_contract


def orders(spark, *specs):
    full = [(f" o{i} ", " c ", status, bought, None, None, delivered, None) for i, (status, bought, delivered) in enumerate(specs)]
    return clean.clean_orders(spark.createDataFrame(full, nullable("orders")))


def nullable(table):
    schema = local_time_contract(table)
    for field in schema:
        field.nullable = True
    return schema


def test_delivery_days_are_calendar_days(spark):
    df = orders(
        spark,
        ("delivered", dt(2020, 1, 1, 23, 50), dt(2020, 1, 2, 0, 10)),
        ("delivered", dt(2020, 1, 1, 0, 10), dt(2020, 1, 1, 23, 50)),
        ("delivered", dt(2020, 1, 3), dt(2020, 1, 1)),
        ("shipped", dt(2020, 1, 1), None),
    )
    assert rows(df.select("order_id", "delivery_days"), "order_id") == [("o0", 1), ("o1", 0), ("o2", -2), ("o3", None)]


def test_delivered_flag_is_never_null(spark):
    df = orders(spark, (" DELIVERED ", dt(2020, 1, 1), None), (None, dt(2020, 1, 1), None), ("", dt(2020, 1, 1), None))
    assert rows(df.select("order_status", "is_delivered"), "order_id") == [("delivered", True), (None, False), ("", False)]


def test_payments(spark):
    raw = spark.createDataFrame(
        [("a", 1, " Credit_Card", n, 10.005) for n in (0, -1, 1, None)], nullable("order_payments")
    )
    cleaned = clean.clean_order_payments(raw)
    assert [r["payment_installments"] for r in cleaned.collect()] == [None, None, 1, None]
    assert {(r["payment_type"], r["payment_value"]) for r in cleaned.collect()} == {("credit_card", 10.01)}


def test_products(spark):
    raw = spark.createDataFrame([(" p ", " Toys ", -1, 0, -2, 0, -3, 1, None)], nullable("products"))
    assert rows(clean.clean_products(raw)) == [("p", "toys", None, 0, None, None, None, 1, None)]


def test_review_scores(spark):
    raw = spark.createDataFrame([("r", "o", s, " t ", " m ", None, None) for s in (0, 1, 5, 6, None)], nullable("order_reviews"))
    cleaned = clean.clean_order_reviews(raw).collect()
    assert [r["review_score"] for r in cleaned] == [None, 1, 5, None, None]
    assert {(r["review_comment_title"], r["review_comment_message"]) for r in cleaned} == {("t", "m")}


def test_states_are_upper_case_and_text_is_trimmed(spark):
    customers = clean.clean_customers(spark.createDataFrame([(" a ", " p ", 1, " são paulo ", " sp ")], nullable("customers")))
    assert rows(customers) == [("a", "p", 1, "são paulo", "SP")]
    sellers = clean.clean_sellers(spark.createDataFrame([(" s ", 1, " x ", "rj")], nullable("sellers")))
    assert rows(sellers) == [("s", 1, "x", "RJ")]


def test_cleaning_keeps_every_row_and_column(spark):
    assert set(clean.CLEANERS) == set(SOURCE_TABLES)
    for table in SOURCE_TABLES:
        raw = spark.createDataFrame([], nullable(table))
        assert clean.CLEANERS[table](raw).columns[: len(raw.columns)] == contract(table).fieldNames()
