"""Quarantine: each rule, reason order, and no row lost."""

from datetime import datetime as dt

import pytest
from conftest import rows

from ordermill.operators import quarantine as qr
from ordermill.plans.medallion import run_quarantine
from ordermill.sources.contracts import ORDER_STATUSES

FEED = """order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz,
    order_approved_at timestamp_ntz, order_delivered_customer_date timestamp_ntz"""
T0, T1 = dt(2020, 1, 1), dt(2020, 1, 2)


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [
            ("ok", "c", "delivered", T0, None, T1),
            ("same", "c", "delivered", T0, None, T0),
            (None, "c", "shipped", T0, None, None),
            ("r2", None, "shipped", T0, None, None),
            ("r3", "c", "INVALID", T0, None, None),
            ("r3n", "c", None, T0, None, None),
            ("r4", "c", "shipped", None, None, T1),
            ("r5", "c", "delivered", T1, None, T0),
            (None, None, None, None, None, None),
        ],
        FEED,
    )


def test_reasons(feed):
    got = {(r["order_id"], r["rejection_reason"]) for r in qr.quarantined_rows(qr.flag_orders(feed)).collect()}
    assert got == {
        (None, "NULL_ORDER_ID"),
        ("r2", "NULL_CUSTOMER_ID"),
        ("r3", "INVALID_ORDER_STATUS"),
        ("r3n", "NULL_ORDER_STATUS"),
        ("r4", "NULL_PURCHASE_TIMESTAMP"),
        ("r5", "DELIVERY_BEFORE_PURCHASE"),
        (None, "NULL_ORDER_ID, NULL_CUSTOMER_ID, NULL_ORDER_STATUS, NULL_PURCHASE_TIMESTAMP"),
    }


def test_flags_are_never_null_and_counts_balance(feed):
    flagged = qr.flag_orders(feed)
    assert all(r[f] is not None for r in flagged.collect() for f in qr.FLAGS)
    assert rows(qr.split_balance(flagged)) == [(9, 2, 7, True)]


def test_written_outputs(feed, tmp_path):
    valid, rejected = run_quarantine(feed, str(tmp_path / "valid"), str(tmp_path / "quarantine"))
    assert valid.columns == feed.columns
    assert rows(valid.select("order_id"), "order_id") == [("ok",), ("same",)]
    assert rejected.count() == 7
    assert rejected.filter("quarantine_timestamp is not null").count() == 0


def test_every_known_status_is_valid(spark):
    df = spark.createDataFrame([(s, "c", s, T0, None, None) for s in ORDER_STATUSES], FEED)
    assert qr.valid_rows(qr.flag_orders(df)).count() == 8
