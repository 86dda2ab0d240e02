"""A third of all rows in one group, much of it exact copies: results against brute force in pandas."""

from datetime import datetime as dt
from datetime import timedelta

import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermill.operators import incremental, joins, layout, marts, quality

N = 30_000


@pytest.fixture(scope="module")
def items(spark):
    """One order, product and seller hold a third of the items; half of those rows are identical."""
    hot = F.col("id") % 3 == 0
    copy = hot & (F.col("id") % 2 == 0)

    def key(name, n):
        return F.when(hot, F.lit(f"hot-{name}")).otherwise(F.concat(F.lit(name), (F.col("id") % n).cast("string")))

    return spark.range(N, numPartitions=8).select(
        key("o", 7001).alias("order_id"),
        F.when(copy, "hot-p").otherwise(F.concat(F.lit("p"), (F.col("id") % 211).cast("string"))).alias("product_id"),
        key("s", 53).alias("seller_id"),
        F.when(copy, 9.99).otherwise((F.col("id") % 1000) / 100).alias("price"),
        F.when(copy, 0.01).otherwise((F.col("id") % 77) / 100).alias("freight_value"),
        F.col("id").alias("row"),
    )


@pytest.fixture(scope="module")
def pdf(items):
    return pd.DataFrame([r.asDict() for r in items.collect()])


def test_order_metrics(items, pdf):
    cents = pdf.assign(p=(pdf.price * 100).round().astype(int), f=(pdf.freight_value * 100).round().astype(int))
    g = cents.groupby("order_id")
    want = sorted(
        zip(g.size().index, g.size(), g.product_id.nunique(), g.seller_id.nunique(), g.p.sum() / 100.0, g.f.sum() / 100.0)
    )
    assert rows(marts.order_item_metrics(items), "order_id") == want


def test_latest_row_per_hot_key(items, pdf):
    start = dt(2020, 1, 1)
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), (F.col("row") % 500).cast("int"))
    timed = items.select("order_id", "row", (F.lit(str(start)).cast("timestamp_ntz") + minutes).alias("ts"))
    got = rows(incremental.latest_per_key(timed, "order_id", "ts").select("order_id", "ts", "row"), "order_id")
    pdf = pdf.assign(m=pdf.row % 500).sort_values(["m", "row"]).groupby("order_id").last().sort_index()
    assert got == [(k, start + timedelta(minutes=int(m)), int(r)) for k, m, r in zip(pdf.index, pdf.m, pdf.row)]


def test_audit_and_orphans(spark, items, pdf):
    counts = pdf.groupby("order_id").size()
    found = {r["check"]: r["failures"] for r in quality.audit(items, "i", key="order_id").collect()}
    assert found == {"duplicate_key": (counts > 1).sum(), "surplus_rows": N - len(counts), "null_key": 0}
    parents = items.filter("order_id <> 'hot-o'").select("order_id").distinct()
    assert rows(quality.orphan_check(items, parents, "order_id", "r")) == [("r", "order_id", 1, N // 3)]


def test_salted_join_keeps_copies(items):
    sellers = items.select("seller_id").distinct().withColumn("state", F.upper("seller_id"))
    got = joins.salted_join(items, sellers, "seller_id", "inner", spread_by=["row"])
    assert got.agg(F.count("*"), F.sum("row"), F.count_if(F.upper("seller_id") != F.col("state"))).first()[:] == (
        N, N * (N - 1) // 2, 0,
    )
    spread = joins.hot_keys(items, "seller_id", 0.1).collect()
    assert [r["seller_id"] for r in spread] == ["hot-s"]


def test_profile_names_the_hot_key(items):
    top = layout.key_skew_profile(items, "order_id", k=1).first()
    assert (top["order_id"], top["rows"], top["share"]) == ("hot-o", N // 3, 0.333333)
