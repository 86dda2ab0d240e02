"""Order-value transforms and exact arithmetic."""

from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ordermill.functions import exact
from ordermill.operators.values import negative_order_values, valid_order_values, with_order_value

PARTS = "order_id string, product_revenue double, freight_revenue double"


def totals(spark, *parts):
    df = spark.createDataFrame([(f"o{i}", *p) for i, p in enumerate(parts)], PARTS)
    return [r["total_order_value"] for r in with_order_value(df).orderBy("order_id").collect()]


def test_value_is_the_sum(spark):
    assert totals(spark, (12.5, 7.25), (300.0, 30.0), (80.10, 8.01)) == [19.75, 330.0, 88.11]


def test_zero_freight(spark):
    assert totals(spark, (45.0, 0.0), (99.95, 0.0)) == [45.0, 99.95]


def test_rounds_to_two_decimals(spark):
    assert totals(spark, (100.123, 10.456), (1.005, 0.0)) == [110.58, 1.01]


def test_null_parts_give_null(spark):
    assert totals(spark, (None, 10.0), (100.0, None), (None, None)) == [None, None, None]


def test_negative_filter(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", -0.01), ("c", 0.0), ("d", None), ("e", -7.0)], "order_id string, total_order_value double")
    assert rows(negative_order_values(df).select("order_id"), "order_id") == [("b",), ("e",)]


def test_output_schema(spark):
    df = with_order_value(spark.createDataFrame([("a", 1.0, 2.0)], PARTS))
    assert df.dtypes == [("order_id", "string"), ("product_revenue", "double"), ("freight_revenue", "double"), ("total_order_value", "double")]


def test_valid_values_drop_negative_and_unknown(spark):
    df = spark.createDataFrame([("a", 20.0, 2.0), ("b", -20.0, 2.0), ("c", None, 2.0), ("d", 0.0, 0.0)], PARTS)
    assert rows(valid_order_values(df).select("order_id", "total_order_value"), "order_id") == [("a", 22.0), ("d", 0.0)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**12), 10**12), st.integers(1, 10**6)), min_size=1, max_size=40))
def test_half_up_div_is_exact(spark, pairs):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    for scale in (1, 100):
        quotient = exact.half_up_div(F.col("a"), F.col("b"), scale)
        got = [r["q"] for r in df.withColumn("q", quotient).orderBy("i").collect()]
        assert got == [int((Decimal(a) * scale / Decimal(b)).to_integral_value(ROUND_HALF_UP)) for a, b in pairs]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.integers(-(10**9), 10**9).map(lambda k: k / 100),
            st.integers(-(10**9), 10**9).map(lambda k: k / 1000),
            st.floats(-1e16, 1e16),
            st.just(float("nan")),
            st.none(),
        ),
        min_size=30,
        max_size=60,
    )
)
def test_round2_is_round(spark, numbers):
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    differs = ~exact.round2(F.col("v")).eqNullSafe(F.round("v", 2))
    assert df.filter(differs).count() == 0


def test_mean_of_sums_near_the_bigint_limit(spark):
    df = spark.createDataFrame([(9 * 10**18 // 4,), (9 * 10**18 // 4,), (9 * 10**18 // 4 - 1,)], "v bigint")
    half = exact.half_up_div(F.sum("v"), F.count("v"))
    assert df.agg(half).first()[0] == 9 * 10**18 // 4


def test_mean_rounds_ties_up_and_skips_nulls(spark):
    df = spark.createDataFrame([(0.01,), (0.02,), (None,)], "v double")
    assert df.agg(exact.money_mean("v")).first()[0] == 0.02
    assert df.agg(exact.money_mean(-F.col("v"))).first()[0] == -0.02
    empty = df.filter("false")
    assert tuple(empty.agg(exact.money_mean("v"), exact.money_sum("v")).first()) == (None, None)


def test_sum_does_not_depend_on_order(spark):
    df = spark.range(100_000).select(F.lit(0.1).cast("double").alias("v"))
    assert df.repartition(7).agg(exact.money_sum("v")).first()[0] == 10_000.0


@pytest.mark.parametrize("values,want", [([0.0000005, 0.0000005], 0.000001), ([-23.5456785, -23.5456785], -23.545679), ([10.0, None], 10.0)])
def test_coordinate_mean(spark, values, want):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    total, n = F.sum(exact.coordinate("v")), F.count("v")
    assert df.agg(exact.coordinate_mean(total, n)).first()[0] == want


def test_tolerance_counts_one_sided_nulls(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.1), (None, 1.0), (1.0, None), (None, None)], "a double, b double")
    flags = [r[0] for r in df.select(exact.off_by_more_than(F.col("a"), F.col("b"), 0.01)).collect()]
    assert flags == [False, True, True, True, False]
