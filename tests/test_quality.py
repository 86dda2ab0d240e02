"""Audits: single-pass findings, NULL handling, relationships, reconciliation."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermill.operators import quality as q
from ordermill.plans.validation import ValidationError, raise_on_failure

KV = "k string, v double"


def failures(df):
    return {(r["check"], r["column"]): r["failures"] for r in df.collect()}


def test_key_checks_differ(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", -3.0), ("b", 0.0), (None, None), (None, -1.0)], KV)
    found = failures(q.audit(df, "t", [*q.not_negative("v"), *q.positive("v"), *q.not_null("v")], key="k"))
    assert found == {
        ("duplicate_key", "k"): 2,  # a and NULL
        ("surplus_rows", "k"): 3,
        ("null_key", "k"): 2,
        ("negative", "v"): 2,
        ("non_positive", "v"): 3,
        ("null", "v"): 1,
    }


def test_empty_table_has_no_failures(spark):
    found = failures(q.audit(spark.createDataFrame([], KV), "t", q.not_null("v"), key="k"))
    assert set(found.values()) == {0}


def test_total_mismatch_sees_nulls(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (1.0, 2.0, 3.1), (1.0, 2.0, None), (None, 2.0, 3.0), (None, 2.0, None)], "a double, b double, t double")
    assert failures(q.audit(df, "t", [q.total_is_sum("t", "a", "b")])) == {("derived_total", "t"): 3}


def test_average_tolerance(spark):
    df = spark.createDataFrame([(1.0, 2.0, 2), (1.01, 2.0, 2), (1.02, 2.0, 2), (9.0, 0.0, 0), (None, 2.0, 2)], "a double, t double, n int")
    assert failures(q.audit(df, "t", [q.average_is_ratio("a", "t", "n")])) == {("derived_average", "a"): 2}


def test_range_and_domain_ignore_null(spark):
    df = spark.createDataFrame([("x", 0.0), ("y", 1.0), (None, 5.0), ("x", 5.1), ("z", None)], KV)
    assert failures(q.audit(df, "t", [q.within("v", 1, 5), q.one_of("k", ["x", "y"])])) == {("out_of_range", "v"): 2, ("not_in_domain", "k"): 1}


def test_row_counts_need_both_sides(spark):
    actual = spark.createDataFrame([("a", 3), ("b", 2)], "table string, rows bigint")
    expected = spark.createDataFrame([("a", 3), ("b", 5), ("c", 1)], "table string, rows bigint")
    got = q.row_count_check(actual, expected)
    assert rows(got.select("table", "failures"), "table") == [("a", 0), ("b", 3), ("c", 1)]


def test_orphans_include_null_keys(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(q.orphan_check(child, parent, "k", "r")) == [("r", "k", 2, 3)]
    assert rows(q.orphan_check(parent.filter("k is not null"), parent, "k", "r")) == [("r", "k", 0, 0)]


def test_fanout_equals_the_real_join(spark):
    left = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "k string")
    right = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 1), ("z", 1)], "k string, n int")
    got = q.join_fanout(left, right, "k", "r").first()
    assert got["joined_rows"] == left.join(right, "k", "left").count() == 9
    assert (got["left_rows"], got["unmatched_rows"], got["most_matches"]) == (5, 2, 3)


def test_recomputation_is_null_safe(spark):
    schema = "name string, english string, n bigint, money double"
    stored = spark.createDataFrame([(None, None, 3, 1.0), ("a", "A", 2, 2.0), ("b", "b", 0, 0.0), ("c", "C", None, 5.0)], schema)
    now = spark.createDataFrame([(None, None, 4, 1.0005), ("a", "A", 2, 2.002), ("c", "C", 1, None)], schema)
    found = failures(q.compare_metrics(stored, now, "t", ["name", "english"], ["n"], ["money"]))
    # NULL group: n differs; a: money differs; b: absent means zeros; c: NULL against 1, and 5 against zero
    assert found == {("recomputed", "n"): 2, ("recomputed", "money"): 2}


def test_reconciliation_tolerance(spark):
    schema = "product_revenue double, freight_revenue double, total_order_value double, total_payment double"
    good = spark.createDataFrame([(1.0, 0.1, 1.1, 0.0), (2.0, None, 2.01, 5.0)], schema)
    assert rows(q.revenue_reconciliation(good)) == [(3.0, 0.1, 3.11, 5.0, True)]
    bad = spark.createDataFrame([(1.0, 0.1, 1.12, 0.0)], schema)
    assert q.revenue_reconciliation(bad).first()["passed"] is False


def test_profile_counts_nulls(spark):
    df = spark.createDataFrame([("a", None), (None, None)], KV)
    assert rows(q.profile_table(df, "t").select("column", "rows", "nulls", "columns"), "column") == [("k", 2, 1, 2), ("v", 2, 2, 2)]


def test_summary(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 4.5), ("d", None)], KV)
    assert rows(q.numeric_summary(df, ["v"])) == [("v", 3, 2.5, 1.8028, 1.0, 4.5)]


def test_failed_suite_raises(spark):
    findings = spark.createDataFrame([("t", "null", "c", 0)], q.FINDINGS)
    raise_on_failure(findings)
    with pytest.raises(ValidationError, match="t.c null=4"):
        raise_on_failure(findings.withColumn("failures", F.lit(4)))


def test_invalid_metric_counts_rows_once(spark):
    df = spark.createDataFrame([(-1, -1), (1, -1), (1, 1), (None, -1)], "a int, b int")
    assert failures(q.audit(df, "t", [q.any_invalid("bad", ["a", "b"])])) == {("bad", "a,b"): 3}


def test_summary_keeps_small_decimals(spark):
    df = spark.createDataFrame([(1.234567,), (1.238,)], "v double")
    assert q.numeric_summary(df, ["v"]).first()["mean"] == 1.236284
