"""The plans the operators promise."""

import pytest
from conftest import plan, rows

from ordermill.operators import incremental, marts, quality
from ordermill.plans import medallion, validation
from ordermill.sources.contracts import SOURCE_TABLES
from ordermill.sources.tables import write_table


@pytest.fixture(scope="module")
def stored(tables, tmp_path_factory):
    root = tmp_path_factory.mktemp("stored")
    return {
        "orders": write_table(tables.silver("orders"), str(root / "orders")),
        "items": write_table(tables.silver("order_items"), str(root / "items")),
        "payments": write_table(tables.silver("order_payments"), str(root / "payments")),
        "enriched": write_table(tables.enriched(), str(root / "enriched")),
    }


def test_filter_and_columns_reach_the_scan(stored):
    text = plan(marts.delivered_orders(stored["enriched"], ["order_id", "customer_unique_id", "total_order_value"]))
    assert "EqualTo(order_status,delivered)" in text.split("PushedFilters")[1]
    schema = text.split("ReadSchema")[1]
    assert "total_order_value" in schema and "order_approved_at" not in schema
    assert "Exchange" not in text


def test_mark_is_pushed_down(stored):
    text = plan(incremental.lookback(stored["orders"], "order_purchase_timestamp", "2001-07-01"))
    assert "GreaterThanOrEqual(order_purchase_timestamp,2001-06-30" in text


def test_top_k_keeps_k_rows_per_task(stored):
    assert "TakeOrderedAndProject" in plan(marts.top_orders(stored["enriched"]))


def test_latest_row_is_limited_before_the_shuffle(stored):
    text = plan(incremental.latest_per_key(stored["orders"], "customer_id", "order_purchase_timestamp"))
    before, after = text.split("Exchange")[0], text.split("Exchange")[1]
    assert "Final" in before and "WindowGroupLimit" in after and "Partial" in after


def test_one_scan_per_audited_table(stored):
    rules = quality.not_negative("price", "freight_value") + quality.not_null("product_id", "seller_id")
    assert plan(quality.audit(stored["items"], "items", rules, key="order_id")).count("FileScan") == 1


def test_unused_metrics_are_not_computed(stored):
    """The customer mart needs no payments and no distinct counts, so the order mart below drops them."""
    gold = marts.gold_orders(stored["orders"], stored["items"], stored["payments"])
    text = gold.groupBy("customer_id").agg({"total_order_value": "max"})
    assert plan(text).count("FileScan") == 2
    assert "Expand" not in plan(text)


def test_distinct_counts_spread_a_hot_group(stored):
    """The first shuffle of a distinct count hashes the value too, not the group alone."""
    text = plan(marts.sales_metrics(stored["items"], ["seller_id"], {"n": "order_id"}))
    first_shuffle = text[text.rindex("hashpartitioning") :]
    assert "order_id" in first_shuffle.split(")")[0] and "seller_id" in first_shuffle.split(")")[0]


def test_null_safe_recomputation_is_an_equi_join(stored):
    mart = marts.sales_metrics(stored["items"], ["product_id", "seller_id"], {})
    text = plan(quality.compare_metrics(mart, mart, "t", ["product_id", "seller_id"], ["total_items_sold"], []))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_distinct_counts_expand_no_rows(tables, stored):
    """Two distinct counts are two aggregates; one aggregate would triple its rows first."""
    for mart in (marts.gold_sellers(tables.silver("sellers"), stored["items"]), marts.gold_orders(stored["orders"], stored["items"], stored["payments"])):
        assert "Expand" not in plan(mart)


def test_all_item_marts_roll_up_from_one_shuffle_of_the_items(tables, stored, tmp_path):
    """Only the lines read the items; the marts and what is expected of them read the lines."""
    silver = {n: tables.silver(n) for n in SOURCE_TABLES} | {"order_items": stored["items"]}
    lines = medallion.build_lines(silver, str(tmp_path))
    items = stored["items"].inputFiles()[0].rsplit("/", 1)[0]
    # Exchanges of the lines' own plan: by order, product and seller, once.
    assert plan(marts.item_lines(stored["items"])).count("Exchange hashpartitioning") == 1
    for mart in (*medallion.gold_plans(silver, lines).values(), validation.gold_expectations(silver, lines)):
        assert not any(f.startswith(items) for f in mart.inputFiles())


def test_lines_give_the_same_marts_as_items(tables, stored):
    lines = marts.item_lines(stored["items"])
    names = tables.silver("category_translation")
    for build in (
        lambda i: marts.gold_orders(stored["orders"], i, stored["payments"]),
        lambda i: marts.gold_products(tables.silver("products"), i),
        lambda i: marts.gold_category_translated(i, tables.silver("products"), names),
    ):
        assert sorted(rows(build(lines)), key=repr) == sorted(rows(build(stored["items"])), key=repr)


def test_row_counts_of_stored_layers_read_no_column(stored):
    """The counts come from the files' footers."""
    text = plan(medallion.layer_row_counts({"silver": {"orders": stored["orders"], "order_items": stored["items"]}}))
    assert text.count("FileScan") == text.count("ReadSchema: struct<>") == 2
