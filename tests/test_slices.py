"""Layers of large inputs, computed a slice of the keys at a time: the same rows with less on the disks."""

import time

import pytest
from conftest import plan, rows

from ordermill.plans import catalog, medallion
from ordermill.sources import tables as io

SLICES = 3


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Stored tables whose keys repeat, are NULL, or have no partner."""
    tables = {
        "orders": (
            [("o1", "c1", "delivered"), ("o2", "c1", "shipped"), ("o2", "c2", "shipped"), ("o3", None, None), (None, "c9", "delivered"), ("o5", "c3", "delivered")],
            "order_id string, customer_id string, order_status string",
        ),
        "order_items": (
            [("o1", "p1", "s1", 10.0, 1.0), ("o1", "p1", "s2", 0.1, 0.2), ("o1", "p2", "s1", None, 0.0), ("o1", "p2", "s1", 3.0, 0.5)]
            + [("o2", "p1", None, 7.5, 0.1), (None, "p3", "s1", 2.0, 0.5), ("o5", None, "s9", 1.0, 1.0), ("o5", "p9", "s1", 1.0, None)]
            + [(f"x{i % 17}", f"p{i % 5}", f"s{i % 3}", i / 4, i / 8) for i in range(60)],
            "order_id string, product_id string, seller_id string, price double, freight_value double",
        ),
        "order_payments": (
            [("o1", "card", 3, 10.0), ("o1", "voucher", None, 6.3), ("o2", None, 1, 2.0), (None, "card", 2, 1.0), ("o7", "card", 1, None)],
            "order_id string, payment_type string, payment_installments int, payment_value double",
        ),
        "customers": ([("c1", "u1"), ("c1", "u2"), ("c2", "u1"), (None, "u3")], "customer_id string, customer_unique_id string"),
        "products": (
            [("p1", "toys"), ("p1", "books"), ("p2", None), ("p3", "books"), ("p4", "games"), (None, "toys")],
            "product_id string, product_category_name string",
        ),
        "sellers": ([("s1", "a"), ("s1", "b"), ("s2", "c"), ("s7", "d"), (None, "e")], "seller_id string, seller_city string"),
        "category_translation": ([("toys", "toys_en"), ("toys", "play_en")], "product_category_name string, product_category_name_english string"),
        "order_reviews": (
            [("o1", 5), (None, 1)],
            "order_id string, review_score int",
        ),
        "geolocation": (
            [(1, 2.0, 3.0, "a", "A"), (None, None, 4.0, None, "B")],
            "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string",
        ),
    }
    root, day = tmp_path_factory.mktemp("silver"), "CAST('2020-01-01 00:00:00' AS TIMESTAMP_NTZ) AS"
    dated = {"orders": ["order_purchase_timestamp"], "order_reviews": ["review_creation_date", "review_answer_timestamp"]}
    out = {}
    for name, (data, schema) in tables.items():
        df = spark.createDataFrame(data, schema).selectExpr("*", *[f"{day} {c}" for c in dated.get(name, [])])
        out[name] = io.write_table(df, str(root / name))
    return out


def gold(silver, root, slices, monkeypatch):
    monkeypatch.setattr(medallion, "slices_for", lambda items: slices)
    return medallion.build_gold(silver, str(root))


def test_slices_give_the_same_marts(silver, tmp_path, monkeypatch):
    whole, sliced = (gold(silver, tmp_path / str(n), n, monkeypatch) for n in (1, SLICES))
    assert len(whole) == 8 and sorted(whole) == sorted(sliced)
    for name in whole:
        assert whole[name].schema == sliced[name].schema
        assert sorted(rows(whole[name]), key=repr) == sorted(rows(sliced[name]), key=repr), name


def test_a_rerun_replaces_the_layer(silver, tmp_path, monkeypatch):
    """Whether it was written in more slices before, or in fewer."""
    want = None
    for n in (SLICES, 2, 1, SLICES):
        monkeypatch.setattr(medallion, "slices_for", lambda items, n=n: n)
        lines = medallion.build_lines(silver, str(tmp_path))
        found = sorted(rows(lines.drop(f"slice_of_{n}")), key=repr)
        want = want or found
        assert found == want


def test_a_slice_reads_its_own_lines_and_keys_only(spark, silver, tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "slices_for", lambda items: SLICES)
    lines = medallion.build_lines(silver, str(tmp_path))
    parts = medallion.sliced_plans(silver, lines, str(tmp_path), SLICES)
    assert {n: len(p) for n, p in parts.items() if len(p) > 1} == {"orders": 3, "payments": 3, "products": 2, "sellers": 2}
    for name in ("orders", "payments", "products", "sellers"):
        text = plan(parts[name][1])
        cuts = text.count(f"(slice_of_{SLICES}#") if name == "orders" else 0
        # Each scan either prunes folders or hashes its key before anything is shuffled.
        scans = text.split("FileScan")[1:]
        assert all("xxhash64" in x.split("PushedFilters")[0] or f"PartitionFilters: [isnotnull(slice_of_{SLICES}" in x for x in scans), text
        assert (cuts > 0) == (name == "orders")


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}


@pytest.mark.parametrize("slices", [1, SLICES])
def test_what_a_layer_has_shuffled_leaves_the_disks(spark, silver, tmp_path, monkeypatch, slices):
    before = shuffle_files(spark)
    kept = gold(silver, tmp_path, slices, monkeypatch)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and kept["orders"].count() == 6
    assert spark.conf.get(io.DROP_SHUFFLES, None) in (None, "false")


def test_small_inputs_are_not_cut(spark, tables):
    assert medallion.slices_for(tables.silver("order_items")) == 1
    assert medallion.slices_for(spark.range(1 << 30)) == medallion.MOST_SLICES


def test_layers_are_stored_compactly(spark, small, monkeypatch):
    """Counts over sliced layers equal those over whole ones; every file of the layers has the smaller codec."""
    roots = []

    def scratch(session, label):
        roots.append(io.scratch_path(session, label))
        return roots[-1]

    monkeypatch.setattr(catalog, "scratch_path", scratch)
    whole = sorted(rows(catalog.registered()["layer_row_counts"](spark, small)))
    monkeypatch.setattr(medallion, "slices_for", lambda items: SLICES)
    assert sorted(rows(catalog.registered()["layer_row_counts"](spark, small))) == whole
    assert len(roots) == 4
    for root in roots:
        files = [f for f in spark.read.option("recursiveFileLookup", True).format("binaryFile").load(root).inputFiles() if f.endswith(".parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("name", ["gold_validation_suite", "gold_validation_suite_defects"])
def test_the_suites_find_the_same_in_sliced_marts(spark, small, monkeypatch, name):
    """And nothing that the marts shuffled is left when the findings are read."""
    whole = sorted(rows(catalog.registered()[name](spark, small)))
    before = shuffle_files(spark)
    monkeypatch.setattr(medallion, "slices_for", lambda items: SLICES)
    sliced = catalog.registered()[name](spark, small)
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and len(whole) == 59 and sorted(rows(sliced)) == whole
