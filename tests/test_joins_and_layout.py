"""Join strategies give the plain join's rows; layouts keep every row."""

import math
from collections import Counter

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from ordermill.operators import joins, layout
from ordermill.plans.catalog import QUERIES
from ordermill.sources.tables import write_table


@pytest.fixture(scope="module")
def sides(spark):
    """One key holds 90 percent of the left rows; some keys are NULL, some match nothing."""
    key = F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 50 == 9, None).otherwise(F.concat(F.lit("k"), F.col("id") % 70))
    left = spark.range(5000).select("id", key.alias("k"))
    right = spark.createDataFrame([("hot", "H1"), ("hot", "H2"), *[(f"k{i}", f"v{i}") for i in range(40)], ("zz", "z"), (None, "n")], "k string, v string")
    return left, right


def bag(df):
    return Counter(tuple(r) for r in df.select("id", "k", "v").collect())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_salt", [100, 3000, 1_000_000])
def test_salted_join(sides, how, rows_per_salt):
    left, right = sides
    got = joins.salted_join(left, right, "k", how, spread_by=["id"], rows_per_salt=rows_per_salt)
    assert bag(got) == bag(left.join(right, "k", how))
    assert "SortMergeJoin" in plan(got)


def test_salting_spreads_the_hot_key(sides):
    left, _ = sides
    hot = [tuple(r) for r in joins.hot_keys(left, "k", 0.05, rows_per_salt=1000).collect()]
    assert hot == [("hot", 5)]
    assert joins.hot_keys(left, "k", 0.95).count() == 0


def test_parts_follow_from_the_rows_and_partitions(spark, sides, tables):
    left, _ = sides
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = left.filter("k IS NOT NULL").count()
    assert [tuple(r) for r in joins.hot_keys(left, "k", 0.05).collect()] == [("hot", math.ceil(4500 * 4 * partitions / keyed))]
    # The registered query cuts its keys as well.
    cut = joins.hot_keys(tables.silver("orders"), "order_status", 0.01).collect()
    assert max(r["_salts"] for r in cut) > 1
    assert "_salts" in plan(QUERIES["skewed_join_hot_status"](tables))


@pytest.mark.parametrize("share", [0.02, 0.1, 0.3])
def test_candidates_hold_every_frequent_key_in_bounded_number(sides, share):
    left, _ = sides
    counts = {r["k"]: r["count"] for r in left.filter("k IS NOT NULL").groupBy("k").count().collect()}
    listed = [r["k"] for r in joins.frequent_candidates(left, "k", share).collect()]
    assert {k for k, n in counts.items() if n > share * sum(counts.values())} <= set(listed) and None not in listed
    assert len(listed) <= 1 / share


def test_hot_keys_shuffle_no_other_key(spark, tmp_path):
    table = write_table(spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")), str(tmp_path / "t"))
    text = plan(joins.hot_keys(table, "k", 0.01))
    grouped = text[text.index("HashAggregate(keys=[k") :]
    assert "BroadcastHashJoin" in grouped and "LeftSemi" in grouped


def test_no_rows_no_hot_keys(sides):
    left, right = sides
    empty = left.filter("false")
    assert joins.hot_keys(empty, "k", 0.01).count() == 0
    assert joins.salted_join(empty, right, "k", "left", spread_by=["id"]).count() == 0


def test_salted_join_refuses_what_it_cannot_keep(sides):
    with pytest.raises(ValueError):
        joins.salted_join(*sides, "k", "full", spread_by=["id"])


def test_a_lookup_keeps_all_facts_and_leaves_the_strategy_to_spark(sides):
    left, right = sides
    small = joins.lookup_join(left, right, "k")
    assert "ResolvedHint" not in plan(small)
    assert bag(small) == bag(left.join(right, "k", "left"))
    assert "SortMergeJoin" in plan(joins.shuffle_join(left, right, "k"))
    assert bag(joins.shuffle_join(left, right, "k")) == bag(small)


def test_layouts(spark):
    df = spark.range(1000)
    assert layout.partition_profile(df.repartition(4)).agg(F.count("*"), F.sum("rows")).first()[:] == (4, 1000)
    assert layout.layout_summary(df.repartition(4).coalesce(12), "x").first()["partitions"] == 4
    keyed = df.withColumn("k", F.col("id") % 3).repartition(8, "k")
    assert layout.layout_summary(keyed, "x").first()["partitions"] <= 3


def test_skew_profile(sides):
    left, _ = sides
    top = layout.key_skew_profile(left, "k", k=2).collect()
    keys = left.select("k").distinct().count()
    assert (top[0]["k"], top[0]["rows"], top[0]["share"]) == ("hot", 4500, 0.9)
    assert top[0]["ratio_to_mean"] == round(4500 * keys / 5000, 6)


def files_of(folder):
    return {p.relative_to(folder): p.stat().st_size for p in folder.rglob("*.parquet")}


def test_compaction_by_size(spark, tmp_path):
    for name in ("one", "some"):
        write_table(spark.range(20_000), str(tmp_path / name), files=50)
    before = layout.file_layout(spark, str(tmp_path / "one")).first()
    assert layout.compact_table(spark, str(tmp_path / "one")) == 50
    assert layout.compact_table(spark, str(tmp_path / "one")) == 0  # nothing left to gain
    one = layout.file_layout(spark, str(tmp_path / "one")).first()
    layout.compact_table(spark, str(tmp_path / "some"), target_bytes=before["bytes"] // 4 + 1)
    some = layout.file_layout(spark, str(tmp_path / "some")).first()
    assert (before["files"], one["files"], some["files"]) == (50, 1, 4)
    assert before["rows"] == one["rows"] == some["rows"] == 20_000
    assert not list((tmp_path / "one").glob("_compact*"))


def test_compaction_leaves_large_files_and_keeps_partitions_it_is_not_told_of(spark, tmp_path):
    table = tmp_path / "days"
    rows_ = spark.range(3000).withColumns({"day": F.concat(F.lit("2001-07-01 0"), F.col("id") % 3, F.lit(":00 é")), "part": F.col("id") % 2})
    rows_.repartition(12).write.partitionBy("day", "part").parquet(str(table))
    # A large file in one partition, and one partition with a single small file.
    spark.range(10_000, 90_000).coalesce(1).withColumns({"day": F.lit("2001-07-01 00:00 é"), "part": F.lit(0)}).write.mode("append").partitionBy("day", "part").parquet(str(table))
    spark.range(5).coalesce(1).withColumns({"day": F.lit("alone"), "part": F.lit(1)}).write.mode("append").partitionBy("day", "part").parquet(str(table))
    before, want = files_of(table), rows(spark.read.parquet(str(table)), "id", "day", "part")
    large = max(before, key=before.get)
    layout.compact_table(spark, str(table), target_bytes=before[large])
    after = files_of(table)
    assert after[large] == before[large] and {p for p in before if "day=alone" in p.parts} <= set(after)
    assert {p.parent for p in after} == {p.parent for p in before}
    assert len(after) == 8 and len(before) > 50
    assert rows(spark.read.parquet(str(table)), "id", "day", "part") == want


@pytest.mark.parametrize("after", [0, 1, 3])
def test_a_compaction_that_died_is_finished_by_the_next(spark, tmp_path, monkeypatch, after):
    """It dies before its plan, or with the plan after some removals; no row is lost or doubled."""
    table = tmp_path / "t"
    spark.range(500).repartition(10).write.parquet(str(table))
    calls, remove = [], layout.remove_path

    def dies(*a):
        calls.append(a)
        if len(calls) > after:
            raise OSError("lost")
        remove(*a)

    monkeypatch.setattr(layout, "remove_path", dies)
    if after == 0:
        monkeypatch.setattr(layout, "put_if_absent", dies)
    with pytest.raises(OSError):
        layout.compact_table(spark, str(table))
    monkeypatch.undo()
    layout.compact_table(spark, str(table))
    assert rows(spark.read.parquet(str(table)), "id") == [(i,) for i in range(500)]
    assert len(files_of(table)) == 1 and not list(table.glob("_compact*"))


def test_filter_order_does_not_change_the_plan(spark, tables):
    from ordermill.operators.marts import delivered_orders

    columns = ["order_id", "customer_id"]
    orders = tables.silver("orders")
    late = delivered_orders(orders.repartition(20), columns)
    early = delivered_orders(orders, columns).repartition(20)
    assert rows(late, *columns) == rows(early, *columns)
    assert late._jdf.queryExecution().optimizedPlan().sameResult(early._jdf.queryExecution().optimizedPlan())
