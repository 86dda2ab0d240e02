"""Streams agree with their batch counterparts, and replays are harmless."""

from datetime import datetime as dt
from datetime import timedelta
from functools import reduce

from conftest import rows
from pyspark.sql import DataFrame

from ordermill.operators import incremental as inc
from ordermill.operators import quarantine as qr
from ordermill.sources import versions as v
from ordermill.streaming import ingest as s

SCHEMA = "k string, ts timestamp_ntz"


def test_replays_in_the_window_are_dropped_across_runs(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / d) for d in ("in", "out", "checkpoint"))
    t0 = dt(2020, 1, 10)
    first = spark.createDataFrame([("a", t0), ("b", t0 + timedelta(hours=1)), ("a", t0)], SCHEMA)
    second = spark.createDataFrame([("a", t0), ("c", t0 + timedelta(hours=2)), ("d", t0 - timedelta(hours=30))], SCHEMA)
    for batch in (first, second):
        batch.coalesce(1).write.mode("append").parquet(inbox)
        stream = s.dedup_within(s.parquet_stream(spark, inbox, batch.schema), "k", "ts")
        s.run_to_table(stream, out, checkpoint)
    got = spark.read.parquet(out)
    # d lies more than 24 hours behind the newest event of the first run: late, dropped
    assert [r["k"] for r in got.orderBy("k").collect()] == ["a", "b", "c"]
    assert got.columns == ["k", "ts"]


def test_stream_equals_batch_inside_the_window(spark, tmp_path):
    base = dt(2020, 1, 10)
    history = spark.createDataFrame([(f"k{i}", base + timedelta(minutes=i)) for i in range(500)], SCHEMA)
    replays = history.filter("k like '%7'")
    inbox = str(tmp_path / "in")
    history.unionByName(replays).repartition(6).write.parquet(inbox)
    stream = s.dedup_within(s.parquet_stream(spark, inbox, history.schema, max_files_per_trigger=2), "k", "ts")
    s.run_to_table(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    batch = inc.late_dedup(history, replays, "k", "ts", base + timedelta(hours=24))
    assert rows(spark.read.parquet(str(tmp_path / "out")), "k") == rows(batch, "k")


def test_corrections_of_any_age_replace_what_came_before(spark, tmp_path):
    inbox, versions, checkpoint = (str(tmp_path / d) for d in ("in", "versions", "checkpoint"))
    t0 = dt(2020, 1, 10)
    arrivals = [
        [("a", t0, "shipped"), ("b", t0 + timedelta(days=9), "new")],
        [("a", t0 + timedelta(hours=1), "delivered"), ("c", t0 - timedelta(days=30), "late")],
        [("a", t0, "shipped"), ("b", t0, "older")],
    ]
    schema = SCHEMA + ", state string"
    everything = spark.createDataFrame([r for part in arrivals for r in part], schema)
    for part in arrivals:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(inbox)
        s.run_newest_versions(s.parquet_stream(spark, inbox, everything.schema), "k", "ts", versions, checkpoint)
    got = rows(s.newest_versions(spark, versions, everything.schema), "k")
    assert [(k, state) for k, _, state in got] == [("a", "delivered"), ("b", "new"), ("c", "late")]
    assert got == rows(inc.latest_per_key(everything, "k", "ts"), "k")


def test_order_ingest_matches_the_batch_split_and_survives_replay(spark, tables, tmp_path):
    feed = tables.roles.orders_feed()
    inbox, valid, rejected, checkpoint = (str(tmp_path / d) for d in ("in", "valid", "rejected", "checkpoint"))
    feed.repartition(2).write.parquet(inbox)
    stream = s.parquet_stream(spark, inbox, feed.schema, max_files_per_trigger=1)
    s.run_order_ingest(stream, valid, rejected, checkpoint)
    flagged = qr.flag_orders(feed)
    expected = rows(qr.valid_rows(flagged), *feed.columns)
    assert rows(spark.read.parquet(valid).select(*feed.columns), *feed.columns) == expected
    again = spark.read.parquet(rejected)
    assert again.count() == qr.quarantined_rows(flagged).count()
    assert again.filter("quarantine_timestamp is null").count() == 0
    # a run without new files adds nothing
    s.run_order_ingest(s.parquet_stream(spark, inbox, feed.schema), valid, rejected, checkpoint)
    assert spark.read.parquet(valid).count() == len(expected)


def test_replayed_batch_replaces_itself(spark, tables, tmp_path):
    feed = tables.roles.orders_feed()
    valid, rejected = str(tmp_path / "valid"), str(tmp_path / "rejected")
    for _ in range(2):
        s.write_split_batch(feed, 7, valid, rejected)
    assert spark.read.parquet(valid).count() + spark.read.parquet(rejected).count() == feed.count()


def _batches(spark):
    t0 = dt(2020, 1, 10)
    rows_of = [
        [(f"k{i}", t0 + timedelta(minutes=i), f"first {i}") for i in range(40)],
        [(f"k{i}", t0 + timedelta(days=1), f"corrected {i}") for i in range(0, 40, 3)],
        [(f"k{i}", t0, f"older {i}") for i in range(40)],
        [(f"k{i}", t0 + timedelta(days=1), f"corrected {i}") for i in range(0, 40, 3)],
        [("new", t0, "x"), (None, t0, "no key"), ("k1", None, "no time")],
    ]
    return [spark.createDataFrame(r, SCHEMA + ", state string") for r in rows_of]


def test_five_batches_leave_one_row_a_key(spark, tmp_path):
    root, batches = str(tmp_path / "versions"), _batches(spark)
    for i, batch in enumerate(batches):
        v.merge_newest(batch, i, "k", "ts", root, buckets=4)
        so_far = reduce(DataFrame.unionByName, batches[: i + 1])
        want = rows(inc.latest_per_key(so_far, "k", "ts"), "k")
        assert rows(v.newest_rows(spark, root, batch.schema), "k") == want
        # Everything on disk, not only what the commit names.
        assert spark.read.parquet(f"{root}/data").count() == len(want)
        assert spark.read.parquet(f"{root}/commits").select("batch").distinct().count() <= 2


def test_replayed_and_broken_batches_count_once(spark, tmp_path):
    root, batches = str(tmp_path / "versions"), _batches(spark)
    v.merge_newest(batches[0], 0, "k", "ts", root, buckets=4)
    before = rows(v.newest_rows(spark, root, batches[0].schema), "k")
    v.merge_newest(batches[1], 0, "k", "ts", root)
    assert rows(v.newest_rows(spark, root, batches[0].schema), "k") == before
    # A batch that wrote its rows and died before the commit is not seen, and is merged whole when it comes again.
    batches[1].limit(2).selectExpr("*", "1 AS bucket").write.partitionBy("bucket").parquet(f"{root}/data/generation=1")
    assert rows(v.newest_rows(spark, root, batches[0].schema), "k") == before
    v.merge_newest(batches[1], 1, "k", "ts", root)
    want = rows(inc.latest_per_key(batches[0].unionByName(batches[1]), "k", "ts"), "k")
    assert rows(v.newest_rows(spark, root, batches[0].schema), "k") == want


def test_untouched_buckets_keep_their_files_and_empty_batches_pass(spark, tmp_path):
    root, batches = str(tmp_path / "versions"), _batches(spark)
    v.merge_newest(batches[0].limit(0), 0, "k", "ts", root)
    assert v.newest_rows(spark, root, batches[0].schema).count() == 0
    v.merge_newest(batches[0], 1, "k", "ts", root)
    v.merge_newest(batches[4].filter("k = 'new'"), 2, "k", "ts", root)
    _, buckets, generations = v.last_commit(spark, root)
    assert buckets == v.BUCKETS and sorted(generations.values()).count(2) == 1
