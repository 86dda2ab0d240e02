"""Marks, lookback, late data and idempotent batches."""

import os
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime as dt
from datetime import timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ordermill.operators import incremental as inc
from ordermill.plans import medallion
from ordermill.plans.medallion import run_idempotent_batch, run_incremental
from ordermill.sources.marks import fold, mark_history, read_mark, write_mark

MARK = dt(2020, 6, 1, 12)
SCHEMA = "k string, ts timestamp_ntz, payload string"


@pytest.fixture(scope="module")
def feed(spark):
    return spark.createDataFrame(
        [
            ("before", dt(2020, 5, 31, 11, 59, 59, 999999), "x"),
            ("edge", dt(2020, 5, 31, 12), "x"),
            ("at", MARK, "x"),
            ("micro", dt(2020, 6, 1, 12, 0, 0, 1), "x"),
            ("after", dt(2020, 6, 2), "x"),
            ("none", None, "x"),
        ],
        SCHEMA,
    )


def keys(df):
    return {r["k"] for r in df.collect()}


def test_filters(feed):
    assert keys(inc.after_mark(feed, "ts", MARK)) == {"micro", "after"}
    assert keys(inc.since(feed, "ts", "2020-06-01 12:00:00")) == {"at", "micro", "after"}
    assert keys(inc.lookback(feed, "ts", MARK)) == {"edge", "at", "micro", "after"}
    assert keys(inc.between_dates(feed, "ts", "2020-05-31 12:00:00", "2020-06-02")) == {"edge", "at", "micro"}


def test_malformed_literal_raises(feed):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        inc.since(feed, "ts", "not a date").count()


def test_summary(feed):
    got = inc.incremental_summary(feed, "ts", MARK).first()
    assert (got["full_rows"], got["incremental_rows"], got["skipped_rows"]) == (6, 3, 3)
    assert (got["full_min"], got["incremental_min"]) == (dt(2020, 5, 31, 11, 59, 59, 999999), MARK)


def test_mark_moves_to_the_microsecond_and_stays_without_rows(spark, feed, tmp_path):
    marks, out = str(tmp_path / "marks"), str(tmp_path / "out")
    write_mark(spark, marks, 0, MARK)
    source = feed.filter("k <> 'after'")
    run_incremental(source, "ts", marks, out)
    assert read_mark(spark, marks) == (1, dt(2020, 6, 1, 12, 0, 0, 1))
    run_incremental(source, "ts", marks, out)
    assert read_mark(spark, marks) == (1, dt(2020, 6, 1, 12, 0, 0, 1))
    run_incremental(feed, "ts", marks, out)
    assert rows(spark.read.parquet(out).select("run", "k"), "run") == [(1, "micro"), (2, "after")]
    assert mark_history(spark, marks).count() == 3


def test_failed_run_leaves_the_mark(spark, feed, tmp_path):
    marks = str(tmp_path / "marks")
    write_mark(spark, marks, 0, MARK)
    broken = feed.withColumn("payload", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        run_incremental(broken, "ts", marks, str(tmp_path / "out"))
    assert read_mark(spark, marks) == (0, MARK)


def test_latest_row_is_settled_by_payload_on_ties(spark):
    t0, t1 = dt(2020, 1, 1), dt(2020, 1, 2)
    df = spark.createDataFrame(
        [("a", t0, "z"), ("a", t1, "b"), ("a", t1, "c"), ("a", t1, "c"), ("b", None, "x"), ("b", t0, "a"), (None, t0, "n")], SCHEMA
    )
    for partitions in (1, 7):
        got = rows(inc.latest_per_key(df.repartition(partitions), "k", "ts"), "k")
        assert got == [(None, t0, "n"), ("a", t1, "c"), ("b", t0, "a")]


def test_replays_change_nothing(feed):
    once = inc.latest_per_key(inc.lookback(feed, "ts", MARK), "k", "ts")
    twice = inc.late_dedup(feed, inc.lookback(feed, "ts", MARK), "k", "ts", MARK)
    assert rows(once, "k") == rows(twice, "k")
    assert inc.next_mark(twice, "ts", MARK).first()["mark"] == dt(2020, 6, 2)
    assert inc.next_mark(twice.filter("false"), "ts", MARK).first()["mark"] == MARK


def test_batch_replaces_its_own_days_only(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("a", dt(2020, 1, 1, 1), "1"), ("b", dt(2020, 1, 2, 1), "1"), ("c", dt(2020, 1, 2, 2), "1")], SCHEMA)
    for _ in range(2):
        assert run_idempotent_batch(df, "ts", path, "2020-01-01", "2020-01-03").count() == 3
    second = df.filter("k = 'b'").withColumn("payload", F.lit("2"))
    run_idempotent_batch(second, "ts", path, "2020-01-02", "2020-01-03")
    assert rows(spark.read.parquet(path).select("k", "payload"), "k") == [("a", "1"), ("b", "2")]


def test_a_day_that_lost_its_rows_ends_up_empty(spark, tmp_path):
    path = str(tmp_path / "table")
    df = spark.createDataFrame([("a", dt(2020, 1, 1, 1), "1"), ("b", dt(2020, 1, 2, 1), "1"), ("c", dt(2020, 1, 3, 2), "1")], SCHEMA)
    run_idempotent_batch(df, "ts", path, "2020-01-01", "2020-01-04")
    left = run_idempotent_batch(df.filter("k = 'b'"), "ts", path, "2020-01-02", "2020-01-04")
    assert [r["k"] for r in left.orderBy("k").collect()] == ["a", "b"]  # the first day lies outside the interval
    gone = run_idempotent_batch(df.filter("false"), "ts", path, "2020-01-01", "2020-01-04")
    assert gone.count() == 0 and gone.columns == ["k", "ts", "payload", "day"]
    assert run_idempotent_batch(df.filter("false"), "ts", str(tmp_path / "new"), "2020-01-01", "2020-01-04").count() == 0


def test_two_runs_that_race_leave_one_mark(spark, feed, tmp_path, monkeypatch):
    """Both read the same mark and write their rows; one commits, the other fails and leaves nothing."""
    marks, out = str(tmp_path / "marks"), str(tmp_path / "out")
    assert write_mark(spark, marks, 0, MARK)
    ready = threading.Barrier(2, timeout=60)
    move = medallion.next_mark
    monkeypatch.setattr(medallion, "next_mark", lambda *a: (move(*a), ready.wait())[0])

    def attempt(_):
        try:
            run_incremental(feed, "ts", marks, out)
            return "committed"
        except medallion.ConcurrentRunError:
            return "lost"

    with ThreadPoolExecutor(2) as pool:
        assert sorted(pool.map(attempt, range(2))) == ["committed", "lost"]
    assert mark_history(spark, marks).count() == 2
    rows = medallion.incremental_rows(spark, marks, out)
    assert rows.count() == inc.after_mark(feed, "ts", MARK).count()
    assert len(list((tmp_path / "out" / "run=1").glob("attempt=*"))) == 1


def test_an_attempt_without_a_mark_is_never_read(spark, feed, tmp_path):
    marks, out = str(tmp_path / "marks"), str(tmp_path / "out")
    write_mark(spark, marks, 0, MARK)
    feed.write.parquet(f"{out}/run=1/attempt=dead")
    run_incremental(feed, "ts", marks, out)
    assert medallion.incremental_rows(spark, marks, out).count() == inc.after_mark(feed, "ts", MARK).count()


def test_a_thousand_runs_leave_few_files(spark, tmp_path):
    marks, runs = str(tmp_path / "marks"), 1000 if "LONG_TESTS" in os.environ else 50
    for run in range(runs):
        assert write_mark(spark, marks, run, MARK + timedelta(hours=run), f"a{run}")
    assert not write_mark(spark, marks, runs - 1, MARK) and not write_mark(spark, marks, 3, MARK)
    assert len([p for p in (tmp_path / "marks").iterdir() if p.name[0] not in "._"]) <= 10
    assert read_mark(spark, marks) == (runs - 1, MARK + timedelta(hours=runs - 1))
    assert mark_history(spark, marks).count() == runs


def test_entries_and_folded_files_may_overlap(spark, tmp_path):
    """A run that died while folding leaves both; the history counts each run once, and the next fold cleans up."""
    marks = str(tmp_path / "marks")
    for run in range(6):
        write_mark(spark, marks, run, MARK + timedelta(hours=run))
    kept = {p.name: p.read_text() for p in (tmp_path / "marks").glob("run-*.json")}
    fold(spark, marks, 5)
    for name, text in kept.items():
        (tmp_path / "marks" / name).write_text(text)
    assert mark_history(spark, marks).count() == 6
    for run in range(6, 9):
        assert write_mark(spark, marks, run, MARK + timedelta(hours=run))
    assert sorted(p.name[:4] for p in (tmp_path / "marks").iterdir() if p.name[0] not in "._") == ["upto"]
