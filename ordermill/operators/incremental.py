"""Incremental, late-data and idempotent batch operators on timestamped tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def instant(value: str | datetime) -> Column:
    """A zone-free timestamp literal; as a literal it is pushed down to Parquet.

    It goes through text, since a Python datetime would pass through the zones
    of the driver and of the session.
    """
    return F.lit(str(value)).cast("timestamp_ntz")


def since(df: DataFrame, ts: str, start: str | datetime) -> DataFrame:
    return df.filter(F.col(ts) >= instant(start))


def after_mark(df: DataFrame, ts: str, mark: str | datetime) -> DataFrame:
    """Rows strictly after the high-water mark; ``lookback`` also sees late rows at or before it."""
    return df.filter(F.col(ts) > instant(mark))


def between_dates(df: DataFrame, ts: str, start: str | datetime, end: str | datetime) -> DataFrame:
    """Half-open interval: from ``start``, before ``end``."""
    return df.filter((F.col(ts) >= instant(start)) & (F.col(ts) < instant(end)))


def lookback(df: DataFrame, ts: str, mark: str | datetime, hours: int = 24) -> DataFrame:
    """Rows from ``hours`` before the mark on, inclusive, to catch late arrivals."""
    start = instant(mark) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return df.filter(F.col(ts) >= start)


def incremental_summary(df: DataFrame, ts: str, start: str | datetime) -> DataFrame:
    """Full, incremental and skipped row counts with both time ranges, in one pass."""
    fresh = F.col(ts) >= instant(start)
    return df.agg(
        F.count("*").alias("full_rows"),
        F.count_if(fresh).alias("incremental_rows"),
        (F.count("*") - F.count_if(fresh)).alias("skipped_rows"),
        F.min(ts).alias("full_min"),
        F.max(ts).alias("full_max"),
        F.min(F.when(fresh, F.col(ts))).alias("incremental_min"),
        F.max(F.when(fresh, F.col(ts))).alias("incremental_max"),
    )


def next_mark(rows: DataFrame, ts: str, mark: str | datetime) -> DataFrame:
    """The mark after processing ``rows``: their maximum, or the old mark when there are none."""
    return rows.agg(F.coalesce(F.max(ts).cast("timestamp_ntz"), instant(mark)).alias("mark"))


def latest_per_key(df: DataFrame, key: str, ts: str, tie_break: Sequence[str] | None = None) -> DataFrame:
    """The newest row of each key; ties are settled by the remaining columns.

    ``row_number() = 1`` lets Spark drop all but one row per key in each map
    task before the shuffle, so a hot key never reaches one task whole.
    """
    rest = [c for c in df.columns if c not in (key, ts)] if tie_break is None else list(tie_break)
    newest = Window.partitionBy(key).orderBy(F.desc_nulls_last(ts), *[F.desc_nulls_last(c) for c in rest])
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def late_dedup(
    history: DataFrame, replays: DataFrame, key: str, ts: str, mark: str | datetime, hours: int = 24
) -> DataFrame:
    """Lookback rows together with replayed ones, newest row per key."""
    return latest_per_key(lookback(history, ts, mark, hours).unionByName(replays), key, ts)
