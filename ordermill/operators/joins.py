"""Join strategies a caller can ask for by name; all return the rows of the plain join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join to a dimension, without a hint.

    Spark broadcasts the dimension if its size, estimated or measured while the
    job runs, is under the session's bound; beyond it the join shuffles both
    sides and adaptive execution splits hot keys.
    """
    return facts.join(dimension, key, "left")


def shuffle_join(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Sort-merge join whatever the sizes, by a hint on this join alone."""
    return left.join(right.hint("merge"), key, how)


def frequent_candidates(df: DataFrame, key: str, share: float) -> DataFrame:
    """At most ``1 / share`` keys, among them every one with more than ``share`` of the keyed rows.

    Each task sums up its rows in a fixed number of counters and the summaries
    are merged, so no key is shuffled with its count.
    """
    keyed = df.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"))
    return keyed.stat.freqItems(["key"], share).select(F.explode("key_freqItems").alias(key))


def hot_keys(df: DataFrame, key: str, share: float, rows_per_salt: int | None = None) -> DataFrame:
    """Keys holding more than ``share`` of the keyed rows (at most ``1 / share`` of them), and into how many parts each is cut.

    Only the candidates are counted.  Without ``rows_per_salt`` a part is a
    quarter of a task's even share: all keyed rows over the session's shuffle
    partitions.
    """
    keyed = df.filter(F.col(key).isNotNull()).select(key)
    total = keyed.agg(F.count("*").alias("n")).scalar()
    listed = F.broadcast(frequent_candidates(df, key, share))
    counts = keyed.join(listed, key, "left_semi").groupBy(key).agg(F.count("*").alias("n"))
    if rows_per_salt is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = F.ceil(F.col("n") * (4 * partitions) / total)
    else:
        parts = F.ceil(F.col("n") / rows_per_salt)
    return counts.filter(F.col("n") > total * share).select(key, parts.alias("_salts"))


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread_by: Iterable[str],
    rows_per_salt: int | None = None,
    hot_share: float = 0.01,
) -> DataFrame:
    """Inner or left shuffle join that cuts each hot key of ``left`` into parts of about ``rows_per_salt`` rows (see ``hot_keys``).

    Only hot keys are salted and only their matches in ``right`` are copied, once
    for each part; NULL keys match nothing and are spread as well.
    The hot-key list has at most ``1 / hot_share`` rows, which bounds its
    broadcast.  The salt is a hash of ``spread_by`` (columns that vary within a
    key), so a retried task sends each row to the same place again.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"salted_join supports inner and left joins, not {how}")
    if not 0 < hot_share <= 1:
        raise ValueError("hot_share must be above 0 and at most 1, as it bounds the broadcast list")
    hot = F.broadcast(hot_keys(left, key, hot_share, rows_per_salt))
    spread, salts = F.xxhash64(*spread_by), F.coalesce("_salts", F.lit(1).cast("long"))
    salt = F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, salts))
    salted_left = left.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    every = F.sequence(F.lit(0).cast("long"), salts - 1)
    salted_right = right.join(hot, key, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted_left.join(salted_right.hint("merge"), [key, "_salt"], how).drop("_salt")
