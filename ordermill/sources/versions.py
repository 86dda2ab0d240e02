"""A table with the newest version of each key, merged batch by batch.

Rows are dealt to buckets by a hash of their key.  A batch rewrites the buckets
it touches, each as a new generation, and a commit then names the generation of
every bucket.  Commits alternate between two folders, so the last one stays whole
while the next is written.  What the new commit no longer names is removed:
stored are the newest versions and nothing else, however many batches came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.incremental import latest_per_key
from ordermill.sources.tables import path_exists, remove_path

#: Buckets of a new table; one should hold what a task can sort.
BUCKETS = 64


def last_commit(spark: SparkSession, root: str) -> tuple[int, int, dict[int, int]]:
    """The number of the last merged batch (-1 before any), the number of buckets, and the generation of each that has rows."""
    slots = [f"{root}/commits/slot={i}" for i in (0, 1)]
    found = [p for p in slots if path_exists(spark, p)]
    if not found:
        return -1, 0, {}
    commits = spark.read.schema("batch long, buckets int, bucket int, generation long").parquet(*found)
    rows = commits.filter(F.col("batch") == commits.agg(F.max("batch")).scalar()).collect()  # one a bucket
    if not rows:
        return -1, 0, {}
    return rows[0]["batch"], rows[0]["buckets"], {r["bucket"]: r["generation"] for r in rows if r["bucket"] is not None}


def bucket_paths(root: str, generations: dict[int, int], buckets: list[int] | None = None) -> list[str]:
    wanted = generations if buckets is None else [b for b in buckets if b in generations]
    return [f"{root}/data/generation={generations[b]}/bucket={b}" for b in wanted]


def merge_newest(batch: DataFrame, batch_id: int, key: str, ts: str, root: str, buckets: int = BUCKETS) -> None:
    """Merge a batch into the table at ``root``; the newest row of each key stays, whichever batch it came with.

    A batch that is merged already changes nothing, and one that failed midway is
    merged again from the same commit, so each counts once.  Only buckets with
    rows in the batch are read and rewritten.
    """
    spark = batch.sparkSession
    last, held, generations = last_commit(spark, root)
    if last >= batch_id:
        return
    buckets = held or buckets
    number = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    touched = sorted(r["bucket"] for r in batch.select(number).distinct().collect())  # at most ``buckets``
    old = bucket_paths(root, generations, touched)
    rows = batch if not old else batch.unionByName(spark.read.schema(batch.schema).parquet(*old))
    newest = latest_per_key(rows, key, ts).select("*", number)
    written = f"{root}/data/generation={batch_id}"
    # A bucket goes to few files, and one too large for a task is split.
    newest.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(written)
    current = generations | dict.fromkeys(touched, batch_id)
    named = [(batch_id, buckets, b, g) for b, g in current.items()] or [(batch_id, buckets, None, None)]
    commit = spark.createDataFrame(named, "batch long, buckets int, bucket int, generation long")
    commit.coalesce(1).write.mode("overwrite").parquet(f"{root}/commits/slot={batch_id % 2}")
    for path in old:
        remove_path(spark, path)


def newest_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The table as its last commit has it.

    A merge that ends while rows are being read removes files this may still
    need; the read then fails and is to be repeated.
    """
    _, _, generations = last_commit(spark, root)
    paths = bucket_paths(root, generations)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
