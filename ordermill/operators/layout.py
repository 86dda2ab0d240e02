"""Partition layout and key skew, reported and changed with DataFrame calls."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.sources.marks import put_if_absent
from ordermill.sources.tables import file_names, path_exists, remove_path, rename_path


def partition_profile(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("rows"))


def layout_summary(df: DataFrame, layout: str) -> DataFrame:
    """Non-empty partitions, total rows and the largest partition of one layout."""
    totals = partition_profile(df).agg(
        F.count("*").alias("partitions"), F.sum("rows").alias("rows"), F.max("rows").alias("largest")
    )
    return totals.select(F.lit(layout).alias("layout"), "*")


def key_skew_profile(df: DataFrame, key: str, k: int = 10) -> DataFrame:
    """The ``k`` heaviest keys with their share of all rows and their ratio to the mean key.

    Totals come from the counted keys, not from a second pass over the rows.
    """
    counts = df.groupBy(key).agg(F.count("*").alias("rows"))
    totals = counts.agg(F.sum("rows").alias("rows"), F.count("*").alias("keys"))
    return (
        counts.orderBy(F.desc("rows"), key)
        .limit(k)
        .withColumn("share", F.round(F.col("rows") / totals.select("rows").scalar(), 6))
        .withColumn(
            "ratio_to_mean",
            F.round(F.col("rows") * totals.select("keys").scalar() / totals.select("rows").scalar(), 6),
        )
    )


def file_layout(spark: SparkSession, path: str) -> DataFrame:
    """Data files that hold rows, their total bytes and rows."""
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.first("_metadata.file_size").alias("size"), F.count("*").alias("rows"))
    )
    return files.agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"))


def file_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``path, file, folder, bytes`` of every Parquet file of a table.

    ``folder`` is where it lies, partitions included; ``file`` is the path as
    rows know it, with special characters escaped.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return files.select("path", F.col("_metadata.file_path").alias("file"), folder.alias("folder"), F.col("length").alias("bytes"))


def packed_small_files(manifest: DataFrame, target_bytes: int) -> DataFrame:
    """``bin, folder, path, file`` of the files worth rewriting: those below half the target, packed by folder.

    Files go into a folder's bins largest first, each bin near the target; what
    would be alone in its bin stays, and so does every larger file.
    """
    order = Window.partitionBy("folder").orderBy(F.desc("bytes"), "file")
    before = F.coalesce(F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    binned = manifest.filter(F.col("bytes") < target_bytes / 2).withColumn("nth", F.floor(before / target_bytes))
    together = Window.partitionBy("folder", "nth")
    packed = binned.withColumn("files", F.count("*").over(together)).filter("files > 1")
    return packed.select(F.dense_rank().over(Window.orderBy("folder", "nth")).alias("bin"), "folder", "path", "file")


def compact_table(spark: SparkSession, path: str, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Rewrite a table's small files in place into files near ``target_bytes``; returns how many were rewritten.

    Larger files are not touched, and every row stays in its partition, whatever
    the table is partitioned by.  New files are complete and listed in a plan
    before the first old one goes.  A run that dies after that leaves rows in a
    hidden folder, and the next one puts them in place first; a reader in between
    sees too few rows, never a row twice.  Two compactions of one table must not
    run at once.
    """
    finish_compactions(spark, path)
    bins = packed_small_files(file_manifest(spark, path), target_bytes).collect()  # a few bytes for each small file
    if not bins:
        return 0
    work = f"{path.rstrip('/')}/_compact-{uuid.uuid4().hex}"
    chosen = spark.createDataFrame([(r["file"], r["bin"]) for r in bins], "file string, bin int")
    rows = spark.read.parquet(*[r["path"] for r in bins])
    columns = rows.columns
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file")).join(F.broadcast(chosen), F.col("_file") == F.col("file"))
    number = max(r["bin"] for r in bins)
    rows.select(*columns, "bin").repartition(number, "bin").write.partitionBy("bin").parquet(f"{work}/new")
    plan: dict[int, dict] = {}
    for r in bins:
        plan.setdefault(r["bin"], {"bin": r["bin"], "folder": r["folder"], "old": []})["old"].append(r["path"])
    put_if_absent(spark, f"{work}/plan.json", "\n".join(json.dumps(p) for p in plan.values()))
    finish_compactions(spark, path)
    return len(bins)


def finish_compactions(spark: SparkSession, path: str) -> None:
    """Put the files of every planned rewrite in place; drop rewrites that died before they had a plan."""
    for name in file_names(spark, path, hidden=True):
        if not name.startswith("_compact-"):
            continue
        work = f"{path.rstrip('/')}/{name}"
        if path_exists(spark, f"{work}/plan.json"):
            for row in spark.read.schema("bin int, folder string, old array<string>").json(f"{work}/plan.json").collect():
                for old in row["old"]:
                    remove_path(spark, old)
                source = f"{work}/new/bin={row['bin']}"
                for i, new in enumerate(file_names(spark, source) if path_exists(spark, source) else []):
                    rename_path(spark, f"{source}/{new}", f"{row['folder']}/part-{name[9:]}-{row['bin']}-{i}.parquet")
        remove_path(spark, work)
