"""File-source streams: late deduplication and quarantined incremental ingest.

Both run with ``availableNow``: they process what has arrived since the last run
and stop.  The stream's own checkpoint is the high-water mark, so a failed run
resumes where it stopped and files are never processed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.operators.quarantine import flag_orders, quarantined_rows, valid_rows
from ordermill.sources.versions import BUCKETS, merge_newest, newest_rows


def parquet_stream(
    spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def dedup_within(stream: DataFrame, key: str, ts: str, delay: str = "24 hours") -> DataFrame:
    """First arrival of each key; replays within ``delay`` of it are dropped.

    State is one small entry per key seen within the delay.  A row more than
    ``delay`` behind the newest event time of earlier batches is dropped as late,
    whereas the batch lookback counts back from the stored mark.  Watermarks
    need a zoned timestamp, so a cast copy of ``ts`` carries it.
    """
    timed = stream.withColumn("_event_time", F.col(ts).cast("timestamp"))
    return timed.withWatermark("_event_time", delay).dropDuplicatesWithinWatermark([key]).drop("_event_time")


def run_to_table(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append the stream's rows to a Parquet table, exactly once per row."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_newest_versions(stream: DataFrame, key: str, ts: str, versions: str, checkpoint: str, buckets: int = BUCKETS) -> None:
    """Merge each micro-batch into the table of newest versions; a replayed batch changes nothing.

    No row is late: a correction or a replay may arrive any time after or before
    the row it belongs to.  The table holds one row for each key, so neither it
    nor a read of it grows with the number of batches.
    """
    query = (
        stream.writeStream.foreachBatch(lambda df, i: merge_newest(df, i, key, ts, versions, buckets))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest_versions(spark: SparkSession, versions: str, schema: StructType) -> DataFrame:
    """The newest row of each key over all batches, as the batch form of late deduplication gives it."""
    return newest_rows(spark, versions, schema)


def write_split_batch(batch: DataFrame, batch_id: int, valid_out: str, quarantine_out: str) -> None:
    """Split one micro-batch and overwrite its own partition in both tables.

    The partition is named by the batch id, so a replayed batch replaces what
    its first attempt wrote.  Each write reads the batch's files by itself.
    """
    flagged = flag_orders(batch)
    valid_rows(flagged).write.mode("overwrite").parquet(f"{valid_out}/batch={batch_id}")
    quarantined_rows(flagged, at=F.current_timestamp()).write.mode("overwrite").parquet(
        f"{quarantine_out}/batch={batch_id}"
    )


def run_order_ingest(stream: DataFrame, valid_out: str, quarantine_out: str, checkpoint: str) -> None:
    """Ingest new order files: valid rows to one table, rejected rows to another.

    Batch numbers restart with a new checkpoint, so both tables belong to this
    checkpoint alone.
    """
    query = (
        stream.writeStream.foreachBatch(lambda df, i: write_split_batch(df, i, valid_out, quarantine_out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
