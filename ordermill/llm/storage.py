"""Tables that a job writes and reads back, in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ordermill.sources.tables import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` and read it back: its lineage ends here, and no task recomputes it."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
