"""Raw CSV to typed Parquet, table by table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ordermill.sources.contracts import FREE_TEXT_TABLES, SOURCE_TABLES, contract
from ordermill.sources.tables import CORRUPT, read_csv_permissive, write_tables


def bronze_ingest(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    bronze_root: str,
    schemas: Mapping[str, StructType] | None = None,
) -> dict[str, DataFrame]:
    """Read each source table's CSV under its contract and store it as Parquet.

    ``raw_paths`` maps table name to CSV path and must name every table: a
    missing input raises instead of being counted as absent.  A record with a
    cell that does not parse keeps its other cells; its raw text is stored beside
    it, see ``rejected_records``.
    """
    missing = [t for t in SOURCE_TABLES if t not in raw_paths]
    if missing:
        raise ValueError(f"no raw path for: {missing}")
    rows = {
        table: read_csv_permissive(
            spark,
            raw_paths[table],
            schemas[table] if schemas else contract(table),
            multi_line=table in FREE_TEXT_TABLES,
            keep_corrupt=True,
        )
        for table in SOURCE_TABLES
    }
    return {table: df.drop(CORRUPT) for table, df in write_tables(rows, bronze_root).items()}


def rejected_records(spark: SparkSession, bronze_root: str) -> DataFrame:
    """``table, record``: the raw text of every record that did not fit its table's contract."""
    parts = [
        spark.read.parquet(f"{bronze_root}/{table}")
        .filter(F.col(CORRUPT).isNotNull())
        .select(F.lit(table).alias("table"), F.col(CORRUPT).alias("record"))
        for table in SOURCE_TABLES
    ]
    return reduce(DataFrame.unionByName, parts)
