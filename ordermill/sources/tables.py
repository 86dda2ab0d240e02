"""CSV and Parquet reads and writes, and scratch space for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ordermill.sources.quoted import quoted_records

CORRUPT = "_corrupt_record"

# Fixed value: the codec of stored layers; a fifth smaller than the default one on the test tables.
COMPACT = "zstd"

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_scratch: str | None = None
_scratch: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the session's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine; on
    a cluster the setting is required, since executors must see the same files.
    ``remove_scratch`` removes what was written there.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="ordermill-")
        base = _local_scratch
    _scratch.append(f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _scratch[-1]


def remove_scratch(spark: SparkSession) -> None:
    """Remove every intermediate table of this process.

    Results read from them lazily, so call it when the results are consumed.
    """
    while _scratch:
        remove_path(spark, _scratch.pop())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of a table, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    """Give a file another place in the same store."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (old, new))
    if not old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, new):
        raise OSError(f"cannot rename {old} to {new}")


def file_names(spark: SparkSession, path: str, hidden: bool = False) -> list[str]:
    """Names of the files and folders in a folder; without those that readers skip, unless ``hidden``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)
    names = sorted(f.getPath().getName() for f in found)
    return names if hidden else [n for n in names if not n.startswith(("_", "."))]


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row, under an explicit schema or an inferred one; a header that differs from the schema raises."""
    reader = spark.read.option("header", True).option("enforceSchema", False)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_csv_permissive(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool = False, keep_corrupt: bool = False
) -> DataFrame:
    """CSV where a cell that does not parse becomes NULL and the record survives.

    ``multi_line`` keeps quoted line breaks inside their record; the file is
    still read by many tasks, in two passes (``quoted.quoted_records``).
    ``keep_corrupt`` adds the raw text of records that did not fit.  A header
    that differs from the schema raises.
    """
    options = {"mode": "PERMISSIVE", "quote": '"', "escape": '"'}
    wanted = schema
    if keep_corrupt:
        wanted = StructType(list(schema.fields)).add(CORRUPT, StringType())
        options["columnNameOfCorruptRecord"] = CORRUPT
    if multi_line:
        records = quoted_records(spark, path)
        header = F.lower(F.translate("record", '"', ""))
        expected = ",".join(schema.fieldNames()).lower()
        wrong = F.raise_error(F.concat(F.lit(f"CSV header does not conform to the schema {expected}: "), header))
        # The header is judged in the filter, which no column pruning removes.
        data = records.filter(F.when(~F.col("head"), True).when(header == expected, False).otherwise(wrong.cast("boolean")))
        parsed = F.from_csv("record", F.lit(wanted.simpleString()), options | {"multiLine": "true"})
        return data.select(parsed.alias("row")).select("row.*")
    reader = spark.read.option("header", True).option("enforceSchema", False).options(**options)
    return reader.schema(wanted).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row that reads back unchanged: padding, quotes, line breaks, microseconds."""
    options = {
        "header": True,
        "escape": '"',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    df.write.mode("overwrite").options(**options).csv(path)


def write_table(
    df: DataFrame, path: str, files: int | None = None, partition_by: str | None = None, compression: str | None = None
) -> DataFrame:
    """Overwrite a Parquet table and return it read back.

    With ``partition_by`` only the partitions present in ``df`` are replaced, so
    rerunning a batch leaves the table as one run did.  It is read under its own
    schema, since without a row it has no file to take one from.  The row count of the
    result comes from Parquet footers, so callers count that, not the plan.
    """
    if files is not None:
        df = df.repartition(files)
    writer = df.write.mode("overwrite")
    if compression is not None:
        writer = writer.option("compression", compression)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, compression: str | None = None) -> dict[str, DataFrame]:
    """Write independent tables side by side, so one's last tasks do not idle the cluster."""
    if not tables:
        return {}
    session = next(iter(tables.values())).sparkSession
    write = inheritable_thread_target(session)(write_table)
    with ThreadPoolExecutor(max_workers=8) as pool:
        jobs = {name: pool.submit(write, df, f"{root}/{name}", compression=compression) for name, df in tables.items()}
        return {name: job.result() for name, job in jobs.items()}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What a query in here has shuffled leaves the disks when it ends, not when the driver next collects its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def in_slice(key: str, i: int, slices: int) -> Column:
    """Whether a row's key falls in slice ``i``; another hash than that of shuffles, so that a slice fills all their partitions."""
    return F.pmod(F.xxhash64(key), F.lit(slices)) == i


def write_in_turn(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """Overwrite a Parquet table by the rows of all parts, a job for each, and return it read back.

    Only what one part shuffles is on the disks at a time.
    """
    for i, part in enumerate(parts):
        with shuffles_dropped(part.sparkSession):
            part.write.mode("append" if i else "overwrite").option("compression", COMPACT).parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write once to shared scratch space and continue from the files."""
    return write_table(df, scratch_path(df.sparkSession, label))
