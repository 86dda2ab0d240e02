"""High-water marks of an incremental job: a log of small files, one entry for each run.

An entry is put only if its run has none, so of two runs that race one wins and
the other learns of it.  Every few runs the log is folded into one file; entries
and folded files may overlap for a moment, which reading them distinct hides.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.tables import file_names, path_exists, remove_path

#: Runs after which the log is folded.
FOLD = 8

ENTRY = "run long, mark string, attempt string"


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under a name nobody has taken; False if somebody has.

    The file is complete before it has its name.  A local disk gives the name by
    a hard link and other stores by a rename that overwrites nothing; both are
    one step.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    final = jvm.org.apache.hadoop.fs.Path(path)
    store = final.getFileSystem(conf)
    store.mkdirs(final.getParent())
    final, draft = store.makeQualified(final), store.makeQualified(jvm.org.apache.hadoop.fs.Path(final.getParent(), f"_{uuid.uuid4().hex}"))
    out = store.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if final.toUri().getScheme() == "file":
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(final.toUri()).toPath(), jvm.java.io.File(draft.toUri()).toPath())
        else:
            kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
            none = spark.sparkContext._gateway.new_array(kind, 1)
            none[0] = kind.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), conf).rename(draft, final, none)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    finally:
        store.delete(draft, False)


def write_mark(spark: SparkSession, root: str, run: int, mark: datetime, attempt: str | None = None) -> bool:
    """Add the mark of a run, with the attempt whose rows count; False, and nothing changes, if the run has one already."""
    if run <= folded_to(spark, root):
        return False
    entry = json.dumps({"run": run, "mark": str(mark), "attempt": attempt})
    if not put_if_absent(spark, f"{root}/run-{run:020d}.json", entry):
        return False
    if run and run % FOLD == 0:
        fold(spark, root, run)
    return True


def folded_to(spark: SparkSession, root: str) -> int:
    """The last run that a folded file covers, -1 without one."""
    names = file_names(spark, root) if path_exists(spark, root) else []
    return max((int(n[5:-5]) for n in names if n.startswith("upto-")), default=-1)


def fold(spark: SparkSession, root: str, run: int) -> None:
    """Gather all entries up to ``run`` in one file and remove what it replaces; a few bytes for each run."""
    rows = spark.read.schema(ENTRY).json(root).filter(F.col("run") <= run).distinct().orderBy("run").collect()
    put_if_absent(spark, f"{root}/upto-{run:020d}.json", "\n".join(json.dumps(r.asDict()) for r in rows))
    for name in file_names(spark, root):
        kind, _, number = name.removesuffix(".json").partition("-")
        if (kind == "run" and int(number) <= run) or (kind == "upto" and int(number) < run):
            remove_path(spark, f"{root}/{name}")


def mark_history(spark: SparkSession, root: str) -> DataFrame:
    """``run, mark, attempt`` of every committed run."""
    return spark.read.schema(ENTRY).json(root).distinct().withColumn("mark", F.col("mark").cast("timestamp_ntz"))


def read_mark(spark: SparkSession, root: str) -> tuple[int, datetime]:
    """Latest run number and its mark.

    One scalar reaches the driver on purpose: as a literal it is pushed to the
    Parquet scan and does not change when the log goes on.
    """
    row = mark_history(spark, root).orderBy(F.desc("run")).limit(1).first()
    if row is None:
        raise ValueError(f"no mark stored under {root}")
    return row["run"], row["mark"]
