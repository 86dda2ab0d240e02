"""Quoted CSV with line breaks inside records, read by as many tasks as the file has splits.

Where a record begins depends on all quotes before it, so a plain reader gives a
file to one task.  Here a file is read as lines, which tasks can do from any byte
on.  Whether a line ends inside a quoted field is known for both ways it can
begin, inside or outside: a function over two states.  Each task composes the
functions of its lines, a scan over the composed functions of a file's splits
gives the state in which each split really begins, and a second pass cuts the
lines into records.  Only a record that crosses into another split is shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What runs in tasks is sent by value: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A field: in quotes (a doubled quote stands for one) and whatever follows up to the comma, or anything that begins otherwise.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"[^,]*+|[^",][^,]*+)?+'

#: A line that ends outside of quotes, beginning outside or inside.  All loops are possessive: linear, and no recursion.
FROM_OUTSIDE = rf"\A{FIELD}(?:,{FIELD})*+\z"
FROM_INSIDE = rf'\A[^"]*+(?:""[^"]*+)*+"[^,]*+(?:,{FIELD})*+\z'


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, line, out, ins``: lines in the order of their split, and whether each ends inside quotes if it begins outside, inside."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quoted = F.contains("line", F.lit('"'))
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line")).select(
        "*", (quoted & ~F.rlike("line", F.lit(FROM_OUTSIDE))).alias("out"), (~quoted | ~F.rlike("line", F.lit(FROM_INSIDE))).alias("ins")
    )


def states_after(out: np.ndarray, ins: np.ndarray, state: bool | np.ndarray) -> np.ndarray:
    """Whether each line ends inside quotes when the first begins in ``state``.

    A line settles the state, keeps it or turns it around; so a line's state is
    what was settled last, turned around by each turn since.
    """
    settles, turns = out == ins, np.cumsum(out & ~ins)
    last = np.maximum.accumulate(np.where(settles, np.arange(len(out)), -1))
    known = last >= 0
    base = np.where(known, out[last], state)
    return base ^ ((turns - np.where(known, turns[last], 0)) % 2 == 1)


def runs(batch: pa.RecordBatch, *names: str) -> list[tuple[int, int]]:
    """Stretches of rows with equal values of ``names``."""
    if not batch.num_rows:
        return []
    change = np.zeros(batch.num_rows, dtype=bool)
    for name in names:
        column = batch.column(name)
        column = column.dictionary_encode().indices if pa.types.is_string(column.type) else column
        values = column.to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
    return list(zip(edges[:-1], edges[1:], strict=True))


def split_states(lines: DataFrame) -> DataFrame:
    """``file, start, inside``: whether each split of each file begins inside quotes."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state = None, (False, True)

        def told() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"file": [split[0]], "start": [split[1]], "out": [state[0]], "ins": [state[1]]})

        for batch in batches:
            for a, b in runs(batch, "file", "start"):
                here = batch.column("file")[a].as_py(), batch.column("start")[a].as_py()
                if here != split:
                    if split is not None:
                        yield told()
                    split, state = here, (False, True)
                out, ins = (batch.column(c).to_numpy(zero_copy_only=False)[a:b] for c in ("out", "ins"))
                state = tuple(bool(states_after(out, ins, s)[-1]) for s in state)
        if split is not None:
            yield told()

    splits = lines.select("file", "start", "out", "ins").mapInArrow(compose, "file string, start long, out boolean, ins boolean")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    settles = F.col("out") == F.col("ins")
    turned = splits.withColumn("turns", F.sum((F.col("out") & ~F.col("ins")).cast("int")).over(order))
    since = F.coalesce(F.max("turns").over(before), F.lit(0)) - F.coalesce(F.last(F.when(settles, F.col("turns")), ignorenulls=True).over(before), F.lit(0))
    settled = F.coalesce(F.last(F.when(settles, F.col("out")), ignorenulls=True).over(before), F.lit(False))
    return turned.select("file", "start", (settled != (since % 2 == 1)).alias("inside"))


def pieces_of(lines: DataFrame, states: DataFrame) -> DataFrame:
    """``file, start, text, opened, closed, head``: records, and the parts of those that cross into another split.

    ``opened`` tells whether the record begins here, ``closed`` whether it ends
    here, and ``head`` whether it is the first of its file.  The states are one
    row a split, hence the broadcast, which keeps lines in order.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, state, held, opened, fresh = None, False, [], False, True

        def piece(closed: bool) -> dict:
            return {"file": split[0], "start": split[1], "text": "\n".join(held), "opened": opened, "closed": closed, "head": opened and fresh and split[1] == 0}

        def rows(pieces: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(pieces, schema=SCHEMA)

        for batch in batches:
            for a, b in runs(batch, "file", "start"):
                here = batch.column("file")[a].as_py(), batch.column("start")[a].as_py()
                if here != split:
                    if held:
                        yield rows([piece(not state)])
                    split, state, held, opened, fresh = here, batch.column("inside")[a].as_py(), [], False, True
                text = batch.column("line").slice(a, b - a)
                out, ins = (batch.column(c).to_numpy(zero_copy_only=False)[a:b] for c in ("out", "ins"))
                after = states_after(out, ins, state)
                begins = np.flatnonzero(~np.concatenate(([state], after[:-1])))
                state = bool(after[-1])
                if not len(begins):
                    held += text.to_pylist()
                    continue
                # What was held ends before the first beginning; the last record waits for what follows.
                held += text.slice(0, begins[0]).to_pylist()
                if held:
                    yield rows([piece(True)])
                    fresh = fresh and not opened
                ends, inner = begins[1:], begins[:-1]
                if len(inner):
                    long = np.flatnonzero(ends - inner > 1)
                    whole = text.take(pa.array(inner)).to_pylist() if len(long) else text.take(pa.array(inner))
                    for i in long:
                        whole[i] = "\n".join(text.slice(inner[i], ends[i] - inner[i]).to_pylist())
                    n, head = len(inner), np.zeros(len(inner), dtype=bool)
                    head[0] = fresh and split[1] == 0
                    fresh = False
                    yes = pa.array(np.ones(n, dtype=bool))
                    columns = [pa.array([split[0]] * n), pa.array(np.full(n, split[1])), pa.array(whole, pa.string()), yes, yes, pa.array(head)]
                    yield pa.RecordBatch.from_arrays(columns, schema=SCHEMA)
                held, opened = text.slice(begins[-1]).to_pylist(), True
        if held:
            yield rows([piece(not state)])

    return lines.join(F.broadcast(states), ["file", "start"]).select("file", "start", "line", "out", "ins", "inside").mapInArrow(
        cut, "file string, start long, text string, opened boolean, closed boolean, head boolean"
    )


SCHEMA = pa.schema([("file", pa.string()), ("start", pa.int64()), ("text", pa.string()), ("opened", pa.bool_()), ("closed", pa.bool_()), ("head", pa.bool_())])


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``record, head``: every record of the files at ``path`` as text, and whether it is its file's first.

    Records end at a line feed or at a carriage return with one, outside of
    quotes; breaks in quotes stay as they are.  Empty ones are left out.  A quote that nothing closes takes the rest
    of its file, as in any reader.
    """
    lines = lines_of(spark, path)
    pieces = pieces_of(lines, split_states(lines))
    whole = F.col("opened") & F.col("closed")
    parts = pieces.filter(~whole)
    # Within a split, what ends an earlier record comes before what begins a later one.
    order = Window.partitionBy("file").orderBy("start", "opened")
    numbered = parts.withColumn("number", F.sum(F.col("opened").cast("int")).over(order))
    held = F.array_sort(F.collect_list(F.struct("start", "opened", "text")))
    joined = numbered.groupBy("file", "number").agg(F.array_join(F.transform(held, lambda p: p["text"]), "\n").alias("text"), F.bool_or("head").alias("head"))
    records = pieces.filter(whole).select("text", "head").unionByName(joined.select("text", "head"))
    text = F.regexp_replace("text", r"\r\z", "")
    text = F.when(F.col("head"), F.regexp_replace(text, "\\A\ufeff", "")).otherwise(text)
    return records.select(text.alias("record"), "head").filter(F.trim("record") != "")
