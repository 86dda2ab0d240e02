"""The layered job: raw CSV to bronze, bronze to silver, silver to gold, then the audit.

Each layer is written once and read back by the next, so nothing is computed
twice and lost executors recompute one layer at most.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from ordermill.operators import marts, quality
from ordermill.operators.clean import CLEANERS
from ordermill.operators.incremental import after_mark, between_dates, next_mark
from ordermill.operators.quarantine import flag_orders, quarantined_rows, valid_rows
from ordermill.plans.validation import gold_expectations, raise_on_failure, validate_gold
from ordermill.sources.ingest import bronze_ingest
from ordermill.sources.marks import mark_history, read_mark, write_mark
from ordermill.sources.tables import COMPACT, in_slice, remove_path, shuffles_dropped, write_in_turn, write_table, write_tables


def build_silver(bronze: Mapping[str, DataFrame], root: str) -> dict[str, DataFrame]:
    return write_tables({t: clean(bronze[t]) for t, clean in CLEANERS.items()}, root, COMPACT)


# The planned bytes of items that a slice is worth, and the most slices.
SLICE_BYTES = 16 << 20
MOST_SLICES = 6


def slices_for(items: DataFrame) -> int:
    """Into how many slices of the orders the layers are cut: one for small inputs, as each slice is a job and reads its sources anew."""
    planned = int(items._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(1, min(MOST_SLICES, planned // SLICE_BYTES))


def cut(df: DataFrame, key: str, i: int, slices: int) -> DataFrame:
    """The rows of a slice of the keys; of lines stored by slices of the orders, just their folder."""
    if slices == 1:
        return df
    folder = _folder(slices)
    return df.filter(F.col(folder) == i if key == "order_id" and folder in df.columns else in_slice(key, i, slices))


def _folder(slices: int) -> str:
    return f"slice_of_{slices}"


def build_lines(silver: Mapping[str, DataFrame], root: str) -> DataFrame:
    """The items by order, product and seller, stored: the one shuffle of all items, from which all marts roll up."""
    items, path = silver["order_items"], f"{root}/order_lines"
    slices = slices_for(items)
    if slices == 1:
        return write_in_turn([marts.item_lines(items)], path)
    remove_path(items.sparkSession, path)
    for i in range(slices):
        lines = marts.item_lines(cut(items, "order_id", i, slices))
        write_in_turn([lines], f"{path}/{_folder(slices)}={i}")
    schema = StructType(list(lines.schema.fields)).add(_folder(slices), IntegerType())
    return items.sparkSession.read.schema(schema).parquet(path)


def gold_plans(silver: Mapping[str, DataFrame], lines: DataFrame) -> dict[str, DataFrame]:
    """The marts that need no other mart."""
    s = silver
    return {
        "orders": marts.gold_orders(s["orders"], lines, s["order_payments"]),
        "products": marts.gold_products(s["products"], lines),
        "sellers": marts.gold_sellers(s["sellers"], lines),
        "category": marts.gold_category(lines, s["products"], s["category_translation"]),
        "reviews": marts.gold_reviews(s["order_reviews"]),
        "payments": marts.gold_payments(s["order_payments"]),
        "geolocation": marts.gold_geolocation(s["geolocation"]),
    }


def build_gold(silver: Mapping[str, DataFrame], root: str, lines: DataFrame | None = None) -> dict[str, DataFrame]:
    """The eight marts; customers read the stored order mart.

    Those of a small input are written side by side.  Larger ones follow one
    another, each slice by slice, as all shuffles together are many times the input.
    """
    lines = build_lines(silver, root) if lines is None else lines
    slices = slices_for(silver["order_items"])
    if slices == 1:
        with shuffles_dropped(lines.sparkSession):
            gold = write_tables(gold_plans(silver, lines), root, COMPACT)
    else:
        gold = {name: write_in_turn(parts, f"{root}/{name}") for name, parts in sliced_plans(silver, lines, root, slices).items()}
        for build in CATEGORY_SUMS:
            remove_path(lines.sparkSession, f"{root}/{build.__name__}")
    n, tables = _fewer(slices), (silver["customers"], gold["orders"])
    parts = [marts.gold_customers(*(cut(t, "customer_id", i, n) for t in tables)) for i in range(n)]
    return gold | {"customers": write_in_turn(parts, f"{root}/customers")}


def _fewer(slices: int) -> int:
    """Slices of other keys than the order's, for which each slice reads all lines."""
    return (slices + 1) // 2


# The sums of the category mart, which are stored while it is built, with the key of which disjoint sets add up.
CATEGORY_SUMS = {marts.category_sales: "order_id", marts.category_products: "product_id"}


def sliced_plans(silver: Mapping[str, DataFrame], lines: DataFrame, root: str, slices: int) -> dict[str, Iterable[DataFrame]]:
    """``gold_plans`` in parts, one for each slice of the key by which a mart joins and groups.

    Categories are too few to slice: their sums are stored here, slice by slice
    of what they add up over, and the mart totals them.
    """
    s, fewer = silver, _fewer(slices)
    counts = {"order_id": slices, "product_id": fewer}

    def parts(build: Callable[..., DataFrame], key: str, n: int, *tables: DataFrame) -> list[DataFrame]:
        return [build(*(cut(t, key, i, n) for t in tables)) for i in range(n)]

    def sums(build: Callable[..., DataFrame], key: str) -> DataFrame:
        found = (build(cut(lines, key, i, counts[key]), s["products"]) for i in range(counts[key]))
        return write_in_turn(found, f"{root}/{build.__name__}")

    return {
        "products": parts(marts.gold_products, "product_id", fewer, s["products"], lines),
        "sellers": parts(marts.gold_sellers, "seller_id", fewer, s["sellers"], lines),
        "category": [marts.category_totals(*(sums(b, key) for b, key in CATEGORY_SUMS.items()), s["category_translation"])],
        "orders": parts(marts.gold_orders, "order_id", slices, s["orders"], lines, s["order_payments"]),
        "payments": parts(marts.gold_payments, "order_id", slices, s["order_payments"]),
        "reviews": [marts.gold_reviews(s["order_reviews"])],
        "geolocation": [marts.gold_geolocation(s["geolocation"])],
    }


def layer_row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per layer and table."""
    return quality.union_findings(quality.row_counts(tables, layer=layer) for layer, tables in layers.items())


def layer_growth(counts: DataFrame, order: tuple[str, ...] = ("bronze", "silver", "gold")) -> DataFrame:
    """Rows per table across the layers, flagged where a layer has more rows than the one before."""
    per_layer = [F.sum(F.when(F.col("layer") == name, F.col("rows"))).alias(f"{name}_rows") for name in order]
    wide = counts.groupBy("table").agg(*per_layer)
    grew = F.lit(False)
    for before, after in zip(order, order[1:]):
        grew = grew | F.coalesce(F.col(f"{after}_rows") > F.col(f"{before}_rows"), F.lit(False))
    return wide.withColumn("increased", grew)


def run_medallion(
    spark: SparkSession,
    raw_paths: Mapping[str, str],
    root: str,
    schemas: Mapping[str, StructType] | None = None,
    strict: bool = True,
) -> dict[str, dict[str, DataFrame]]:
    """All layers below ``root`` and the findings; raises on a failed check when ``strict``."""
    bronze = bronze_ingest(spark, raw_paths, f"{root}/bronze", schemas)
    silver = build_silver(bronze, f"{root}/silver")
    lines = build_lines(silver, f"{root}/shared")
    gold = build_gold(silver, f"{root}/gold", lines)
    findings = write_table(validate_gold(gold, gold_expectations(silver, lines)).coalesce(1), f"{root}/findings")
    if strict:
        raise_on_failure(findings)
    return {"bronze": bronze, "silver": silver, "gold": gold, "audit": {"findings": findings}}


def run_quarantine(feed: DataFrame, valid_path: str, quarantine_path: str) -> tuple[DataFrame, DataFrame]:
    """Write the valid and the quarantined rows of a feed, each in its own narrow pass over it."""
    flagged = flag_orders(feed)
    return write_table(valid_rows(flagged), valid_path), write_table(quarantined_rows(flagged), quarantine_path)


def run_idempotent_batch(source: DataFrame, ts: str, path: str, start: str, end: str) -> DataFrame:
    """Replace the days from ``start`` up to before ``end`` by the rows of ``source``, and only those days.

    A rerun changes nothing, and a day that has lost its rows ends up empty:
    overwriting partitions reaches only days with rows, so the others are
    overwritten by themselves (a list no longer than the interval).
    ``rebalance`` gathers a day into few files and still splits a day too large
    for one task.
    """
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    by_day = between_dates(source, ts, start, end).withColumn("day", F.to_date(ts))
    write_table(by_day.hint("rebalance", "day"), path, partition_by="day")
    table = source.sparkSession.read.schema(by_day.schema).parquet(path)
    stored = table.filter((F.col("day") >= F.lit(first)) & (F.col("day") < F.lit(last))).select("day").distinct()
    emptied = stored.join(by_day.select("day").distinct(), "day", "left_anti").collect()
    for row in emptied:
        write_table(by_day.filter(F.lit(False)).drop("day"), f"{path}/day={row['day']}")
    return source.sparkSession.read.schema(by_day.schema).parquet(path)


class ConcurrentRunError(RuntimeError):
    """Another run has committed in the meantime; nothing of this one counts."""


def run_incremental(source: DataFrame, ts: str, marks: str, out: str) -> None:
    """Process the rows after the stored mark, then move the mark.

    Each attempt writes to a folder of its own, and the mark names the attempt
    that counts (``incremental_rows``).  The mark is written last and only once
    a run: what an attempt left that failed before, or lost to another, is never
    read.  Without new rows nothing changes.
    """
    spark = source.sparkSession
    last_run, mark = read_mark(spark, marks)
    run, attempt = last_run + 1, f"a{uuid.uuid4().hex}"
    path = f"{out}/run={run}/attempt={attempt}"
    written = write_table(after_mark(source, ts, mark), path)
    reached = next_mark(written, ts, mark).first()["mark"]
    if reached <= mark:
        remove_path(spark, path)
    elif not write_mark(spark, marks, run, reached, attempt):
        remove_path(spark, path)
        raise ConcurrentRunError(f"run {run} is committed already")


def incremental_rows(spark: SparkSession, marks: str, out: str) -> DataFrame:
    """The rows of all committed runs, with ``run`` and ``mark``.

    The log has a few bytes a run; joined on the partition columns, it keeps
    other attempts' files from being read.
    """
    committed = mark_history(spark, marks).filter("attempt IS NOT NULL")
    return spark.read.parquet(out).join(committed, ["run", "attempt"]).drop("attempt")
