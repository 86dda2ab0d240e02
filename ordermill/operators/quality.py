"""Audits that return findings as rows instead of printing them.

A findings row is ``(table, check, column, failures)``.  All checks of one table
share one pass: row rules are counted per key first (which combines map-side),
then the keys are summed, so key checks cost no second read.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.exact import mismatch, off_by_more_than, round2
from ordermill.functions.text import is_blank

FINDINGS = "table string, check string, column string, failures bigint"


class Rule(NamedTuple):
    """A named check; ``failing`` is true on rows that violate it."""

    check: str
    column: str
    failing: Column


def not_null(*columns: str) -> list[Rule]:
    return [Rule("null", c, F.col(c).isNull()) for c in columns]


def not_blank(*columns: str) -> list[Rule]:
    return [Rule("blank", c, is_blank(c)) for c in columns]


def not_negative(*columns: str) -> list[Rule]:
    return [Rule("negative", c, F.col(c) < 0) for c in columns]


def positive(*columns: str) -> list[Rule]:
    return [Rule("non_positive", c, F.col(c) <= 0) for c in columns]


def within(column: str, low: float, high: float) -> Rule:
    return Rule("out_of_range", column, (F.col(column) < low) | (F.col(column) > high))


def not_before(later: str, earlier: str) -> Rule:
    """``later`` must not precede ``earlier``; rows missing either are not judged."""
    return Rule("before_" + earlier, later, F.col(later) < F.col(earlier))


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    return Rule("not_in_domain", column, ~F.col(column).isin(list(allowed)))


def total_is_sum(total: str, *parts: str) -> Rule:
    """A stored total must equal the rounded sum of its parts, NULLs included."""
    return Rule("derived_total", total, mismatch(F.col(total), round2(sum(map(F.col, parts[1:]), F.col(parts[0])))))


def average_is_ratio(average: str, total: str, count: str, tolerance: float = 0.01) -> Rule:
    """A stored average must be ``total / count``; rows with count 0 are not judged.

    Compared as doubles; a billionth is added, so that a difference of just the
    tolerance is not lost to floating point.
    """
    ratio = F.try_divide(F.col(total), F.col(count))
    return Rule(
        "derived_average", average, (F.col(count) > 0) & off_by_more_than(F.col(average), ratio, tolerance + 1e-9)
    )


def any_invalid(check: str, columns: Iterable[str]) -> Rule:
    """One failure per row in which any of the metrics is negative."""
    columns = list(columns)
    return Rule(check, ",".join(columns), reduce(lambda a, b: a | b, [F.col(c) < 0 for c in columns]))


KEY_CHECKS = ("duplicate_key", "surplus_rows", "null_key")


def audit(
    df: DataFrame,
    table: str,
    rules: Sequence[Rule] = (),
    key: str | Sequence[str] | None = None,
    key_checks: Sequence[str] = KEY_CHECKS,
) -> DataFrame:
    """Findings of all rules, and of the key checks when a key is given.

    ``duplicate_key`` counts keys that occur more than once, ``surplus_rows`` the
    rows beyond the first of each key, ``null_key`` rows with a NULL in the key.
    """
    counted = [F.count_if(r.failing).alias(f"_f{i}") for i, r in enumerate(rules)]
    named = [(r.check, r.column, F.sum(f"_f{i}")) for i, r in enumerate(rules)]
    if key is None:
        totals_in = df.agg(*counted)
    else:
        keys = [key] if isinstance(key, str) else list(key)
        totals_in = df.groupBy(*keys).agg(F.count("*").alias("_copies"), *counted)
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        available = {
            "duplicate_key": F.count_if(F.col("_copies") > 1),
            "surplus_rows": F.sum(F.col("_copies") - 1),
            "null_key": F.sum(F.when(any_null, F.col("_copies"))),
        }
        named = [(c, ",".join(keys), available[c]) for c in key_checks] + named
    totals = totals_in.agg(*[F.coalesce(total, F.lit(0)).alias(f"t{i}") for i, (_, _, total) in enumerate(named)])
    rows = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"t{i}").alias("failures"),
        )
        for i, (check, column, _) in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*rows)))


def union_findings(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# -- profiles -----------------------------------------------------------------


def profile_table(df: DataFrame, table: str) -> DataFrame:
    """Rows, columns and NULLs per column, in one aggregate."""
    names = df.columns
    totals = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return (
        totals.unpivot(["_rows"], names, "column", "nulls")
        .select(F.lit(table).alias("table"), "column", F.col("_rows").alias("rows"), "nulls")
        .withColumn("columns", F.lit(len(names)))
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per metric, as typed columns.

    Means come from sums of decimals with twelve places, whatever the scale of
    the column.
    """
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("count"),
            F.round(F.sum(F.col(c).cast("decimal(38,12)")).cast("double") / F.count(c), 6).alias("mean"),
            F.round(F.stddev_samp(F.col(c).cast("double")), 4).alias("stddev"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    return df.agg(F.array(*rows).alias("metrics")).select(F.inline("metrics"))


def row_counts(tables: Mapping[str, DataFrame], **tags: str) -> DataFrame:
    """One ``(table, rows)`` row per table, with constant tag columns in front."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(
            *[F.lit(v).alias(k) for k, v in tags.items()], F.lit(name).alias("table"), "rows"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_count_check(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Findings for tables whose row count is not the expected one.

    Both inputs are ``(table, rows)``; a table present on one side only counts
    as a failure of all its rows.  Expectations are data, never constants.
    """
    sides = actual.select("table", F.col("rows").alias("n")).unionByName(
        expected.select("table", (-F.col("rows")).alias("n"))
    )
    return (
        sides.groupBy("table")
        .agg(F.abs(F.sum("n")).alias("failures"))
        .select("table", F.lit("row_count").alias("check"), F.lit("*").alias("column"), "failures")
    )


# -- relationships ------------------------------------------------------------


def orphan_check(child: DataFrame, parent: DataFrame, key: str, relation: str, parent_key: str | None = None) -> DataFrame:
    """Child rows and keys without a parent; a NULL key has no parent.

    Children are counted per key before the anti join, so a hot key travels as
    one row per task; parents may repeat a key and are made distinct alike.
    """
    parents = parent.select(F.col(parent_key or key).alias(key)).distinct()
    per_key = child.groupBy(key).agg(F.count("*").alias("_rows"))
    return (
        per_key.join(parents, key, "left_anti")
        .agg(F.count("*").alias("orphan_keys"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"))
        .select(F.lit(relation).alias("relation"), F.lit(key).alias("key"), "orphan_keys", "orphan_rows")
    )


def join_fanout(left: DataFrame, right: DataFrame, key: str, relation: str) -> DataFrame:
    """Rows before and after ``left LEFT JOIN right``, without producing the joined rows.

    Both sides are counted per key; the join of the counts says how many rows
    the full join would have.
    """
    before = left.groupBy(key).agg(F.count("*").alias("_l"))
    children = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_r"))
    return (
        before.join(children, key, "left")
        .agg(
            F.coalesce(F.sum("_l"), F.lit(0)).alias("left_rows"),
            F.coalesce(F.sum(F.col("_l") * F.coalesce(F.col("_r"), F.lit(1))), F.lit(0)).alias("joined_rows"),
            F.coalesce(F.sum(F.when(F.col("_r").isNull(), F.col("_l"))), F.lit(0)).alias("unmatched_rows"),
            F.coalesce(F.max("_r"), F.lit(0)).alias("most_matches"),
        )
        .select(F.lit(relation).alias("relation"), "left_rows", "joined_rows", "unmatched_rows", "most_matches")
    )


# -- recomputation --------------------------------------------------------------


def compare_metrics(
    stored: DataFrame,
    recomputed: DataFrame,
    table: str,
    keys: Sequence[str],
    exact: Sequence[str],
    approximate: Sequence[str],
    tolerance: float = 0.001,
) -> DataFrame:
    """Findings per metric that differs between a stored mart and its recomputation.

    One aggregate and one join serve all metrics.  Keys match NULL-safe.  A key
    the recomputation lacks stands for zeros, as in the marts.
    """
    old, new = stored.alias("old"), recomputed.alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])

    def pair(metric: str) -> tuple[Column, Column]:
        return F.col(f"old.{metric}"), F.coalesce(F.col(f"new.{metric}"), F.lit(0))

    rules = [Rule("recomputed", m, mismatch(*pair(m))) for m in exact]
    rules += [Rule("recomputed", m, off_by_more_than(*pair(m), tolerance)) for m in approximate]
    return audit(old.join(new, on, "left"), table, rules)


# -- reconciliation ---------------------------------------------------------------


def revenue_reconciliation(orders: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Product plus freight revenue against the order totals; payments are reported only.

    Sums over a whole table run in decimals, which cannot overflow here.
    """

    def total(c: str) -> Column:
        return F.sum(F.col(c).cast("decimal(18,2)")).alias(c)

    sums = orders.agg(*[total(c) for c in ("product_revenue", "freight_revenue", "total_order_value", "total_payment")])
    gap = F.col("product_revenue") + F.col("freight_revenue") - F.col("total_order_value")
    return sums.withColumn("passed", F.abs(gap) <= F.lit(tolerance).cast("decimal(18,4)")).select(
        *[F.col(c).cast("double").alias(c) for c in sums.columns], "passed"
    )
