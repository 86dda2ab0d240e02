"""Schema contracts checked against the schema and the rows of an incoming table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)


class ContractError(ValueError):
    """An incoming table breaks its contract; raised before anything is written."""


def schema_issues(expected: StructType, incoming: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, issue, expected, actual)`` per difference; nullability is not compared."""
    want = {f.name: f.dataType.simpleString() for f in expected}
    have = {f.name: f.dataType.simpleString() for f in incoming}
    issues: list[tuple[str, str, str | None, str | None]] = []
    for name, kind in want.items():
        if name not in have:
            issues.append((name, "missing", kind, None))
        elif have[name] != kind:
            issues.append((name, "type_mismatch", kind, have[name]))
    issues += [(name, "unexpected", None, kind) for name, kind in have.items() if name not in want]
    return issues


def schema_diff(df: DataFrame, expected: StructType) -> DataFrame:
    """Contract findings of a table: schema differences plus what its rows would lose.

    One aggregate over the rows counts, per contracted column, NULLs where the
    contract forbids them and values that do not cast to the contracted type.
    ``rows`` is the number of affected rows; all of them for a schema difference.
    """
    have = set(df.columns)
    measured = []
    for field in expected:
        kind = field.dataType.simpleString()
        if field.name not in have:
            continue
        value = F.col(field.name)
        if not field.nullable:
            measured.append((field.name, "null_in_required", kind, F.count_if(value.isNull())))
        if df.schema[field.name].dataType != field.dataType:
            lost = value.isNotNull() & value.try_cast(field.dataType).isNull()
            measured.append((field.name, "uncastable", kind, F.count_if(lost)))
    totals = df.agg(F.count("*").alias("_rows"), *[m[3].alias(f"m{i}") for i, m in enumerate(measured)])

    def finding(column, issue, expected_type, actual_type, rows):
        return F.struct(
            F.lit(column).alias("column"),
            F.lit(issue).alias("issue"),
            F.lit(expected_type).cast("string").alias("expected"),
            F.lit(actual_type).cast("string").alias("actual"),
            rows.alias("rows"),
        )

    structural = [finding(*issue, F.col("_rows")) for issue in schema_issues(expected, df.schema)]
    rows = list(structural)
    rows += [
        finding(name, issue, kind, df.schema[name].dataType.simpleString(), F.col(f"m{i}"))
        for i, (name, issue, kind, _) in enumerate(measured)
    ]
    if not rows:
        rows = [finding(None, "none", None, None, F.lit(0).cast("bigint"))]
        return totals.select(F.inline(F.array(*rows))).filter(F.lit(False))
    # A schema difference is one whether or not the table has rows.
    found = totals.select(F.posexplode(F.array(*rows)).alias("_nth", "_finding"))
    found = found.filter((F.col("_nth") < len(structural)) | (F.col("_finding.rows") > 0))
    return found.select("_finding.*")


#: Whole-number types from narrow to wide, with the digits each needs, and what fits a float or double exactly.
INTEGRAL = (ByteType(), ShortType(), IntegerType(), LongType())
DIGITS = (3, 5, 10, 19)
EXACT_IN = {FloatType(): INTEGRAL[:2], DoubleType(): (*INTEGRAL[:3], FloatType())}


def widest(a: DataType, b: DataType) -> DataType | None:
    """The narrowest type that holds every value of both without loss, or None.

    Whole numbers widen among themselves, into decimals and into what represents
    them exactly; dates into zone-free timestamps; structs, arrays and maps by
    their parts, where a field that one struct lacks is NULL.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        fields = []
        for name in [f.name for f in a] + [f.name for f in b if f.name not in a.names]:
            sides = [s[name].dataType for s in (a, b) if name in s.names]
            kind = widest(sides[0], sides[-1])
            if kind is None:
                return None
            fields.append(StructField(name, kind, len(sides) == 1 or a[name].nullable or b[name].nullable))
        return StructType(fields)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        kind = widest(a.elementType, b.elementType)
        return kind and ArrayType(kind, a.containsNull or b.containsNull)
    if isinstance(a, MapType) and isinstance(b, MapType):
        key, value = widest(a.keyType, b.keyType), widest(a.valueType, b.valueType)
        return MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    for one, other in ((a, b), (b, a)):
        if one in INTEGRAL and other in INTEGRAL:
            return max(a, b, key=INTEGRAL.index)
        if other in EXACT_IN.get(one, ()):
            return one
        if isinstance(one, TimestampNTZType) and isinstance(other, DateType):
            return one
    sizes = [_decimal_size(t) for t in (a, b)]
    if None in sizes:
        return None
    scale = max(s for _, s in sizes)
    precision = max(p - s for p, s in sizes) + scale
    return DecimalType(precision, scale) if precision <= 38 else None


def _decimal_size(kind: DataType) -> tuple[int, int] | None:
    """Precision and scale that hold a whole or decimal number."""
    if isinstance(kind, DecimalType):
        return kind.precision, kind.scale
    return (DIGITS[INTEGRAL.index(kind)], 0) if kind in INTEGRAL else None


def type_changes(expected: DataType, incoming: DataType, path: str = "") -> list[tuple[str, str, str | None, str | None, str | None]]:
    """``(column, issue, expected, actual, result)`` of every difference, down to nested fields.

    Issues are ``missing``, ``unexpected``, ``widened`` (the result holds both
    without loss; the expected type may be it already) and ``type_mismatch``.
    """
    if isinstance(expected, StructType) and isinstance(incoming, StructType):
        out = []
        for name in [f.name for f in expected] + [f.name for f in incoming if f.name not in expected.names]:
            at = f"{path}.{name}" if path else name
            if name not in incoming.names:
                out.append((at, "missing", expected[name].dataType.simpleString(), None, None))
            elif name not in expected.names:
                out.append((at, "unexpected", None, incoming[name].dataType.simpleString(), None))
            else:
                out += type_changes(expected[name].dataType, incoming[name].dataType, at)
        return out
    if isinstance(expected, ArrayType) and isinstance(incoming, ArrayType):
        return type_changes(expected.elementType, incoming.elementType, f"{path}.element")
    if isinstance(expected, MapType) and isinstance(incoming, MapType):
        return type_changes(expected.keyType, incoming.keyType, f"{path}.key") + type_changes(expected.valueType, incoming.valueType, f"{path}.value")
    if expected == incoming:
        return []
    kind = widest(expected, incoming)
    result = None if kind is None else kind.simpleString()
    return [(path, "type_mismatch" if kind is None else "widened", expected.simpleString(), incoming.simpleString(), result)]


def evolution_reasons(expected: StructType, incoming: StructType, allow_new_columns: bool = False) -> list[tuple[str, str]]:
    """``(column, reason)`` for everything that keeps a batch out of a table that may widen its types; empty when it is accepted."""
    reasons = {"missing": "missing_columns", "type_mismatch": "type_changed"} | ({} if allow_new_columns else {"unexpected": "new_columns"})
    return [(column, reasons[issue]) for column, issue, *_ in type_changes(expected, incoming) if issue in reasons]


def widening_diff(df: DataFrame, expected: StructType) -> DataFrame:
    """``column, issue, expected, actual, result, lost``: every difference of a table's schema, and what the expected type would lose.

    ``lost`` counts values of a top-level column that do not come back unchanged
    from the expected type: a long that fits an int is none, one that does not
    is.  One aggregate counts all columns.
    """
    changes = type_changes(expected, df.schema)
    counts, typed = [], []
    for i, (column, issue, *_rest) in enumerate(changes):
        lost = F.lit(None).cast("bigint")
        if issue in ("widened", "type_mismatch") and column in df.columns and column in expected.names:
            value, kind = F.col(column), df.schema[column].dataType
            lost = F.count_if(value.isNotNull() & ~value.try_cast(expected[column].dataType).try_cast(kind).eqNullSafe(value))
        counts.append(lost.alias(f"m{i}"))
    for i, change in enumerate(changes):
        named = zip(("column", "issue", "expected", "actual", "result"), change, strict=True)
        typed.append(F.struct(*[F.lit(v).cast("string").alias(k) for k, v in named], F.col(f"m{i}").alias("lost")))
    kind = "array<struct<column: string, issue: string, expected: string, actual: string, result: string, lost: bigint>>"
    totals = df.agg(F.count("*").alias("_rows"), *counts)
    return totals.select(F.inline(F.array(*typed).cast(kind) if typed else F.array().cast(kind)))


def evolve_widening(current: DataFrame, incoming: DataFrame, allow_new_columns: bool = False) -> DataFrame:
    """Append a batch whose differences lose nothing: each column gets the narrowest type that holds both sides."""
    reasons = evolution_reasons(current.schema, incoming.schema, allow_new_columns)
    if reasons:
        raise ContractError("schema change rejected: " + ", ".join(f"{column}: {reason}" for column, reason in reasons))
    wanted = widest(current.schema, incoming.schema)

    def shaped(df: DataFrame) -> DataFrame:
        return df.select(*[_as_type(F.col(f"`{f.name}`") if f.name in df.columns else None, df.schema[f.name].dataType if f.name in df.columns else None, f.dataType).alias(f.name) for f in wanted])

    return shaped(current).unionByName(shaped(incoming))


def _as_type(value: Column | None, kind: DataType | None, wanted: DataType) -> Column:
    """A value as a wider type; structs by name, with NULL for fields they lack."""
    if value is None:
        return F.lit(None).cast(wanted)
    if kind == wanted:
        return value
    if isinstance(wanted, StructType) and isinstance(kind, StructType):
        fields = [_as_type(value[f.name] if f.name in kind.names else None, kind[f.name].dataType if f.name in kind.names else None, f.dataType).alias(f.name) for f in wanted]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(wanted, ArrayType) and isinstance(kind, ArrayType):
        return F.transform(value, lambda x: _as_type(x, kind.elementType, wanted.elementType))
    if isinstance(wanted, MapType) and isinstance(kind, MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(_as_type(e["key"], kind.keyType, wanted.keyType).alias("key"), _as_type(e["value"], kind.valueType, wanted.valueType).alias("value")),
        )
        return F.map_from_entries(entries)
    return value.cast(wanted)


def evolution_decision(expected: StructType, incoming: StructType, allow_new_columns: bool = False) -> str | None:
    """Why a schema change is rejected, or None when it is accepted.

    Missing columns and changed types always break; new columns break only
    under the strict policy.  ``evolution_reasons`` is the policy that widens.
    """
    found = {issue for _, issue, _, _ in schema_issues(expected, incoming)}
    if "missing" in found:
        return "missing_columns"
    if "type_mismatch" in found:
        return "type_changed"
    if "unexpected" in found and not allow_new_columns:
        return "new_columns"
    return None


def evolve(current: DataFrame, incoming: DataFrame, allow_new_columns: bool = False) -> DataFrame:
    """Append a compatible batch; columns only one side has are NULL on the other."""
    reason = evolution_decision(current.schema, incoming.schema, allow_new_columns)
    if reason:
        raise ContractError(f"schema change rejected: {reason}")
    return current.unionByName(incoming, allowMissingColumns=True)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, or an error when a required column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def null_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows read, rows with a NULL in any of the columns, and whether the gate passes."""
    any_null = F.lit(False)
    for c in columns:
        any_null = any_null | F.col(c).isNull()
    return df.agg(F.count("*").alias("rows"), F.count_if(any_null).alias("invalid_rows")).withColumn(
        "passed", F.col("invalid_rows") == 0
    )


def fail_on_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same table, or an error when any row has a NULL in these columns.

    Reads those columns once, over all rows: a check inside the later plan would
    skip rows that plan filters out.
    """
    seen = null_rows(df, columns).first()
    if not seen["passed"]:
        raise ContractError(f"{seen['invalid_rows']} of {seen['rows']} rows have a NULL in {list(columns)}")
    return df
