"""Schema contracts: differences, policy, row-level losses and gates."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from ordermill.operators import contracts as c

WANT = StructType().add("id", StringType(), False).add("status", StringType()).add("n", IntegerType())


def incoming(ddl):
    return StructType.fromDDL(ddl)


@pytest.mark.parametrize(
    "ddl,allow_new,reason",
    [
        ("id string, status string, n int", False, None),
        ("n int, status string, id string", False, None),
        ("id string, status string, n int, email string", False, "new_columns"),
        ("id string, status string, n int, email string", True, None),
        ("id string, status int, n int", True, "type_changed"),
        ("id string, n int", True, "missing_columns"),
        ("id string, n string, email string", True, "missing_columns"),
    ],
)
def test_policy(spark, ddl, allow_new, reason):
    assert c.evolution_decision(WANT, incoming(ddl), allow_new) == reason


def test_diff_counts_lost_values(spark):
    df = spark.createDataFrame([("a", "1", "x"), (None, "two", "x"), ("c", None, "x"), (None, "9999999999", "x")], "id string, n string, extra string")
    got = rows(c.schema_diff(df, WANT).select("column", "issue", "expected", "actual", "rows"), "column", "issue")
    assert got == [
        ("extra", "unexpected", None, "string", 4),
        ("id", "null_in_required", "string", "string", 2),
        ("n", "type_mismatch", "int", "string", 4),
        ("n", "uncastable", "int", "string", 2),
        ("status", "missing", "string", None, 4),
    ]


def test_matching_table_has_no_findings(spark):
    assert c.schema_diff(spark.createDataFrame([("a", "s", 1)], "id string, status string, n int"), WANT).count() == 0
    assert c.schema_diff(spark.createDataFrame([(1,)], "x int"), StructType.fromDDL("x int")).count() == 0


def test_evolve_aligns_columns(spark):
    current = spark.createDataFrame([("a", 1)], "id string, n int")
    wider = spark.createDataFrame([(2, "b", "e")], "n int, id string, email string")
    assert rows(c.evolve(current, wider, allow_new_columns=True), "id") == [("a", 1, None), ("b", 2, "e")]
    with pytest.raises(c.ContractError, match="new_columns"):
        c.evolve(current, wider)


def test_gates(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "id string, n int")
    with pytest.raises(c.ContractError, match="status"):
        c.require_columns(df, ["id", "status"])
    assert rows(c.null_rows(df, ["id", "n"])) == [(2, 1, False)]
    with pytest.raises(c.ContractError, match="1 of 2 rows"):
        c.fail_on_nulls(df, ["id"])
    good = df.filter(F.col("id").isNotNull())
    assert c.fail_on_nulls(good, ["id", "n"]) is good


def test_schema_differences_of_an_empty_table_are_found(spark):
    from pyspark.sql.types import LongType, StructField, StructType

    expected = StructType([StructField("id", LongType()), StructField("n", LongType())])
    found = c.schema_diff(spark.createDataFrame([], "id long, extra long"), expected).collect()
    assert len(found) == 2


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("int", "bigint", "bigint"),
        ("tinyint", "smallint", "smallint"),
        ("int", "double", "double"),
        ("bigint", "double", None),
        ("int", "float", None),
        ("smallint", "float", "float"),
        ("float", "double", "double"),
        ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(10,0)", "decimal(5,4)", "decimal(14,4)"),
        ("decimal(38,0)", "decimal(5,4)", None),
        ("bigint", "decimal(38,30)", None),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("date", "timestamp", None),
        ("string", "int", None),
        ("void", "string", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<a:int,b:string>", "struct<b:string,a:bigint,c:date>", "struct<a:bigint,b:string,c:date>"),
        ("struct<a:int>", "struct<a:string>", None),
    ],
)
def test_the_widest_type_loses_nothing_either_way(spark, a, b, want):
    a, b = (incoming(f"x {k}")["x"].dataType for k in (a, b))
    kind = c.widest(a, b)
    assert (kind and kind.simpleString()) == want
    if not isinstance(a, StructType):
        assert c.widest(b, a) == kind


def test_reasons_name_each_column(spark):
    want = incoming("id bigint, d struct<x:int,y:array<struct<z:int>>>, gone string")
    have = incoming("id int, d struct<x:string,y:array<struct<z:bigint,new:int>>>")
    assert c.type_changes(want, have) == [
        ("id", "widened", "bigint", "int", "bigint"),
        ("d.x", "type_mismatch", "int", "string", None),
        ("d.y.element.z", "widened", "int", "bigint", "bigint"),
        ("d.y.element.new", "unexpected", None, "int", None),
        ("gone", "missing", "string", None, None),
    ]
    assert c.evolution_reasons(want, have) == [("d.x", "type_changed"), ("d.y.element.new", "new_columns"), ("gone", "missing_columns")]
    assert c.evolution_reasons(incoming("n int"), incoming("n bigint")) == []


def test_values_a_narrow_type_would_lose_are_counted(spark):
    df = spark.createDataFrame([(1, 1.5), (2**40, 2.0), (None, None), (-(2**31), 1e300)], "n bigint, x double")
    got = rows(c.widening_diff(df, incoming("n int, x int")), "column")
    assert got == [("n", "widened", "int", "bigint", "bigint", 1), ("x", "widened", "int", "double", "double", 2)]
    assert c.widening_diff(df, df.schema).count() == 0
    assert [r["lost"] for r in c.widening_diff(df.limit(0), incoming("n int, x int")).collect()] == [0, 0]


def test_evolved_rows_keep_their_values(spark):
    current = spark.createDataFrame([(1, (2, [3], {"k": 4})), (2, None)], "id int, d struct<a:int,l:array<int>,m:map<string,int>>")
    later = spark.createDataFrame([((2**40, [2**41], {"k": 0.5}, "new"), 2**42)], "d struct<a:bigint,l:array<bigint>,m:map<string,double>,e:string>, id bigint")
    both = c.evolve_widening(current, later, allow_new_columns=True).orderBy("id")
    assert both.schema["d"].dataType.simpleString() == "struct<a:bigint,l:array<bigint>,m:map<string,double>,e:string>"
    got = [(r["id"], r["d"] and tuple(r["d"])) for r in both.collect()]
    assert got == [(1, (2, [3], {"k": 4.0}, None)), (2, None), (2**42, (2**40, [2**41], {"k": 0.5}, "new"))]
    with pytest.raises(c.ContractError, match="d.e: new_columns"):
        c.evolve_widening(current, later)
    with pytest.raises(c.ContractError, match="d: missing_columns"):
        c.evolve_widening(current, later.drop("d"), allow_new_columns=True)
