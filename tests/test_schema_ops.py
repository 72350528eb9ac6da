from __future__ import annotations

import pytest
from pyspark.sql import types as T

from conftest import rows
from tableloom.operators import schema as s


def test_case_only_rename_is_no_change(spark):
    t = spark.createDataFrame([(1, "a")], "id int, value string")
    b = spark.createDataFrame([(2, "b")], "ID int, VALUE string")
    assert not s.diff_schemas(t.schema, b.schema)
    for policy in s.POLICIES:
        stored, batch = s.align(t, b, policy)
        assert rows(stored.unionByName(batch)) == [(1, "a"), (2, "b")]
        assert stored.unionByName(batch).columns == ["id", "value"]


def test_fail_lists_all_three_kinds(spark):
    t = spark.createDataFrame([(1, "a", 1)], "id int, gone string, kind int")
    b = spark.createDataFrame([(1, "x", 2)], "id int, kind string, added int")
    with pytest.raises(s.SchemaChangeError, match=r"added \['added'\], removed \['gone'\], retyped .*int -> string"):
        s.align(t, b, "fail")


def test_append_new_columns(spark):
    t = spark.createDataFrame([(1, "original")], "id int, value string")
    b = spark.createDataFrame([(1, "updated", 30), (2, "new", 40)], "id int, value string, added_value int")
    stored, batch = s.align(t, b, "append_new_columns")
    assert rows(stored) == [(1, "original", None)]
    assert rows(batch) == rows(b)


def test_ignore_needs_all_target_columns(spark):
    t = spark.createDataFrame([(1, "a")], "id int, value string")
    with pytest.raises(s.SchemaChangeError, match="lacks target columns"):
        s.align(t, t.select("id"), "ignore")
    _, batch = s.align(t, spark.createDataFrame([(9, "b", 2)], "extra int, value string, id int"), "ignore")
    assert rows(batch) == [(2, "b")]


def test_keys_are_immutable(spark):
    t, b = T._parse_datatype_string("id int, v string"), T._parse_datatype_string("id bigint, v string")
    with pytest.raises(s.SchemaChangeError, match="change type"):
        s.check_protected(t, b, "ID")
    with pytest.raises(s.SchemaChangeError, match="lacks key"):
        s.check_protected(t, b, "id", "seq")
    narrow, wide = T.StructType([T.StructField("id", T.VarcharType(5))]), T.StructType([T.StructField("id", T.VarcharType(40))])
    with pytest.raises(s.SchemaChangeError, match="change type"):
        s.check_protected(narrow, wide, "id")


def test_widening(spark):
    narrow = T.StructType([T.StructField("Name", T.VarcharType(5)), T.StructField("x", T.VarcharType(9))])
    wide = T.StructType([T.StructField("name", T.VarcharType(40)), T.StructField("x", T.VarcharType(3))])
    assert s.widened_widths(narrow, wide) == {"Name": 40, "x": 9}
    spark.sql("CREATE TABLE IF NOT EXISTS width_probe (id INT, name VARCHAR(7)) USING parquet")
    assert s.declared_widths(spark.table("width_probe").schema) == {"name": 7}
    spark.sql("DROP TABLE width_probe")


def test_contract(spark):
    contract = T._parse_datatype_string("color string, id int, date_day date")
    ok = spark.createDataFrame([(1, "2024-01-01", "blue")], "id bigint, date_day string, color string")
    assert s.apply_contract(ok, contract).schema.simpleString() == "struct<color:string,id:int,date_day:date>"
    with pytest.raises(s.ContractError, match="not returned"):
        s.apply_contract(ok.withColumnRenamed("color", "colour"), contract)
    with pytest.raises(s.ContractError, match="not declared"):
        s.apply_contract(ok.selectExpr("*", "1 AS extra"), contract)
    assert s.apply_contract(ok, None) is ok


@pytest.mark.parametrize("source, target, ok", [
    ("tinyint", "bigint", True), ("bigint", "int", False), ("bigint", "decimal(38,0)", True),
    ("float", "double", True), ("double", "float", False), ("date", "timestamp_ntz", True),
    ("timestamp_ntz", "date", False), ("decimal(10,2)", "decimal(12,4)", True), ("decimal(10,2)", "decimal(10,4)", False),
    ("decimal(10,2)", "decimal(11,1)", False), ("int", "string", False), ("string", "string", True),
    ("array<int>", "array<int>", True), ("array<int>", "array<bigint>", False)])
def test_type_lattice(source, target, ok):
    assert s.can_store(T._parse_datatype_string(source), T._parse_datatype_string(target)) is ok


def test_text_widths_in_lattice():
    assert s.can_store(T.VarcharType(5), T.VarcharType(10))
    assert not s.can_store(T.VarcharType(10), T.VarcharType(5))
    assert s.can_store(T.VarcharType(10), T.StringType())
    assert not s.can_store(T.StringType(), T.VarcharType(10))


def test_cast_loss(spark):
    df = spark.createDataFrame([("1", 1.5, 300), ("x", 2.0, 7), (None, None, None)], "a string, b double, c int")
    out = s.cast_loss_profile(df, {"a": "int", "b": "int", "c": "tinyint"})
    assert {(r.column_name, r.rows_lost) for r in out.collect()} == {("a", 1), ("b", 1), ("c", 1)}


def test_null_fill_and_widths_of_empty_input(spark):
    df = spark.createDataFrame([], "id int, name string")
    assert s.null_fill(df, {"NAME": "int", "x": "date"}).schema.simpleString() == "struct<id:int,name:string,x:date>"
    assert rows(s.string_width_plan(df, {"name": 5})) == [("name", 5, None, False)]


def test_safe_cast_agrees_with_try_cast(spark):
    from pyspark.sql import functions as F

    from tableloom.functions.casting import safe_cast

    texts = ["1", " 7 ", "+5", "-128", "128", "1.5", "1e3", "", "abc", "n/a", "NaN", "-Infinity", "inf", "2024-01-01", "2024",
             "2024-01-01 10:00:00.5", "24-1-1", "\t3\n", "9223372036854775808", "true", "1d", ".5", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for kind in ("tinyint", "smallint", "int", "bigint", "double", "float", "decimal(10,2)", "date", "timestamp_ntz", "boolean"):
        target = T._parse_datatype_string(kind)
        both = df.select("v", safe_cast(F.col("v"), T.StringType(), target).alias("a"), F.col("v").try_cast(target).alias("b"))
        assert rows(both.where("NOT a <=> b")) == [], kind
    numbers = [0.0, 1.5, -1.5, 127.0, 127.9, 128.0, -128.9, -129.0, 2147483647.5, -2147483648.5, 2147483648.0, 1e19, -1e19,
               float("nan"), float("inf"), -9223372036854775808.0, 9223372036854775807.0, None]
    df = spark.createDataFrame([(x,) for x in numbers], "v double")
    for kind in ("tinyint", "smallint", "int", "bigint"):
        target = T._parse_datatype_string(kind)
        both = df.select("v", safe_cast(F.col("v"), T.DoubleType(), target).alias("a"), F.col("v").try_cast(target).alias("b"))
        assert rows(both.where("NOT a <=> b")) == [], kind
    df = spark.createDataFrame([(x,) for x in (0, 127, 128, -128, -129, 32768, 2**31, -(2**31), 2**63 - 1, None)], "v bigint")
    for kind in ("tinyint", "smallint", "int", "bigint"):
        target = T._parse_datatype_string(kind)
        both = df.select("v", safe_cast(F.col("v"), T.LongType(), target).alias("a"), F.col("v").try_cast(target).alias("b"))
        assert rows(both.where("NOT a <=> b")) == [], kind
