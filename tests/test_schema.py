"""Schema evolution and key checks."""

from dataclasses import replace
from decimal import Decimal

import datetime as dt
import pytest
from helpers import SYS, rows, table
from pyspark.sql import types as T

from changeloom import ChangeError, Column, TableSpec, UserActionError
from changeloom.functions.types import source_type, spark_type
from changeloom.operators import checks, schema


@pytest.fixture
def people(spark):
    return table(spark, [(1, "Ann", 30), (2, "Bob", 41)], "id int, name string, age int", ["id"], defaults={"age": "0"})


def asked(t, *columns):
    return t.spec.with_columns(columns)


def test_describe(spark):
    t = table(
        spark, [], "id int, price decimal(10,2), js string, at timestamp", ["id"], defaults={"price": "1.50"}
    )
    assert [tuple(r) for r in schema.describe_table(t).orderBy("position").collect()] == [
        (0, "id", "INT", None, None, True, None),
        (1, "price", "DECIMAL", 10, 2, False, "1.50"),
        (2, "js", "STRING", None, None, False, None),
        (3, "at", "UTC_DATETIME", None, None, False, None),
    ]
    for name in ("BOOLEAN", "SHORT", "LONG", "FLOAT", "DOUBLE", "NAIVE_DATE", "NAIVE_TIME", "NAIVE_DATETIME", "BINARY"):
        assert source_type(spark_type(name)) == name
    with pytest.raises(ChangeError):
        source_type(T.MapType(T.StringType(), T.StringType()))


def test_spec_survives_its_schema(people):
    again = TableSpec.from_schema(T.StructType.fromJson(people.spec.schema().jsonValue()))
    assert again == people.spec and again.keys == ["id"] and again["age"].default == "0"


def test_add_column(people):
    t = schema.add_column(people, Column("d", T.DecimalType(6, 2), default="2.5"))
    t = schema.add_column(t, Column("s", T.StringType(), default="NULL"))
    t = schema.add_column(t, Column("n", T.LongType()))
    assert rows(t, "id", "d", "s", "n") == [(1, Decimal("2.50"), "NULL", None), (2, Decimal("2.50"), "NULL", None)]
    with pytest.raises(ChangeError, match="already exists"):
        schema.add_column(t, Column("n", T.LongType()))
    assert schema.add_column(t, Column("n", T.LongType()), if_not_exists=True) is t


def test_add_column_with_default_on_existing_column(people):
    t = schema.add_column_with_default(people, Column("age", T.IntegerType(), default="9"))
    assert rows(t) == rows(people) and t.spec["age"].default == "9"
    same = schema.add_column_with_default(people, Column("age", T.IntegerType(), default="NULL"))
    assert same.spec["age"].default == "0"
    with pytest.raises(ChangeError, match="reserved"):
        schema.add_column_with_default(people, Column(SYS.synced, T.TimestampType()))


def test_rename_copy_drop(people):
    t = schema.rename_column(people, "age", "years")
    assert t.df.columns == ["id", "name", "years"] and t.spec["years"].default == "0"
    t = schema.copy_column(t, "id", "id2")
    assert rows(t, "id2") == [(1,), (2,)] and t.spec.keys == ["id"]
    assert schema.drop_column(t, "name").spec.names == ["id", "years", "id2"]
    for call in (
        lambda: schema.rename_column(t, "none", "x"),
        lambda: schema.rename_column(t, "name", "id"),
        lambda: schema.rename_column(t, "name", SYS.deleted),
        lambda: schema.copy_column(t, "none", "x"),
        lambda: schema.copy_column(t, "name", "id"),
        lambda: schema.copy_column(t, "name", SYS.start),
        lambda: schema.drop_column(t, "none"),
    ):
        with pytest.raises(ChangeError):
            call()
    assert schema.drop_column(t, "none", if_exists=True) is t


def test_change_type_rounds_and_refuses(spark):
    t = table(spark, [(1, Decimal("0.125"), 2.5, "7")], "id int, d decimal(6,3), f double, s string", ["id"])
    assert rows(schema.change_type(t, "d", T.DecimalType(5, 2)), "d") == [(Decimal("0.13"),)]
    assert rows(schema.change_type(t, "d", T.IntegerType()), "d") == [(0,)]
    assert rows(schema.change_type(t, "f", T.LongType()), "f") == [(2,)]
    assert rows(schema.change_type(t, "s", T.ShortType()), "s") == [(7,)]
    assert rows(schema.change_type(t, "id", T.StringType()), "id") == [("1",)]
    text = table(spark, [(1, "7.5")], "id int, s string", ["id"])
    assert rows(schema.change_type(text, "s", T.LongType()), "s") == [(8,)]
    big = table(spark, [(1, Decimal("123.456"))], "id int, d decimal(6,3)", ["id"])
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        schema.change_type(big, "d", T.DecimalType(4, 2)).df.collect()


def test_alter_adds_in_order_and_drops_only_if_told(people):
    wanted = asked(people, people.spec["id"], Column("z", T.LongType()), Column("a", T.StringType(), default="x"))
    kept = schema.alter_table(people, wanted)
    assert kept.spec.names == ["id", "name", "age", "z", "a"]
    assert rows(kept)[0] == (1, "Ann", 30, None, "x")
    dropped = schema.alter_table(people, wanted, drop_columns=True)
    assert dropped.spec.names == ["id", "z", "a"] and dropped.df.columns == ["id", "z", "a"]


def test_alter_key_change(spark, people):
    wanted = asked(
        people,
        people.spec["id"],
        people.spec["name"],
        replace(people.spec["age"], dtype=T.LongType()),
        Column("k1", T.StringType(), key=True),
        Column("k2", T.DateType(), key=True),
        Column("k3", T.TimestampType(), key=True),
        Column("k4", T.DoubleType(), key=True),
        Column("v", T.IntegerType()),
    )
    t = schema.alter_table(people, wanted)
    assert t.spec.keys == ["id", "k1", "k2", "k3", "k4"] and t.spec["age"].default == "0"
    assert rows(t)[0] == (1, "Ann", 30, "", dt.date(1970, 1, 1), dt.datetime(1970, 1, 1), 0.0, None)


def test_key_column_left_out_loses_key_status(spark):
    t = table(spark, [(1, 1), (2, 1)], "a int, b int", ["a", "b"])
    kept = schema.alter_table(t, asked(t, t.spec["a"]))
    assert kept.spec.keys == ["a"] and kept.spec.names == ["a", "b"]
    assert schema.alter_table(t, asked(t, t.spec["a"]), drop_columns=True).spec.names == ["a"]
    with pytest.raises(UserActionError, match="cannot be the key"):
        schema.alter_table(t, asked(t, t.spec["b"]))
    with pytest.raises(UserActionError):
        only_new = [replace(c, key=False) for c in t.spec.columns] + [Column("n", T.IntegerType(), key=True)]
        schema.alter_table(t, asked(t, *only_new))
    without = schema.alter_table(t, asked(t, *[replace(c, key=False) for c in t.spec.columns]))
    assert without.spec.keys == []


def test_diff(people):
    wanted = asked(people, Column("name", T.StringType(), key=True), Column("age", T.LongType()), Column("x", T.LongType()))
    diff = schema.diff_schema(people.spec, wanted, drop_columns=True)
    assert (diff.dropped, [c.name for c in diff.added], [c.name for c in diff.retyped]) == (("id",), ["x"], ["age"])
    assert diff.key_changed and diff.result.names == ["name", "age", "x"]
    same = schema.diff_schema(people.spec, people.spec, drop_columns=True)
    assert same.result == people.spec and not (same.added or same.dropped or same.retyped or same.key_changed)


def test_key_checks(spark):
    t = table(spark, [(1, 1), (1, 2), (None, 3), (None, 4), (5, 5)], "a int, b int", ["a"])
    assert rows(checks.duplicate_keys(t.df.dropna(), ["a"])) == [(1, 2)]
    assert rows(checks.key_violations(t.df, ["a"])) == [(1, 2)]
    with pytest.raises(UserActionError, match="1 repeated values, 2 rows with NULL"):
        checks.check_keys(t)
    checks.check_keys(table(spark, [(1, 1), (1, 2)], "a int, b int", ["a", "b"]))


def test_names_must_be_unique():
    with pytest.raises(ChangeError, match="unique"):
        TableSpec((Column("a"), Column("a")))
    with pytest.raises(ChangeError, match="dots"):
        TableSpec((Column("a.b"),))


def test_conflicts_name_what_stands_against_a_key(spark):
    t = table(spark, [(1, "a"), (1, "b"), (2, "a"), (None, "c")], "id int, s string", ["s"])
    assert rows(checks.key_conflicts(t, ["id", "new"])) == sorted([(1, 2), (None, 1)], key=repr)
    assert rows(checks.key_conflicts(t, ["id", "s"])) == [(None, "c", 1)]
    assert rows(checks.key_conflicts(t, ["new"])) == [(4,)] and rows(checks.key_conflicts(t, [])) == []


def test_describe_content_counts_rows_and_nulls(spark):
    t = table(spark, [(1, None), (2, "x"), (None, None)], "id int, s string", ["id"], defaults={"s": "d"})
    found = schema.describe_content(t).orderBy("position").collect()
    assert [(r["column_name"], r["primary_key"], r["column_default"], r["row_count"], r["null_count"]) for r in found] == [
        ("id", True, None, 3, 1), ("s", False, "d", 3, 2)
    ]
    assert {r["row_count"] for r in schema.describe_content(t.with_df(t.df.limit(0))).collect()} == {0}
