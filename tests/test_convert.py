import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from rowferry.functions import (
    Columns,
    date_with_default,
    first_present,
    fixed2,
    flag_boolean,
    full_name,
    integer_with_default,
    key_text,
    split_key,
)
from rowferry.functions.convert import WHITESPACE

TEXTS = ["  12abc", "3.9", "-7", "", "   ", None, "abc", "99999999999999999999", " 4.5e2x", "\t hi \n", "1e3"]


def one(spark, values, dtype, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["x"] for r in df.select("i", build(Columns(df)).alias("x")).orderBy("i").collect()]


def test_safe_string(spark):
    got = one(spark, TEXTS, "string", lambda c: c.string("v"))
    assert got == ["12abc", "3.9", "-7", None, "", None, "abc", "99999999999999999999", "4.5e2x", "hi", "1e3"]
    assert one(spark, ["  abcdef "], "string", lambda c: c.string("v", 3)) == ["abc"]


def test_trim_takes_every_kind_of_white_space(spark):
    values = [w + "a b" + w for w in WHITESPACE] + ["\u0085x"]
    assert one(spark, values, "string", lambda c: c.string("v")) == ["a b"] * 25 + ["\u0085x"]
    assert len(WHITESPACE) == 25


def test_safe_string_of_numbers(spark):
    assert one(spark, [1.0, 1.5, None, 1e20], "double", lambda c: c.string("v")) == ["1", "1.5", None, "1.0E20"]
    assert one(spark, [7, None], "bigint", lambda c: c.string("v")) == ["7", None]


def test_normalize_string(spark):
    got = one(spark, ["", "   ", None, " a "], "string", lambda c: c.normalized("v"))
    assert got == [None, None, None, "a"]


def test_safe_integer(spark):
    got = one(spark, TEXTS, "string", lambda c: c.integer("v"))
    assert got == [12, 3, -7, None, None, None, None, None, 4, None, 1]
    assert one(spark, [3.9, -3.9, float("nan"), 1e30, None], "double", lambda c: c.integer("v")) == [3, -3, None, None, None]
    assert one(spark, [True], "boolean", lambda c: c.integer("v")) == [None]


def test_safe_float(spark):
    got = one(spark, TEXTS, "string", lambda c: c.float("v"))
    assert got == [12.0, 3.9, -7.0, None, None, None, None, 1e20, 450.0, None, 1000.0]
    got = one(spark, [".5x", "5.", ".", "-Infinity!", "+1e"], "string", lambda c: c.float("v"))
    assert got == [0.5, 5.0, None, -math.inf, 1.0]


def test_safe_date(spark):
    day = dt.datetime(2024, 1, 15)
    values = ["2024-01-15", "2024-13-01", "", None, "2024-01-15T10:00:00Z", "2024-01-15 10:00:00+03:00", "15-JANUARY-2024"]
    got = one(spark, values, "string", lambda c: c.date("v", ("dd-MMMM-yyyy",)))
    assert got == [day, None, None, None, day.replace(hour=10), day.replace(hour=7), day]
    assert one(spark, [1705276800000, 9 * 10**15, None], "bigint", lambda c: c.date("v")) == [day, None, None]
    assert one(spark, [day.date()], "date", lambda c: c.date("v")) == [day]
    assert one(spark, [day], "timestamp_ntz", lambda c: c.date("v")) == [day]


def test_safe_date_does_not_depend_on_the_session_zone(spark):
    values = ["2024-01-15T10:00:00Z", "2024-01-15 10:00:00"]
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Africa/Dar_es_Salaam")
        assert one(spark, values, "string", lambda c: c.date("v")) == [dt.datetime(2024, 1, 15, 10)] * 2
        assert one(spark, [1705276800000], "bigint", lambda c: c.date("v")) == [dt.datetime(2024, 1, 15)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_safe_boolean(spark):
    assert one(spark, ["N", "0", "false", "   ", "", None], "string", lambda c: c.boolean("v")) == [True] * 4 + [False] * 2
    assert one(spark, [0.0, 2.0, float("nan"), None], "double", lambda c: c.boolean("v")) == [False, True, False, False]
    assert one(spark, [0, 5, None], "int", lambda c: c.boolean("v")) == [False, True, False]
    assert one(spark, [True, False, None], "boolean", lambda c: c.boolean("v")) == [True, False, False]


def test_flags(spark):
    assert one(spark, [1, 0, 2, None], "int", lambda c: c.yn("v")) == ["Y", "N", "N", "N"]
    assert one(spark, ["1"], "string", lambda c: c.yn("v")) == ["N"]
    got = one(spark, ["Y", " n", "TRUE", "0", "maybe", None], "string", lambda c: flag_boolean(c["v"]))
    assert got == [True, False, True, False, None, None]


def test_safe_json(spark):
    assert one(spark, ['a"b', "\t", "", None], "string", lambda c: c.json("v")) == ['"a\\"b"', '"\\t"', '""', None]
    assert one(spark, [5, None], "bigint", lambda c: c.json("v")) == ["5", None]
    assert one(spark, [(1, None)], "struct<a: int, b: string>", lambda c: c.json("v")) == ['{"a":1,"b":null}']


def test_defaults(spark):
    assert one(spark, ["x", "5"], "string", lambda c: integer_with_default(9)(c["v"])) == [9, 5]
    assert one(spark, ["x"], "string", lambda c: date_with_default("2024-01-01")(c["v"])) == [dt.datetime(2024, 1, 1)]
    assert one(spark, ["", "  ", None, " a "], "string", lambda c: c.string_or("v", "?")) == ["?", "?", "?", "a"]


def test_full_name(spark):
    df = spark.createDataFrame([("NULL", None, "Bo"), (None, " ", ""), (" A", "b ", "C")], "a string, b string, c string")
    got = [r[0] for r in df.select(full_name(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["Bo", "", " A b  C"]


def test_first_present(spark):
    df = spark.createDataFrame([(0, "", "z"), (4, "a", "z"), (None, "a", "z")], "n int, a string, b string")
    got = [r[0] for r in df.select(Columns(df).first_present("n", "gone", "a", "b")).collect()]
    assert got == ["z", "4", "a"]
    assert df.select(Columns(df).first_present("gone")).first()[0] is None
    assert df.select(first_present((F.col("n"), "int"))).collect()[1][0] == "4"


def test_key_text(spark):
    df = spark.createDataFrame([("a", None, 3)], "a string, b string, c int")
    key = key_text(F.col("a"), F.col("b"), F.col("c"))
    assert tuple(df.select(key, split_key(key, 1), split_key(key, 2), split_key(key, 3)).first()) == ("a||3", "a", "", "3")


def test_fixed2(spark):
    values = [1.005, 2.5, -0.001, -12.345, 1234567.891, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fixed2(F.col("v"))).collect()]
    assert got == ["1.00", "2.50", "0.00", "-12.35", "1234567.89", None]


def test_unknown_column_is_an_error(spark):
    with pytest.raises(KeyError):
        Columns(spark.range(1)).string("gone")
