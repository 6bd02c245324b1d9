import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators import project
from rowferry.plans import civil


def test_map_fields(spark):
    df = spark.createDataFrame([(1, "a", 2)], "ID int, NAME string, OTHER int")
    assert rows(project.map_fields(df, {"NAME": "name", "ID": "id"})) == [("a", 1)]
    with pytest.raises(ValueError, match="missing"):
        project.map_fields(df, {"GONE": "gone"})


def test_lowercase_fields(spark):
    assert project.lowercase_fields(spark.range(1).toDF("ID")).columns == ["id"]
    before = spark.conf.get("spark.sql.caseSensitive")
    try:
        spark.conf.set("spark.sql.caseSensitive", "true")
        with pytest.raises(ValueError, match="collide"):
            project.lowercase_fields(spark.createDataFrame([(1, 2)], "a int, A int"))
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def test_map_and_convert(spark):
    df = spark.createDataFrame([(" 5x", "t")], "A string, B string")
    assert rows(project.map_and_convert(df, {"A": ("n", "bigint"), "B": ("f", "boolean")})) == [(5, True)]
    with pytest.raises(ValueError, match="no converter"):
        project.map_and_convert(df, {"A": ("n", "decimal")})


def test_transform_rows(spark):
    df = spark.range(2)
    assert project.transform_rows(df) is df
    assert rows(project.transform_rows(df, lambda d: d.select((F.col("id") + 1).alias("n")))) == [(1,), (2,)]


def test_conform(spark):
    schema = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.StringType())])
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    out = project.conform(df, schema)
    assert out.columns == ["b", "a"] and out.schema["b"].dataType == T.LongType()
    with pytest.raises(ValueError, match="outside"):
        project.conform(df.withColumn("c", F.lit(1)), schema)
    with pytest.raises(ValueError, match="missing"):
        project.conform(df.drop("a"), schema)


def test_wide_transforms_are_compiled_in_any_session(spark):
    other = spark.newSession()
    other.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    civil.transform_of("birth_certificate", "2024-01-01 00:00:00")(other.createDataFrame([("a",)], "FIRST_NAME string")).collect()
    assert other.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
