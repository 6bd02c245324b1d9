import datetime as dt

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.sources import jdbc, ranges, tables


def test_parameters_are_bound_not_spliced(spark):
    df = spark.createDataFrame([("a",), ("x' OR '1'='1",)], "v string")
    got = tables.run_query(spark, "SELECT v FROM {t} WHERE v = :v", {"v": "x' OR '1'='1"}, t=df)
    assert rows(got) == [("x' OR '1'='1",)]


def test_statements(spark):
    got = tables.run_statements(spark, {"a": "SELECT 1 AS x", "b": "SELECT :n AS x"}, {"n": 2})
    assert {n: df.first()[0] for n, df in got.items()} == {"a": 1, "b": 2}


def test_query_files(spark, tmp_path):
    (tmp_path / "b.sql").write_text("SELECT :n\n   AS x")
    (tmp_path / "a.sql").write_text("SELECT 'a;b' AS x;\n \nSELECT 2 AS x ;\n")
    assert tables.query_names(tmp_path) == ["a", "b"] and tables.query_names(tmp_path / "none") == []
    assert tables.run_query(spark, tables.query_text(tmp_path, "b"), {"n": 3}).first()[0] == 3
    parts = tables.split_statements((tmp_path / "a.sql").read_text())
    assert parts == ["SELECT 'a;b' AS x", "SELECT 2 AS x"]
    assert [spark.sql(p).first()[0] for p in parts] == ["a;b", 2]


def test_tables_are_found_in_the_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS other")
    spark.sql("CREATE TABLE IF NOT EXISTS other.tbl_region (k INT) USING parquet")
    try:
        assert tables.find_tables(spark, "*region*", ["default", "other", "gone"]) == ["other.tbl_region"]
        where = tables.locate_tables(spark, ["tbl_region", "nope"], ["default", "other"])
        assert where == {"tbl_region": "other", "nope": None}
        assert tables.catalog_row_count(spark, "other.nope") == 0
    finally:
        spark.sql("DROP DATABASE other CASCADE")


def test_declared_schema_is_checked(spark):
    schema = T.StructType([T.StructField("r_regionkey", T.LongType()), T.StructField("gone", T.StringType())])
    with pytest.raises(ValueError, match="r_regionkey bigint .found int.*gone string .found nothing"):
        tables.read_table(spark, SF, "region", schema)
    assert tables.read_table(spark, SF, "region").count() == 5


def test_date_range(spark):
    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2025, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "at timestamp_ntz")
    assert rows(tables.date_range(df, "at", "01-JANUARY-2024", "01-JUNE-2024")) == [(days[0],), (days[1],)]
    assert tables.date_range(df, "at", "02-January-2024").count() == 2
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        tables.date_range(df, "at", "soon").collect()


def test_date_range_reaches_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = tables.date_range(orders, "o_orderdate", "01-JANUARY-1997")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01T00:00)" in plan


def test_catalog_row_count(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS counted (k INT) USING parquet")
    try:
        spark.range(7).selectExpr("CAST(id AS INT) AS k").write.insertInto("counted")
        assert tables.catalog_row_count(spark, "counted") == 7
        spark.sql("ANALYZE TABLE counted COMPUTE STATISTICS")
        assert tables.catalog_row_count(spark, "counted") == 7
    finally:
        spark.sql("DROP TABLE counted")


@pytest.mark.parametrize("how", [ranges.even_ranges, ranges.quantile_ranges])
@pytest.mark.parametrize("n", [1, 4, 50])
def test_ranges_cover_every_row_once(spark, how, n):
    df = spark.range(100).selectExpr("CASE WHEN id = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id * id END AS k")
    split = how(df, "k", n)
    per_range = [df.where(p).count() for p in split.predicates()]
    assert sum(per_range) == 100 and len(per_range) <= max(n, 1)
    by_slice = dict(ranges.read_ranges(df, split).groupBy("_slice").count().collect())
    assert [by_slice.get(i, 0) for i in range(len(per_range))] == per_range


def test_ranges_of_nothing(spark):
    empty = spark.range(0).toDF("k")
    assert ranges.even_ranges(empty, "k", 4).predicates() == ["1 = 1"]
    assert ranges.quantile_ranges(empty, "k", 4).predicates() == ["1 = 1"]


def test_advice():
    assert [ranges.choose_strategy(n, i) for n, i in [(10, True), (100_001, False), (1_000_001, False), (1_000_001, True)]] == [
        "rownum", "offset", "offset", "cursor"
    ]
    assert [ranges.choose_partitions(n) for n in (0, 1, 1_000_000, 1_000_001)] == [1, 1, 1, 2]


def test_jdbc_options(spark):
    db = jdbc.JdbcDatabase("jdbc:x://h/db", "u", "secret", driver="d.D", properties={"ssl": "true"})
    assert "secret" not in repr(db)
    assert db.read_options("SELECT 1") == {
        "url": "jdbc:x://h/db", "user": "u", "password": "secret", "driver": "d.D", "ssl": "true",
        "query": "SELECT 1", "fetchsize": "10000",
    }
    assert db.write_options("s.t")["dbtable"] == "s.t" and db.write_options("s.t")["batchsize"] == "10000"
    assert "url" not in db.connection_properties()
    assert jdbc.query_reader(spark, db, "SELECT 1") is not None
    assert jdbc.staging_writer(spark.range(1), db, "t") is not None


def test_sample_is_repeatable(spark):
    df = spark.range(100).select((F.col("id") * 37 % 101).alias("k"))
    assert rows(tables.sample_rows(df, ["k"], 3)) == rows(tables.sample_rows(df.repartition(7), ["k"], 3))


def test_many_cuts(spark):
    many = ranges.KeyRanges("k", tuple(range(10, 20_010, 10)))
    df = spark.createDataFrame([(None,), (0,), (9,), (10,), (19,), (20,), (20_000,), (99_999,)], "k long")
    assert [r[0] for r in df.select(many.slice_of()).collect()] == [0, 0, 0, 1, 1, 2, 2000, 2000]
