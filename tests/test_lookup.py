import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowferry.operators.joins import Dimension, join_dimensions, rows_with_match, rows_without_match
from rowferry.operators.lookup import (
    ForeignKey,
    LookupSpec,
    build_lookup,
    build_lookups,
    measure,
    ready_lookup,
    rebuild_lookup,
    resolve_code,
    resolve_codes,
    validate_lookup,
)
from rowferry.operators.quality import fk_coverage, fk_unresolved


@pytest.fixture
def places(spark):
    data = [("a", 1, 10), ("a", 2, 5), ("b", 3, 1), (None, 4, 1), ("c", None, 1)]
    return spark.createDataFrame(data, "code string, id int, seq int")


def test_last_id_wins(places):
    assert rows(build_lookup(places)) == [("a", 2), ("b", 3)]
    assert rows(build_lookup(places, order_by="seq")) == [("a", 1), ("b", 3)]


def test_numeric_codes_become_text(spark):
    df = spark.createDataFrame([(1.0, 5), (2.5, 6)], "code double, id int")
    assert rows(build_lookup(df)) == [("1", 5), ("2.5", 6)]


def test_resolve(spark, places):
    facts = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "zz"), (5, " a")], "k int, code string")
    got = rows(resolve_code(facts, "code", build_lookup(places), "ref"))
    assert got == [(1, "a", 2), (2, "", None), (3, None, None), (4, "zz", None), (5, " a", None)]
    assert rows(resolve_code(facts, "code", None, "ref"))[0] == (1, "a", None)


def test_zero_is_no_code(spark):
    lookup = spark.createDataFrame([("0", 9), ("1", 8)], "code string, id bigint")
    facts = spark.createDataFrame([(0,), (1,), (None,)], "code int")
    assert rows(resolve_code(facts, "code", lookup, "ref")) == [(None, None), (0, None), (1, 8)]


def test_resolve_many_and_missing_lookup(spark, places):
    facts = spark.createDataFrame([("a", "b")], "x string, y string")
    lookups = build_lookups({"places": places}, [LookupSpec("places"), LookupSpec("gone")])
    keys = [ForeignKey("x", "places", "x_id"), ForeignKey("y", "gone", "y_id")]
    assert rows(resolve_codes(facts, keys, lookups)) == [("a", "b", 2, None)]


def test_validate(spark, places):
    assert validate_lookup(places, "code", "id").usable
    assert validate_lookup(places, "nope", "id").missing_columns == ("nope",)
    assert not validate_lookup(places.where("code is null"), "code", "id").has_data
    assert not validate_lookup(None, "code", "id").exists
    with pytest.raises(ValueError, match="cannot build"):
        rebuild_lookup(None, LookupSpec("gone"))


def test_broadcast_only_what_measures_small(spark, places):
    n, size = measure(places)
    assert n == 5 and size > 0
    lookup = build_lookup(places)
    facts = spark.createDataFrame([("a",), ("q",)], "code string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        small = resolve_code(facts, "code", ready_lookup(lookup), "ref")
        large = resolve_code(facts, "code", ready_lookup(lookup, max_bytes=0), "ref")
        plans = [d._jdf.queryExecution().executedPlan().toString() for d in (small, large)]
        assert "BroadcastHashJoin" in plans[0] and "SortMergeJoin" in plans[1]
        assert rows(small) == rows(large) == [("a", 2), ("q", None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_code_is_split_when_the_lookup_is_large(spark, root):
    data = spark.range(0, 40000, 1, 4).selectExpr("CASE WHEN id % 3 > 0 THEN 'hot' ELSE CAST(id AS STRING) END AS code", "id", "uuid() AS pad")
    data.write.parquet(f"{root}/f")
    facts = spark.read.parquet(f"{root}/f")
    lookup = build_lookup(spark.range(20000).selectExpr("CAST(id AS STRING) AS code", "id"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    }
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        got = resolve_code(facts, "code", ready_lookup(lookup, max_bytes=0), "ref").groupBy().agg(
            F.count("ref"), F.max("pad"), F.max("id")
        )
        got.collect()
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_coverage_against_brute_force(spark, places):
    codes = ["a"] * 50 + ["b", "", None, "q", "q", "r"]
    facts = spark.createDataFrame([(c,) for c in codes], "code string")
    lookup = build_lookup(places)
    known = {"a", "b"}
    present = [c for c in codes if c]
    want = (
        "k", len(codes), len(codes) - len(present), sum(c in known for c in present),
        sum(c not in known for c in present), len({c for c in present if c not in known}),
    )
    assert rows(fk_coverage(facts, "code", lookup, "k")) == [want]
    assert rows(fk_unresolved(facts, "code", lookup)) == [("q", 2), ("r", 1)]


def test_dimensions(spark):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "k int, d int")
    dim = spark.createDataFrame([(10, "x", 7)], "id int, name string, up int")
    top = spark.createDataFrame([(7, "t")], "id int, name string")
    got = join_dimensions(
        facts,
        [
            Dimension(dim, {"d": "id"}, {"name": "d_name", "up": "up"}),
            Dimension(top, {"up": "id"}, {"name": "up_name"}),
            Dimension(None, {"d": "id"}, {"name": "none_name", "n": "none_n"}, {"n": "bigint"}),
        ],
    )
    assert got.columns == ["k", "d", "d_name", "up", "up_name", "none_name", "none_n"]
    assert rows(got)[0] == (1, 10, "x", 7, "t", None, None)
    assert dict(got.dtypes)["none_n"] == "bigint"
    assert got.count() == 3


def test_match(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(rows_with_match(df, other, ["k"])) == [(1,)]
    assert rows(rows_without_match(df, other, ["k"])) == [(None,), (2,)]
    # The same with every key taken for hot, and with the rows declared unique.
    assert rows(rows_with_match(df, other, ["k"], hot_rows=0)) == [(1,)]
    assert rows(rows_without_match(df, other, ["k"], hot_rows=0)) == [(None,), (2,)]
    assert rows(rows_without_match(df, other, ["k"], unique=True)) == [(None,), (2,)]


def test_hot_code_is_counted_before_the_lookup_join(spark):
    facts = spark.range(1000).select(F.lit("hot").alias("code"))
    lookup = spark.createDataFrame([("hot", 1)], "code string, id bigint")
    plan = fk_coverage(facts, "code", lookup, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate [")


def test_rows_without_a_code_spread_and_match_nothing(spark):
    codes = spark.createDataFrame([("-1", 1), ("=x", 2), ("x", 3)], "code string, id long")
    df = spark.range(40).selectExpr("id AS n", "CASE id WHEN 0 THEN '-1' WHEN 1 THEN '=x' WHEN 2 THEN 'x' WHEN 3 THEN '' END AS c")
    got = resolve_code(df, "c", codes, "ref")
    assert rows(got.where("ref IS NOT NULL").select("n", "ref")) == [(0, 1), (1, 2), (2, 3)]
    assert got.count() == 40
