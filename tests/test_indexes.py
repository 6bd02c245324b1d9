"""Rank index, hash trees, references by content, and the automatic choice of paging."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowferry.operators import hash_tree, rank_index
from rowferry.operators.containment import references
from rowferry.operators.hash_tree import compare_by_tree, differing_leaves, hash_leaves, reconcile_by_tree
from rowferry.operators.paging import page
from rowferry.operators.quality import compare_keys, reconcile_keys
from rowferry.operators.rank_index import append_rows, build_rank_index, page_by_rank, page_files

DDL = "k int, v string"


def plain(data):
    return sorted(data, key=lambda r: [(x is not None, x) for x in r])


def test_pages_of_any_depth_read_one_file_or_two(spark):
    rng = random.Random(1)
    data = [(rng.choice((None, 3, *range(40))), f"v{i % 90}") for i in range(1000)]
    index = build_rank_index(spark.createDataFrame(data, DDL), ["k"], rows_per_file=100)
    want = plain(data)
    files = {r["file"] for r in index.read_fences(spark).collect()}
    assert len(files) >= 8 and index.n_rows == 1000
    for offset, size in ((0, 7), (495, 60), (993, 50), (1000, 5), (10, 0)):
        got = [tuple(r) for r in page_by_rank(spark, index, offset, size).collect()]
        assert got == want[offset : offset + size]
        assert len(page_files(spark, index, offset, max(size, 1))) <= 2
    more = [(100 + i % 7, "w") for i in range(150)]
    longer = append_rows(index, spark.createDataFrame(more, DDL), rows_per_file=100)
    want = plain(data + more)
    assert [tuple(r) for r in page_by_rank(spark, longer, 980, 100).collect()] == want[980:1080]
    assert files < {r["file"] for r in longer.read_fences(spark).collect()}, "old files stay"
    assert [tuple(r) for r in page_by_rank(spark, index, 990, 100).collect()] == want[990:1000], "the old index still reads the old rows"
    with pytest.raises(ValueError, match="must come after"):
        append_rows(longer, spark.createDataFrame([(5, "x")], DDL))
    assert append_rows(longer, spark.createDataFrame([], DDL)) == longer
    empty = build_rank_index(spark.createDataFrame([], DDL), ["k"])
    assert page_by_rank(spark, empty, 0, 5).collect() == []
    assert rows(page_by_rank(spark, append_rows(empty, spark.createDataFrame(more, DDL)), 0, 1)) == [(100, "w")]


def test_small_files_do_not_make_small_ranges(spark):
    rows_in = spark.range(0, 3000).select((F.col("id") % 900).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    index = build_rank_index(rows_in, ["k"], rows_per_file=100)
    fences = index.read_fences(spark).orderBy("before").collect()
    assert [(r["before"], r["n"]) for r in fences] == [(100 * i, 100) for i in range(30)]
    assert len({r["file"].rsplit("/", 1)[1].split("-")[1] for r in fences}) == 1, "one task wrote them all"


def test_trees_find_the_leaves_that_differ(spark):
    bits, data = 8, [(i, f"v{i}", None if i % 3 else i) for i in range(3000)]
    ddl = "k long, v string, n long"
    left = spark.createDataFrame(data, ddl)
    changed = [r if r[0] not in (5, 6) else (r[0], "other", r[2]) for r in data if r[0] != 77] + [(9000, "x", None)]
    right = spark.createDataFrame(changed, ddl)
    a, b = hash_leaves(left, ["k"], bits), hash_leaves(right, ["k"], bits)
    apart = {r[0] for r in differing_leaves(a, b, bits).collect()}
    where = {r["k"]: r["leaf"] for r in left.union(right).select("k", hash_tree.leaf_of(["k"], bits).alias("leaf")).collect()}
    assert apart == {where[k] for k in (5, 6, 77, 9000)}
    assert differing_leaves(a, a, bits).collect() == []
    found = {r["k"]: r["status"] for r in compare_by_tree(left, right, ["k"], bits).collect()}
    want = {r["k"]: r["status"] for r in compare_keys(left, right, ["k"]).collect()}
    assert {k: s for k, s in found.items() if s != "same"} == {k: s for k, s in want.items() if s != "same"}
    assert len(found) < 100, "only keys of four leaves were compared"
    assert rows(reconcile_by_tree(left, right, ["k"], bits, (a, b))) == rows(reconcile_keys(left, right, ["k"]))
    assert rows(reconcile_by_tree(left, left, ["k"], bits)) == [("same", 3000)]
    nulls = spark.createDataFrame([(1, None, 2), (None, "a", None)], ddl)
    moved = spark.createDataFrame([(1, None, None), (None, "a", None)], ddl)
    assert rows(reconcile_by_tree(nulls, moved, ["k"], bits)) == rows(reconcile_keys(nulls, moved, ["k"])) == [("different", 1), ("same", 1)]
    assert reconcile_by_tree(left.limit(0), left.limit(0), ["k"]).collect() == []


def test_references_are_found_by_content(spark):
    big = spark.range(0, 30_000).select(F.col("id").alias("a"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("code"))
    part = spark.range(0, 20_000, 3).select(F.col("id").alias("x"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("ref"))
    nearly = spark.range(0, 20_000, 2).select(F.when(F.col("id") == 9_998, 29_999_999).otherwise(F.col("id")).alias("y"))  # one value is not there
    gaps = spark.createDataFrame([(1, None), (2, None), (40_000, None)], "z int, w int")
    one = spark.createDataFrame([(7,)], "q int")
    tables = {"big": big, "part": part, "nearly": nearly, "gaps": gaps, "one": one}
    found = {tuple(r) for r in references(tables, ("integral", "string")).collect()}
    assert found == {("part", "x", "big", "a", 6667), ("part", "ref", "big", "code", 6667)}
    small = {"a": spark.createDataFrame([(1,), (2,)], "k int"), "b": spark.createDataFrame([(1,), (2,), (3,)], "j long")}
    assert {tuple(r) for r in references(small).collect()} == {("a", "k", "b", "j", 2)}
    assert references({"none": gaps.select("w")}).collect() == []


def test_paging_chosen_by_rows(spark):
    df = spark.range(50).select(F.col("id").alias("k"))
    assert rows(page(df, "auto", ["k"], 3, offset=10)) == [(10,), (11,), (12,)]
    assert rows(page(df, "auto", ["k"], 2, last=[4])) == [(5,), (6,)]
    large = spark.range(100_001).select(F.col("id").alias("k"))
    assert "CollectLimit" in (plan := page(large, "auto", ["k"], 3, offset=10)._jdf.queryExecution().toString()) or "Offset" in plan
    assert rank_index.RankIndex is not None
