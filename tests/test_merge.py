"""Merges against a row-by-row model of the write rules, on data with repeated and NULL keys."""

import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.errors import PySparkException

from rowferry.operators.dedupe import duplicate_keys, keep_first, keep_last
from rowferry.operators.merge import (
    MergeConflict,
    live_rows,
    merge,
    merge_changes,
    merge_into_table,
    merge_stats,
    observed,
)

DDL = "k int, j string, seq int, v int, w string"
KEYS = ["k", "j"]


def tables(seed, unique_target=True, unique_source=False):
    rnd = random.Random(seed)

    def row(seq):
        k = rnd.choice([None, 1, 2, 3, 4, 5])
        j = rnd.choice([None, "a", "b", "a|b"])
        return (k, j, seq, rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]))

    def unique(data):
        seen, out = set(), []
        for r in data:
            if None in r[:2] or r[:2] not in seen:
                out.append(r)
                seen.add(r[:2])
        return out

    target = [row(i) for i in range(25)]
    source = [row(100 + i) for i in range(40)]
    return (unique(target) if unique_target else target), (unique(source) if unique_source else source)


def row_by_row(target, source, mode, update=("seq", "v", "w"), condition=None, delete_missing=False):
    """Write the source one row at a time, in order, as single-row statements would."""
    names = ["k", "j", "seq", "v", "w"]
    out = [list(r) for r in target]
    fresh = []
    hit_keys = {r[:2] for r in source if None not in r[:2]}
    for s in source:
        matches = [t for t in out + fresh if None not in s[:2] and tuple(t[:2]) == s[:2]]
        old = [t for t in matches if any(t is o for o in out)]
        if mode == "skip-existing":
            if not old:
                fresh.append(list(s))
        elif mode == "insert-ignore":
            if not matches:
                fresh.append(list(s))
        elif matches:
            for t in matches:
                if condition is None or condition(t, s):
                    for name in update:
                        t[names.index(name)] = s[names.index(name)]
        elif mode != "update":
            fresh.append(list(s))
    if delete_missing:
        out = [t for t in out if tuple(t[:2]) in hit_keys]
    return Counter(tuple(r) for r in out + fresh)


def run(spark, target, source, mode, **options):
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    changes = merge_changes(t, s, mode, KEYS, order_by=["seq"], **options)
    return Counter(tuple(r) for r in live_rows(changes).collect()), merge_stats(changes, s).first()


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("mode", ["upsert", "update", "insert-ignore", "skip-existing", "sync"])
@pytest.mark.parametrize("unique_target", [True, False])
def test_modes_against_the_row_by_row_model(spark, seed, mode, unique_target):
    target, source = tables(seed, unique_target)
    got, stats = run(spark, target, source, mode, target_unique=unique_target)
    assert got == row_by_row(target, source, mode)
    assert stats["read"] == len(source)
    if unique_target:
        assert stats["inserted"] + stats["updated"] + stats["skipped"] + stats["superseded"] == len(source)
    assert sum(got.values()) == len(target) + stats["inserted"]


def test_shuffled_and_broadcast_forms_agree(spark):
    target, source = tables(7)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("-1", before):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            for hint in (False, True):
                got, _ = run(spark, target, source, "upsert", broadcast_source=hint)
                assert got == row_by_row(target, source, "upsert")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("mode", ["upsert", "update", "sync", "skip-existing"])
@pytest.mark.parametrize("hot_rows", [0, 1, 3])
def test_hot_keys_taken_out_give_the_same(spark, mode, hot_rows):
    target, source = tables(9, unique_target=False)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got, stats = run(spark, target, source, mode, target_unique=False, hot_rows=hot_rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == row_by_row(target, source, mode)
    assert stats["read"] == len(source)


def test_chosen_columns(spark):
    target, source = tables(1)
    got, _ = run(spark, target, source, "upsert", update_columns=["v"])
    # A new key takes its first row's other columns row by row; compare where the source is unique.
    target, source = tables(1, unique_source=True)
    got, _ = run(spark, target, source, "upsert", update_columns=["v"])
    assert got == row_by_row(target, source, "upsert", update=("v",))


def test_condition(spark):
    target, source = tables(2, unique_source=True)
    got, stats = run(spark, target, source, "upsert", condition="t.v < s.v")
    want = row_by_row(
        target, source, "upsert", condition=lambda t, s: t[3] is not None and s[3] is not None and t[3] < s[3]
    )
    assert got == want
    assert stats["inserted"] + stats["updated"] + stats["skipped"] == len(source)


def test_true_sync_deletes(spark):
    target, source = tables(3)
    got, stats = run(spark, target, source, "sync", delete_missing=True)
    assert got == row_by_row(target, source, "sync", delete_missing=True)
    assert stats["deleted"] == len(target) - stats["updated"]


def test_null_in_the_source_overwrites(spark):
    t = spark.createDataFrame([(1, "old")], "k int, v string")
    s = spark.createDataFrame([(1, None)], "k int, v string")
    assert rows(merge(t, s, "upsert", ["k"])) == [(1, None)]


def test_upsert_twice_is_once(spark):
    target, source = tables(4)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL).dropna(subset=KEYS)
    once = merge(t, s, "upsert", KEYS, order_by=["seq"])
    assert rows(merge(once, s, "upsert", KEYS, order_by=["seq"])) == rows(once)


def test_skip_existing_after_append_adds_nothing(spark):
    target, source = tables(5, unique_source=True)
    t = spark.createDataFrame(target, DDL)
    s = spark.createDataFrame(source, DDL).dropna(subset=KEYS)
    both = merge(t, s, "append-only")
    changes = merge_changes(both, s, "skip-existing", KEYS, target_unique=False)
    assert merge_stats(changes).first()["inserted"] == 0


def test_skip_existing_keeps_source_duplicates_unless_told(spark):
    t = spark.createDataFrame([(1, 0)], "k int, seq int")
    s = spark.createDataFrame([(2, 5), (2, 4), (1, 9)], "k int, seq int")
    assert rows(merge(t, s, "skip-existing", ["k"])) == [(1, 0), (2, 4), (2, 5)]
    assert rows(merge(t, s, "skip-existing", ["k"], dedupe="first", order_by=["seq"])) == [(1, 0), (2, 4)]


def test_repeated_target_keys_do_not_distort_the_counts(spark):
    t = spark.createDataFrame([(1, 0), (1, 1), (1, 2)], "k int, seq int")
    s = spark.createDataFrame([(1, 5), (2, 5)], "k int, seq int")
    for mode in ("skip-existing", "insert-ignore"):
        stats = merge_stats(merge_changes(t, s, mode, ["k"]), s).first()
        assert (stats["inserted"], stats["skipped"], stats["superseded"], stats["kept"]) == (1, 1, 0, 3)


def test_delete_insert_and_fresh_start(spark):
    t = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, v string")
    s = spark.createDataFrame([(9, "s")], "k int, v string")
    changes = merge_changes(t, s, "delete-insert", delete_condition="v = 'a'")
    assert rows(live_rows(changes)) == [(2, None), (3, "b"), (9, "s")]
    assert merge_stats(changes).first()["deleted"] == 1
    assert rows(merge(t, s, "delete-insert")) == [(9, "s")]
    assert rows(merge(t, s, "fresh-start")) == [(9, "s")]


def test_stamp_and_missing_columns(spark):
    t = spark.createDataFrame([(1, "a", "then"), (2, "b", "then")], "k int, v string, at string")
    s = spark.createDataFrame([(1, "z"), (3, "c")], "k int, v string")
    got = rows(merge(t, s, "upsert", ["k"], stamp=("at", "now")))
    assert got == [(1, "z", "now"), (2, "b", "then"), (3, "c", None)]
    got = rows(merge(t, s, "upsert", ["k"]))
    assert got[0] == (1, "z", "then")
    with pytest.raises(ValueError, match="not in the target"):
        merge(t, s.toDF("k", "other"), "upsert", ["k"])


def test_only_key_columns_means_ignore(spark):
    t = spark.createDataFrame([(1,)], "k int")
    s = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    stats = merge_stats(merge_changes(t, s, "upsert", ["k"]), s).first()
    assert (stats["inserted"], stats["updated"], stats["skipped"], stats["superseded"]) == (1, 0, 1, 1)


def test_conflicts_as_errors(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string")
    with pytest.raises(MergeConflict, match="repeats"):
        merge(t, twice, "upsert", ["k"], on_duplicate="error")
    with pytest.raises(MergeConflict, match="already holds"):
        merge(t, t, "insert", ["k"], on_conflict="error")
    assert merge(t, twice, "insert", ["k"], on_conflict="error").count() == 3


def test_bad_calls(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    for kwargs, text in [
        ({"mode": "replace"}, "unknown merge mode"),
        ({"mode": "upsert"}, "needs key columns"),
        ({"mode": "update", "keys": []}, "needs key columns"),
        ({"mode": "upsert", "keys": ["gone"]}, "not in both"),
        ({"mode": "upsert", "keys": ["k"], "on_conflict": "what"}, "on_conflict"),
        ({"mode": "upsert", "keys": ["k"], "on_duplicate": "what"}, "on_duplicate"),
        ({"mode": "upsert", "keys": ["k"], "update_columns": ["zz"]}, "update columns"),
    ]:
        with pytest.raises(ValueError, match=text):
            merge(t, t, **kwargs)


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "c"), (1, 1, "a"), (2, 1, "z")], "k int, seq int, v string")
    assert rows(keep_last(df, ["k"], ["seq"])) == [(1, 2, "c"), (2, 1, "z")]
    assert rows(keep_first(df, ["k"], ["seq"])) == [(1, 1, "a"), (2, 1, "z")]
    assert rows(duplicate_keys(df, ["k"])) == [(1, 3)]
    with pytest.raises(ValueError, match="order_by"):
        keep_last(df, ["k"], [])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 3 AS k", "id AS seq")
    plan = plan_of(keep_last(df, ["k"], ["seq"]))
    assert "row_number(), 1, Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_skip_existing_reads_only_the_keys_of_the_target(spark, root):
    target, source = tables(6, unique_source=True)
    spark.createDataFrame(target, DDL).write.parquet(f"{root}/t")
    spark.createDataFrame(source, DDL).write.parquet(f"{root}/s")
    t, s = spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/s")
    added = live_rows(merge_changes(t, s, "skip-existing", KEYS, with_kept=False, source_unique=True))
    scans = [line for line in plan_of(added).splitlines() if "FileScan" in line and f"{root}/t" in line]
    assert scans and all("ReadSchema: struct<k:int,j:string>" in line for line in scans)
    assert rows(t.unionByName(added)) == rows(merge(t, s, "skip-existing", KEYS))


def test_without_hot_keys_their_branch_is_dropped(spark, root):
    spark.range(100).selectExpr("id AS k", "id AS v").write.parquet(f"{root}/t")
    spark.range(50, 300).selectExpr("id AS k", "id AS v").write.parquet(f"{root}/s")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        t, s = spark.read.parquet(f"{root}/t"), spark.read.parquet(f"{root}/s")
        plans = []
        for hot_rows in (5, 0):
            changes = merge_changes(t, s, "skip-existing", ["k"], with_kept=False, hot_rows=hot_rows)
            assert changes.where("_live").count() == 200
            changes.collect()
            plans.append(changes._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        assert "BroadcastHashJoin" not in plans[0] and "BroadcastHashJoin" in plans[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_counters_fill_while_writing(spark, root):
    target, source = tables(8)
    t, s = spark.createDataFrame(target, DDL), spark.createDataFrame(source, DDL)
    changes = merge_changes(t, s, "upsert", KEYS, order_by=["seq"])
    watched, counters = observed(changes, "c")
    live_rows(watched).write.parquet(f"{root}/out")
    want = merge_stats(changes).first().asDict()
    got = counters.get
    assert {k: got[k] for k in want} == want
    assert got["live"] == spark.read.parquet(f"{root}/out").count()


def test_row_level_merge_needs_a_table_that_supports_it(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS rl_target (k INT, v STRING) USING parquet")
    try:
        s = spark.createDataFrame([(1, "a")], "k int, v string")
        with pytest.raises(PySparkException) as error:
            merge_into_table(s, "rl_target", ["k"], condition="rl_target.v <> s.v", delete_missing=True)
        assert "UNSUPPORTED_FEATURE.TABLE_OPERATION" in error.value.getCondition()
    finally:
        spark.sql("DROP TABLE IF EXISTS rl_target")


@pytest.mark.parametrize("mode", ["upsert", "update", "sync"])
def test_a_merge_of_unique_keys_shuffles_each_side_once(spark, tmp_path, mode):
    for name in ("target", "source"):
        spark.range(50).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / name))
    t, s = (spark.read.parquet(str(tmp_path / name)) for name in ("target", "source"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = merge_changes(t, s, mode, ["k"], source_unique=True)
        plan = changes._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("SortMergeJoin") == 1
