"""Keyed files: rows equal to the plain merge, files read and written in proportion to the change."""

import random
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rowferry.operators.merge import merge
from rowferry.plans import keyed
from rowferry.plans import load as load_module
from rowferry.plans.commits import CommitConflict, commit, commit_numbers
from rowferry.plans.keyed import KeyedFiles
from rowferry.plans.load import changed_since, current_target, forget_old_runs, load_from_changes, load_in_ranges, load_table, write_merge
from rowferry.plans.progress import table_progress
from rowferry.plans.spec import TableLoad

TS = "2024-01-01 00:00:00"
DDL = "a long, b string, v string, n int"


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


def load(data, mode="upsert", files=KeyedFiles(5), **options):
    kept = options.pop("keep_changes", False)
    schema = "a long, b string, v string, n int"
    return TableLoad("t", lambda s: s.createDataFrame(data, schema), ("a", "b"), _SCHEMA, mode=mode, files=files, options=options, keep_changes=kept)


from pyspark.sql import types as T  # noqa: E402

_SCHEMA = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("v", T.StringType()), T.StructField("n", T.IntegerType())]
)


def made(rng, n, tag, least=0):
    keys = rng.sample(range(least, least + 4 * n), n)
    out = [(k, f"p/{k % 3} x", f"{tag}{k}", k) for k in keys]
    return [*out, (None, "p", tag, 1), (keys[0] + 10_000, None, tag, 2)]


def now(spark, root):
    return rows(current_target(spark, root, "t", _SCHEMA))


def files_of(spark, root):
    """Data files of the table now."""
    return {r[0] for r in current_target(spark, root, "t", _SCHEMA).select(F.input_file_name()).distinct().collect()}


@pytest.mark.parametrize("files", [KeyedFiles(2, ("b",)), KeyedFiles(3, most_entries=1)])
def test_runs_of_all_modes_equal_the_plain_merge(spark, root, files):
    rng = random.Random(3)
    data = made(rng, 40, "first")
    load_table(spark, root, load(data, "insert", files), TS)
    want = frame(spark, data)
    for i, (mode, options) in enumerate(
        [("upsert", {}), ("insert-ignore", {}), ("update", {}), ("skip-existing", {"dedupe": "first", "order_by": ["n"]}), ("upsert", {"update_columns": ["n"]}), ("upsert", {}),
         ("sync", {"delete_missing": True}), ("append-only", {}), ("upsert", {"condition": "s.n > t.n", "target_unique": False}), ("delete-insert", {"delete_condition": "n < 20"}), ("fresh-start", {})]
    ):
        data = made(rng, 25, f"run{i} ", least=i if mode != "append-only" else 5000)
        if mode == "upsert" and not options:
            data += [(data[0][0], data[0][1], "twice", 10**6)]
            options = {"order_by": ["n"]}
        if mode in ("skip-existing", "append-only"):  # a finished table is left alone: go past that check
            before = table_progress(spark, root, "t")
            result = write_merge(spark, root, load(data, mode, files, **options), frame(spark, data), TS, before)
        else:
            result = load_table(spark, root, load(data, mode, files, **options), TS)
        want = spark.createDataFrame(merge(want, frame(spark, data), mode, ["a", "b"], **options).collect(), DDL)
        assert now(spark, root) == rows(want), (mode, options)
        assert result.target_rows == want.count()


def test_an_upsert_leaves_other_files_as_they_were(spark, root):
    files = KeyedFiles(4, ("b",))
    data = [(k, f"p{k % 3}", "old", k) for k in range(300)]
    load_table(spark, root, load(data, "insert", files), TS)
    before = files_of(spark, root)
    assert len(before) >= 12
    load_table(spark, root, load([(3, "p0", "new", 0), (6, "p0", "new", 0)], "upsert", files), TS)
    after = files_of(spark, root)
    assert len(before - after) <= 2 and len(after - before) <= 2
    assert not [f for f in before - after if "cell=p0" not in f]
    assert rows(current_target(spark, root, "t", _SCHEMA).where("v = 'new'")) == [(3, "p0", "new", 0), (6, "p0", "new", 0)]
    # new keys add files and replace none
    held = files_of(spark, root)
    load_table(spark, root, load([(1000, "p0", "new", 0)], "upsert", files), TS)
    assert held < files_of(spark, root)


def test_only_entries_that_may_hold_a_key_are_read(spark, root):
    files, keys = KeyedFiles(8), ["a", "b"]
    for part in range(4):  # runs side by side in each bucket, ranges that overlap
        data = [(k * 4 + part, "p", "x", 0) for k in range(2000)]
        write_merge(spark, root, load(data, "append-only", files), frame(spark, data), TS, table_progress(spark, root, "t"))
    manifest = keyed.read_manifest(spark, _SCHEMA, keys, table_progress(spark, root, "t")["manifest"])
    assert manifest.count() == 32
    one = keyed.entries_that_may_hold(spark, manifest, frame(spark, [(42, "p", "", 0)]), files, keys)
    holds = {
        r["rowferry_cell"]: r["entry"]
        for r in manifest.collect()
        if keyed.entry_rows(spark, _SCHEMA, [(r["rowferry_cell"], r["entry"])]).where("a = 42").count()
    }
    assert len(holds) == 1 and set(holds.items()) <= set(one) and len(one) <= 2
    everything = frame(spark, [(k, "p", "", 0) for k in range(8000)])
    assert set(keyed.entries_that_may_hold(spark, manifest, everything, files, keys)) == set(keyed.entries_of(manifest))
    absent = frame(spark, [(k, "q", "", 0) for k in range(200)] + [(10**6, "p", "", 0)])
    assert len(keyed.entries_that_may_hold(spark, manifest, frame(spark, [(10**6, "p", "", 0)]), files, keys)) == 0  # out of every range
    hits = sum(
        len(keyed.entries_that_may_hold(spark, manifest, frame(spark, [(k, "q", "", 0)]), files, keys)) for k in range(0, 40, 4)
    )
    assert hits <= 4, "of 40 entries asked for keys that are not there"
    assert absent.count() == 201


STEPS = ["write_entries", "next_manifest", "save_progress"]


@pytest.mark.parametrize(("step", "after"), [(s, a) for s in STEPS for a in (False, True)][1:])
def test_dying_at_each_step_changes_nothing_or_all(spark, root, monkeypatch, step, after):
    data = [(k, "p", "old", k) for k in range(50)]
    news = [(k, "p", "new", k) for k in range(40, 60)]
    load_table(spark, root, load(data, "insert"), TS)
    old = now(spark, root)
    want = rows(merge(frame(spark, data), frame(spark, news), "upsert", ["a", "b"]))
    place = load_module if step == "save_progress" else keyed
    real = getattr(place, step)

    def dies(*args, **kwargs):
        if after:
            real(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(place, step, dies)
        with pytest.raises(RuntimeError, match="lost"):
            load_table(spark, root, load(news), TS)
    assert now(spark, root) == (want if after and step == "save_progress" else old)
    load_table(spark, root, load(news), TS)
    assert now(spark, root) == want


def test_only_one_writer_gets_a_commit(spark, root):
    commit(spark, f"{root}/c", 1, "{}")
    with pytest.raises(CommitConflict):
        commit(spark, f"{root}/c", 1, '{"other": 1}')
    commit(spark, f"{root}/c", 2, "{}")
    assert commit_numbers(spark, f"{root}/c") == [1, 2]


def test_two_loads_at_once(spark, root):
    files = KeyedFiles(4, ("b",))
    load_table(spark, root, load([(k, f"p{k % 2}", "old", 0) for k in range(20)], "insert", files), TS)
    before = table_progress(spark, root, "t")

    def write(data):
        return write_merge(spark, root, load(data, "upsert", files), frame(spark, data), TS, before)

    write([(0, "p0", "first", 1)])
    write([(1, "p1", "second", 2)])  # began before the first committed, in another partition: both stay
    held = {r[0]: r[2] for r in now(spark, root)}
    assert (held[0], held[1], len(held)) == ("first", "second", 20)
    with pytest.raises(CommitConflict):
        write([(0, "p0", "third", 3)])  # read what the first one changed
    assert {r[0]: r[2] for r in now(spark, root)}[0] == "first"
    # a load reads again and goes through, whatever the layout
    calls, real = [], load_module.save_progress

    def late(*args, **kwargs):
        if not calls:
            calls.append(1)
            other = frame(spark, [(0, "p0", "between", 4)])
            write_merge(spark, root, load([], "upsert", files), other, TS, table_progress(spark, root, "t"))
        return real(*args, **kwargs)

    load_module.save_progress = late
    try:
        load_table(spark, root, load([(0, "p0", "last", 5), (2, "p0", "last", 5)], "upsert", files), TS)
    finally:
        load_module.save_progress = real
    held = {r[0]: r[2] for r in now(spark, root)}
    assert (held[0], held[2], held[1]) == ("last", "last", "second")


def test_two_plain_loads_at_once_lose_nothing(spark, root):
    plain = load([(1, "p", "a", 0)], "insert", None)
    load_table(spark, root, plain, TS)
    before = table_progress(spark, root, "t")
    for k in (2, 3):
        one = load([(k, "p", "b", 0)], "upsert", None)
        if k == 2:
            write_merge(spark, root, one, frame(spark, [(k, "p", "b", 0)]), TS, before)
        else:
            with pytest.raises(CommitConflict):
                write_merge(spark, root, one, frame(spark, [(k, "p", "b", 0)]), TS, before)
            load_table(spark, root, one, TS)
    assert [r[0] for r in now(spark, root)] == [1, 2, 3]


def test_a_load_in_ranges_goes_on_where_it_died(spark, root):
    data = [(k, "p", "x", k) for k in range(100)] + [(None, "p", "x", 5)]
    ran, broken = [], [True]

    def transform(df):
        low = df.agg(F.min("a")).first()[0]
        ran.append(low)
        if broken and len(ran) == 3:
            raise RuntimeError("lost")
        return df

    for files, table in ((KeyedFiles(3), "t"), (None, "u")):
        ran.clear()
        broken[:] = [True]
        one = replace(load(data, "upsert", files), table_id=table, transform=transform)
        with pytest.raises(RuntimeError, match="lost"):
            load_in_ranges(spark, root, one, "a", 5, TS)
        last = table_progress(spark, root, table)
        assert (last["ranges_done"], last["is_complete"], last["cuts"]) == (2, False, [19, 39, 59, 79])
        assert current_target(spark, root, table, _SCHEMA).count() == 40
        broken.clear()
        results = load_in_ranges(spark, root, one, "a", 3, TS)
        assert ran == [0, 19, 39, 39, 59, 79], "only the ranges left ran, with the first run's cuts"
        assert len(results) == 3 and table_progress(spark, root, table)["is_complete"]
        assert rows(current_target(spark, root, table, _SCHEMA)) == rows(frame(spark, data))
    fresh = load(data[:10], "fresh-start", KeyedFiles(3))
    load_in_ranges(spark, root, fresh, "a", 2, TS)
    assert rows(current_target(spark, root, "t", _SCHEMA)) == rows(frame(spark, data[:10]))
    with pytest.raises(ValueError, match="missing in all"):
        load_in_ranges(spark, root, load(data, "sync", delete_missing=True), "a", 2, TS)


def test_changes_of_runs(spark, root):
    first = load([(k, "p", "old", k) for k in range(5)], "insert", keep_changes=True)
    load_table(spark, root, first, TS)
    second = load([(1, "p", "new", 1), (9, "p", "new", 9)], "sync", keep_changes=True, delete_missing=True)
    load_table(spark, root, second, TS)
    got = sorted((r["a"], r["v"], r["_op"], r["_run"]) for r in changed_since(spark, root, second, 1).collect())
    assert got == [(0, "old", "deleted", 2), (1, "new", "updated", 2), (2, "old", "deleted", 2), (3, "old", "deleted", 2), (4, "old", "deleted", 2), (9, "new", "inserted", 2)]
    assert changed_since(spark, root, second, 0).count() == 11 and changed_since(spark, root, second, 2).count() == 0
    load_table(spark, root, load([(1, "p", "again", 1)]), TS)
    with pytest.raises(ValueError, match="did not keep"):
        changed_since(spark, root, second, 2)
    with pytest.raises(ValueError, match="only in keyed files"):
        load([], "upsert", None, keep_changes=True)


def test_old_runs_go_when_nobody_needs_them(spark, root):
    files = KeyedFiles(2, most_entries=2)
    for i in range(4):
        load_table(spark, root, load([(k, "p", f"run {i}", i) for k in range(i, 20)], "upsert", files), TS)
    want = now(spark, root)
    assert forget_old_runs(spark, root, "t") == [], "they are too young"
    gone = forget_old_runs(spark, root, "t", older_than_s=0)
    assert gone and now(spark, root) == want
    load_table(spark, root, load([(1, "p", "on it goes", 1)], "upsert", files), TS)
    assert now(spark, root) != want


def test_layouts_are_not_mixed(spark, root):
    load_table(spark, root, load([(1, "p", "a", 1)], "insert"), TS)
    with pytest.raises(ValueError, match="lies in keyed files"):
        load_table(spark, root, load([(1, "p", "a", 1)], "upsert", None), TS)
    with pytest.raises(ValueError, match="number of buckets"):
        load_table(spark, root, load([(1, "p", "a", 1)], "upsert", KeyedFiles(6)), TS)
    with pytest.raises(ValueError, match="must be among them"):
        load([], "upsert", KeyedFiles(2, ("v",)))


def test_a_table_that_follows_another_reads_only_its_changes(spark, root):
    def upstream(data, mode):
        return load(data, mode, keep_changes=True, **({"delete_missing": True} if mode == "sync" else {}))

    follower = replace(load([], "upsert"), table_id="f", transform=lambda df: df.withColumn("v", F.upper("v")))
    assert load_from_changes(spark, root, follower, upstream([], "insert"), TS).action == "skip"
    first = upstream([(k, "p", "old", k) for k in range(30)] + [(None, "p", "old", 0)], "insert")
    load_table(spark, root, first, TS)
    assert load_from_changes(spark, root, follower, first, TS).read == 31
    second = upstream([(1, "p", "new", 1), (2, "p", "new", 2)], "upsert")
    load_table(spark, root, second, TS)
    load_table(spark, root, upstream([(2, "p", "newer", 2), (50, "p", "newer", 5)], "upsert"), TS)
    result = load_from_changes(spark, root, follower, second, TS)
    assert (result.read, result.updated, result.inserted) == (3, 2, 1)
    held = {r["a"]: r["v"] for r in current_target(spark, root, "f", _SCHEMA).collect()}
    assert (held[1], held[2], held[50], held[3], len(held)) == ("NEW", "NEWER", "NEWER", "OLD", 32)
    assert load_from_changes(spark, root, follower, second, TS).action == "skip"
    load_table(spark, root, replace(follower, source=lambda s: frame(s, [(3, "p", "corrected", 3)])), TS)
    assert load_from_changes(spark, root, follower, second, TS).action == "skip", "a load in between forgets nothing"
