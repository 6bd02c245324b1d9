import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.lookup import ForeignKey
from rowferry.plans.load import current_target, load_table
from rowferry.plans.progress import table_progress
from rowferry.plans.spec import TableLoad
from rowferry.streaming.incremental import (
    append_stream,
    changes_path,
    file_stream,
    merge_stream,
    resolve_stream,
)

TS = "2024-01-01 00:00:00"
SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("v", T.StringType())])


def arrive(spark, folder, data):
    """One more file with these rows."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def load(mode, data=()):
    return TableLoad("t", lambda s: s.createDataFrame(list(data), SCHEMA), ("k",), SCHEMA, mode=mode)


def test_append_is_exactly_once_over_restarts(spark, root):
    inbox = f"{root}/in"
    arrive(spark, inbox, [(1, 1, "a"), (2, 1, "b")])

    def run():
        stream = file_stream(spark, inbox, SCHEMA, files_per_batch=1)
        return append_stream(stream, root, "out", lambda d: d.withColumn("v", F.upper("v")))

    assert rows(run()) == [(1, 1, "A"), (2, 1, "B")]
    assert run().count() == 2
    arrive(spark, inbox, [(3, 1, "c")])
    assert rows(run()) == [(1, 1, "A"), (2, 1, "B"), (3, 1, "C")]


@pytest.mark.parametrize("mode", ["upsert", "skip-existing"])
def test_merge_over_batches_and_restarts(spark, root, mode):
    inbox = f"{root}/in"
    load_table(spark, root, load("append-only", [(1, 0, "old"), (9, 0, "keep")]), TS)

    def run():
        stream = file_stream(spark, inbox, SCHEMA, files_per_batch=1)
        return merge_stream(stream, root, load(mode), TS, order_by=["seq"])

    # Two files are two batches; the second repeats a key of the first.
    arrive(spark, inbox, [(1, 5, "n1"), (2, 7, "first"), (2, 6, "lost"), (None, 1, "x")])
    arrive(spark, inbox, [(2, 1, "later"), (3, 1, "c"), (None, 1, "x")])
    run()
    files = spark.read.parquet(changes_path(root, "t")).select("batch_id").distinct().count()
    assert files == 2
    nulls = [(None, 1, "x"), (None, 1, "x")]
    if mode == "upsert":
        want = [*nulls, (1, 5, "n1"), (2, 1, "later"), (3, 1, "c"), (9, 0, "keep")]
    else:
        want = [*nulls, (1, 0, "old"), (2, 6, "lost"), (3, 1, "c"), (9, 0, "keep")]
    assert rows(current_target(spark, root, "t", SCHEMA)) == want
    assert run().action == "skip"
    assert rows(current_target(spark, root, "t", SCHEMA)) == want
    arrive(spark, inbox, [(3, 2, "d")])
    result = run()
    assert result.read == 1
    last = (3, 2, "d") if mode == "upsert" else (3, 1, "c")
    assert last in rows(current_target(spark, root, "t", SCHEMA))


def test_a_crash_between_log_and_merge_is_made_good(spark, root, monkeypatch):
    inbox = f"{root}/in"
    arrive(spark, inbox, [(1, 1, "a")])
    from rowferry.streaming import incremental

    def run():
        return merge_stream(file_stream(spark, inbox, SCHEMA), root, load("upsert"), TS, order_by=["seq"])

    def die(*args, **kwargs):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(incremental, "write_merge", die)
        with pytest.raises(RuntimeError):
            run()
    assert table_progress(spark, root, "t") is None
    arrive(spark, inbox, [(2, 1, "b")])
    run()
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(1, 1, "a"), (2, 1, "b")]


def test_a_batch_load_in_between_does_not_replay_the_log(spark, root):
    inbox = f"{root}/in"

    def run():
        return merge_stream(file_stream(spark, inbox, SCHEMA), root, load("upsert"), TS, order_by=["seq"])

    arrive(spark, inbox, [(1, 1, "streamed")])
    run()
    load_table(spark, root, load("upsert", [(1, 2, "corrected")]), TS)
    arrive(spark, inbox, [(2, 1, "b")])
    run()
    assert rows(current_target(spark, root, "t", SCHEMA)) == [(1, 2, "corrected"), (2, 1, "b")]


def test_keys_resolve_on_a_stream(spark, root):
    inbox = f"{root}/in"
    arrive(spark, inbox, [(1, 1, "a"), (2, 1, "zz"), (3, 1, "")])
    lookup = spark.createDataFrame([("a", 7)], "code string, id bigint")
    stream = resolve_stream(file_stream(spark, inbox, SCHEMA), [ForeignKey("v", "l", "ref")], {"l": lookup})
    assert stream.isStreaming
    assert rows(append_stream(stream, root, "out")) == [(1, 1, "a", 7), (2, 1, "zz", None), (3, 1, "", None)]


def test_only_repeatable_modes(spark, root):
    arrive(spark, f"{root}/in", [(1, 1, "a")])
    with pytest.raises(ValueError, match="not repeatable"):
        merge_stream(file_stream(spark, f"{root}/in", SCHEMA), root, load("append-only"), TS, order_by=["seq"])
