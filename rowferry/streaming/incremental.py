"""The same loads fed by increments, on Structured Streaming.

Appends go through the file sink, which is exactly-once by its own log. Merges
would rewrite the target for every micro-batch, so a run first lays its
micro-batches down in a change log, one folder per batch id (a repeated batch
overwrites its folder), and then merges everything new in one pass. The
progress row of that merge records the last batch it took in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.dedupe import keep_first, keep_last
from rowferry.operators.lookup import ForeignKey, ready_lookups, resolve_codes
from rowferry.operators.project import conform, transform_rows
from rowferry.plans.load import LoadResult, retried, skipped_result, write_merge
from rowferry.plans.progress import open_or_create, table_progress
from rowferry.plans.spec import TableLoad

STREAM_MODES = ("upsert", "skip-existing", "insert-ignore")


def file_stream(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    name_glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Parquet files of a folder as a stream; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def _run_available(writer, checkpoint: str) -> int:
    """Process what is there now and stop; gives the rows read."""
    query = writer.trigger(availableNow=True).option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return sum(p.numInputRows for p in query.recentProgress)


def append_stream(
    stream: DataFrame, root: str, table_id: str, transform: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Append everything new to ``root/table_id``; running again without new files adds nothing."""
    rows = transform_rows(stream, transform)
    path = f"{root.rstrip('/')}/{table_id}"
    _run_available(rows.writeStream.format("parquet").option("path", path), f"{root.rstrip('/')}/_checkpoint/{table_id}")
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def resolve_stream(
    stream: DataFrame, keys: Sequence[ForeignKey], lookups: Mapping[str, DataFrame | None]
) -> DataFrame:
    """Stream-static left joins: no state is kept, and each lookup is made ready once for all batches."""
    return resolve_codes(stream, keys, ready_lookups(lookups))


def changes_path(root: str, table_id: str) -> str:
    return f"{root.rstrip('/')}/_changes/{table_id}"


def pending_changes(spark: SparkSession, root: str, load: TableLoad, taken: int) -> DataFrame:
    """Logged rows of batches after ``taken``, with their ``batch_id``; older folders are not read."""
    logged = T.StructType([*load.schema.fields, T.StructField("batch_id", T.LongType())])
    log = open_or_create(spark, changes_path(root, load.table_id), logged, "batch_id")
    return log.where(F.col("batch_id") > taken)


def merge_stream(
    stream: DataFrame,
    root: str,
    load: TableLoad,
    load_ts: str,
    order_by: Sequence[str],
    lookups: Mapping[str, DataFrame | None] | None = None,
) -> LoadResult:
    """Merge everything new into the target of ``load``, once per run.

    Of a key that came several times, the later batch wins an upsert and the
    earlier one a skip-existing; within a batch ``order_by`` decides. Merging a
    batch again changes nothing, so a crash between log and merge is made good
    by the next run.
    """
    if load.mode not in STREAM_MODES:
        raise ValueError(f"mode {load.mode!r} is not repeatable; a stream merges by one of {STREAM_MODES}")
    spark = stream.sparkSession
    resolved = resolve_stream(stream, load.foreign_keys, lookups or {})
    cleaned = conform(transform_rows(resolved, load.transform), load.schema)
    log = changes_path(root, load.table_id)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{log}/batch_id={batch_id}")

    _run_available(cleaned.writeStream.foreachBatch(write_batch), f"{root.rstrip('/')}/_checkpoint/{load.table_id}")

    settled = replace(load, options={**load.options, "source_unique": True})

    def merge_new() -> LoadResult:
        before = table_progress(spark, root, load.table_id)
        pending = pending_changes(spark, root, load, before["last_batch"] if before else -1)
        newest = pending.agg(F.max("batch_id")).first()[0]
        if newest is None:
            return skipped_result(load, before)
        one_per_key = _settle(pending, load, order_by).drop("batch_id")
        return write_merge(spark, root, settled, one_per_key, load_ts, before, newest, counted=pending)

    return retried(merge_new)


def _settle(pending: DataFrame, load: TableLoad, order_by: Sequence[str]) -> DataFrame:
    keys = list(load.keys)
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    pick = keep_last if load.mode == "upsert" else keep_first
    # NULL keys never match each other, so their rows all stay.
    return pick(pending.where(~any_null), keys, ["batch_id", *order_by]).unionByName(pending.where(any_null))
