"""The progress table: one row per finished load run, and the pointer to each table's current rows.

A merge cannot overwrite the Parquet it reads, so every run writes a folder of its
own and then commits one progress row that names what holds the table now: the
folders (earlier ones and the new one where the run only added rows, the new one
alone where it rewrote the table), or the manifest of a table in keyed files. The
row is a file that only one writer can create under its run number, so of two runs
side by side one is refused and starts over from what the other left; a run that
dies before its commit leaves the table as it was.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.plans.commits import commit, commit_numbers, commit_path, file_system, read_text, safe_name


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer sees through: joins with it fold away."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1, numPartitions=1).where(F.lit(False)).select(*nulls)


PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("table_id", T.StringType()),
        T.StructField("run", T.LongType()),
        T.StructField("mode", T.StringType()),
        T.StructField("read_rows", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("updated", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("deleted", T.LongType()),
        T.StructField("target_rows", T.LongType()),
        T.StructField("is_complete", T.BooleanType()),
        T.StructField("last_batch", T.LongType()),
        T.StructField("paths", T.ArrayType(T.StringType())),
        T.StructField("load_ts", T.StringType()),
        # the folder of the manifest, for a table in keyed files
        T.StructField("manifest", T.StringType()),
        # the folder with the rows this run changed, where a load keeps them
        T.StructField("changes", T.StringType()),
        # a load by key ranges: its cuts, and how many ranges are done
        T.StructField("cuts", T.ArrayType(T.LongType())),
        T.StructField("ranges_done", T.LongType()),
        # the last run of the table this one follows whose changes it has taken in
        T.StructField("seen_run", T.LongType()),
    ]
)


def progress_path(root: str) -> str:
    return f"{root.rstrip('/')}/_progress"


def open_or_create(spark: SparkSession, path: str, schema: T.StructType, *partition_by: str) -> DataFrame:
    """The table at a path; an empty one is laid down when there is none yet."""
    empty_frame(spark, schema).write.mode("ignore").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def commits_path(root: str, table_id: str) -> str:
    return f"{progress_path(root)}/{safe_name(table_id)}"


def load_progress(spark: SparkSession, root: str) -> DataFrame:
    """Every run so far; no rows when nothing has run."""
    fs, at = file_system(spark, progress_path(root))
    if not fs.exists(at):
        return empty_frame(spark, PROGRESS_SCHEMA)
    reader = spark.read.schema(PROGRESS_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json")
    return reader.json(progress_path(root))


def save_progress(spark: SparkSession, root: str, **values) -> None:
    """Commit one run; ``CommitConflict`` when another writer has committed its number. What is not given is 0, false or NULL."""
    unknown = set(values) - set(PROGRESS_SCHEMA.names)
    if unknown or not values.get("table_id"):
        raise ValueError(f"a progress row needs table_id and knows no {sorted(unknown)}")
    row = {f.name: 0 if isinstance(f.dataType, T.LongType) else None for f in PROGRESS_SCHEMA.fields}
    row["is_complete"] = False
    row["last_batch"] = -1
    row.update(values)
    commit(spark, commits_path(root, row["table_id"]), row["run"], json.dumps(row, default=list))


def latest_progress(progress: DataFrame) -> DataFrame:
    """One row per table: its last run."""
    rest = [n for n in PROGRESS_SCHEMA.names if n != "table_id"]
    last = F.max_by(F.struct(*rest), F.col("run")).alias("p")
    return progress.groupBy("table_id").agg(last).select("table_id", "p.*")


def run_progress(spark: SparkSession, root: str, table_id: str, run: int) -> Row:
    """What one run of a table committed."""
    found = json.loads(read_text(spark, commit_path(commits_path(root, table_id), run)))
    return Row(**{name: found.get(name) for name in PROGRESS_SCHEMA.names})


def table_progress(spark: SparkSession, root: str, table_id: str) -> Row | None:
    """The last run of one table, or None."""
    runs = commit_numbers(spark, commits_path(root, table_id))
    return run_progress(spark, root, table_id, max(runs)) if runs else None


def is_complete(spark: SparkSession, root: str, table_id: str) -> bool:
    row = table_progress(spark, root, table_id)
    return bool(row and row["is_complete"])


def mark_complete(spark: SparkSession, root: str, table_id: str) -> None:
    row = table_progress(spark, root, table_id)
    if row is None:
        save_progress(spark, root, table_id=table_id, run=1, is_complete=True)
    elif not row["is_complete"]:
        save_progress(spark, root, **{**row.asDict(), "run": row["run"] + 1, "is_complete": True, "changes": None})


def clear_progress(spark: SparkSession, root: str, table_id: str) -> None:
    """Forget a table: the next run starts with an empty target. Earlier runs stay on record."""
    row = table_progress(spark, root, table_id)
    if row is not None:
        save_progress(spark, root, table_id=table_id, run=row["run"] + 1, mode="clear")


def progress_summary(progress: DataFrame) -> DataFrame:
    """One row: tables, complete tables, rows in the targets, rows read over all runs."""
    latest = latest_progress(progress)
    one = F.lit(1).alias("k")
    tables = latest.agg(
        F.count("*").alias("total_tables"),
        F.count_if("is_complete").alias("completed_tables"),
        F.coalesce(F.sum("target_rows"), F.lit(0)).alias("total_rows"),
    ).select("*", one)
    runs = progress.agg(F.coalesce(F.sum("read_rows"), F.lit(0)).alias("read_rows")).select("*", one)
    return tables.join(runs, "k").drop("k")


# A finished table is left alone in these modes; in the others a run always has work to do.
_DONE_ONCE = ("skip-existing", "append-only", "insert")


def resume_action(mode: str, complete: bool, target_rows: int) -> str:
    """What a run of one table should do, given its mode and what is there already."""
    if mode in _DONE_ONCE and complete:
        return "skip"
    if mode == "fresh-start":
        return "clear-and-load" if target_rows else "load"
    if not target_rows:
        return "load"
    return "load-new-rows" if mode == "skip-existing" else "merge"


def resume_action_column(mode: Column, complete: Column, target_rows: Column) -> Column:
    """``resume_action`` over a table of tables."""
    return (
        F.when(mode.isin(*_DONE_ONCE) & complete, F.lit("skip"))
        .when((mode == "fresh-start") & (target_rows > 0), F.lit("clear-and-load"))
        .when((mode == "fresh-start") | (target_rows == 0), F.lit("load"))
        .when(mode == "skip-existing", F.lit("load-new-rows"))
        .otherwise(F.lit("merge"))
    )
