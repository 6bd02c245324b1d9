"""Run declared loads: extract, resolve keys, clean, merge, write, report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, replace
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.dedupe import keep_last
from rowferry.operators.lookup import measures_small, ready_lookup, rebuild_lookup, resolve_codes
from rowferry.operators.merge import ADDING_MODES, KEYED_MODES, live_rows, merge, merge_changes, observed
from rowferry.operators.project import conform, transform_rows
from rowferry.plans import keyed
from rowferry.plans.commits import CommitConflict, commit_numbers, file_system, names, remove
from rowferry.plans.progress import commits_path, empty_frame, load_progress, resume_action, run_progress, save_progress, table_progress
from rowferry.plans.spec import TableLoad, check_plan, priority_groups
from rowferry.session import work_path
from rowferry.sources.ranges import KeyRanges, even_ranges

# How often a run starts over after another writer committed first.
ATTEMPTS = 5


class LoadFailed(RuntimeError):
    """One or more loads of a priority group failed; later groups did not run."""


@dataclass(frozen=True)
class LoadResult:
    table_id: str
    action: str
    read: int = 0
    inserted: int = 0
    updated: int = 0
    skipped: int = 0
    deleted: int = 0
    superseded: int = 0
    target_rows: int = 0
    paths: tuple[str, ...] = ()


def read_target(spark: SparkSession, schema: T.StructType, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else empty_frame(spark, schema)


def rows_of(spark: SparkSession, schema: T.StructType, run: Row | None) -> DataFrame:
    """The rows of a table as one run left them."""
    if run and run["manifest"]:
        return keyed.read_keyed(spark, schema, run["manifest"])
    return read_target(spark, schema, (run and run["paths"]) or ())


def current_target(spark: SparkSession, root: str, table_id: str, schema: T.StructType) -> DataFrame:
    """The rows of a table as its last finished run left them."""
    return rows_of(spark, schema, table_progress(spark, root, table_id))


def cleaned_source(spark: SparkSession, load: TableLoad, lookups: Mapping[str, DataFrame | None]) -> DataFrame:
    """The source with its keys resolved, cleaned and in the target's declared columns."""
    resolved = resolve_codes(load.source(spark), load.foreign_keys, lookups)
    return conform(transform_rows(resolved, load.transform), load.schema)


def write_merge(
    spark: SparkSession,
    root: str,
    load: TableLoad,
    cleaned: DataFrame,
    load_ts: str,
    before: Row | None,
    last_batch: int = -1,
    counted: DataFrame | None = None,
    **progress,
) -> LoadResult:
    """Merge a cleaned source into the table ``before`` describes, write, and commit to the progress table.

    A mode that only adds rows writes only those, so the cost follows the source
    and the target's keys, not the target; in keyed files any keyed merge reads and
    writes only what it touches. ``counted`` are the rows to report as read and to
    measure, where ``cleaned`` was cut down from more. ``progress`` are further
    values of the progress row. ``CommitConflict`` when another run committed first
    and what it changed is what this one read.
    """
    run = (before["run"] if before else 0) + 1
    held = before["target_rows"] if before else 0
    last_batch = max(last_batch, before["last_batch"] if before else -1)
    action = resume_action(load.mode, False, held)
    folder = f"{root.rstrip('/')}/{load.table_id}/run={run}-{uuid.uuid4().hex[:12]}"
    counted = cleaned if counted is None else counted
    n_read = counted.count()
    known = held and measures_small(counted, n_read)
    options = {"broadcast_source": bool(known), "target_rows": held, "source_rows": n_read, **load.options}
    write = _write_keyed if load.files else _write_plain
    counts, state, again = write(spark, load, cleaned, before, folder, run, options)
    ops = {k: counts[k] for k in ("inserted", "updated", "skipped", "deleted")}
    values = {"table_id": load.table_id, "mode": load.mode, "read_rows": n_read, "is_complete": True, "load_ts": load_ts, **ops}
    values |= {"seen_run": (before and before["seen_run"]) or 0, **progress}
    while True:
        try:
            save_progress(spark, root, run=run, last_batch=last_batch, **values, **state)
            break
        except CommitConflict:
            newest = table_progress(spark, root, load.table_id)
            state = None if progress else again(newest)
            if state is None:
                raise
            run, last_batch = newest["run"] + 1, max(last_batch, newest["last_batch"])
    lost = n_read - ops["inserted"] - ops["updated"] - ops["skipped"]
    paths = tuple(state["paths"])
    return LoadResult(load.table_id, action, n_read, **ops, superseded=lost, target_rows=state["target_rows"], paths=paths)


def _stage_changes(spark: SparkSession, load: TableLoad, changes: DataFrame, folder: str) -> tuple[DataFrame, str | None]:
    """The live rows of a change set; with ``keep_changes`` from a copy of it, by what became of each row."""
    if not load.keep_changes:
        return live_rows(changes), None
    kept = f"{folder}/changes"
    changes.write.partitionBy("_op").parquet(kept)
    return live_rows(spark.read.schema(changes.schema).parquet(kept)).select(*load.schema.names), kept


def _write_plain(spark, load, cleaned, before, folder, run, options):
    """A folder a run: of all rows, or of the new ones where the mode only adds."""
    if before and before["manifest"]:
        raise ValueError(f"{load.table_id} lies in keyed files; declare them")
    adds = load.mode in ADDING_MODES
    paths = list((before and before["paths"]) or ())
    target = read_target(spark, load.schema, paths)
    changes = merge_changes(target, cleaned, load.mode, load.keys, with_kept=not adds, **options)
    watched, counters = observed(changes, f"{load.table_id}-{run}")
    live, kept = _stage_changes(spark, load, watched, folder)
    live.write.parquet(f"{folder}/data")
    counts = {k: v or 0 for k, v in counters.get.items()}
    held = (before["target_rows"] if before and adds else 0) + counts["live"]
    state = {"paths": [*paths, f"{folder}/data"] if adds else [f"{folder}/data"], "target_rows": held, "changes": kept}
    return counts, state, lambda newest: None


def _write_keyed(spark, load, cleaned, before, folder, run, options):
    """Only the entries that may hold a key of the source are read, only they are replaced."""
    files, keys = load.files, list(load.keys)
    if before and before["paths"]:
        raise ValueError(f"{load.table_id} was not written in keyed files; load it into another table first")
    old = before["manifest"] if before else None
    manifest = keyed.read_manifest(spark, load.schema, keys, old)
    if old and keyed.other_buckets(manifest, files):
        raise ValueError(f"{load.table_id} was written with another number of buckets")
    adds = load.mode in ADDING_MODES
    whole = load.mode in ("delete-insert", "fresh-start") or bool(options.get("delete_missing"))
    cells = cleaned.select(files.cell(keys).alias(keyed.CELL)).distinct()
    if whole:
        held, full = keyed.entries_of(manifest), []
    else:
        asked = load.mode in KEYED_MODES and old
        held = keyed.entries_that_may_hold(spark, manifest, cleaned, files, keys) if asked else []
        full = keyed.crowded(manifest, cells, files) if old else []
    replaced = full if adds else sorted({*held, *full})
    target = keyed.entry_rows(spark, load.schema, held if adds else replaced)
    changes = merge_changes(target, cleaned, load.mode, keys, with_kept=not adds, **options)
    watched, counters = observed(changes, f"{load.table_id}-{run}")
    live, kept = _stage_changes(spark, load, watched, folder)
    if adds and full:
        live = live.unionByName(keyed.entry_rows(spark, load.schema, full))
    added = keyed.write_entries(spark, live, files, keys, folder)
    rows = keyed.next_manifest(spark, manifest, replaced, added, f"{folder}/manifest")

    def again(newest: Row) -> dict | None:
        """The same change on top of what another run left, if that run changed no cell this one read or wrote."""
        if whole or not newest["manifest"]:
            return None
        other = keyed.read_manifest(spark, load.schema, keys, newest["manifest"])
        ours = {r[0] for r in cells.collect()} | {cell for cell, _ in replaced}
        if ours & keyed.cells_that_differ(manifest, other):
            return None
        path = f"{folder}/manifest-{newest['run']}"
        return {"paths": [], "manifest": path, "target_rows": keyed.next_manifest(spark, other, replaced, added, path), "changes": kept}

    counts = {k: v or 0 for k, v in counters.get.items()}
    return counts, {"paths": [], "manifest": f"{folder}/manifest", "target_rows": rows, "changes": kept}, again


def skipped_result(load: TableLoad, before: Row | None) -> LoadResult:
    """What a run reports that had nothing to do."""
    if before is None:
        return LoadResult(load.table_id, "skip")
    return LoadResult(load.table_id, "skip", target_rows=before["target_rows"], paths=tuple(before["paths"] or ()))


def _staged(spark: SparkSession, load: TableLoad, cleaned: DataFrame) -> DataFrame:
    """Read the source once where that was asked for: a database read again could give other rows."""
    if not load.stage:
        return cleaned
    path = work_path(spark, f"stage-{load.table_id}")
    cleaned.write.parquet(path)
    return spark.read.schema(load.schema).parquet(path)


def retried(run: Callable[[], LoadResult]) -> LoadResult:
    """Start over when another writer committed first."""
    for left in reversed(range(ATTEMPTS)):
        try:
            return run()
        except CommitConflict:
            if not left:
                raise


def load_table(
    spark: SparkSession,
    root: str,
    load: TableLoad,
    load_ts: str,
    lookups: Mapping[str, DataFrame | None] | None = None,
) -> LoadResult:
    """Load one table, unless it is already complete and its mode leaves complete tables alone.

    Of two loads at once one commits; the other starts over from what that one left.
    """
    staged: list[DataFrame] = []

    def once() -> LoadResult:
        before = table_progress(spark, root, load.table_id)
        if before and resume_action(load.mode, before["is_complete"], before["target_rows"]) == "skip":
            return skipped_result(load, before)
        if not staged:
            staged.append(_staged(spark, load, cleaned_source(spark, load, lookups or {})))
        return write_merge(spark, root, load, staged[0], load_ts, before)

    return retried(once)


# Later ranges add to what the first one cleared.
_CLEARING = {"fresh-start": "insert", "delete-insert": "insert"}


def load_in_ranges(
    spark: SparkSession,
    root: str,
    load: TableLoad,
    column: str,
    n: int,
    load_ts: str,
    lookups: Mapping[str, DataFrame | None] | None = None,
) -> list[LoadResult]:
    """Load one table range by range of a source column, each with its own commit; gives the results of this run's ranges.

    The cuts are taken from the source once and kept with the first commit. A load
    that died goes on after its last committed range, with the cuts it began with.
    ``column`` is an integer column of the source; rows that share a merge key must
    share its value, as when it is the key.
    """
    if load.options.get("delete_missing"):
        raise ValueError("a range of the source cannot tell which target rows are missing in all of it")
    source = load.source(spark)
    results: list[LoadResult] = []

    def once() -> LoadResult:
        before = table_progress(spark, root, load.table_id)
        begun = before is not None and not before["is_complete"] and before["cuts"] is not None
        if before and not begun and resume_action(load.mode, before["is_complete"], before["target_rows"]) == "skip":
            return skipped_result(load, before)
        cuts = tuple(before["cuts"]) if begun else even_ranges(source, column, n).cuts
        at = before["ranges_done"] if begun else 0
        mode = _CLEARING.get(load.mode, load.mode) if at else load.mode
        part = source.where(KeyRanges(column, cuts).predicates()[at])
        one = replace(load, source=lambda _: part, mode=mode)
        cleaned = _staged(spark, one, cleaned_source(spark, one, lookups or {}))
        done = at == len(cuts)
        return write_merge(spark, root, one, cleaned, load_ts, before, cuts=None if done else list(cuts), ranges_done=at + 1, is_complete=done)

    while True:
        results.append(retried(once))
        last = table_progress(spark, root, load.table_id)
        if last["is_complete"]:
            return results


def changed_since(spark: SparkSession, root: str, load: TableLoad, run: int) -> DataFrame:
    """The rows that runs after ``run`` inserted, updated or deleted, with ``_op`` and ``_run``.

    Every run in between must have kept its changes; one that did not is an error, not a gap.
    """
    logged = T.StructType([*load.schema.fields, T.StructField("_live", T.BooleanType()), T.StructField("_op", T.StringType())])
    out = empty_frame(spark, T.StructType([*load.schema.fields, T.StructField("_op", T.StringType()), T.StructField("_run", T.LongType())]))
    for number in commit_numbers(spark, commits_path(root, load.table_id)):
        if number <= run:
            continue
        row = run_progress(spark, root, load.table_id, number)
        if row["changes"]:
            rows = spark.read.schema(logged).parquet(row["changes"]).where(F.col("_op").isin("inserted", "updated", "deleted"))
            out = out.unionByName(rows.drop("_live").withColumn("_run", F.lit(number).cast("long")))
        elif row["inserted"] or row["updated"] or row["deleted"] or row["mode"] == "clear":
            raise ValueError(f"run {number} of {load.table_id} did not keep its changes")
    return out


def load_from_changes(
    spark: SparkSession,
    root: str,
    load: TableLoad,
    upstream: TableLoad,
    load_ts: str,
    lookups: Mapping[str, DataFrame | None] | None = None,
) -> LoadResult:
    """Merge into one table what another's runs inserted or updated since this one last looked.

    The source is the change feed of ``upstream`` (which must ``keep_changes``), cut to the
    last change of each key; ``load.source`` is not read. Rows that were deleted upstream
    stay here. The run that was taken in is committed with the merge, so a run that dies
    takes the same changes again.
    """

    def once() -> LoadResult:
        before, newest = (table_progress(spark, root, one.table_id) for one in (load, upstream))
        seen = (before and before["seen_run"]) or 0
        if newest is None or newest["run"] <= seen:
            return skipped_result(load, before)
        changed = changed_since(spark, root, upstream, seen).where(F.col("_run") <= newest["run"])
        keys, whole = list(upstream.keys), F.lit(True)
        for key in keys:
            whole = whole & F.col(key).isNotNull()
        last = keep_last(changed.where(whole), keys, ["_run"]).unionByName(changed.where(~whole))
        rows = last.where("_op <> 'deleted'").select(*upstream.schema.names)
        resolved = resolve_codes(rows, load.foreign_keys, lookups or {})
        cleaned = conform(transform_rows(resolved, load.transform), load.schema)
        return write_merge(spark, root, load, cleaned, load_ts, before, seen_run=newest["run"])

    return retried(once)


def forget_old_runs(spark: SparkSession, root: str, table_id: str, keep: int = 1, older_than_s: int = 7 * 24 * 3600) -> list[str]:
    """Delete run folders that none of the last ``keep`` runs needs; gives those deleted.

    A folder younger than ``older_than_s`` seconds stays: its run may still be at work.
    """
    base = f"{root.rstrip('/')}/{table_id}"
    runs = commit_numbers(spark, commits_path(root, table_id))
    needed: set[str] = set()
    for number in runs[-keep:]:
        row = run_progress(spark, root, table_id, number)
        paths = [*(row["paths"] or ()), *(p for p in (row["manifest"], row["changes"]) if p)]
        if row["manifest"]:
            entries = spark.read.schema(f"{keyed.CELL} string, entry string").parquet(row["manifest"]).select("entry").distinct()
            paths += [f"{r['entry']}/" for r in entries.collect()]
        needed |= {p.removeprefix(base).split("/")[1] for p in paths if p.startswith(f"{base}/")}
    gone = []
    for name in names(spark, base):
        fs, at = file_system(spark, f"{base}/{name}")
        age = spark._jvm.System.currentTimeMillis() - fs.getFileStatus(at).getModificationTime()
        if name.startswith("run=") and name not in needed and age >= 1000 * older_than_s:
            remove(spark, f"{base}/{name}")
            gone.append(name)
    return gone


def _load_and_look_up(spark, root, load, load_ts, lookups, looked_up) -> LoadResult:
    """Load a table; where others look its codes up, its lookup is there afterwards."""
    result = load_table(spark, root, load, load_ts, lookups)
    if load.table_id in looked_up:
        loaded = current_target(spark, root, load.table_id, load.schema)
        lookups[load.table_id] = ready_lookup(rebuild_lookup(loaded, load.lookup))
    return result


def load_chain(spark: SparkSession, root: str, loads: Sequence[TableLoad], load_ts: str) -> list[LoadResult]:
    """Load tables by priority; each sees the ids of those before it. A failing group stops the rest."""
    check_plan(loads)
    looked_up = {fk.table for load in loads for fk in load.foreign_keys}
    lookups: dict[str, DataFrame] = {}
    results = []
    for priority, group in priority_groups(loads):
        failures = []
        for load in group:
            try:
                results.append(_load_and_look_up(spark, root, load, load_ts, lookups, looked_up))
            except Exception as error:
                failures.append(f"{load.table_id}: {error}")
        if failures:
            raise LoadFailed(f"priority group {priority}: {'; '.join(failures)}")
    return results


def load_graph(spark: SparkSession, root: str, loads: Sequence[TableLoad], load_ts: str, at_once: int = 3) -> list[LoadResult]:
    """Load every table as soon as those it needs are there, up to ``at_once`` side by side.

    Each load runs in a scheduler pool of its own name, so that with
    ``spark.scheduler.mode=FAIR`` a small table does not wait behind a large one. What
    depends on a load that failed does not run; all others do. Results come in the order given.
    """
    check_plan(loads)
    by_id = {load.table_id: load for load in loads}
    looked_up = {fk.table for load in loads for fk in load.foreign_keys}
    lookups: dict[str, DataFrame] = {}
    results, failures, running = {}, [], {}
    ready = TopologicalSorter({load.table_id: load.needs for load in loads})
    ready.prepare()

    def run(load: TableLoad) -> LoadResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", load.table_id)
        try:
            return _load_and_look_up(spark, root, load, load_ts, lookups, looked_up)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(at_once) as pool:
        while True:
            for name in ready.get_ready():
                running[pool.submit(inheritable_thread_target(spark)(run), by_id[name])] = name
            if not running:
                break
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if future.exception():
                    failures.append(f"{name}: {future.exception()}")
                else:
                    results[name] = future.result()
                    ready.done(name)
    if failures:
        left = [load.table_id for load in loads if load.table_id not in results]
        raise LoadFailed(f"{'; '.join(failures)}; not loaded: {', '.join(left)}")
    return [results[load.table_id] for load in loads]


def _replace_partitions(spark: SparkSession, path: str, pending: str, partition_by: Sequence[str]) -> None:
    """Put the partitions laid down in ``pending`` in the place of the old ones; may be repeated."""
    rows = spark.read.schema(spark.read.parquet(path).schema).parquet(pending)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def merge_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    mode: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    **options,
) -> None:
    """Merge into a partitioned Parquet folder, reading and rewriting only the partitions the source touches.

    The partition columns must be key columns, so that no other partition can hold
    a row of the same key. What is read is picked by a semi join with the source's
    partitions, which prunes the scan while it runs.

    The merged partitions are first laid down whole in ``_pending`` inside the
    folder, where readers do not look, and marked when complete; then they replace
    the old ones. A run cut short after the mark is finished from there by the next
    call before it merges anything, one cut short before it has changed nothing.
    """
    outside = [c for c in partition_by if c not in keys]
    if outside or not partition_by:
        raise ValueError(f"partition columns must be key columns: {outside or 'none given'}")
    if mode not in KEYED_MODES or options.get("delete_missing"):
        raise ValueError(f"mode {mode!r} reaches beyond the partitions of the source")
    pending = f"{path.rstrip('/')}/_pending"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = jvm_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    complete = jvm_path(f"{pending}/_COMPLETE")
    if fs.exists(complete):
        _replace_partitions(spark, path, pending, partition_by)
    fs.delete(jvm_path(pending), True)

    target = spark.read.parquet(path)
    named = [F.col(c).alias(f"__touched_{c}") for c in partition_by]
    touched = source.select(*named).distinct()
    # One row per partition of the source; broadcast, the set prunes the target's folders.
    touched = F.broadcast(touched) if measures_small(touched) else touched
    same = [F.col(c).eqNullSafe(F.col(f"__touched_{c}")) for c in partition_by]
    merged = merge(target.join(touched, same, "left_semi"), source, mode, keys, **options)
    merged.write.partitionBy(*partition_by).parquet(pending)
    fs.createNewFile(complete)
    _replace_partitions(spark, path, pending, partition_by)
    fs.delete(jvm_path(pending), True)


def load_report(spark: SparkSession, root: str) -> DataFrame:
    """A row per run, without the paths."""
    return load_progress(spark, root).select(
        "table_id", "run", "mode", "read_rows", "inserted", "updated", "skipped", "deleted", "target_rows",
        F.coalesce("is_complete", F.lit(False)).alias("is_complete"),
    )
