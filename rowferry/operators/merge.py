"""Merge a source into a target by a chosen rule.

A merge is described by its *change set*: the target's columns, ``_op`` saying
what became of each row (``kept``, ``updated``, ``inserted``, ``skipped``,
``deleted``) and ``_live`` saying whether the row is in the new target.

Shape of every keyed merge, for a target far larger than one executor:

* rows with a NULL key never match; they go around the joins, so they do not
  pile up in one partition;
* the source is cut to one row per key before it is joined;
* where no target key can be hot (keys are unique, or the target is known to be small),
  one target FULL OUTER JOIN source with a flag on each side tells old, changed and new
  rows apart: both sides shuffle once;
* a source the caller measured to be small (``broadcast_source``) is broadcast to
  a LEFT JOIN and the target is not shuffled. So is the join where target keys may
  repeat; a key that may repeat without end (target keys not declared unique,
  source rows of skip-existing) is taken out when hot and salted;
* beside such a LEFT JOIN, and for modes that only add, new rows are found through
  the keys: target keys SEMI source keys, then source ANTI those. That read of the
  target is pruned to its key columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rowferry.operators.dedupe import duplicate_keys, keep_first, keep_last
from rowferry.operators.skew import HOT_ROWS, join_split, key_counts

MODES = (
    "insert",
    "insert-ignore",
    "upsert",
    "update",
    "delete-insert",
    "sync",
    "skip-existing",
    "fresh-start",
    "append-only",
)
KEYED_MODES = ("insert-ignore", "upsert", "update", "sync", "skip-existing")
# These never change a row that is there, so a load may write just the new rows.
ADDING_MODES = ("insert", "append-only", "insert-ignore", "skip-existing")
OPS = ("inserted", "updated", "skipped", "deleted", "kept")


class MergeConflict(ValueError):
    """A key conflict where the caller asked for an error."""


def _align(source: DataFrame, target: DataFrame) -> DataFrame:
    """The source by name and in the target's types; columns it does not have are NULL."""
    extra = [c for c in source.columns if c not in target.columns]
    if extra:
        raise ValueError(f"source columns {extra} are not in the target: {target.columns}")
    have = {f.name: f.dataType for f in source.schema.fields}
    picked = []
    for f in target.schema.fields:
        if f.name not in have:
            picked.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif have[f.name] == f.dataType:
            picked.append(F.col(f"`{f.name}`"))
        else:
            picked.append(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name))
    return source.select(*picked)


def _tag(df: DataFrame, op: str, live: bool = True) -> DataFrame:
    return df.withColumns({"_op": F.lit(op), "_live": F.lit(live)})


def _split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows that can match, and rows that cannot; the second scan skips row groups without NULLs."""
    nullable = [k for k in keys if df.schema[k].nullable]
    if not nullable:
        return df, None
    any_null = reduce(lambda a, b: a | b, [F.col(f"`{k}`").isNull() for k in nullable])
    return df.where(~any_null), df.where(any_null)


def _hint(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def existing_keys(
    target: DataFrame,
    source_keys: DataFrame,
    keys: Sequence[str],
    target_unique: bool = True,
    broadcast_source: bool = False,
) -> DataFrame:
    """Keys of the source that the target holds, reading only the target's key columns."""
    held = target.select(*keys)
    if not target_unique:
        held = held.distinct()
    return held.join(_hint(source_keys, broadcast_source), list(keys), "left_semi")


def merge_changes(
    target: DataFrame,
    source: DataFrame,
    mode: str,
    keys: Sequence[str] = (),
    *,
    update_columns: Sequence[str] | None = None,
    condition: str | None = None,
    on_conflict: str = "update",
    on_duplicate: str = "last",
    order_by: Sequence[str] = (),
    dedupe: str | None = None,
    delete_condition: str | None = None,
    delete_missing: bool = False,
    stamp: tuple[str, str] | None = None,
    target_unique: bool = True,
    source_unique: bool = False,
    broadcast_source: bool = False,
    with_kept: bool = True,
    hot_rows: int = HOT_ROWS,
    target_rows: int | None = None,
    source_rows: int | None = None,
) -> DataFrame:
    """The change set of one merge.

    ``condition`` is SQL over the aliases ``t`` (target row) and ``s`` (source row).
    ``on_duplicate`` says what a key repeated in the source means for upsert, update
    and sync: ``"last"`` by ``order_by`` wins, or ``"error"``. ``dedupe="first"``
    does the same for skip-existing, which otherwise inserts every new row. Without
    ``order_by`` the largest row by its remaining columns counts as the last.
    ``source_unique`` declares that no key repeats, which saves the dedupe;
    ``target_unique=False`` that target keys may, which collapses them first.
    ``stamp`` is ``(column, load time)``, written on updated rows. ``target_rows`` and
    ``source_rows``, where the caller knows them, spare the search for hot keys in a
    side too small to have one.
    """
    if mode not in MODES:
        raise ValueError(f"unknown merge mode {mode!r}; use one of {MODES}")
    if mode in KEYED_MODES and not keys:
        raise ValueError(f"merge mode {mode!r} needs key columns")
    if on_conflict not in ("update", "ignore", "error"):
        raise ValueError(f"unknown on_conflict {on_conflict!r}")
    if on_duplicate not in ("last", "error"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    missing = [k for k in keys if k not in source.columns or k not in target.columns]
    if missing:
        raise ValueError(f"key columns {missing} are not in both source and target")

    given = [c for c in source.columns if c not in keys]
    source = _align(source, target)

    if on_conflict == "error" and keys:
        _raise_on_conflict(target, source, keys, target_unique)
    if mode in ("insert", "append-only"):
        added = _tag(source, "inserted")
        return _tag(target, "kept").unionByName(added) if with_kept else added
    if mode in ("delete-insert", "fresh-start"):
        doomed = F.lit(True)
        if mode == "delete-insert" and delete_condition:
            doomed = F.coalesce(F.expr(delete_condition), F.lit(False))
        marked = target.withColumns(
            {"_op": F.when(doomed, F.lit("deleted")).otherwise(F.lit("kept")), "_live": ~doomed}
        )
        return marked.unionByName(_tag(source, "inserted"))

    if update_columns is not None:
        unknown = [c for c in update_columns if c not in given]
        if unknown:
            raise ValueError(f"update columns {unknown} are not in the source")
    if mode == "upsert" and on_conflict == "ignore":
        mode = "insert-ignore"

    t_rows, t_null = _split_null_keys(target, keys)
    s_rows, s_null = _split_null_keys(source, keys)
    repeats = mode == "skip-existing" and dedupe is None and not source_unique
    counts = None if source_unique else key_counts(s_rows, keys)
    s_keys = s_rows.select(*keys) if source_unique else counts.select(*keys)
    if not source_unique:
        s_rows = _one_source_row(s_rows, mode, keys, on_duplicate, order_by, dedupe)
    found = existing_keys(t_rows, s_keys, keys, target_unique, broadcast_source)

    if mode in ("insert-ignore", "skip-existing"):
        # Partitioned by key already, so this shuffles nothing; a repeated key would count a source row twice.
        found = found.distinct()
        parts = [_tag(target, "kept")] if with_kept else []

        if repeats and not broadcast_source and not _small(source_rows, hot_rows):
            parts.append(join_split(s_rows, keys, counts, found, _new_or_skipped, hot_rows))
        else:
            parts.append(_new_or_skipped(s_rows, found, keys))
    else:
        touched = list(given if update_columns is None else update_columns)

        def match(rows: DataFrame, news: DataFrame, on: Sequence[str]) -> DataFrame:
            return _matched(rows, news, on, touched, condition, delete_missing, stamp, broadcast_source)

        if (target_unique or _small(target_rows, hot_rows)) and not broadcast_source:
            parts = [_matched(t_rows, s_rows, keys, touched, condition, delete_missing, stamp, False, mode)]
        else:
            if broadcast_source:
                parts = [match(t_rows, s_rows, keys)]
            else:
                parts = [join_split(t_rows, keys, key_counts(t_rows, keys), s_rows, match, hot_rows)]
            parts.append(_new_rows(s_rows.join(found, list(keys), "left_anti"), mode))
        if t_null is not None:
            parts.append(_tag(t_null, "deleted", live=False) if delete_missing else _tag(t_null, "kept"))
    if s_null is not None:
        parts.append(_new_rows(s_null, mode))
    return reduce(DataFrame.unionByName, parts)


def _small(n_rows: int | None, hot_rows: int) -> bool:
    """Whether a side is known to hold too few rows for a hot key."""
    return n_rows is not None and n_rows <= hot_rows


def _new_or_skipped(s_rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows, told apart by whether the target holds their key, in one join."""
    flagged = s_rows.join(found.withColumn("__held", F.lit(True)), list(keys), "left")
    new = F.col("__held").isNull()
    op = F.when(new, F.lit("inserted")).otherwise(F.lit("skipped"))
    return flagged.select(*s_rows.columns, op.alias("_op"), new.alias("_live"))


def _new_rows(df: DataFrame, mode: str) -> DataFrame:
    """Source rows without a match: an update passes them over, every other mode inserts them."""
    return _tag(df, "skipped", live=False) if mode == "update" else _tag(df, "inserted")


def _one_source_row(s_rows, mode, keys, on_duplicate, order_by, dedupe):
    if mode == "skip-existing":
        return keep_first(s_rows, keys, order_by) if dedupe == "first" else s_rows
    if on_duplicate == "error":
        twice = duplicate_keys(s_rows, keys).take(1)
        if twice:
            raise MergeConflict(f"the source repeats key {twice[0].asDict()}")
        return s_rows
    order = list(order_by) or [c for c in s_rows.columns if c not in keys][:1] or list(keys)[:1]
    return keep_first(s_rows, keys, order) if mode == "insert-ignore" else keep_last(s_rows, keys, order)


def _raise_on_conflict(target, source, keys, target_unique):
    source_keys = source.select(*keys).dropna().distinct()
    clash = existing_keys(target, source_keys, keys, target_unique).take(1)
    if clash:
        raise MergeConflict(f"the target already holds key {clash[0].asDict()}")


def _matched(t_rows, s_rows, keys, touched, condition, delete_missing, stamp, broadcast_source, new_mode=None):
    """Every target row that has a key, with the source row of that key if there is one.

    Whether a row matched is decided by a flag, never by a source value being
    NULL: a NULL in the source overwrites. With ``new_mode`` the source rows
    without a target row come out of the same join, as that mode treats them.
    """
    t = t_rows.withColumn("__held", F.lit(True)).alias("t")
    s = _hint(s_rows.withColumn("__hit", F.lit(True)), broadcast_source).alias("s")
    on = [F.col(f"t.`{k}`") == F.col(f"s.`{k}`") for k in keys]
    joined = t.join(s, on, "full" if new_mode else "left")
    hit = F.col("s.__hit").isNotNull()
    new = F.col("t.__held").isNull()
    change = hit if condition is None else hit & F.coalesce(F.expr(condition), F.lit(False))
    if not touched:
        change = F.lit(False)
    columns = []
    for name in t_rows.columns:
        value = F.col(f"t.`{name}`")
        if name in touched:
            value = F.when(change, F.col(f"s.`{name}`")).otherwise(value)
        if stamp and name == stamp[0]:
            at = F.lit(stamp[1]).cast(t_rows.schema[name].dataType)
            value = F.when(change, at).otherwise(F.col(f"t.`{name}`"))
        if new_mode:
            value = F.when(new, F.col(f"s.`{name}`")).otherwise(value)
        columns.append(value.alias(name))
    unmatched = "deleted" if delete_missing else "kept"
    op = F.when(change, F.lit("updated")).when(hit, F.lit("skipped")).otherwise(F.lit(unmatched))
    live = hit if delete_missing else F.lit(True)
    if new_mode:
        passed = new_mode == "update"
        op = F.when(new, F.lit("skipped" if passed else "inserted")).otherwise(op)
        live = F.when(new, F.lit(not passed)).otherwise(live)
    return joined.select(*columns, op.alias("_op"), live.alias("_live"))


def live_rows(changes: DataFrame) -> DataFrame:
    """The new target."""
    return changes.where("_live").drop("_op", "_live")


def merge(target: DataFrame, source: DataFrame, mode: str, keys: Sequence[str] = (), **options) -> DataFrame:
    """The new target after one merge; options as in ``merge_changes``."""
    return live_rows(merge_changes(target, source, mode, keys, **options))


def _op_counts():
    return [F.count_if(F.col("_op") == op).alias(op) for op in OPS]


def merge_stats(changes: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """One row of counts; with the source also ``read`` and ``superseded`` (duplicates that lost).

    Source rows are counted in the same aggregate, so no second pass joins the two.
    """
    if source is None:
        return changes.agg(*_op_counts())
    tagged = changes.select("_op").unionAll(source.select(F.lit("read").alias("_op")))
    counts = tagged.agg(*_op_counts(), F.count_if(F.col("_op") == "read").alias("read"))
    # A kept-but-matched target row and a passed-over source row are both one source row.
    lost = F.col("read") - F.col("inserted") - F.col("updated") - F.col("skipped")
    return counts.withColumn("superseded", lost)


def observed(changes: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The change set with counters that fill while it is written: no extra pass for the report.

    The counters sit after the last shuffle, so a retried map task cannot count twice.
    """
    observation = Observation(name)
    return changes.observe(observation, *_op_counts(), F.count_if("_live").alias("live")), observation


def merge_into_table(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    mode: str = "upsert",
    update_columns: Sequence[str] | None = None,
    condition: str | None = None,
    delete_missing: bool = False,
) -> None:
    """The same merge as a row-level command, for a catalog table whose format supports it.

    ``condition`` names the target by its table name and the source by ``s``. The
    source must hold one row per key (see ``keep_last``).
    """
    target = table.split(".")[-1]
    on = reduce(lambda a, b: a & b, [F.col(f"{target}.`{k}`") == F.col(f"s.`{k}`") for k in keys])
    writer = source.alias("s").mergeInto(table, on)
    touched = [c for c in (update_columns or source.columns) if c not in keys]
    if mode in ("upsert", "update", "sync") and touched:
        matched = writer.whenMatched(F.expr(condition)) if condition else writer.whenMatched()
        writer = matched.update({c: F.col(f"s.`{c}`") for c in touched})
    if mode in ("upsert", "sync", "insert-ignore", "skip-existing"):
        writer = writer.whenNotMatched().insert({c: F.col(f"s.`{c}`") for c in source.columns})
    if delete_missing:
        writer = writer.whenNotMatchedBySource().delete()
    writer.merge()
