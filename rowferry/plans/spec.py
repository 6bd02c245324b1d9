"""Declared loads: what is read, how it is cleaned, where it goes and by which rule."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import groupby
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rowferry.operators.lookup import ForeignKey, LookupSpec
from rowferry.operators.merge import ADDING_MODES, KEYED_MODES, MODES
from rowferry.plans.keyed import KeyedFiles

Source = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class TableLoad:
    """One table to load. A lower priority number loads earlier.

    ``options`` are those of ``merge_changes``. ``lookup`` says how later loads find
    this table's ids by code; ``foreign_keys`` name the tables they look up.
    ``stage`` writes the cleaned source once before merging, for sources that
    should be read only once. ``files`` lays the table down in keyed files, so that a
    merge rewrites only what it touches. ``keep_changes`` keeps the rows each run
    changed, for loads that take only those (see ``changed_since``).
    """

    table_id: str
    source: Source
    keys: tuple[str, ...]
    schema: T.StructType
    transform: Callable[[DataFrame], DataFrame] | None = None
    mode: str = "skip-existing"
    priority: int = 1
    depends_on: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    lookup: LookupSpec | None = None
    options: Mapping[str, Any] = field(default_factory=dict)
    stage: bool = False
    files: KeyedFiles | None = None
    keep_changes: bool = False
    description: str = ""

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"{self.table_id}: unknown mode {self.mode!r}; use one of {MODES}")
        if self.mode in KEYED_MODES and not self.keys:
            raise ValueError(f"{self.table_id}: mode {self.mode!r} needs keys")
        missing = [k for k in self.keys if k not in self.schema.names]
        if missing:
            raise ValueError(f"{self.table_id}: keys {missing} are not in the target schema")
        if self.files:
            outside = [c for c in self.files.partition_by if c not in self.keys]
            if outside or not self.keys:
                raise ValueError(f"{self.table_id}: keyed files need keys, and partition columns {outside} must be among them")
        if self.keep_changes and not self.files and self.mode not in ADDING_MODES:
            raise ValueError(f"{self.table_id}: mode {self.mode!r} can keep its changes only in keyed files")

    @property
    def needs(self) -> set[str]:
        return set(self.depends_on) | {fk.table for fk in self.foreign_keys}


def check_plan(loads: Sequence[TableLoad]) -> None:
    """Every table a load needs must come from a load of a lower priority number, with a lookup if looked up."""
    by_id = {load.table_id: load for load in loads}
    if len(by_id) != len(loads):
        raise ValueError("two loads have the same table_id")
    for load in loads:
        for name in sorted(load.needs):
            if name not in by_id:
                raise ValueError(f"{load.table_id} needs {name}, which no load provides")
            if by_id[name].priority >= load.priority:
                raise ValueError(f"{load.table_id} needs {name}, which does not load before it")
        for fk in load.foreign_keys:
            if by_id[fk.table].lookup is None:
                raise ValueError(f"{load.table_id} looks up {fk.table}, which declares no lookup")


def priority_groups(loads: Sequence[TableLoad]) -> list[tuple[int, list[TableLoad]]]:
    ordered = sorted(loads, key=lambda load: load.priority)
    return [(p, list(group)) for p, group in groupby(ordered, key=lambda load: load.priority)]


def tables_with_foreign_keys(loads: Sequence[TableLoad]) -> list[str]:
    return [load.table_id for load in loads if load.foreign_keys]
