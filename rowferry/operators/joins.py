"""Joins to dimension tables, some of which may be absent, and key membership."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators.skew import HOT_ROWS, join_split, key_counts


@dataclass(frozen=True)
class Dimension:
    """Left join ``on`` (``{column so far: dimension column}``) and take ``take`` (``{dimension column: name}``).

    ``table`` may be None: the taken columns are then NULL of the type named in ``types`` (text by default).
    """

    table: DataFrame | None
    on: Mapping[str, str]
    take: Mapping[str, str]
    types: Mapping[str, str] = field(default_factory=dict)


def join_dimensions(df: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Chain of left equi-joins. A later dimension may join on a column an earlier one brought in."""
    for number, dim in enumerate(dimensions):
        if dim.table is None:
            nulls = {name: F.lit(None).cast(dim.types.get(col, "string")) for col, name in dim.take.items()}
            df = df.withColumns(nulls)
            continue
        renamed = {right: f"__d{number}_{right}" for right in dim.on.values()}
        right = dim.table.select(
            *[F.col(old).alias(new) for old, new in renamed.items()],
            *[F.col(old).alias(new) for old, new in dim.take.items()],
        )
        condition = [F.col(left) == F.col(renamed[r]) for left, r in dim.on.items()]
        df = df.join(right, condition, "left").drop(*renamed.values())
    return df


def rows_with_match(
    df: DataFrame, other: DataFrame, keys: Sequence[str], unique: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose key is in ``other``. A hot key costs one row per task in ``other``; its rows in ``df`` are salted.

    ``unique`` declares that ``df`` has one row per key, which saves counting them.
    """
    return _by_match(df, other, keys, "left_semi", unique, hot_rows)


def rows_without_match(
    df: DataFrame, other: DataFrame, keys: Sequence[str], unique: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows whose key is not in ``other``; a NULL key never matches, so it stays."""
    return _by_match(df, other, keys, "left_anti", unique, hot_rows)


def _by_match(df, other, keys, how, unique, hot_rows):
    held = other.select(*keys).distinct()

    def join(rows: DataFrame, keys_held: DataFrame, on: Sequence[str]) -> DataFrame:
        return rows.join(keys_held, list(on), how).select(*df.columns)

    if unique:
        return join(df, held, keys)
    return join_split(df, keys, key_counts(df, keys), held, join, hot_rows)
