"""Keys that hold so many rows that one task should not get them all.

AQE splits a skewed join partition only where both sides of the join come straight
from a shuffle. Where one side is an aggregate or another join, the rows of hot
keys are taken out and salted: the other side's one row per hot key is repeated for
every salt, and both shuffle on key and salt.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is hot. A table of n rows has at most n / HOT_ROWS
# hot keys, which bounds what is broadcast for them: their keys, never whole rows.
HOT_ROWS = 5_000_000
SALTS = 64


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once, with its rows; counted on the map side first, so a hot key travels as one row per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("__n"))


def join_split(
    df: DataFrame,
    keys: Sequence[str],
    counts: DataFrame,
    other: DataFrame,
    join: Callable[[DataFrame, DataFrame, Sequence[str]], DataFrame],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """``join(df, other, keys)`` with the hot keys of ``df`` apart; ``other`` holds one row per key.

    A row's salt is the task that read it, so exact copies spread as well and a
    task run again deals its rows the same way. Without hot keys AQE finds their
    set empty and drops the second branch.
    """
    hot = F.broadcast(counts.where(F.col("__n") > hot_rows).select(*keys))
    cold_rows = df.join(hot, list(keys), "left_anti").select(*df.columns)
    salted = df.join(hot, list(keys), "left_semi").select(
        *df.columns, F.pmod(F.spark_partition_id(), F.lit(salts)).alias("__salt")
    )
    repeated = other.join(hot, list(keys), "left_semi").select(
        *other.columns, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt")
    )
    taken_out = join(salted, repeated, [*keys, "__salt"]).drop("__salt")
    return join(cold_rows, other, list(keys)).unionByName(taken_out)
