"""First or last row per key, safe against a key that holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _can_order(dtype: T.DataType) -> bool:
    text = dtype.simpleString()
    return "map<" not in text and "variant" not in text


def _one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], last: bool) -> DataFrame:
    if not order_by:
        raise ValueError("order_by is required: which duplicate wins must be declared")
    rest = [f.name for f in df.schema.fields if f.name not in (*keys, *order_by) and _can_order(f.dataType)]
    order = [F.col(f"`{c}`") for c in [*order_by, *rest]]
    window = Window.partitionBy(*keys).orderBy(*[o.desc() if last else o.asc() for o in order])
    # A filter on row_number = 1 makes Spark keep one row per key and task before the
    # shuffle (WindowGroupLimit), so a hot key never travels whole.
    return df.withColumn("__rn", F.row_number().over(window)).where("__rn = 1").drop("__rn")


def keep_last(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row per key by ``order_by``; ties fall to the remaining columns, so the pick is repeatable."""
    return _one_per_key(df, keys, order_by, last=True)


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, order_by, last=False)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts; NULL keys do not count as equal."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    )
