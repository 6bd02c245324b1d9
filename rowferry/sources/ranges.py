"""Split a table into key ranges that are read in parallel."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The row counts from which offset and cursor paging are advised.
OFFSET_FROM_ROWS = 100_000
CURSOR_FROM_ROWS = 1_000_000


def choose_strategy(n_rows: int, indexed: bool = False) -> str:
    """Paging advised for a table of this size."""
    if n_rows > CURSOR_FROM_ROWS and indexed:
        return "cursor"
    return "offset" if n_rows > OFFSET_FROM_ROWS else "rownum"


def choose_partitions(n_rows: int, rows_per_range: int = CURSOR_FROM_ROWS) -> int:
    """How many ranges to read a table of this size in."""
    return max(1, ceil(n_rows / rows_per_range))


@dataclass(frozen=True)
class KeyRanges:
    """Disjoint ranges of an integer key; the first also takes NULL, the ends are open."""

    column: str
    cuts: tuple[int, ...]

    def predicates(self) -> list[str]:
        """One SQL condition per range, as ``spark.read.jdbc(predicates=...)`` takes them."""
        col, cuts = self.column, self.cuts
        if not cuts:
            return ["1 = 1"]
        first = f"{col} < {cuts[0]} OR {col} IS NULL"
        middle = [f"{col} >= {a} AND {col} < {b}" for a, b in zip(cuts, cuts[1:])]
        return [first, *middle, f"{col} >= {cuts[-1]}"]

    def slice_of(self) -> Column:
        """The number of the range a row falls in, from 0."""
        return _position(F.col(self.column), self.cuts, 0)


def _position(key: Column, cuts: tuple[int, ...], before: int) -> Column:
    """How many cuts are at or below the key, by halving: the depth grows with the logarithm of the cuts."""
    if not cuts:
        return F.lit(before)
    mid = len(cuts) // 2
    above = _position(key, cuts[mid + 1 :], before + mid + 1)
    return F.when(key >= cuts[mid], above).otherwise(_position(key, cuts[:mid], before))


def even_ranges(df: DataFrame, column: str, n: int) -> KeyRanges:
    """Ranges of equal width between the smallest and the largest key."""
    low, high = df.agg(F.min(column).cast("bigint"), F.max(column).cast("bigint")).first()
    if low is None or n < 2:
        return KeyRanges(column, ())
    cuts = [low + i * (high - low) // n for i in range(1, n)]
    return KeyRanges(column, tuple(sorted(set(c for c in cuts if c > low))))


def quantile_ranges(df: DataFrame, column: str, n: int, accuracy: float = 0.001) -> KeyRanges:
    """Ranges holding about equally many rows, for keys that are not spread evenly."""
    if n < 2:
        return KeyRanges(column, ())
    steps = [i / n for i in range(1, n)]
    cuts = df.approxQuantile(column, steps, accuracy)
    return KeyRanges(column, tuple(sorted({int(c) for c in cuts})))


def read_ranges(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """The table with the number of its range: ``_slice``."""
    return df.withColumn("_slice", ranges.slice_of())


def read_by_predicates(df: DataFrame, ranges: KeyRanges) -> DataFrame:
    """One pushed-down read per range, unioned: each row once, with the number of its range as ``_slice``.

    For a source that is asked range by range, as a database is; a Parquet folder
    is split by Spark itself and needs no ranges.
    """
    parts = [df.where(p).withColumn("_slice", F.lit(i)) for i, p in enumerate(ranges.predicates())]
    return reduce(DataFrame.unionAll, parts)
