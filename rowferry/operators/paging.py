"""Pages of an ordered table, and row numbers for tables of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.session import work_path
from rowferry.sources.ranges import choose_partitions, choose_strategy

STRATEGIES = ("rownum", "offset", "cursor")

# A top-k keeps its rows in each task and then in one; what needs more is numbered over ranges.
TOP_ROWS = 100_000


def validate_paging(strategy: str, order_by: Sequence[str]) -> None:
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown paging strategy {strategy!r}; use one of {STRATEGIES}")
    if not order_by:
        raise ValueError("paging needs order columns: without them pages overlap")


def typed_literal(value: Any, dtype: T.DataType) -> Column:
    """A literal of exactly this type; timestamps go through text, so no session zone touches them."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)) and value is not None:
        value = str(value)
    return F.lit(value).cast(dtype)


def total_order(df: DataFrame, order_by: Sequence[str]) -> list[str]:
    """The order columns, then all others that can be ordered: only equal rows tie, and those are interchangeable."""
    rest = [f.name for f in df.schema.fields if f.name not in order_by and isinstance(f.dataType, T.AtomicType)]
    return [*order_by, *rest]


def _equals(df: DataFrame, name: str, value: Any) -> Column:
    return F.col(name).isNull() if value is None else F.col(name) == typed_literal(value, df.schema[name].dataType)


def _exceeds(df: DataFrame, name: str, value: Any) -> Column:
    """NULLs come first."""
    return F.col(name).isNotNull() if value is None else F.col(name) > typed_literal(value, df.schema[name].dataType)


def after_key(df: DataFrame, order_by: Sequence[str], last: Sequence[Any]) -> Column:
    """``order_by > last`` column by column, in a form that reaches the scan as a pushed filter."""
    clauses = []
    for i, name in enumerate(order_by):
        equal = [_equals(df, c, v) for c, v in zip(order_by[:i], last[:i])]
        clauses.append(reduce(lambda a, b: a & b, [*equal, _exceeds(df, name, last[i])]))
    return reduce(lambda a, b: a | b, clauses)


def page_keyset(
    df: DataFrame, order_by: Sequence[str], size: int, last: Sequence[Any] | None = None
) -> DataFrame:
    """The next page after key ``last``; the cost does not grow with the page's depth.

    Where the order columns repeat, ``last`` must hold the values of ``total_order``
    (``last_key(page, total_order(df, order_by))``): after the order columns alone
    the rest of a repeated key would be passed over.
    """
    validate_paging("cursor", order_by)
    order = total_order(df, order_by)
    if last is not None:
        if any(v is None for v in last[: len(order_by)]):
            raise ValueError("a page key cannot hold NULL")
        df = df.where(after_key(df, order[: len(last)], last))
    return page_offset(df, order_by, 0, size)


def page_offset(df: DataFrame, order_by: Sequence[str], offset: int, size: int) -> DataFrame:
    """Rows after the first ``offset``, by a top-k of ``offset + size`` rows, or by their numbers where these are too many for a task.

    Each deep page numbers the rows anew, so a deep crawl should do so once
    (``page_rownum``) or page by key.
    """
    validate_paging("offset", order_by)
    if offset + size > TOP_ROWS:
        # a frame that carries numbers of its own keeps them
        renamed = df.withColumnRenamed("_rn", "__rn")
        return page_rownum(renamed, ["__rn" if c == "_rn" else c for c in order_by], offset, size).withColumnRenamed("__rn", "_rn")
    return df.orderBy(*total_order(df, order_by)).offset(offset).limit(size)


def place_rows(
    df: DataFrame, order_by: Sequence[str], partitions: int | None = None, unique_order: bool = True
) -> DataFrame:
    """The rows range-partitioned in order and written once, with their partition and place in it.

    The number of ranges follows from the number of rows. ``unique_order=False``
    adds the remaining columns to the order, so that a key many rows share is
    split over partitions as well.
    """
    spark = df.sparkSession
    n = partitions or choose_partitions(df.count())
    order = [F.col(c).asc() for c in (order_by if unique_order else total_order(df, order_by))]
    place = F.monotonically_increasing_id()
    placed = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumns({"__part": F.shiftright(place, 33), "__place": place.bitwiseAND(F.lit((1 << 33) - 1))})
    )
    path = work_path(spark, "numbered")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def number_rows(
    df: DataFrame, order_by: Sequence[str], partitions: int | None = None, unique_order: bool = True
) -> DataFrame:
    """Every row with its number ``_rn`` (from 1) in the order given, without one task sorting the table.

    The rows are placed once (see ``place_rows``); one small aggregate then gives
    each partition's first number.
    """
    validate_paging("rownum", order_by)
    written = place_rows(df, order_by, partitions, unique_order)
    sizes = written.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    # One row per range partition: its size is bounded by `partitions`, whatever the table holds.
    return written.join(F.broadcast(firsts), "__part").select(
        *df.columns, (F.col("__first") + F.col("__place") + 1).alias("_rn")
    )


def page_rownum(
    df: DataFrame, order_by: Sequence[str], offset: int, size: int, unique_order: bool = False
) -> DataFrame:
    """The rows numbered ``offset + 1`` to ``offset + size`` in their order; the number itself is dropped.

    The same at every depth, and no task sorts more than its range; a large page is
    sorted over ranges, a small one by a top-k. Numbering writes the table once: a
    caller who wants many pages calls ``number_rows`` and gives its result, with
    ``_rn``, as ``df``.
    """
    validate_paging("rownum", order_by)
    numbered = df if "_rn" in df.columns else number_rows(df, order_by, unique_order=unique_order)
    rows = numbered.where(F.col("_rn").between(offset + 1, offset + size)).orderBy("_rn")
    return (rows.limit(size) if size <= TOP_ROWS else rows).drop("_rn")


def page(
    df: DataFrame,
    strategy: str,
    order_by: Sequence[str],
    size: int,
    offset: int = 0,
    last: Sequence[Any] | None = None,
    indexed: bool = False,
) -> DataFrame:
    """A page by the strategy named, or for ``"auto"`` by the one advised for the table's rows.

    ``indexed`` says that the order is that of the files, so that a key predicate prunes
    the scan. A page key that is given stands for the cursor: an offset cannot follow it.
    """
    if strategy == "auto":
        strategy = "cursor" if last is not None else choose_strategy(df.count(), indexed and not offset)
    validate_paging(strategy, order_by)
    if strategy == "cursor":
        return page_keyset(df, order_by, size, last)
    if strategy == "offset":
        return page_offset(df, order_by, offset, size)
    return page_rownum(df, order_by, offset, size)


def last_key(page_df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """One row with the key of the page's last row; all NULL for an empty page."""
    top = page_df.agg(F.max(F.struct(*order_by)).alias("k"))
    return top.select(*[F.col(f"k.{c}").alias(c) for c in order_by])


def page_meta(df: DataFrame, order_by: Sequence[str], size: int, last: Sequence[Any] | None = None) -> DataFrame:
    """One row: rows in the page, its last key, and whether a further row follows."""
    peek = page_keyset(df, order_by, size + 1, last).select(*order_by)
    numbered = peek.withColumn("__rn", F.row_number().over(Window.orderBy(*order_by)))
    inside = F.when(F.col("__rn") <= size, F.struct(*order_by))
    return numbered.agg(
        F.count_if(F.col("__rn") <= size).alias("n_rows"),
        F.max(inside).alias("k"),
        (F.count("*") > size).alias("has_more"),
    ).select("n_rows", *[F.col(f"k.{c}").alias(f"last_{c}") for c in order_by], "has_more")


def page_cover(df: DataFrame, order_by: Sequence[str], size: int, unique_order: bool = True) -> DataFrame:
    """Do the pages hold every row exactly once? Pages, full pages, rows, repeated and missing keys.

    ``unique_order=False`` splits a repeated key by a hash of the whole row.
    """
    keyed, order = df.select(*order_by), list(order_by)
    if not unique_order:
        whole = F.xxhash64(*[F.col(c) for c in total_order(df, order_by)])
        keyed, order = df.select(*order_by, whole.alias("__tie")), [*order_by, "__tie"]
    numbered = number_rows(keyed, order)
    paged = numbered.withColumn("__page", F.call_function("div", F.col("_rn") - 1, F.lit(size)))
    by_page = paged.groupBy("__page").agg(F.count("*").alias("n"))
    pages = by_page.agg(
        F.count("*").alias("n_pages"),
        F.count_if(F.col("n") == size).alias("full_pages"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_pages"),
    )
    tagged = df.select(*order_by, F.lit(1).alias("__all"), F.lit(0).alias("__paged")).unionAll(
        paged.select(*order_by, F.lit(0), F.lit(1))
    )
    per_key = tagged.groupBy(*order_by).agg(F.sum("__all").alias("a"), F.sum("__paged").alias("p"))
    keys = per_key.agg(
        F.count_if(F.col("p") > F.col("a")).alias("repeated_keys"),
        F.count_if(F.col("p") < F.col("a")).alias("missing_keys"),
    )
    one = F.lit(1).alias("__one")
    return pages.select("*", one).join(keys.select("*", one), "__one").drop("__one")
