"""Pages by row number from ordered files and a sparse index of fences.

The table is laid down once in order, as files of a million rows each. A fence says
for each file how many rows stand before it, how many it holds, and its least and greatest
key. A page of any depth finds its files among the fences and reads only these: one file,
or two where the page crosses a border. Rows above the greatest key are appended as files
of their own, with fences that go on counting.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.paging import total_order, validate_paging
from rowferry.session import work_path
from rowferry.sources.ranges import choose_partitions


@dataclass(frozen=True)
class RankIndex:
    """``folder`` holds the ordered rows, ``fences`` the index; ``order`` is a total order of the rows."""

    schema: T.StructType
    order: tuple[str, ...]
    folder: str
    fences: str
    n_rows: int

    def read_fences(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.fences)


RANGE_ROWS = 250_000


def _lay_down(df: DataFrame, order: Sequence[str], n_rows: int, rows_per_file: int, folder: str) -> DataFrame:
    """The rows in order, in files of ``rows_per_file``; gives a row for each file: rows, least and greatest key.

    A range holds many small files: the driver draws the borders of ranges from a sample of
    keys that grows with their number.
    """
    spark, part = df.sparkSession, f"{folder}/part-{uuid.uuid4().hex}"
    ranges = choose_partitions(n_rows, max(rows_per_file, RANGE_ROWS))
    df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).write.option("maxRecordsPerFile", rows_per_file).parquet(part)
    laid = spark.read.schema(df.schema).parquet(part)
    # the folder and name of the file, without the encoding of its whole address
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    key = F.struct(*order)
    files = laid.select(*order, name.alias("name")).groupBy("name").agg(
        F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    return files.select(F.concat(F.lit(f"{part}/"), F.url_decode("name")).alias("file"), "n", "low", "high")


def _counted(files: DataFrame, before: int) -> DataFrame:
    """Fences in order of their keys; there is one row for each file, which bounds the window."""
    earlier = Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.lit(before))


def build_rank_index(df: DataFrame, order_by: Sequence[str], rows_per_file: int = 1_000_000) -> RankIndex:
    """Lay the table down in its order, ties broken by the remaining columns, with an index of its files."""
    validate_paging("rownum", order_by)
    spark, order = df.sparkSession, tuple(total_order(df, order_by))
    folder = work_path(spark, "ranked")
    n = df.count()
    fences = _counted(_lay_down(df, order, n, rows_per_file, f"{folder}/rows"), 0)
    fences.write.parquet(f"{folder}/fences-0")
    return RankIndex(df.schema, order, f"{folder}/rows", f"{folder}/fences-0", n)


def append_rows(index: RankIndex, df: DataFrame, rows_per_file: int = 1_000_000) -> RankIndex:
    """The index with more rows, all of them above what it holds; the files it has stay as they are."""
    spark, order, n = df.sparkSession, index.order, df.count()
    if not n:
        return index
    fences = index.read_fences(spark)
    top, least = fences.agg(F.max("high").alias("k")), df.agg(F.min(F.struct(*order)).alias("k"))
    below = top.select(F.col("k").alias("top"), F.lit(1).alias("one")).join(least.select(F.col("k").alias("least"), F.lit(1).alias("one")), "one")
    if below.where(F.col("least") < F.col("top")).take(1):
        raise ValueError("rows to append must come after those of the index")
    more = _counted(_lay_down(df, order, n, rows_per_file, index.folder), index.n_rows)
    path = f"{index.folder.removesuffix('/rows')}/fences-{uuid.uuid4().hex}"
    fences.unionByName(more).write.parquet(path)
    return RankIndex(index.schema, order, index.folder, path, index.n_rows + n)


def page_files(spark: SparkSession, index: RankIndex, offset: int, size: int) -> list[tuple[str, int]]:
    """The files that hold rows ``offset + 1`` to ``offset + size``, in order, with the rows before each."""
    near = index.read_fences(spark).where((F.col("before") < offset + size) & (F.col("before") + F.col("n") > offset) & (F.col("n") > 0))
    return [(r["file"], r["before"]) for r in near.select("file", "before").orderBy("before").collect()]


def page_by_rank(spark: SparkSession, index: RankIndex, offset: int, size: int) -> DataFrame:
    """Rows ``offset + 1`` to ``offset + size`` in order, from the files that hold them."""
    files = page_files(spark, index, offset, size) if size > 0 else []
    if not files:
        return spark.createDataFrame([], index.schema)
    rows = spark.read.schema(index.schema).parquet(*(f for f, _ in files))
    return rows.orderBy(*index.order).offset(offset - files[0][1]).limit(size)
