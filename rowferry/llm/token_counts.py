"""Token counts from an exact length histogram.

Every document is encoded once; what leaves a task is one row for each length it met. The
histogram over all documents answers for every context limit: totals and quantiles from
sums up to a length, totals of documents cut at the limit from sums beyond it. Sums run
within blocks of ``SPAN`` lengths, and over the blocks, so no task sees more than a block
or the list of blocks.

Defined cases: null and empty texts have length 0; repeated rows count each; an empty
table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowferry.llm.bpe import ByteCoder, coder
from rowferry.llm.common import ship, written

SPAN = 1024


def _lengths(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, seen = coder(ByteCoder, path), Counter()
        c.lexicon = None
        for part in batches:
            seen.update(len(ids) // 4 for ids in c.encode(part.column(0).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["length", "n"])

    return run


def length_histogram(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """``length`` in tokens and ``n_docs``, exact over all documents."""
    ship(docs.sparkSession)
    lengths = docs.select(F.col(text_col).alias("text")).mapInArrow(_lengths(path), "length long, n long")
    return lengths.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limits(histogram: DataFrame) -> DataFrame:
    """For each length that occurs, taken as the context limit.

    ``n_longer`` documents are over it, ``quantile`` of all are not, ``total_tokens`` is
    what all documents hold, ``kept_tokens`` what is left of them when each is cut at the
    limit, ``lost_tokens`` the rest.
    """
    held = written(histogram.where("length is not null"), "length-histogram")
    block = held.withColumn("block", F.floor(F.col("length") / SPAN)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = block.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("b_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("b_tokens").over(after), F.lit(0)).alias("tokens_after"),
        F.sum("b_docs").over(everything).alias("all_docs"),
        F.sum("b_tokens").over(everything).alias("total_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    longer = F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    beyond = F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return (
        block.withColumn("longer", longer)
        .withColumn("beyond", beyond)
        .join(blocks, "block")
        .withColumn("n_longer", F.col("longer") + F.col("docs_after"))
        .withColumn("kept_tokens", F.col("total_tokens") - F.col("beyond") - F.col("tokens_after") + F.col("n_longer") * F.col("length"))
        .select(
            "length",
            "n_docs",
            "n_longer",
            ((F.col("all_docs") - F.col("n_longer")) / F.col("all_docs")).alias("quantile"),
            "total_tokens",
            "kept_tokens",
            (F.col("total_tokens") - F.col("kept_tokens")).alias("lost_tokens"),
        )
    )
