"""Tables in keyed files: a merge rewrites only the files that hold one of its keys.

A row lies in a *cell*: a hash bucket of its key, inside its partition where the table has
partition columns (these must be key columns, so a key stays in one cell). What a run wrote
into a cell is an *entry*, a folder with one or more files. The manifest lists the entries
that hold the table now, each with its rows, its least and greatest key and the size of its
Bloom filter; the filters lie beside the data, a row for each 32,768 bits.

A merge asks which entries may hold keys of its source: those of the same cells, whose range
holds the key, and whose filter holds its bits. Only these are read. Modes that change rows
write them anew together with the new rows; modes that add rows leave them and add an entry.
A cell with more than ``most_entries`` is written anew as one. All other entries go over into
the next manifest as they are.

The progress row that names the manifest is the commit. A run that dies before it leaves
the table as it was; its folder has a name of its own that nobody reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.plans.progress import empty_frame

CELL = "rowferry_cell"
NO_KEY = "none"
BLOCK_BITS = 1 << 15  # what bitmap_construct_agg fills
POSITIONS = 4


@dataclass(frozen=True)
class KeyedFiles:
    """How a table is laid out. ``buckets`` stays what it was when the table was first written."""

    buckets: int
    partition_by: tuple[str, ...] = ()
    most_entries: int = 8
    bits_per_key: int = 10

    def __post_init__(self):
        if self.buckets < 1 or self.most_entries < 1 or self.bits_per_key < 1:
            raise ValueError("buckets, most_entries and bits_per_key must be 1 or more")

    def cell(self, keys: Sequence[str]) -> Column:
        """The cell of a row; rows without a whole key match nothing and lie apart."""
        bucket = F.concat(F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("string"), F.lit(f"of{self.buckets}"))
        if self.partition_by:
            shown = F.concat_ws("-", *(F.col(c).cast("string") for c in self.partition_by))
            plain = F.regexp_replace(F.substring(shown, 1, 60), "[^A-Za-z0-9.-]", "_")
            bucket = F.concat_ws("-", plain, F.lower(F.hex(F.xxhash64(*self.partition_by))), bucket)
        missing = F.lit(False)
        for key in keys:
            missing = missing | F.col(key).isNull()
        return F.when(missing, F.lit(NO_KEY)).otherwise(bucket)


def manifest_schema(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    key = T.StructType([T.StructField(k, schema[k].dataType) for k in keys])
    return T.StructType(
        [
            T.StructField(CELL, T.StringType()),
            T.StructField("entry", T.StringType()),
            T.StructField("n_rows", T.LongType()),
            T.StructField("blocks", T.LongType()),
            T.StructField("low", key),
            T.StructField("high", key),
        ]
    )


def read_manifest(spark: SparkSession, schema: T.StructType, keys: Sequence[str], manifest: str | None) -> DataFrame:
    listed = manifest_schema(schema, keys)
    return spark.read.schema(listed).parquet(manifest) if manifest else empty_frame(spark, listed)


def entry_rows(spark: SparkSession, schema: T.StructType, entries: Sequence[tuple[str, str]]) -> DataFrame:
    """The rows of entries ``(cell, run folder)``; their number is that of cells and files, never of rows."""
    folders = sorted(f"{run}/data/{CELL}={cell}" for cell, run in entries)
    return spark.read.schema(schema).parquet(*folders) if folders else empty_frame(spark, schema)


def entries_of(manifest: DataFrame) -> list[tuple[str, str]]:
    return [tuple(r) for r in manifest.select(CELL, "entry").collect()]


def read_keyed(spark: SparkSession, schema: T.StructType, manifest: str) -> DataFrame:
    """All rows of a table."""
    return entry_rows(spark, schema, entries_of(spark.read.schema(f"{CELL} string, entry string").parquet(manifest)))


def _key_bits(keys: Sequence[str], blocks: Column) -> list[Column]:
    """The block of a key's bits, and their positions in it."""
    h = F.xxhash64(F.lit(1), *keys)
    places = [F.shiftright(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(POSITIONS)]
    return [F.pmod(F.xxhash64(F.lit(2), *keys), blocks).alias("block"), F.array(*places).alias("places")]


def write_entries(spark: SparkSession, rows: DataFrame, files: KeyedFiles, keys: Sequence[str], run: str) -> DataFrame:
    """Lay rows down by cell, with their filters; gives their manifest rows."""
    schema = rows.schema
    rows.withColumn(CELL, files.cell(keys)).hint("rebalance", F.col(CELL)).write.partitionBy(CELL).parquet(f"{run}/data")
    kept = T.StructType([*(schema[k] for k in keys), T.StructField(CELL, T.StringType())])
    laid = spark.read.schema(kept).parquet(f"{run}/data")
    key = F.struct(*keys)
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") * files.bits_per_key / BLOCK_BITS))
    entries = laid.groupBy(CELL).agg(
        F.count("*").alias("n_rows"), blocks.cast("long").alias("blocks"), F.min(key).alias("low"), F.max(key).alias("high")
    )
    entries.select(CELL, F.lit(run).alias("entry"), "n_rows", "blocks", "low", "high").write.parquet(f"{run}/entries")
    entries = read_manifest(spark, schema, keys, f"{run}/entries")
    keyed = laid.where(F.col(CELL) != NO_KEY).join(entries.select(CELL, "blocks"), CELL)
    placed = keyed.select(CELL, *_key_bits(keys, F.col("blocks"))).select(CELL, "block", F.explode("places").alias("place"))
    bits = placed.groupBy(CELL, "block").agg(F.bitmap_construct_agg("place").alias("bits"))
    bits.withColumn("entry", F.lit(run)).write.partitionBy(CELL).parquet(f"{run}/filter")
    return entries


def entries_that_may_hold(spark: SparkSession, manifest: DataFrame, source_keys: DataFrame, files: KeyedFiles, keys: Sequence[str]) -> list[tuple[str, str]]:
    """Entries that may hold one of the keys; one that does hold one is never left out."""
    key = F.struct(*keys)
    asked = source_keys.select(*keys).withColumn(CELL, files.cell(keys)).where(F.col(CELL) != NO_KEY)
    near = asked.join(manifest, CELL).where((key >= F.col("low")) & (key <= F.col("high")))
    near = near.select(CELL, "entry", *_key_bits(keys, F.col("blocks")))
    in_range = entries_of(near.select(CELL, "entry").distinct())
    if not in_range:
        return []
    schema = "block long, bits binary, entry string"
    folders = sorted(f"{run}/filter/{CELL}={cell}" for cell, run in in_range)
    cell_of_file = F.regexp_extract(F.input_file_name(), f"{CELL}=([^/]+)/", 1)
    bits = spark.read.schema(schema).parquet(*folders).withColumn(CELL, cell_of_file)
    held = F.expr("forall(places, p -> (shiftright(CAST(conv(hex(substring(bits, shiftright(p, 3) + 1, 1)), 16, 10) AS INT), p % 8) & 1) = 1)")
    return entries_of(near.join(bits, [CELL, "entry", "block"]).where(held).select(CELL, "entry").distinct())


def other_buckets(manifest: DataFrame, files: KeyedFiles) -> bool:
    """Whether the table was written with another number of buckets."""
    ours = F.col(CELL).endswith(f"of{files.buckets}") | (F.col(CELL) == NO_KEY)
    return bool(manifest.where(~ours).take(1))


def crowded(manifest: DataFrame, cells: DataFrame, files: KeyedFiles) -> list[tuple[str, str]]:
    """The entries of those cells that already hold as many as a cell may."""
    full = manifest.groupBy(CELL).count().where(F.col("count") >= files.most_entries).select(CELL)
    return entries_of(manifest.join(full.join(cells.select(CELL), CELL, "left_semi"), CELL, "left_semi"))


def next_manifest(spark: SparkSession, manifest: DataFrame, replaced: Sequence[tuple[str, str]], added: DataFrame, folder: str) -> int:
    """Lay down the manifest without the replaced entries and with the added ones; gives the table's rows."""
    if replaced:
        gone = spark.createDataFrame(list(replaced), f"{CELL} string, entry string")
        manifest = manifest.join(gone, [CELL, "entry"], "left_anti")
    listed = manifest.select(*added.columns).unionByName(added)
    listed.coalesce(1).write.parquet(folder)
    return spark.read.schema(added.schema).parquet(folder).agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]


def cells_that_differ(one: DataFrame, other: DataFrame) -> set[str]:
    """Cells whose entries are not the same in two manifests."""
    return {cell for cell, _ in set(entries_of(one)) ^ set(entries_of(other))}
