"""Written intermediate tables, word hashing and other helpers that the operators share.

Every function that runs in a task takes Arrow batches and keeps memory bounded by a
block, whatever the partition holds.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.session import work_path

MIX_A = np.uint64(0xBF58476D1CE4E5B9)
MIX_B = np.uint64(0x94D049BB133111EB)
LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))

# Texts are long: small batches bound what a task holds on both sides of the pipe.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1024", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, so that tasks import it wherever they run."""
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    folder = tempfile.mkdtemp(prefix="rowferry-ship-")
    path = os.path.join(folder, "rowferry_llm.zip")
    with zipfile.ZipFile(path, "w") as out:
        for here, _, names in os.walk(os.path.join(root, "rowferry")):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    out.write(full, os.path.relpath(full, root))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, laid down once in the shared folder and read back."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX_A
    x ^= x >> np.uint64(27)
    x *= MIX_B
    x ^= x >> np.uint64(31)
    return x


def span_hash(h: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """One hash for each run of ``k`` consecutive values, from runs of powers of two.

    Equal runs have equal hashes wherever they stand. What is joined is mixed as a whole: a
    part that is only added could change places with one that the next join adds.
    """
    if len(h) < k:
        return np.zeros(0, np.uint64)
    mult, level, size, out, done = LANES[lane], h, 1, None, 0
    n = len(h) - k + 1
    rest = k
    while rest:
        if rest & 1:
            part = level[done : done + n]
            out = part if out is None else mix(out * mult + part)
            done += size
        rest >>= 1
        if rest:
            level = mix(level[:-size] * mult + level[size:])
            size *= 2
    return out


class WordHasher(dict):
    """Words of a text as rows of a table of 128-bit hashes."""

    def __init__(self, most: int = 300_000):
        super().__init__()
        self.most, self.raw, self.array = most, bytearray(), np.zeros((0, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.raw += xxhash.xxh3_128_digest(word)
        return at

    def hashes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each word."""
        if len(self) > self.most:
            self.clear()
            self.raw = bytearray()
            self.array = np.zeros((0, 2), np.uint64)
        at = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        have, want = len(self.array), len(self)
        if want > have:
            fresh = np.frombuffer(bytes(self.raw[16 * have :]), np.uint64).reshape(-1, 2)
            if want > len(self.array.base if self.array.base is not None else self.array):
                room = np.empty((max(1024, 2 * want), 2), np.uint64)
                room[:have] = self.array
            else:
                room = self.array.base
            room[have:want] = fresh
            self.array = room[:want]
        return self.array[at, 0], self.array[at, 1]


_KEPT: dict = {}


def of_worker(key, make):
    """What this Python worker keeps between tasks: one thing at a time, so stages of different kinds do not add up."""
    pa.default_memory_pool().release_unused()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def hasher() -> WordHasher:
    """The word table of this Python worker."""
    return of_worker("words", WordHasher)


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """The least of each run of ``k`` values."""
    size, level = 1, x
    while 2 * size <= k:
        level = np.minimum(level[:-size], level[size:])
        size *= 2
    rest = k - size
    return np.minimum(level[: len(x) - k + 1], level[rest : rest + len(x) - k + 1])


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    """Values dealt evenly over ``n`` buckets by their upper bits."""
    return ((h >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def batch(columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, schema.field(n).type) for n, c in columns.items()],
        schema=schema,
    )


def spans(lengths: np.ndarray) -> np.ndarray:
    """0 … n-1 for each n of ``lengths``, one after another."""
    total = int(lengths.sum())
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.arange(total) - starts


def has_rows(df: DataFrame) -> bool:
    return bool(df.select(F.lit(1)).take(1))
