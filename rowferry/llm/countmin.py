"""Count-min sketches built by partition, merged by block, asked by every task.

A counter stops at two, since all that is asked is "once or more often". Two rows of
``2 ** bits`` counters: an answer can be too high, never too low. The merged sketch has a
fixed size, ``2 * 2 ** bits / 8`` bytes (32 MB for the default), so it may be broadcast;
when the corpus outgrows it, more keys look repeated and the exact pass behind it works
more, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BITS = 27
BLOCK_BITS = 19
LOTS = 16  # parts in which the merged sketch comes to the driver
ROWS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))
SCHEMA = "row int, block int, once binary, more binary"
ARROW = pa.schema([("row", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])


def slots(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    return (keys * ROWS[row]) >> np.uint64(64 - bits)


def _packed(low: np.ndarray) -> bytes:
    """Positions within a block: gaps of two bytes, or a bit map where that is shorter."""
    size = 1 << BLOCK_BITS
    if 2 * len(low) < size // 8:
        gaps = np.diff(low, prepend=0)
        if not len(gaps) or gaps.max() < 1 << 16:
            return b"g" + gaps.astype(np.uint16).tobytes()
    flags = np.zeros(size, bool)
    flags[low] = True
    return b"b" + np.packbits(flags).tobytes()


def _flags(packed: bytes) -> np.ndarray:
    flags = np.zeros(1 << BLOCK_BITS, bool)
    if packed[:1] == b"g":
        flags[np.cumsum(np.frombuffer(packed, np.uint16, offset=1), dtype=np.int64)] = True
        if len(packed) == 1:
            flags[:] = False
    else:
        flags[:] = np.unpackbits(np.frombuffer(packed, np.uint8, offset=1)).astype(bool)
    return flags


def partial(keys: np.ndarray, bits: int = BITS) -> Iterator[pa.RecordBatch]:
    """The sketch of one lot of keys, in blocks; empty blocks are left out."""
    if not len(keys):
        return
    for row in range(len(ROWS)):
        slot, count = np.unique(slots(keys, row, bits), return_counts=True)
        slot = slot.astype(np.int64)
        block = slot >> BLOCK_BITS
        low = slot & ((1 << BLOCK_BITS) - 1)
        ids, first = np.unique(block, return_index=True)
        ends = np.append(first[1:], len(block))
        once, more = [], []
        for a, b in zip(first, ends, strict=True):
            once.append(_packed(low[a:b][count[a:b] == 1]))
            more.append(_packed(low[a:b][count[a:b] > 1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([row] * len(ids), pa.int32()), pa.array(ids, pa.int32()), pa.array(once, pa.binary()), pa.array(more, pa.binary())],
            schema=ARROW,
        )


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by row and block; one block is held at a time."""
    at, seen, more = None, None, None

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()), pa.array([b""], pa.binary()), pa.array([np.packbits(more).tobytes()], pa.binary())],
            schema=ARROW,
        )

    for part in batches:
        for row, block, a, b in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if (row, block) != at:
                if at is not None and more.any():
                    yield out()
                at, seen, more = (row, block), np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
            one, two = _flags(a), _flags(b)
            more |= two | (seen & one)
            seen |= one | two
    if at is not None and more.any():
        yield out()


def merged(parts: DataFrame, bits: int = BITS) -> np.ndarray:
    """The merged sketch: for each row one bit a counter, set where it reached two."""
    n = len(ROWS) << max(0, bits - BLOCK_BITS)
    blocks = (
        parts.repartition(min(n, max(1, int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "row", "block")
        .sortWithinPartitions("row", "block")
        .mapInArrow(_merge, SCHEMA)
        .select("row", "block", "more")
    )
    out = np.zeros((len(ROWS), (1 << bits) // 8), np.uint8)
    step = (1 << BLOCK_BITS) // 8
    # at most 2 ** bits / 4 bytes in all; a lot at a time, as the driver's JVM would hold a whole collect several times over
    for row, block, more in blocks.repartition(LOTS).toLocalIterator():
        out[row, block * step : block * step + step] = np.frombuffer(more, np.uint8)
    return out


def repeated(sketch: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may have come more than once; no key that did is missed."""
    bits = int(sketch.shape[1] * 8).bit_length() - 1
    yes = np.ones(len(keys), bool)
    for row in range(len(ROWS)):
        slot = slots(keys, row, bits).astype(np.int64)
        yes &= (sketch[row, slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
    return yes
