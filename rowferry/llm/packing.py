"""Best-fit packing of token sequences by a grouping genetic algorithm.

Texts become token ids once; only longer ones are cut. The pieces, as lengths alone, are
dealt over cells of about ``CELL`` pieces, and each cell is packed by several islands. An
individual is a packing, its genes are whole bins. Crossover puts the best-filled bins of
one parent into the other, drops the bins that then hold a piece twice, and best-fits the
displaced pieces, largest first. After each epoch the elites of an island move to the next
one; the best packing of a cell wins. A cell stops as soon as it has as few bins as the sum
of its lengths allows. The worst-filled bin of each cell is then packed again with those of
other cells.

No piece crosses the driver; a task holds one cell, whose size does not depend on the data.

Defined cases: a null text counts as empty, its document is the end token alone; a text
that fills a sequence exactly with its end token is one piece; repeated rows are packed
each; an empty table gives an empty result; all other columns ride along in ``carry``.
"""

from __future__ import annotations

import bisect
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.bpe import WordCoder, coder
from rowferry.llm.common import of_worker, ship, written

LIMIT = 4096
END = 1
CELL = 1024
ISLANDS = 2
EPOCHS = 2
POPULATION = 4
CROSSES = 6
TOGETHER = 16  # cells whose worst bins are packed again together


def _tokenize(path: str, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, end = coder(WordCoder, path), np.array([END], np.uint32).tobytes()
        uid = TaskContext.get().partitionId() << 36
        for part in batches:
            for lot in range(0, part.num_rows, 1024):
                rows = part.slice(lot, 1024)
                at, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(c.encode(rows.column("text").to_pylist())):
                    ids += end
                    for k, a in enumerate(range(0, len(ids), 4 * limit)):
                        cut = ids[a : a + 4 * limit]
                        at.append(i)
                        piece.append(k)
                        start.append(a // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("carry").take(pa.array(at, pa.int64())), pa.array(range(uid, uid + len(at)), pa.int64()), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                    names=["carry", "uid", "piece", "start", "length", "ids_crc32"],
                )
                uid += len(at)

    return run


class Packing:
    """Bins of item numbers, for one cell."""

    def __init__(self, bins: list[list[int]], fill: list[int]):
        self.bins, self.fill = bins, fill

    def score(self, limit: int) -> tuple[int, float]:
        return len(self.bins), -sum((f / limit) ** 2 for f in self.fill)


def best_fit(lengths: list[int], items: list[int], limit: int, bins: list[list[int]], fill: list[int]) -> Packing:
    """Put ``items`` where they leave the least room, in the order given."""
    room = sorted((limit - f, i) for i, f in enumerate(fill))
    for item in items:
        at = bisect.bisect_left(room, (lengths[item], -1))
        if at < len(room):
            left, i = room.pop(at)
            bins[i].append(item)
            fill[i] += lengths[item]
        else:
            i, left = len(bins), limit
            bins.append([item])
            fill.append(lengths[item])
        if left - lengths[item]:
            bisect.insort(room, (left - lengths[item], i))
    return Packing(bins, fill)


def cross(a: Packing, b: Packing, lengths: list[int], limit: int, rng: random.Random) -> Packing:
    """The best-filled bins of ``b`` go whole into ``a``."""
    order = sorted(range(len(b.bins)), key=lambda i: (-b.fill[i], rng.random()))
    given = order[: rng.randint(1, max(1, len(order) * 2 // 3))]
    taken = {x for i in given for x in b.bins[i]}
    bins, fill, loose = [list(b.bins[i]) for i in given], [b.fill[i] for i in given], []
    for items, f in zip(a.bins, a.fill, strict=True):
        if taken.isdisjoint(items):
            bins.append(list(items))
            fill.append(f)
        else:
            loose += [x for x in items if x not in taken]
    loose.sort(key=lambda x: (-lengths[x], rng.random()))
    return best_fit(lengths, loose, limit, bins, fill)


def evolve(lengths: list[int], limit: int, seed: int, elites: list[Packing], population: int = POPULATION, crosses: int = CROSSES) -> list[Packing]:
    """One epoch of one island: the two best packings."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // limit)
    pool = list(elites)
    while len(pool) < population:
        if pool and len(pool[0].bins) <= least:
            break
        # the first individual is best fit by falling length, the others best fit with some disorder
        noise = 0.0 if not pool else 0.3
        items = sorted(range(len(lengths)), key=lambda x: -lengths[x] * (1 - noise * rng.random()))
        pool.append(best_fit(lengths, items, limit, [], []))
        pool.sort(key=lambda p: p.score(limit))
    for _ in range(crosses):
        if len(pool[0].bins) <= least or len(pool) < 2:
            break
        a, b = rng.sample(pool, 2)
        pool.append(cross(a, b, lengths, limit, rng))
        pool.sort(key=lambda p: p.score(limit))
        pool.pop()
    return pool[:2]


def _numbers(packing: Packing, n: int) -> bytes:
    out = np.empty(n, np.int32)
    for b, items in enumerate(packing.bins):
        out[items] = b
    return out.tobytes()


def _packing(numbers: bytes, lengths: list[int]) -> Packing:
    bins: dict[int, list[int]] = {}
    for item, b in enumerate(np.frombuffer(numbers, np.int32).tolist()):
        bins.setdefault(b, []).append(item)
    return Packing(list(bins.values()), [sum(lengths[x] for x in items) for items in bins.values()])


def _ordered(group: pa.Table) -> pa.Table:
    return group.sort_by([("length", "descending"), ("uid", "ascending")])


ELITES = "cell long, island int, rank int, bins int, packing binary"


def _epoch(limit: int, number: int, islands: int):
    def run(group: pa.Table, elites: pa.Table) -> pa.Table:
        of_worker("packing", dict)
        if not group.num_rows:
            return pa.table({"cell": pa.array([], pa.int64()), "island": pa.array([], pa.int32()), "rank": pa.array([], pa.int32()),
                             "bins": pa.array([], pa.int32()), "packing": pa.array([], pa.binary())})
        lengths = _ordered(group).column("length").to_pylist()
        cell, island = group.column("cell")[0].as_py(), group.column("island")[0].as_py()
        come = [_packing(p, lengths) for p in elites.column("packing").to_pylist()] if elites.num_rows else []
        best = evolve(lengths, limit, (cell * islands + island) * 1009 + number, come)
        n = len(best)
        return pa.table({
            "cell": pa.array([cell] * n, pa.int64()), "island": pa.array([island] * n, pa.int32()), "rank": pa.array(range(n), pa.int32()),
            "bins": pa.array([len(p.bins) for p in best], pa.int32()), "packing": pa.array([_numbers(p, len(lengths)) for p in best], pa.binary()),
        })

    return run


PLACED = "uid long, cell long, length long, bin int, fill long, offset long"


def _place(limit: int):
    def run(group: pa.Table, elites: pa.Table) -> pa.Table:
        group = _ordered(group)
        lengths = group.column("length").to_pylist()
        if lengths:
            found = [_packing(p, lengths) for p in elites.column("packing").to_pylist()]
            best = min(found, key=lambda p: p.score(limit))
        else:
            best = Packing([], [])
        n = len(lengths)
        which, fill, offset = [0] * n, [0] * n, [0] * n
        for b, items in enumerate(best.bins):
            at = 0
            for x in items:
                which[x], fill[x], offset[x] = b, best.fill[b], at
                at += lengths[x]
        return pa.table({
            "uid": group.column("uid"), "cell": group.column("cell"), "length": group.column("length"),
            "bin": pa.array(which, pa.int32()), "fill": pa.array(fill, pa.int64()), "offset": pa.array(offset, pa.int64()),
        })

    return run


def _evolved(cells: DataFrame, limit: int, islands: int, epochs: int) -> DataFrame:
    """``(cell, uid, length)`` to ``PLACED``."""
    on = F.explode(F.array(*(F.lit(i) for i in range(islands)))).alias("island")
    settled = cells.select("cell", on, "uid", "length")
    elites = cells.sparkSession.createDataFrame([], ELITES)
    for number in range(epochs):
        # the elites of an island arrive at the next one
        moved = elites.withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands)).cast("int"))
        grown = settled.groupBy("cell", "island").cogroup(moved.groupBy("cell", "island")).applyInArrow(_epoch(limit, number, islands), ELITES)
        elites = written(grown, "packing-elites")
    best = elites.groupBy("cell").agg(F.min(F.struct("bins", "rank", "island", "packing")).alias("b")).select("cell", "b.packing")
    return cells.groupBy("cell").cogroup(best.groupBy("cell")).applyInArrow(_place(limit), PLACED)


def pack_lengths(pieces: DataFrame, limit: int = LIMIT, cell: int = CELL, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``(uid, length)`` to ``(uid, sequence_id, offset)``."""
    n = max(1, -(-pieces.count() // cell))
    first = pieces.select(F.pmod(F.xxhash64("uid"), F.lit(n)).alias("cell"), "uid", "length")
    placed = written(_evolved(first, limit, islands, epochs), "packing-placed")
    worst = written(placed.groupBy("cell").agg(F.min(F.struct("fill", "bin")).alias("w")).select("cell", "w.bin", F.lit(True).alias("again")), "packing-worst")
    marked = placed.join(worst, ["cell", "bin"], "left")
    again = marked.where("again").select(F.floor(F.col("cell") / TOGETHER).alias("cell"), "uid", "length")
    second = _evolved(again, limit, 1, 1)
    # sequence ids: even for the cells, odd for the bins packed again; a cell never has 2 ** 24 bins
    wide = F.lit(1 << 25)
    kept = marked.where("again is null").select("uid", (F.col("cell") * wide + 2 * F.col("bin")).alias("sequence_id"), "offset")
    return kept.union(second.select("uid", (F.col("cell") * wide + 2 * F.col("bin") + 1).alias("sequence_id"), "offset"))


def pack_documents(docs: DataFrame, path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """One row a piece: ``carry``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``."""
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("carry"), F.col(text_col).alias("text"))
    schema = f"carry {rows.schema['carry'].dataType.simpleString()}, uid long, piece int, start long, length long, ids_crc32 long"
    pieces = written(rows.mapInArrow(_tokenize(path, limit), schema), "packing-pieces")
    placed = pack_lengths(pieces.select("uid", "length"), limit)
    return pieces.join(placed, "uid").drop("uid")
