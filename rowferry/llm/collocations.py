"""Phrase collocations from depth-truncated suffix subtrees, built group by group (ERA).

The corpus is one long string of words for each language, cut where a piece of text ends.
Its suffix tree down to ``DEPTH`` words would hold the count of every phrase; it is never
built whole.

1. Words are counted. A word with fewer than ``LEAST`` occurrences is in no phrase that
   counts, so it ends a suffix as the end of a piece does.
2. Vertical partitioning. Suffixes are told apart by their first word, over slots of a hash
   (``2 ** MOST_BITS`` at most, so the table of slots has a fixed bound). A slot with more
   occurrences than ``BUDGET`` is divided by the first two words, then three, then four.
   Neighbouring slots are grouped up to the budget. A slot without a frequent word has no
   group, which is how a task knows rare words.
3. Suffixes of four words, each once for a block of text with its count, go to their group
   as compressed lists. A hot leaf is one line a block.
4. A group's subtree is its sorted leaves and the depth at which neighbours part. The count
   of a node is the total of the leaves below it. Nodes above a divided prefix are partial
   in each group and are added up at the end.
5. Scores come from joins of candidates with the counts of their two parts; the best of a
   language are cut by task before they meet.

Counts and scores are exact at any size: hashes only place words, phrases are told apart by
their text, and the products are decimals of 28 digits.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows
count each; a text of any length is read whole, in chunks; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import LANES, mix, ship, written

DEPTH = 4
LEAST = 30
BUDGET = 1 << 21
MOST_BITS = 22
TOP = 2000
COVERED = 80

BLOCK = 1 << 20
PART = 1 << 12
CHUNK = 1 << 21
HEAVY = -1
# all that ends a piece becomes a full stop, all that ends a word a space
BREAKS = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"." * 10 + b" ")


class _Block:
    """Texts as numbers of words, with the words beside them; 0 is the end of a piece."""

    def __init__(self):
        self.pending: dict[str, list[bytes]] = {}  # texts not split yet, by language
        self.split: dict[str, list[pa.Array]] = {}
        self.waiting = self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        data = text.lower().translate(BREAKS).replace(b".", b" . ") + b" . "  # bytes: only A-Z change
        at = 0
        while at < len(data):
            cut = data.find(b" ", at + CHUNK)
            cut = len(data) if cut < 0 else cut
            self.pending.setdefault(lang, []).append(data[at:cut])
            self.waiting += cut - at
            at = cut
            if self.waiting >= CHUNK:
                self._split()

    def _split(self) -> None:
        for lang, texts in self.pending.items():
            words = pc.ascii_split_whitespace(pa.array(texts, pa.large_binary()).view(pa.large_string())).flatten()
            words = words.filter(pc.not_equal(words, ""))
            self.split.setdefault(lang, []).append(words)
            self.size += len(words)
        self.pending, self.waiting = {}, 0

    def full(self) -> bool:
        return self.size >= BLOCK

    def close(self) -> None:
        """Number the words: ``x``, one after another; ``words``, ``langs`` and ``of``, the language of each word."""
        self._split()
        self.langs, parts, words, of = list(self.split), [], [pa.array([None], pa.large_string())], [np.zeros(1, np.int32)]
        base = 1
        for nth, lang in enumerate(self.langs):
            coded = pa.chunked_array(self.split.pop(lang), pa.large_string()).dictionary_encode()
            known = coded.chunk(0).dictionary
            number = np.arange(base, base + len(known), dtype=np.int32)
            end = pc.index(known, ".").as_py()
            if end >= 0:
                number[end] = 0
            parts += [number[chunk.indices.to_numpy()] for chunk in coded.chunks]
            words.append(known)
            of.append(np.full(len(known), nth, np.int32))
            base += len(known)
        self.x = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        self.words, self.of = pa.concat_arrays(words), np.concatenate(of)

    def hashes(self) -> np.ndarray:
        """Spark's ``xxhash64(lang, word)`` of each word."""
        seeds = [xxhash.xxh64_intdigest(lang.encode(), 42) for lang in self.langs]
        out = np.zeros(len(self.words), np.uint64)
        words = self.words[1:].view(pa.large_binary()).to_pylist()
        out[1:] = [xxhash.xxh64_intdigest(w, seeds[k]) for w, k in zip(words, self.of[1:].tolist(), strict=True)]
        return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    block = _Block()
    for part in batches:
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
            if text:
                block.add(lang, text)
            if block.full():
                block.close()
                yield block
                block = _Block()
                pa.default_memory_pool().release_unused()
    block.close()
    if len(block.x):
        yield block


WORDS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _blocks(batches):
        n = np.bincount(block.x, minlength=len(block.words))
        n[0] = 0
        some = np.nonzero(n)[0]
        langs = pa.DictionaryArray.from_arrays(pa.array(block.of[some]), pa.array(block.langs, pa.string())).cast(pa.string())
        yield pa.RecordBatch.from_arrays([langs, block.words.take(pa.array(some)).cast(pa.string()), pa.array(n[some], pa.int64())], schema=WORDS)


class Levels:
    """For each depth the group of each slot: 0 none, HEAVY divided at the next depth."""

    def __init__(self, bits: int):
        self.bits = bits
        self.tables: list[np.ndarray] = []
        self.depth_of = [0]  # of each group

    def add(self, slots: np.ndarray, totals: np.ndarray, budget: int) -> bool:
        """Group the slots of the next depth; whether some were heavy."""
        depth = len(self.tables) + 1
        table = np.zeros(1 << self.bits, np.int32)
        heavy = (totals > budget) & (depth < DEPTH)
        table[slots[heavy]] = HEAVY
        slots, totals = slots[~heavy], totals[~heavy]
        order = np.argsort(slots)
        slots, ends = slots[order], np.cumsum(totals[order])
        at = 0
        while at < len(slots):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + budget, "right")))
            table[slots[at:to]] = len(self.depth_of)
            self.depth_of.append(depth)
            at = to
        self.tables.append(table)
        return bool(heavy.any())

    def slot(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def place(self, hashes: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group of each suffix, and the hash of its prefix down to the last depth told apart."""
        h = hashes[columns[0]]
        groups = self.tables[0][self.slot(h)]
        for depth in range(1, len(self.tables)):
            todo = np.nonzero(groups == HEAVY)[0]
            h[todo] = mix(mix(h[todo]) * LANES[0] + hashes[columns[depth][todo]])
            groups[todo] = self.tables[depth][self.slot(h[todo])]
        return groups, h


def _suffixes(block: _Block, hashes: np.ndarray, levels: Levels) -> Iterator[list[np.ndarray]]:
    """The first words of each suffix, a lot at a time; 0 where it ended before."""
    known = levels.tables[0][levels.slot(hashes)] != 0
    known[0] = False
    x = np.append(block.x, np.zeros(DEPTH, np.int32))
    x[~known[x]] = 0
    for at in range(0, len(x) - DEPTH, BLOCK):
        n = min(BLOCK, len(x) - DEPTH - at)
        columns = [x[at : at + n]]
        for k in range(1, DEPTH):
            columns.append(np.where(columns[-1] > 0, x[at + k : at + k + n], 0))
        begun = columns[0] > 0
        yield [c[begun] for c in columns]


PARTS = pa.schema([("part", pa.int32()), ("totals", pa.binary())])


def _count_slots(shared):
    """How many suffixes of heavy slots fall on each slot of the next depth, in runs of ``PART`` slots.

    A suffix that ends there is one leaf however often it comes: it counts once a block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, pack = shared.value, zstandard.ZstdCompressor(level=1).compress
        depth, totals = len(levels.tables), np.zeros(1 << levels.bits, np.int64)
        for block in _blocks(batches):
            hashes = block.hashes()
            for columns in _suffixes(block, hashes, levels):
                groups, h = levels.place(hashes, columns)
                todo = np.nonzero(groups == HEAVY)[0]
                word = columns[depth][todo]
                slots = levels.slot(mix(mix(h[todo]) * LANES[0] + hashes[word]))
                totals += np.bincount(slots[word > 0], minlength=len(totals))
                totals[np.unique(slots[word == 0])] += 1
        for part, some in enumerate(totals.reshape(-1, PART)):
            if some.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack(some.tobytes())], pa.binary())], schema=PARTS)

    return run


def _sum_parts(rows: pa.Table) -> pa.Table:
    unpack, total = zstandard.ZstdDecompressor().decompress, np.zeros(PART, np.int64)
    for one in rows.column("totals"):
        total += np.frombuffer(unpack(one.as_py()), np.int64)
    return pa.Table.from_arrays([rows.column("part").slice(0, 1), pa.array([total.tobytes()], pa.binary())], schema=PARTS)


def _distinct(columns: list[np.ndarray], n: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Each leaf once, in order of its numbers, with its total; without ``n`` each counts 1."""
    bits = max((int(c.max()) for c in columns if len(c)), default=0).bit_length()
    if DEPTH * bits <= 64:  # a leaf is one number
        shift, key = np.uint64(bits), np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            key = key << shift | c.astype(np.uint64)
        if n is None:
            key, n = np.unique(key, return_counts=True)
        else:
            order = np.argsort(key)
            key, n = key[order], n[order]
            at = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0] if len(key) else order
            key, n = key[at], np.add.reduceat(n, at) if len(at) else n
        mask = np.uint64((1 << bits) - 1)
        return [(key >> np.uint64(bits * (DEPTH - 1 - k)) & mask).astype(np.int32) for k in range(DEPTH)], n
    n = np.ones(len(columns[0]), np.int64) if n is None else n
    first = columns[0].astype(np.uint64) << np.uint64(32) | columns[1].astype(np.uint64)
    second = columns[2].astype(np.uint64) << np.uint64(32) | columns[3].astype(np.uint64)
    order = np.lexsort((second, first))
    first, second = first[order], second[order]
    at = np.nonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))[0]
    return [c[order[at]] for c in columns], np.add.reduceat(n[order], at)


LEAVES = pa.schema([("group", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("leaves", pa.binary()), ("totals", pa.binary())])


def _spread_leaves(shared):
    """For each group and language of a block its distinct suffixes and their totals, as numbers of words that come along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, pack = shared.value, zstandard.ZstdCompressor(level=1).compress
        for block in _blocks(batches):
            hashes = block.hashes()
            for every in _suffixes(block, hashes, levels):
                lang_of = block.of[every[0]]
                for nth, lang in enumerate(block.langs):
                    columns = [c[lang_of == nth] for c in every]
                    if not len(columns[0]):
                        continue
                    # numbers of the frequent words that are here: they are fewer, so leaves pack closer
                    used = np.zeros(len(block.words), bool)
                    for c in columns:
                        used[c] = True
                    used[0] = True
                    short, long = np.cumsum(used, dtype=np.int32) - 1, np.nonzero(used)[0].astype(np.int32)
                    columns, n = _distinct([short[c] for c in columns])
                    groups = levels.place(hashes[long], columns)[0]
                    order = np.argsort(groups, kind="stable")
                    groups, n, leaves = groups[order], n[order], np.stack([c[order] for c in columns])
                    words = block.words.take(pa.array(long)).view(pa.large_binary())
                    starts = np.nonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))[0].tolist()
                    number = np.zeros(len(long), np.int32)
                    for a, b in zip(starts, [*starts[1:], len(groups)], strict=True):
                        mine, local = _renumbered(leaves[:, a:b], number)
                        listed = b"\n".join(words.take(pa.array(mine)).to_pylist())
                        packed = (pack(x) for x in (listed, local.tobytes(), n[a:b].astype(np.int64).tobytes()))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([groups[a]], pa.int32()), pa.array([lang]), *(pa.array([x], pa.binary()) for x in packed)], schema=LEAVES
                        )

    return run


def _renumbered(leaves: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of some leaves, and the leaves with their places in that list from 1; ``number`` is scratch of all words."""
    flat = leaves.ravel()
    at = np.arange(len(flat), dtype=np.int32)
    number[flat] = at  # the last place of each word stands for it
    mine = flat[(number[flat] == at) & (flat > 0)]
    number[mine] = np.arange(1, len(mine) + 1, dtype=np.int32)
    number[0] = 0
    return mine, number[leaves].astype(np.uint16 if len(mine) < 1 << 16 else np.uint32)


def _phrases(words: pa.Array, columns: list[np.ndarray]) -> pa.Array:
    """Words joined by one space; 0 is none."""
    return pc.binary_join_element_wise(*(words.take(pa.array(c)) for c in columns), pa.scalar(" ", pa.large_string()), null_handling="skip")


NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("depth", pa.int32()), ("n", pa.int64())])


class _Subtree:
    """The leaves of one group and language."""

    def __init__(self, lang: str, depth: int):
        self.lang, self.depth = lang, depth
        self.ids: dict[bytes, int] = {}
        self.held: list[tuple[list[np.ndarray], np.ndarray]] = []
        self.size, self.most = 0, 2 * BUDGET

    def add(self, words: list[bytes], leaves: bytes, totals: np.ndarray) -> None:
        own = np.zeros(len(words) + 1, np.int32)
        own[1:] = [self.ids.setdefault(w, len(self.ids) + 1) for w in words]
        local = np.frombuffer(leaves, np.uint16 if len(leaves) == 2 * DEPTH * len(totals) else np.uint32)
        self.held.append(([own[c] for c in local.reshape(DEPTH, -1)], totals))
        self.size += len(totals)
        if self.size > self.most:
            self.merge()
            self.most = max(2 * BUDGET, 2 * self.size)

    def merge(self) -> tuple[list[np.ndarray], np.ndarray]:
        columns = [np.concatenate([c[k] for c, _ in self.held]) for k in range(DEPTH)]
        columns, n = _distinct(columns, np.concatenate([n for _, n in self.held]))
        self.held, self.size = [(columns, n)], len(n)
        return columns, n

    def nodes(self, least: int) -> Iterator[pa.RecordBatch]:
        columns, n = self.merge()
        words = pa.array([None, *self.ids], pa.large_binary()).view(pa.large_string())
        part = np.zeros(len(n), bool)  # where a leaf leaves the path of the one before
        part[:1] = True
        for depth, column in enumerate(columns, 1):
            part[1:] |= column[1:] != column[:-1]
            at = np.nonzero(part)[0]
            totals = np.add.reduceat(n, at)
            keep = (column[at] > 0) & ((totals >= least) | (depth < self.depth))
            at, totals = at[keep], totals[keep]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([self.lang] * len(at)), _phrases(words, [c[at] for c in columns[:depth]]).cast(pa.string()),
                        pa.array(np.full(len(at), depth, np.int32)), pa.array(totals),
                    ],
                    schema=NODES,
                )


def _build(shared, least: int):
    """Rows come sorted by group and language; one subtree is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, unpack = shared.value, zstandard.ZstdDecompressor().decompress
        at, tree = None, None
        for part in batches:
            for group, lang, words, leaves, totals in zip(*(part.column(c).to_pylist() for c in LEAVES.names), strict=True):
                if (group, lang) != at:
                    if tree:
                        yield from tree.nodes(least)
                    at, tree = (group, lang), _Subtree(lang, levels.depth_of[group])
                tree.add(unpack(words).split(b"\n"), unpack(leaves), np.frombuffer(unpack(totals), np.int64))
        if tree:
            yield from tree.nodes(least)

    return run


def phrase_counts(texts: DataFrame, least: int = LEAST, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """All phrases of one to four words with ``least`` occurrences (``lang``, ``phrase``, ``depth``, ``n``), and all words of each language."""
    spark = texts.sparkSession
    ship(spark)
    rows = texts.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).where("octet_length(text) > 0")
    counted = rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(counted, "phrases-words")
    frequent = words.where(F.col("n") >= least)
    known = frequent.count()
    levels = Levels(min(MOST_BITS, max(12, (8 * known).bit_length())))
    slot = F.shiftrightunsigned(F.xxhash64("lang", F.col("word")), 64 - levels.bits).cast("int")
    found = frequent.groupBy(slot.alias("slot")).agg(F.sum("n").alias("n")).toArrow()  # at most all slots, once
    heavy = levels.add(found.column("slot").to_numpy().astype(np.int64), found.column("n").to_numpy(), budget)
    while heavy:
        shared = spark.sparkContext.broadcast(levels)
        parts = rows.mapInArrow(_count_slots(shared), "part int, totals binary").groupBy("part").applyInArrow(_sum_parts, "part int, totals binary")
        totals = np.zeros(1 << levels.bits, np.int64)
        for part, some in parts.collect():  # at most all slots, once
            totals[part * PART : (part + 1) * PART] = np.frombuffer(some, np.int64)
        slots = np.nonzero(totals)[0]
        heavy = levels.add(slots, totals[slots], budget)
    shared = spark.sparkContext.broadcast(levels)
    groups = len(levels.depth_of)
    parts = min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), groups // 64))
    leaves = rows.mapInArrow(_spread_leaves(shared), "group int, lang string, words binary, leaves binary, totals binary")
    dealt = leaves.repartitionById(parts, (F.col("group") * F.lit(parts).cast("long") / F.lit(groups)).cast("int"))
    nodes = dealt.sortWithinPartitions("group", "lang").mapInArrow(_build(shared, least), "lang string, phrase string, depth int, n long")
    nodes = nodes.groupBy("lang", "phrase", "depth").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return written(nodes, "phrases-nodes"), words.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(texts: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``."""
    nodes, totals = phrase_counts(texts, least, budget)
    counts = nodes.select("lang", "phrase", F.col("n").alias("a"))
    long = nodes.where("depth > 1").select("lang", "phrase", "depth", F.col("n").alias("a"), F.split("phrase", " ").alias("ws"))

    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("ws", F.lit(1), F.col("k")), " ").alias("head"), F.array_join(F.slice("ws", F.col("k") + 1, F.lit(DEPTH)), " ").alias("rest")
    )
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    # 28 digits hold any product; the quotient is at most 1,000,000
    score = F.expr("(CAST(2000000 AS DECIMAL(8, 0)) * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))

    inner = F.expr(
        "flatten(transform(sequence(2, depth - 1), m -> transform(sequence(1, depth - m + 1), i -> array_join(slice(ws, i, m), ' '))))"
    )
    within = long.where("depth > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("longer"))
    within = within.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(within, ["lang", "phrase"], "left").where(f"longer IS NULL OR CAST(100 AS DECIMAL(3, 0)) * longer < CAST({covered} AS DECIMAL(3, 0)) * a")

    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score")
    )
