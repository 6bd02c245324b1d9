"""BPE encoding and decoding through a minimal acyclic transducer.

The words of all texts are counted exactly, the most frequent ones (a parameter) compiled
into a minimal acyclic automaton: words that end alike share their suffix states. Each
transition carries the number of words that sort before the ones it leads to, so a walk
adds up to the rank of a word, and the rank points to its ids. The automaton is a few
megabytes; it is broadcast, laid into an unnamed file by each Python worker and mapped.
Words outside the lexicon are merged by the ranked rules. Both ways give the ids of the
tokenizers library.

Defined cases: a null text counts as empty; an empty text has no ids; special tokens in a
text are taken as such, as the library does; repeated rows are encoded alike; an empty table gives an empty
result; all other columns ride along in ``carry``.
"""

from __future__ import annotations

import hashlib
import mmap
import tempfile
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.bpe import LONG, ByteCoder, Coder, coder
from rowferry.llm.common import ship, written

WORDS = 60_000


def compile_lexicon(entries: dict[bytes, bytes]) -> bytes:
    """Words with their ids (as bytes of unsigned 32-bit integers) to one block of bytes."""
    words = sorted(w for w in entries if w)
    register: dict = {}
    states: list[tuple[bool, tuple]] = []
    counts: list[int] = []

    def fixed(final: bool, arcs: list) -> int:
        key = (final, tuple(arcs))
        if key not in register:
            register[key] = len(states)
            states.append(key)
            counts.append(final + sum(counts[t] for _, t in arcs))
        return register[key]

    # the path of the last word, each node as [final, arcs]; what the next word leaves is fixed
    path, last = [[False, []]], b""
    for word in [*words, None]:
        same = 0
        if word is not None:
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
        while len(path) - 1 > same:
            final, arcs = path.pop()
            path[-1][1].append((last[len(path) - 1], fixed(final, arcs)))
        if word is None:
            break
        for _ in word[same:]:
            path.append([False, []])
        path[-1][0], last = True, word
    root = fixed(*path[0])
    keys, target, skip = [], [], []
    for s, (final, arcs) in enumerate(states):
        before = int(final)
        for byte, t in arcs:
            keys.append(s << 8 | byte)
            target.append(t)
            skip.append(before)
            before += counts[t]
    flat = b"".join(entries[w] for w in words)
    ends = np.cumsum([0, *(len(entries[w]) for w in words)])
    parts = [
        np.array([root, len(keys), len(states), len(words)], np.int64), np.array(keys, np.int64), np.array(target, np.int64), np.array(skip, np.int64),
        np.array([s[0] for s in states], np.int64), np.array(ends, np.int64),
    ]
    return b"".join(p.tobytes() for p in parts) + flat


class Lexicon:
    """A compiled lexicon, mapped from an unnamed file."""

    def __init__(self, compiled: bytes):
        with tempfile.TemporaryFile() as f:
            f.write(compiled)
            f.flush()
            self.memory = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.root, arcs, states, words = np.frombuffer(self.memory, np.int64, 4).tolist()
        at = 32
        self.keys = np.frombuffer(self.memory, np.int64, arcs, at)
        self.target = np.frombuffer(self.memory, np.int64, arcs, at + 8 * arcs)
        self.skip = np.frombuffer(self.memory, np.int64, arcs, at + 16 * arcs)
        self.final = np.frombuffer(self.memory, np.int64, states, at + 24 * arcs)
        self.ends = np.frombuffer(self.memory, np.int64, words + 1, at + 24 * arcs + 8 * states)
        self.flat = at + 24 * arcs + 8 * states + 8 * (words + 1)

    def ranks(self, words: list[bytes]) -> np.ndarray:
        """The rank of each word, or -1; all words walk together."""
        n = len(words)
        out = np.full(n, -1, np.int64)
        size = np.fromiter(map(len, words), np.int64, n)
        live = np.nonzero((size > 0) & (size <= LONG))[0]
        if not len(live) or not len(self.keys):
            return out
        width = int(size[live].max())
        data = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in live), np.uint8).reshape(len(live), width)
        row, state, rank = np.arange(len(live)), np.full(len(live), self.root), np.zeros(len(live), np.int64)
        for step in range(width):
            key = state << 8 | data[row, step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            ok = self.keys[arc] == key
            row, arc = row[ok], arc[ok]
            state, rank = self.target[arc], rank[ok] + self.skip[arc]
            done = size[live[row]] == step + 1
            end = done & (self.final[state] == 1)
            out[live[row[end]]] = rank[end]
            row, state, rank = row[~done], state[~done], rank[~done]
            if not len(row):
                break
        return out

    def ids_of(self, words: list[bytes]) -> list[bytes | None]:
        out: list[bytes | None] = []
        for r in self.ranks(words).tolist():
            out.append(None if r < 0 else self.memory[self.flat + self.ends[r] : self.flat + self.ends[r + 1]])
        return out


_LEXICONS: dict[str, Lexicon] = {}


def with_lexicon(path: str, name: str, compiled: bytes) -> Coder:
    c = coder(ByteCoder, path)
    if name not in _LEXICONS:
        _LEXICONS.clear()
        _LEXICONS[name] = Lexicon(compiled)
    c.lexicon = _LEXICONS[name]
    return c


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(ByteCoder, path)
        pieces: Counter = Counter()

        def out() -> pa.RecordBatch:
            words, times = Counter(), iter(pieces.values())
            n = next(times)
            for w in c.cut(list(pieces))[0]:
                if w == c.close:
                    n = next(times, 0)
                else:
                    words[w] += n
            return pa.RecordBatch.from_arrays([pa.array([w.encode() for w in words], pa.binary()), pa.array(list(words.values()), pa.int64())], names=["word", "n"])

        for part in batches:
            for text in part.column(0).to_pylist():
                cut = c.pieces(text) if text else ()
                if not isinstance(cut, bytes):
                    pieces.update(cut)
                if len(pieces) > 1_000_000:
                    yield out()
                    pieces.clear()
        if pieces:
            yield out()

    return run


def word_counts(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """How often each word (as the vocabulary cuts texts) stands in all texts."""
    ship(docs.sparkSession)
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_count(path), "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, words: int) -> DataFrame:
    """Some ``words`` of the most frequent words, told by a filter: nothing is sorted or cut by task.

    Words are counted by steps of an eighth of a power of two of their frequency, some five
    hundred at most. All above a step stay, and of the step that would be too many a part by hash.
    """
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    left = words
    for row in sizes:
        if row["count"] > left:
            some = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(left / row["count"] * (1 << 20))
            return counts.where((step > row["step"]) | ((step == row["step"]) & some))
        left -= row["count"]
    return counts


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", words: int = WORDS) -> bytes:
    """The lexicon of the most frequent words, about as many as asked for whatever the number of tasks."""
    counts = written(word_counts(docs, path, text_col).where(F.length("word") <= LONG), "lexicon-words")
    kept = [bytes(r["word"]) for r in frequent_words(counts, words).select("word").collect()]
    return compile_lexicon(dict(zip(kept, coder(ByteCoder, path).merger.merge(kept), strict=True)))


def _encode(path: str, lexicon, name: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = with_lexicon(path, name, lexicon.value)
        for part in batches:
            for a in range(0, part.num_rows, 1024):
                piece = part.slice(a, 1024)
                ids = list(c.encode(piece.column("text").to_pylist()))
                columns, names = [piece.column("carry"), pa.array(ids, pa.binary())], ["carry", "ids"]
                if decode:
                    columns, names = [*columns, pa.array(c.decode_many(ids), pa.string())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", words: int = WORDS, decode: bool = False) -> DataFrame:
    """``carry`` (all other columns), ``ids`` (unsigned 32-bit little-endian) and, if asked for, ``decoded``."""
    spark = docs.sparkSession
    ship(spark)
    compiled = build_lexicon(docs, path, text_col, words)
    shared = spark.sparkContext.broadcast(compiled)
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("carry"), F.col(text_col).alias("text"))
    schema = f"carry {rows.schema['carry'].dataType.simpleString()}, ids binary" + (", decoded string" if decode else "")
    return rows.mapInArrow(_encode(path, shared, hashlib.md5(compiled).hexdigest(), decode), schema)
