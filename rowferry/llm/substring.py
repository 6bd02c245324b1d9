"""Substring dedup: a count-min prefilter over word windows, then exact groups.

A window is ``width`` consecutive words of one document. A word goes when a window covers
it whose word sequence also starts anywhere else, in the same document or another.

1. Sketch. Each window has an anchor: of its runs of ``ANCHOR`` words the one with the
   least hash. Equal windows have equal anchors at equal places, so the number of anchor
   places with a run bounds the number of windows it anchors from above, and there are some
   fourteen windows to a place. Every partition counts its anchor places in a count-min
   sketch; the partial sketches are merged.
2. Candidates. Windows whose anchor the merged sketch saw once are unique and leave. The
   rest belong to blocks of whole documents (bounded bytes and rows), and each block lists
   each of its candidate windows once, as 128 bits, with one or "more".
3. Exact groups. Windows are grouped by their 128 bits; those of total two or more go back
   to the blocks that listed them. A passage that a third of all documents share is one row
   for each block, never one for each document.
4. Each block marks the words its repeated windows cover.

When the corpus outgrows the sketch, more windows go to the exact pass; none is lost.

Defined cases: a null or empty text has no words; a text shorter than a window keeps all
words; repeated rows are documents of their own, so each removes the other's windows; an
empty table gives an empty result; all other columns ride along untouched in ``carry``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowferry.llm import countmin
from rowferry.llm.common import hasher, ship, signed, sliding_min, span_hash, written

WIDTH = 35
ANCHOR = 8
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 512
FLUSH = 1 << 21


def _anchors(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the runs at the anchor places."""
    runs = span_hash(h, ANCHOR)
    per = width - ANCHOR + 1
    least = sliding_min(runs, per)
    # a place is an anchor if the greatest of the minima around it is its own run
    padded = np.concatenate([np.zeros(per - 1, np.uint64), least, np.zeros(per - 1, np.uint64)])
    most = ~sliding_min(~padded, per)
    return least, runs[most == runs]


def _sketch(width: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, keys, held = hasher(), [], 0
        for part in batches:
            for text in part.column(0).to_pylist():
                w = text.encode().split() if text else ()
                if len(w) < width:
                    continue
                found = _anchors(words.hashes(w)[0], width)[1]
                keys.append(found)
                held += len(found)
                if held >= FLUSH:
                    yield from countmin.partial(np.concatenate(keys), bits)
                    keys, held = [], 0
        if keys:
            yield from countmin.partial(np.concatenate(keys), bits)

    return run


def _windows(h1: np.ndarray, h2: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    return span_hash(h1, width, 0), span_hash(h2, width, 1)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _blocks(sketch, width: int, texts: bool):
    """One row a document, with its block; the text only where it is still needed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = hasher(), sketch.value
        base, block, size, rows = TaskContext.get().partitionId() << 32, 0, 0, 0
        for part in batches:
            ids, look, counts, digests, kept = [], [], [], [], []
            for text in part.column("text").to_pylist():
                data = text.encode() if text else b""
                w = data.split()
                candidate = False
                if len(w) >= width:
                    least = _anchors(words.hashes(w)[0], width)[0]
                    # windows side by side mostly share their anchor
                    first = np.concatenate([[True], least[1:] != least[:-1]])
                    candidate = bool(countmin.repeated(bits, least[first]).any())
                if rows >= BLOCK_ROWS or (size and size + len(data) > BLOCK_BYTES):
                    block, size, rows = block + 1, 0, 0
                rows += 1
                size += len(data) if candidate or texts else 0
                ids.append(base + block)
                look.append(candidate)
                counts.append(len(w))
                digests.append(None if candidate or texts else _digest(w))
                kept.append(text if candidate or texts else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("carry"), pa.array(ids, pa.int64()), pa.array(look, pa.bool_()), pa.array(counts, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(kept, pa.string())],
                names=["carry", "block", "candidate", "n_words", "kept_sha256", "text"],
            )

    return run


LISTED = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("block", pa.int64()), ("n", pa.int32())])


def _list(sketch, width: int):
    """The candidate windows of each block, once each."""

    def out(block: int, found: list) -> Iterator[pa.RecordBatch]:
        h1, h2 = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        new = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        at = np.nonzero(new)[0]
        n = np.minimum(np.diff(np.append(at, len(h1))), 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(signed(h1[at])), pa.array(signed(h2[at])), pa.array(np.full(len(at), block)), pa.array(n.astype(np.int32))], schema=LISTED
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = hasher(), sketch.value
        at, found = None, []
        for part in batches:
            for block, text in zip(part.column("block").to_pylist(), part.column("text").to_pylist(), strict=True):
                if block != at and found:
                    yield from out(at, found)
                    found = []
                at = block
                h1, h2 = words.hashes(text.encode().split())
                maybe = countmin.repeated(bits, _anchors(h1, width)[0])
                if maybe.any():
                    a, b = _windows(h1, h2, width)
                    found.append((a[maybe], b[maybe]))
        if found:
            yield from out(at, found)

    return run


def _covered(n: int, starts: np.ndarray, width: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge[:-1]) > 0


def _cut(width: int, texts: bool):
    def run(docs: pa.Table, windows: pa.Table) -> pa.Table:
        words = hasher()
        h1 = windows.column("h1").to_numpy().view(np.uint64)
        h2 = windows.column("h2").to_numpy().view(np.uint64)
        order = np.lexsort((h2, h1))
        h1, h2 = h1[order], h2[order]
        removed, digests, kept = [], [], []
        for text, look, digest in zip(*(docs.column(c).to_pylist() for c in ("text", "candidate", "kept_sha256")), strict=True):
            if not look:
                removed.append(0)
                digests.append(digest if digest else _digest(text.encode().split() if text else []))
                kept.append(text)
                continue
            w = text.encode().split()
            a, b = _windows(*words.hashes(w), width)
            at = np.searchsorted(h1, a)
            hit = np.zeros(len(a), bool)
            todo = np.nonzero(at < len(h1))[0]
            while len(todo):  # one step, but for windows that share the first half
                here = at[todo]
                same = h1[here] == a[todo]
                hit[todo] |= same & (h2[here] == b[todo])
                at[todo] += 1
                todo = todo[same & ~hit[todo] & (at[todo] < len(h1))]
            gone = _covered(len(w), np.nonzero(hit)[0], width)
            n = int(gone.sum())
            left = [x for x, g in zip(w, gone.tolist(), strict=True) if not g] if n else w
            removed.append(n)
            digests.append(_digest(left))
            kept.append(b" ".join(left).decode() if n else text)
        out = [docs.column("carry"), docs.column("n_words"), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
        names = ["carry", "n_words", "n_removed", "kept_sha256"]
        if texts:
            out, names = [*out, pa.array(kept, pa.string())], [*names, "text"]
        return pa.Table.from_arrays(out, names=names)

    return run


def remove_repeats(docs: DataFrame, text_col: str = "text", width: int = WIDTH, texts: bool = True, bits: int = countmin.BITS) -> DataFrame:
    """Cut every word that a repeated window covers.

    Returns ``carry`` (all columns but the text, as a struct), ``n_words``, ``n_removed``,
    ``kept_sha256`` and, unless ``texts`` is off, ``text``: the kept words joined by one
    space, or the text as it was where nothing went.
    """
    if width < ANCHOR:
        raise ValueError(f"a window needs {ANCHOR} words or more")
    spark = docs.sparkSession
    ship(spark)
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(_sketch(width, bits), countmin.SCHEMA)
    sketch = spark.sparkContext.broadcast(countmin.merged(parts, bits))
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in others)).alias("carry"), F.col(text_col).alias("text"))
    carry = rows.schema["carry"].dataType.simpleString()
    schema = f"carry {carry}, block long, candidate boolean, n_words long, kept_sha256 string, text string"
    blocks = written(rows.mapInArrow(_blocks(sketch, width, texts), schema), "repeats-blocks")
    listed = blocks.where("candidate").select("block", "text").mapInArrow(_list(sketch, width), "h1 long, h2 long, block long, n int")
    total = F.sum("n").over(Window.partitionBy("h1", "h2"))
    repeated = listed.withColumn("total", total).where("total > 1").select("block", "h1", "h2")
    out = f"carry {carry}, n_words long, n_removed long, kept_sha256 string" + (", text string" if texts else "")
    return blocks.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(_cut(width, texts), out)
