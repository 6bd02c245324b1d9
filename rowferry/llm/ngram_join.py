"""N-gram Jaccard join by parity sketches.

The shingles of a document are its distinct runs of five words. Two sets ``A`` and ``B``
of Jaccard similarity 0.8 or more differ in at most ``(|A| + |B|) / 9`` shingles.

* Parity sketch: the shingles of a set are dealt over ``m`` chunks, and each chunk is the
  XOR of the 64-bit hashes of its shingles. A shingle that only one set has changes one
  chunk, so the number of unequal chunks (the Hamming distance over chunks) is at most the
  symmetric difference.
* Size bands: sets of 2^k to 2^(k+1) shingles share a band, sets around each border a
  second one, and every band has the one ``m`` that its largest pair needs. Of more than
  ``D`` chunks that are not empty at least one is equal in both sets of a linked pair
  (pigeonhole). A set with fewer filled chunks also joins with twice the chunks, until it
  has more; a pair of such sets meets there.
* Prefilter: of a linked set at least 0.8 of the shingles stand in another document. A
  count-min sketch over a fixed part of all shingles counts too high only, so sets with too
  many lone shingles have no link and leave before the join.
* Equal sets become one class first. A group of equal chunks is known by its smallest member
  (the hub). Each class is compared exactly with the first hub it meets, and with that one only;
  what links has one label from then on.
* Bit sketches: each class also has ``2^j`` bits, nine or more for each shingle that a linked set
  may differ in, and a shingle flips one of them. The Hamming distance is no more than the
  symmetric difference, so a linked pair has ``9 * distance <= |A| + |B|``. Halves of a longer
  sketch are XORed until both are of one length.
* Where members of one hub still have different labels, those outside its largest label are
  compared with the others by their bit sketches, in blocks. A group all of whose members met
  one earlier hub is not looked at again. Pairs that pass are compared exactly: first the nearest
  few of each class, then of each class and label, then, with the labels these leave, all pairs
  that still differ. A round that left no pair out is the last one, and labels are taken anew only
  where a round found a link.
  So no link between different labels is lost, and most pairs are never built.
* Every link is verified over the whole shingle sets (of 64-bit hashes).

Defined cases: null and empty texts, and texts of white space, have an empty set and link
with nothing; fewer words than five make one shingle; repeated rows link as equal
texts do; where one ``doc_id`` names several sets, each row has the component of its own set; a null ``doc_id`` gets its ``n_shingles``, links with nothing and has a null
component; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm import countmin
from rowferry.llm.common import LANES, bucket_of, has_rows, hasher, mix, ship, signed, span_hash, written
from rowferry.llm.components import components

WORDS = 5
SAME = 80  # links need 100 * intersection >= SAME * union
PART = np.uint64(int(0.3 * 2**64))  # the part of all shingle hashes that is sketched
FLUSH = 1 << 21
OTHERS = 256  # sets that are compared with a hub's at once
UNIT, SKETCHES = 1024, 2048  # bit sketches of a block: those that ask, and those asked
NEAREST = 3  # pairs of a class, then of a class and a label, that are verified before the labels are taken anew


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    w = text.encode().lower().split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    return np.unique(span_hash(hasher().hashes(w)[0], min(words, len(w))) + np.uint64(min(words, len(w))))


def _sketch(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, held = [], 0
        for part in batches:
            for text in part.column(0).to_pylist():
                s = shingle_set(text)
                s = s[: np.searchsorted(s, PART)]
                keys.append(s)
                held += len(s)
                if held >= FLUSH:
                    yield from countmin.partial(np.concatenate(keys), bits)
                    keys, held = [], 0
        if held:
            yield from countmin.partial(np.concatenate(keys), bits)

    return run


SETS = "doc_id long, n long, c1 long, c2 long, shingles binary"


def _sets(sketch):
    """A row for each document: size and class of its set, and the set if it may have a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for part in batches:
            n, c1, c2, blobs = [], [], [], []
            for text in part.column("text").to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                if not len(s):
                    c1.append(None), c2.append(None), blobs.append(None)
                    continue
                with np.errstate(over="ignore"):
                    c1.append(int(np.sum(mix(s), dtype=np.uint64).view(np.int64)))
                    c2.append(int(np.sum(mix(s ^ LANES[1]), dtype=np.uint64).view(np.int64)))
                seen = s[: np.searchsorted(s, PART)]
                lone = int((~countmin.repeated(bits, seen)).sum())
                blobs.append(s.tobytes() if 100 * lone <= (100 - SAME) * len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(c1, pa.int64()), pa.array(c2, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "n", "c1", "c2", "shingles"],
            )

    return run


def _families(n: int) -> list[tuple[int, int]]:
    """The bands a set of ``n`` shingles joins in, each with the most shingles a linked pair differs in."""
    k = n.bit_length() - 1
    low, high = 1 << k, (1 << (k + 1)) - 1
    out = [(2 * k, 2 * high * (100 - SAME) // (100 + SAME))]
    if 100 * n >= SAME * (high + 1):  # with sets of the band above
        out.append((2 * k + 1, high * (100 - SAME) // SAME))
    if k and SAME * n <= 100 * (low - 1):  # with sets of the band below
        out.append((2 * k - 1, (low - 1) * (100 - SAME) // SAME))
    return out


def signatures(s: np.ndarray) -> np.ndarray:
    """The filled chunks of the parity sketches of a set, one hash each."""
    out = []
    for family, most in _families(len(s)):
        spread, m = mix(s ^ np.uint64(family + 1)), most * 27 // 20 + 1 + (most > 0)
        while True:
            chunk = bucket_of(spread, m)
            order = np.argsort(chunk, kind="stable")
            ids, at = np.unique(chunk[order], return_index=True)
            parity = np.bitwise_xor.reduceat(spread[order], at)
            out.append(mix(parity ^ mix(ids + np.uint64((family << 32) + (m << 40)))))
            if len(ids) > most:
                break
            m *= 2
    return np.concatenate(out)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        keys, blobs = part.column("key").to_pylist(), part.column("shingles").to_pylist()
        for a in range(0, len(keys), 256):
            sigs = [signatures(np.frombuffer(b, np.uint64)) for b in blobs[a : a + 256]]
            owner = np.repeat(np.array(keys[a : a + 256], np.int64), [len(x) for x in sigs])
            yield pa.RecordBatch.from_arrays([pa.array(signed(np.concatenate(sigs))), pa.array(owner)], names=["sig", "key"])


class _Sets:
    """Shingle sets side by side, to count the intersections of one set with all of them."""

    def __init__(self, blobs: list[bytes]):
        sets = [np.frombuffer(b, np.uint64) for b in blobs]
        self.n = np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate(sets)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], np.repeat(np.arange(len(sets)), self.n)[order]

    def overlap(self, s: np.ndarray) -> np.ndarray:
        a, b = np.searchsorted(self.tokens, s), np.searchsorted(self.tokens, s, side="right")
        take = b - a
        total = int(take.sum())
        at = np.repeat(a - np.cumsum(take) + take, take) + np.arange(total)
        return np.bincount(self.owner[at], minlength=len(self.n))


def bit_sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the shingles over 2^j places, in words of 64 bits; j follows from the size."""
    j = max(6, len(s).bit_length() + 1)
    place = mix(s ^ LANES[0]) >> np.uint64(64 - j)
    flags = (np.bincount(place.astype(np.int64), minlength=1 << j) & 1).astype(np.uint8)
    return np.packbits(flags).view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one a row) of ``words`` words: neighbouring places become one, so a distance can only fall."""
    while sketches.shape[1] > words:
        bits = np.unpackbits(sketches.view(np.uint8), axis=1)
        sketches = np.packbits(bits[:, ::2] ^ bits[:, 1::2], axis=1).view(np.uint64)
    return sketches


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        sets = [np.frombuffer(x, np.uint64) for x in part.column("shingles").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([bit_sketch(s).tobytes() for s in sets], pa.binary())],
            names=["key", "n", "bits"],
        )


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])
NEAR = pa.schema([*LINK, ("cut", pa.bool_())])


def _star(members: pa.Table, head: pa.Table) -> pa.Table:
    """The members that link with the hub."""
    if not members.num_rows or not head.num_rows:
        return LINK.empty_table()
    s = np.frombuffer(head.column("hub_shingles")[0].as_py(), np.uint64)
    others = _Sets(members.column("shingles").to_pylist())
    both = others.overlap(s)
    linked = 100 * both >= SAME * (others.n + len(s) - both)
    return pa.Table.from_arrays([members.column("hub").filter(pa.array(linked)), members.column("key").filter(pa.array(linked))], schema=LINK)


def _near(nearest: int | None, each_label: bool):
    """Pairs of one block whose labels differ and whose sketches allow a link: ``nearest`` of each asking class, or of it and each label, or all.

    ``cut`` tells that the asking class has more.
    """

    def run(group: pa.Table) -> pa.Table:
        unit = np.array(group.column("unit").to_pylist(), bool)
        keys, label, n = (np.array(group.column(c).to_pylist(), np.int64) for c in ("key", "label", "n"))
        blobs = group.column("bits").to_pylist()
        words = np.array([len(b) // 8 for b in blobs])
        out: list[np.ndarray] = []
        cut: list[bool] = []
        # sets of a linked pair differ by less than half, so their sketches are of one length or of two next to each other
        for width in np.unique(words[unit]):
            asking = np.nonzero(unit & (words == width))[0]
            for size in (width // 2, width, 2 * width):
                asked = np.nonzero(~unit & (words == size))[0]
                if not len(asked):
                    continue
                common = int(min(width, size))
                ours = folded(np.frombuffer(b"".join(blobs[i] for i in asking), np.uint64).reshape(-1, width), common)
                theirs = folded(np.frombuffer(b"".join(blobs[i] for i in asked), np.uint64).reshape(-1, size), common)
                for i, bits in zip(asking, ours, strict=True):
                    may = np.nonzero(label[asked] != label[i])[0]
                    far = np.bitwise_count(theirs[may] ^ bits).sum(axis=1, dtype=np.int64)
                    fits = (100 + SAME) * far <= (100 - SAME) * (n[asked[may]] + n[i])
                    to, far = asked[may[fits]], far[fits]
                    fit = len(to)
                    if nearest is not None and len(to) > nearest:
                        lab = label[to] if each_label else np.zeros(len(to), np.int64)
                        order = np.lexsort((keys[to], far, lab))
                        lab = lab[order]
                        first = np.searchsorted(lab, lab)
                        to = to[order[np.arange(len(lab)) - first < nearest]]
                    if len(to):
                        out.append(np.stack([np.full(len(to), keys[i]), keys[to]]))
                        cut += [len(to) < fit] * len(to)
        found = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
        return pa.Table.from_arrays([pa.array(found.min(axis=0)), pa.array(found.max(axis=0)), pa.array(cut, pa.bool_())], schema=NEAR)

    return run


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs ``(hub, key)`` that link. A set is fetched once for each pair, the hub's once for each block of its members."""
    sizes = written(pairs.groupBy("hub").agg(F.ceil(F.count("*") / OTHERS).cast("int").alias("blocks")), f"{name}-sizes")
    heads = (
        sizes.join(sets.withColumnRenamed("key", "hub"), "hub")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("hub", "block", F.col("shingles").alias("hub_shingles"))
    )
    dealt = pairs.join(sizes, "hub").withColumn("block", F.pmod(F.xxhash64("key"), "blocks").cast("int"))
    dealt = dealt.join(sets, "key").select("hub", "block", "key", "shingles")
    links = dealt.groupBy("hub", "block").cogroup(heads.groupBy("hub", "block")).applyInArrow(_star, "a long, b long")
    return written(links, f"{name}-links")


def _unsettled(met: DataFrame, labels: DataFrame, sketches: DataFrame, nearest: int | None, each_label: bool, name: str) -> DataFrame:
    """Pairs that share a hub, differ in their labels and may link by their sketches; ``cut`` where one of the pair has more.

    ``met`` has a row for each class with the hubs it meets. Two classes with one first hub are compared below
    that one, so below a later hub neither the members of one label nor those of one first hub need it.
    """
    one = met.join(labels.withColumnRenamed("node", "key"), "key", "left")
    rows = one.select(F.explode("hubs").alias("hub"), "key", "first", F.coalesce("label", "key").alias("label"))
    sums = rows.groupBy("hub").agg(
        F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi"), F.min("first").alias("lo_first"), F.max("first").alias("hi_first")
    )
    open_ = sums.where("lo <> hi and (lo_first <> hi_first or lo_first = hub)").select("hub", "n")
    rows = written(rows.join(open_, "hub"), f"{name}-open")

    def largest(by: str, part: DataFrame) -> DataFrame:
        groups = part.groupBy("hub", by).agg(F.count("*").alias("m"))
        return groups.groupBy("hub").agg(F.max(F.struct("m", by)).alias("m")).select("hub", F.col("m.m").alias(f"n_{by}"), F.col(f"m.{by}").alias(f"main_{by}"))

    main = largest("label", rows).join(largest("first", rows.where("first <> hub")), "hub", "left")
    main = main.join(rows.select("hub", "n").distinct(), "hub")
    settled = F.greatest("n_label", F.coalesce("n_first", F.lit(0)))
    main = main.select(
        "hub", "main_label", F.when(F.col("n_first") > F.col("n_label"), F.col("main_first")).alias("main_first"),
        F.greatest(F.lit(1), F.ceil((F.col("n") - settled) / UNIT)).cast("int").alias("units"), F.ceil(F.col("n") / SKETCHES).cast("int").alias("rests"),
    )
    rows = rows.drop("n").join(written(main, f"{name}-main"), "hub")
    base = F.when(F.col("main_first").isNotNull(), F.col("first") == F.col("main_first")).otherwise(F.col("label") == F.col("main_label"))
    units = rows.where(~base).select(
        "hub", "key", "label", F.lit(True).alias("unit"),
        F.pmod(F.xxhash64("key"), "units").cast("int").alias("u"), F.explode(F.sequence(F.lit(0), F.col("rests") - 1)).alias("r"),
    )
    others = rows.select(
        "hub", "key", "label", F.lit(False).alias("unit"),
        F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("u"), F.pmod(F.xxhash64("key"), "rests").cast("int").alias("r"),
    )
    blocks = units.union(others).join(sketches, "key")
    near = blocks.groupBy("hub", "u", "r").applyInArrow(_near(nearest, each_label), "a long, b long, cut boolean")
    return written(near.groupBy(F.col("a").alias("hub"), F.col("b").alias("key")).agg(F.max("cut").alias("cut")), f"{name}-near")


def linked_labels(sets: DataFrame) -> DataFrame:
    """``(key, shingles)``, one row a class, to ``(node, label)``: the smallest class that each linked one reaches."""
    sigs = written(sets.mapInArrow(_emit, "sig long, key long"), "ngram-signatures")
    hubs = written(sigs.groupBy("sig").agg(F.min("key").alias("hub"), F.count("*").alias("n")).where("n > 1").select("sig", "hub"), "ngram-hubs")
    met = sigs.join(hubs, "sig").groupBy("key").agg(F.collect_set("hub").alias("hubs"))
    met = written(met.withColumn("first", F.array_min("hubs")), "ngram-met")
    links = _verified(met.where("first <> key").select(F.col("first").alias("hub"), "key"), sets, "ngram-first")
    labels = components(links, "ngram-first-labels")
    sketches = written(sets.join(met.select("key"), "key", "left_semi").mapInArrow(_sketches, "key long, n long, bits binary"), "ngram-sketches")
    for name, nearest, each_label in (("ngram-few", NEAREST, False), ("ngram-each", NEAREST, True), ("ngram-rest", None, True)):
        pairs = _unsettled(met, labels, sketches, nearest, each_label, name)
        if not has_rows(pairs):
            break
        found = _verified(pairs.select("hub", "key"), sets, name)
        if has_rows(found):
            links = links.union(found)
            labels = components(links, f"{name}-labels")
        if not has_rows(pairs.where("cut")):
            break
    return labels


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = countmin.BITS) -> DataFrame:
    """One row a document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest id that links reach)."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = rows.select("text").mapInArrow(_sketch(bits), countmin.SCHEMA)
    sketch = spark.sparkContext.broadcast(countmin.merged(parts, bits))
    found = written(rows.mapInArrow(_sets(sketch), SETS), "ngram-sets")
    sketch.destroy()
    known = found.where("doc_id is not null and n > 0")
    # classes of equal sets are numbered in the order of their smallest documents; a document may be that of several
    least = written(known.groupBy("c1", "c2").agg(F.min("doc_id").alias("least")), "ngram-least")
    classes = written(least.orderBy("least", "c1", "c2").withColumn("key", F.monotonically_increasing_id()), "ngram-classes")
    one = classes.select(F.col("least").alias("doc_id"), "c1", "c2", "key")
    held = known.where("shingles is not null").select("doc_id", "c1", "c2", "shingles").join(one, ["doc_id", "c1", "c2"])
    sets = written(held.dropDuplicates(["key"]).select("key", "shingles"), "ngram-classsets")
    labels = linked_labels(sets).withColumnRenamed("node", "key")
    # the least number of a component is that of its smallest document
    first = classes.select(F.col("key").alias("label"), F.col("least").alias("first"))
    labels = labels.join(first, "label").select("key", "first")
    named = written(classes.join(labels, "key", "left").select("c1", "c2", F.coalesce("first", "least").alias("component_id")), "ngram-named")
    return found.join(named, ["c1", "c2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )
