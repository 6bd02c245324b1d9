"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

1. A rotation is learned on a bounded sample (``SAMPLE`` vectors, by hash) so that the
   signs of the rotated coordinates are balanced and lose as little as they can (ITQ).
2. Every vector is coded. A code has ``tables`` parts of ``bits`` bits; each part is an entry
   of one Hamming table. A vector looks up each part and its neighbours at distance one. How
   often a bit of a pair at the threshold differs follows from the length of the sample's
   vectors without their mean: a strong common mean leaves little, and the same cosine is
   then a wide angle. ``plan`` takes from that share the bits with the least work for the
   rows, and as many tables as meet ``RECALL`` of such pairs, at every size. A pair counts in
   the first table that meets it, so none comes twice.
3. Pairs whose codes differ in more bits than a pair at the threshold does, by ``SIGMAS``
   standard deviations, leave; all others are reranked with the original vectors, by cosine
   in double precision.

Equal vectors of a label are one class before all that, so thousands of copies are one row.
Linked are only pairs at or above the threshold; the tables can miss a pair, see the README
for the measured recall.

Defined cases: a vector that is null, empty or zero, or holds a null or non-finite
component, and one with a null label or null id, links with nothing; vectors of different
length do not link; repeated rows link with each other and count each other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import ship, written
from rowferry.llm.components import components

SAMPLE = 4096
SIMILAR = 0.98
ROUNDS = 30
RECALL = 0.995
SIGMAS = 5
LEAST_TABLES, LEAST_BITS, MOST_BITS = 4, 10, 28


def _down(x: np.ndarray) -> np.ndarray:
    """Vectors over a power of two each, so that their squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=-1, keepdims=True))[1])


def flip_share(sample: np.ndarray, mean: np.ndarray) -> float:
    """How often a bit differs between vectors at the threshold, for unit vectors like the shorter ones of the sample."""
    left = np.quantile(np.linalg.norm(sample - mean, axis=1), 0.1) if len(sample) else 1.0
    half = math.sqrt((1 - SIMILAR) / 2)
    return 2 * math.asin(min(1.0, half / max(left, 1e-9))) / math.pi


def plan(rows: int, flips: float, bits: int | None = None) -> tuple[int, int]:
    """Bits of a part and number of tables that meet ``RECALL`` of the pairs at the threshold with the least work."""

    def tables(b: int) -> int:
        met = (1 - flips) ** b + b * flips * (1 - flips) ** (b - 1)
        return max(LEAST_TABLES, math.ceil(math.log(1 - RECALL) / math.log(max(1e-12, 1 - met))) if met < 1 else LEAST_TABLES)

    def work(b: int) -> float:  # entries asked for, and other rows met by chance
        return tables(b) * (b + 1) * (1 + rows / 2 ** (b + 1))

    best = bits or min(range(LEAST_BITS, MOST_BITS + 1), key=work)
    return best, tables(best)


def learn_rotation(sample: np.ndarray, bits: int, seed: int = 7, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Mean and a matrix from coordinates to ``bits`` balanced bits."""
    dim = sample.shape[1]
    mean, out, rng = sample.mean(axis=0), [], np.random.default_rng(seed)
    values, vectors = np.linalg.eigh(np.cov((sample - mean).T) + 1e-12 * np.eye(dim)) if len(sample) > 1 else (None, np.eye(dim))
    while sum(m.shape[1] for m in out) < bits:
        width = min(dim, bits - sum(m.shape[1] for m in out))
        basis = vectors[:, ::-1][:, :width]
        v = (sample - mean) @ basis
        rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
        for _ in range(rounds):
            u, _, w = np.linalg.svd(np.where(v @ rotation >= 0, 1.0, -1.0).T @ v)
            rotation = (u @ w).T
        out.append(basis @ rotation)
    return mean, np.concatenate(out, axis=1)


def _code(models, bits: int, tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, mean, matrix = models.value
        weights = 1 << np.arange(bits, dtype=np.int64)
        for part in batches:
            vectors = part.column("embedding").to_pylist()
            codes = [None] * len(vectors)
            lengths: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                lengths.setdefault(len(v), []).append(i)
            for n, at in lengths.items():
                x = _down(np.array([vectors[i] for i in at], np.float64))
                x /= np.linalg.norm(x, axis=1)[:, None]
                if n == dim:
                    y = (x - mean) @ matrix
                else:  # a length apart from the rest: signs of a fixed random projection
                    y = x @ np.random.default_rng(n).standard_normal((n, bits * tables))
                parts = ((y >= 0).reshape(len(at), tables, bits) * weights).sum(axis=2)
                for i, row in zip(at, parts.tolist(), strict=True):
                    codes[i] = row
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("part"), pa.array(codes, pa.list_(pa.int64()))], names=["key", "part", "code"]
            )

    return run


def _cosines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in batches:
        a = np.array(part.column("va").to_pylist(), dtype=object)
        b = part.column("vb").to_pylist()
        cos = np.empty(len(b))
        for i, (x, y) in enumerate(zip(a, b, strict=True)):
            x, y = _down(np.array(x, np.float64)), _down(np.array(y, np.float64))
            cos[i] = x @ y / math.sqrt(float(x @ x) * float(y @ y))
        keep = pa.array(cos >= SIMILAR)
        yield pa.RecordBatch.from_arrays([part.column("a").filter(keep), part.column("b").filter(keep)], names=["a", "b"])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", bits: int | None = None) -> DataFrame:
    """One row a vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    spark = vectors.sparkSession
    ship(spark)
    v = F.col("embedding")
    sound = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    )
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"), F.col(label_col).alias("label")
    ).withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = rows.select(
        "vec_id", "embedding", F.xxhash64("label", F.size("embedding")).alias("part"), "sound",
        F.when(F.col("sound"), F.xxhash64("label", "embedding")).alias("c1"), F.when(F.col("sound"), F.xxhash64("embedding", "label", F.lit(1))).alias("c2"),
    )
    known = rows.where("sound")
    classes = written(
        known.groupBy("c1", "c2").agg(F.min("vec_id").alias("key"), F.count("*").alias("copies"), F.first("part").alias("part"), F.first("embedding").alias("embedding")),
        "embedding-classes",
    )
    n = classes.count()
    sample = classes.orderBy(F.xxhash64("c1", F.lit("itq"))).limit(SAMPLE).select("embedding").collect()
    dims = [len(r["embedding"]) for r in sample]
    dim = max(sorted(set(dims)), key=dims.count) if dims else 1
    x = _down(np.array([r["embedding"] for r in sample if len(r["embedding"]) == dim], np.float64)) if dims else np.eye(2, 1)
    x /= np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    flips = flip_share(x, x.mean(axis=0))
    bits, tables = plan(n, flips, bits)
    most = bits * tables * flips + SIGMAS * math.sqrt(bits * tables * flips * (1 - flips))
    model = spark.sparkContext.broadcast((dim, *learn_rotation(x, bits * tables)))
    coded = written(classes.select("key", "part", "embedding").mapInArrow(_code(model, bits, tables), "key long, part long, code array<long>"), "embedding-codes")

    place = F.posexplode("code").alias("t", "sub")
    entries = coded.select("key", "part", "code", place)
    near = F.concat(F.array("sub"), F.transform(F.array(*(F.lit(1 << i) for i in range(bits))), lambda m: F.col("sub").bitwiseXOR(m)))
    asked = entries.select(F.col("key").alias("a"), "part", F.col("code").alias("ca"), "t", F.explode(near).alias("sub"))
    stored = entries.select(F.col("key").alias("b"), "part", F.col("code").alias("cb"), "t", "sub")
    # bits that differ, by table; no table before this one met the pair
    apart = F.zip_with("ca", "cb", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    first = F.expr("forall(slice(apart, 1, t), d -> d > 1)")
    close = F.aggregate("apart", F.lit(0), lambda s, d: s + d) <= F.lit(most)
    met = asked.join(stored, ["part", "t", "sub"]).where("a < b").withColumn("apart", apart).where(first & close).select("a", "b")
    met = written(met, "embedding-pairs")
    held = classes.select("key", "embedding")
    pairs = met.join(held.select(F.col("key").alias("a"), F.col("embedding").alias("va")), "a")
    pairs = pairs.join(held.select(F.col("key").alias("b"), F.col("embedding").alias("vb")), "b")
    links = written(pairs.select("a", "b", "va", "vb").mapInArrow(_cosines, "a long, b long"), "embedding-links")

    labels = components(links, "embedding").withColumnRenamed("node", "key")
    sizes = classes.select("key", "copies")
    both = links.union(links.select("b", "a"))
    beside = both.join(sizes.select(F.col("key").alias("b"), "copies"), "b").groupBy(F.col("a").alias("key")).agg(F.sum("copies").alias("others"))
    named = classes.select("c1", "c2", "key", "copies").join(labels, "key", "left").join(beside, "key", "left")
    named = written(
        named.select("c1", "c2", F.coalesce("label", "key").alias("component"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")), "embedding-named"
    )
    return rows.select("vec_id", "c1", "c2").join(named, ["c1", "c2"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component", "vec_id"), F.lit(False)).alias("kept"),
    )
