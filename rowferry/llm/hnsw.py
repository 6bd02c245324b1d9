"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

1. Equal vectors are one node that carries its ``k + 1`` least ids (cut by task first), so a
   vector that a third of all rows share is one node, and its nearest ids stay exact.
2. Nodes are dealt over shards by a hash; a shard holds some ``SHARD_ROWS`` nodes or
   ``SHARD_BYTES`` of vectors, whatever the table holds. Every node is indexed.
3. A task builds the graph of a shard. Nodes are ordered by their level, highest first, so
   layer l is a prefix of them, and its neighbours are one flat array with a fixed number of
   places a node. Nodes are inserted in lots that double: each lot is searched against the
   graph so far and among itself, keeps neighbours that are nearer to it than to each other,
   and is linked back. Graphs are stored as rows of flat arrays.
4. Queries, in slices of ``SLICE`` rows, go to every shard; a task reads a graph, then streams
   a slice past it. Beams of ``ef`` nodes are kept, and their distances taken again in double
   precision on the original vectors. The results of the shards are merged.

The graph finds most neighbours, not all: recall is measured in the tests and the README.
Distances are exact.

Defined cases: a row whose id is null, or whose vector is null, empty, zero, or holds a null or
non-finite component, takes no part; vectors of different length are no candidates of each
other; of repeated rows each asks for itself, and only one row with the query's id and vector
is left out of its own result; equal distances rank by id; a distance beyond a double is
infinite; fewer candidates than ``k`` give fewer rows, an empty table none; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import ship, written

SHARD_ROWS = 1 << 14
SHARD_BYTES = 1 << 26
SLICE = 1 << 16
M = 16
EF_BUILD = 100
EF = 200
EF_ABOVE = 8
LOT = 512
OPEN = 4  # nodes of a beam that are opened at once


def _scaled(*vectors: np.ndarray) -> list[np.ndarray]:
    """The vectors over one power of two, so that squares neither vanish nor overflow."""
    most = max((float(np.abs(v).max()) for v in vectors if v.size), default=1.0)
    if 1e-100 < most < 1e100 or not most:
        return list(vectors)
    down = -(math.frexp(most)[1] - 1)
    return [np.ldexp(v, down) for v in vectors]


class Graph:
    """Nodes in order of level and for each layer the flat neighbours of its nodes; -1 is an empty place."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray]):
        self.vectors, self.links = vectors, links

    @classmethod
    def build(cls, vectors: np.ndarray, m: int = M, ef: int = EF_BUILD, seed: int = 11) -> tuple[Graph, np.ndarray]:
        """The graph, and which vector each node is."""
        n = len(vectors)
        draw = np.random.default_rng(seed).random(n)
        level = np.floor(-np.log(1 - draw) / math.log(m)).astype(np.int64)
        order = np.argsort(-level, kind="stable")
        level = level[order]
        layers = [int((level >= k).sum()) for k in range(int(level[0]) + 1)]
        links = [np.full((rows, 2 * m if k == 0 else m), -1, np.int32) for k, rows in enumerate(layers)]
        self = cls(_scaled(vectors[order])[0], links)
        at = 1
        while at < n:
            end = min(n, at + min(at, LOT), layers[level[at]])
            self._insert(at, end, int(level[at]), layers, m, ef)
            at = end
        return cls(vectors[order], links), order

    def _distances(self, q: np.ndarray, ids: np.ndarray) -> np.ndarray:
        apart = self.vectors[ids] - q
        return np.einsum("nd,nd->n", apart, apart)

    def _beam(self, q: np.ndarray, entry: np.ndarray, layer: int, ef: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``ef`` nearest nodes met from ``entry`` in a layer, nearest first: ids and squared distances."""
        rows, links = len(q), self.links[layer]
        mark = np.zeros((rows, nodes), np.int16)  # 0: not met
        ids, dist, done = np.full((rows, ef), -1, np.int32), np.full((rows, ef), np.inf), np.ones((rows, ef), bool)
        live, near = np.arange(rows), entry
        while True:
            # nodes met for the first time, once each
            r, c = np.nonzero(near >= 0)
            node = near[r, c]
            new = mark[live[r], node] == 0
            r, c, node = r[new], c[new], node[new]
            mark[live[r], node] = c + 1
            new = mark[live[r], node] == c + 1
            r, c, node = r[new], c[new], node[new]
            d = self._distances(q[live[r]], node)
            new = d < dist[live[r], -1]
            r, c, node, d = r[new], c[new], node[new], d[new]
            touched, r = np.unique(r, return_inverse=True)
            if len(touched):
                at = live[touched]
                first = np.concatenate([[True], r[1:] != r[:-1]])
                place = np.arange(len(r)) - np.maximum.accumulate(np.where(first, np.arange(len(r)), 0))
                width = int(place.max()) + 1
                more_d, more = np.full((len(at), width), np.inf), np.full((len(at), width), -1, np.int32)
                more_d[r, place], more[r, place] = d, node
                all_d = np.concatenate([dist[at], more_d], axis=1)
                keep = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
                dist[at] = np.take_along_axis(all_d, keep, 1)
                ids[at] = np.take_along_axis(np.concatenate([ids[at], more], axis=1), keep, 1)
                done[at] = np.take_along_axis(np.concatenate([done[at], more < 0], axis=1), keep, 1)
            live = np.nonzero(~done.all(axis=1))[0]
            if not len(live):
                return ids, dist
            pick = np.argsort(done[live], axis=1, kind="stable")[:, :OPEN]  # the nearest that are not done
            chosen = np.where(np.take_along_axis(done[live], pick, 1), -1, np.take_along_axis(ids[live], pick, 1))
            done[live[:, None], pick] = True
            near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)

    def _select(self, ids: np.ndarray, dist: np.ndarray, m: int) -> np.ndarray:
        """Of candidates, nearest first, those nearer to the node than to any chosen before; then the nearest others."""
        out = np.full((len(ids), m), -1, np.int32)
        step = max(1, (1 << 21) // (ids.shape[1] * max(ids.shape[1], self.vectors.shape[1])))
        for a in range(0, len(ids), step):
            some, d = ids[a : a + step], dist[a : a + step]
            v = self.vectors[some]
            norm = np.einsum("rcd,rcd->rc", v, v)
            between = norm[:, :, None] + norm[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
            least, taken = np.full(d.shape, np.inf), np.zeros(d.shape, bool)
            count = np.zeros(len(some), np.int64)
            for c in range(d.shape[1]):
                yes = (d[:, c] < least[:, c]) & (count < m) & np.isfinite(d[:, c])
                taken[:, c] = yes
                count += yes
                np.minimum(least, between[:, c], out=least, where=yes[:, None])
            rank = np.argsort(np.where(np.isfinite(d), ~taken, 2), axis=1, kind="stable")[:, :m]
            found = np.where(np.isfinite(np.take_along_axis(d, rank, 1)), np.take_along_axis(some, rank, 1), -1)
            out[a : a + step, : found.shape[1]] = found
        return out

    def _insert(self, at: int, end: int, level: int, layers: list[int], m: int, ef: int) -> None:
        """Nodes ``at`` to ``end``, all of one level."""
        q = self.vectors[at:end]
        entry = np.zeros((end - at, 1), np.int32)
        norm = np.einsum("nd,nd->n", q, q)
        apart = np.maximum(norm[:, None] + norm - 2 * (q @ q.T), 0)
        np.fill_diagonal(apart, np.inf)
        peers = np.argsort(apart, axis=1, kind="stable")[:, : 2 * m]
        peer_d = np.take_along_axis(apart, peers, 1)
        for layer in range(len(layers) - 1, -1, -1):
            above = layer > level
            ids, dist = self._beam(q, entry, layer, EF_ABOVE if above else ef, layers[layer] if above else at)
            entry = ids
            if above:
                continue
            d = np.concatenate([dist, peer_d], axis=1)
            rank = np.argsort(d, axis=1, kind="stable")[:, : 4 * m]
            chosen = self._select(
                np.take_along_axis(np.concatenate([ids, (peers + at).astype(np.int32)], axis=1), rank, 1), np.take_along_axis(d, rank, 1), m
            )
            self.links[layer][at:end, :m] = chosen
            r, c = np.nonzero(chosen >= 0)
            self._link_back(layer, chosen[r, c], (r + at).astype(np.int32))

    def _link_back(self, layer: int, nodes: np.ndarray, new: np.ndarray) -> None:
        links = self.links[layer]
        width = links.shape[1]
        known = (links[nodes] == new[:, None]).any(axis=1)
        nodes, new = nodes[~known], new[~known]
        d = self._distances(self.vectors[nodes], new)
        order = np.lexsort((d, nodes))
        nodes, new, d = nodes[order], new[order], d[order]
        first = np.concatenate([[True], nodes[1:] != nodes[:-1]]) if len(nodes) else np.zeros(0, bool)
        place = np.arange(len(nodes)) - np.maximum.accumulate(np.where(first, np.arange(len(nodes)), 0))
        near = place < width
        nodes, new, d, place, first = nodes[near], new[near], d[near], place[near], first[near]
        heads = nodes[first]
        row = np.cumsum(first) - 1
        ids = np.concatenate([links[heads], np.full((len(heads), width), -1, np.int32)], axis=1)
        ids[row, width + place] = new
        dist = np.full(ids.shape, np.inf)
        r, c = np.nonzero(ids >= 0)
        dist[r, c] = self._distances(self.vectors[heads[r]], ids[r, c])
        rank = np.argsort(dist, axis=1, kind="stable")
        ids, dist = np.take_along_axis(ids, rank, 1), np.take_along_axis(dist, rank, 1)
        full = np.isfinite(dist[:, width])
        links[heads[~full]] = ids[~full, :width]
        if full.any():
            links[heads[full]] = self._select(ids[full], dist[full], width)

    def search(self, q: np.ndarray, ef: int = EF) -> np.ndarray:
        """The nodes of the final beam of each query, -1 where there are fewer."""
        scaled, q = _scaled(self.vectors, q)
        own = Graph(scaled, self.links) if scaled is not self.vectors else self
        entry = np.zeros((len(q), 1), np.int32)
        for layer in range(len(self.links) - 1, 0, -1):
            entry = own._beam(q, entry, layer, EF_ABOVE, len(self.links[layer]))[0]
        return own._beam(q, entry, 0, ef, len(self.vectors))[0]


def euclidean(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances along the last axis, in double precision."""
    with np.errstate(over="ignore", invalid="ignore"):
        apart = a - b
        most = np.abs(apart).max(axis=-1)
        plain = np.sqrt((apart * apart).sum(axis=-1))
        odd = (most > 1e150) | ((most < 1e-150) & (most > 0))
        if odd.any():
            part = apart[odd] / most[odd][:, None]
            plain[odd] = np.where(np.isinf(most[odd]), np.inf, np.sqrt((part * part).sum(axis=-1)) * most[odd])
    return plain


SHARD = "shard int, dim int, vectors binary, ids binary, ends binary, links array<binary>"


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by shard and length; one shard is held at a time."""
    key, vectors, ids = None, [], []

    def out():
        x = np.concatenate(vectors).reshape(-1, key[1])
        graph, order = Graph.build(x)
        lists = [ids[i] for i in order]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([graph.vectors.tobytes()], pa.binary()),
                pa.array([np.array([i for one in lists for i in one], np.int64).tobytes()], pa.binary()),
                pa.array([np.cumsum([len(one) for one in lists], dtype=np.int64).tobytes()], pa.binary()),
                pa.array([[x.tobytes() for x in graph.links]], pa.list_(pa.binary())),
            ],
            names=["shard", "dim", "vectors", "ids", "ends", "links"],
        )

    for part in batches:
        columns = (part.column(c) for c in ("shard", "dim", "embedding", "ids"))
        shard, dim, embedding, lists = columns
        keys = list(zip(shard.to_pylist(), dim.to_pylist(), strict=True))
        at = 0
        while at < len(keys):
            end = at + 1
            while end < len(keys) and keys[end] == keys[at]:
                end += 1
            if keys[at] != key:
                if key:
                    yield out()
                key, vectors, ids = keys[at], [], []
            vectors.append(embedding.slice(at, end - at).flatten().to_numpy().astype(np.float64))
            ids += lists.slice(at, end - at).to_pylist()
            at = end
    if key:
        yield out()


FOUND = "query long, query_id long, vec_id long, score double"


class _Stored:
    """A stored shard, opened for search."""

    def __init__(self, dim: int, vectors: bytes, ids: bytes, ends: bytes, links: list[bytes], m: int = M):
        x = np.frombuffer(vectors, np.float64).reshape(-1, dim)
        self.graph = Graph(x, [np.frombuffer(b, np.int32).reshape(-1, m if k else 2 * m) for k, b in enumerate(links)])
        self.ids, self.ends = np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int64)

    def nearest(self, own: int, q: np.ndarray, nodes: np.ndarray, k: int) -> list[tuple[float, int]]:
        nodes = nodes[nodes >= 0]
        x = self.graph.vectors[nodes]
        score = euclidean(x, q)
        same = (x == q).all(axis=1)
        order = np.argsort(score, kind="stable")
        out: list[tuple[float, int]] = []
        for i in order.tolist():
            if len(out) >= k and score[i] > out[-1][0]:
                break
            at = nodes[i]
            ids = self.ids[self.ends[at - 1] if at else 0 : self.ends[at]].tolist()
            if same[i] and own in ids:
                ids.remove(own)
            out += [(float(score[i]), x) for x in ids]
        return sorted(out)[:k]


def _search(k: int, ef: int):
    """Rows come sorted by shard, length and slice, the graph before its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("vectors", "ids", "ends", "links", "query", "query_id", "embedding")
        stored, key = None, None
        for part in batches:
            keys = list(zip(*(part.column(c).to_pylist() for c in ("shard", "dim", "slice")), strict=True))
            columns = {c: part.column(c) for c in names}
            asked: list[int] = []

            def answer(asked):
                if not asked or not stored:
                    return None
                x = columns["embedding"].take(pa.array(asked)).flatten().to_numpy().astype(np.float64).reshape(len(asked), -1)
                step, out = max(1, min(256, (1 << 22) // (ef * x.shape[1]))), []
                for a in range(0, len(x), step):
                    for i, q, nodes in zip(asked[a : a + step], x[a : a + step], stored.graph.search(x[a : a + step], ef), strict=True):
                        query, own = columns["query"][i].as_py(), columns["query_id"][i].as_py()
                        out += [(query, own, vec, score) for score, vec in stored.nearest(own, q, nodes, k)]
                return pa.RecordBatch.from_pydict(
                    dict(zip(("query", "query_id", "vec_id", "score"), map(list, zip(*out, strict=True)), strict=True)) if out else {"query": [], "query_id": [], "vec_id": [], "score": []},
                    schema=pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]),
                )

            for i, at in enumerate(keys):
                if columns["vectors"][i].is_valid:
                    if found := answer(asked):
                        yield found
                    asked, key = [], at
                    stored = _Stored(at[1], *(columns[c][i].as_py() for c in names[:4]))
                elif at == key:
                    asked.append(i)
                else:  # no vector of this length in the shard
                    if found := answer(asked):
                        yield found
                    asked, key, stored = [], at, None
            if found := answer(asked):
                yield found

    return run


def sound(v: Column) -> Column:
    """Whether a vector of doubles takes part."""
    return F.coalesce(
        (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )


def index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The stored shards of ``vectors(vec_id, embedding)``, all sound, and their number."""
    keyed = vectors.select("vec_id", "embedding", F.xxhash64("embedding").alias("c1"), F.xxhash64(F.lit(1), "embedding").alias("c2"))
    least = F.row_number().over(Window.partitionBy("c1", "c2").orderBy("vec_id"))
    classes = keyed.withColumn("nth", least).where(F.col("nth") <= k + 1).groupBy("c1", "c2").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("embedding").alias("embedding")
    )
    classes = written(classes.withColumn("dim", F.size("embedding")), "hnsw-classes")
    rows, components = classes.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()
    shards = max(1, math.ceil(rows / shard_rows), math.ceil(8 * components / SHARD_BYTES))
    dealt = classes.withColumn("shard", F.pmod("c1", F.lit(shards)).cast("int")).repartitionById(shards, F.col("shard"))
    graphs = dealt.sortWithinPartitions("shard", "dim", "c1", "c2").select("shard", "dim", "embedding", "ids").mapInArrow(_shard, SHARD)
    return written(graphs, "hnsw-shards"), shards


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, ef: int = EF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The ``k`` nearest rows of each query row: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both frames hold ``vec_id`` and ``embedding``; a query leaves out one row with its id and vector.
    """
    spark = vectors.sparkSession
    ship(spark)

    def able(df: DataFrame) -> DataFrame:
        v = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0)  # no negative zero
        return df.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding")).where(F.col("vec_id").isNotNull() & sound(F.col("embedding")))

    graphs, shards = index(able(vectors), k, shard_rows)
    asked = written(able(queries).withColumn("query", F.monotonically_increasing_id()), "hnsw-queries")
    slices = max(1, math.ceil(asked.count() / SLICE))
    both = F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice")
    left = graphs.select("shard", "dim", both, "vectors", "ids", "ends", "links", *(F.lit(None).cast(t).alias(c) for c, t in (("query", "long"), ("query_id", "long"), ("embedding", "array<double>"))))
    right = asked.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.size("embedding").alias("dim"), F.pmod(F.xxhash64("query"), F.lit(slices)).cast("int").alias("slice"),
        *(F.lit(None).cast(t).alias(c) for c, t in (("vectors", "binary"), ("ids", "binary"), ("ends", "binary"), ("links", "array<binary>"))),
        "query", F.col("vec_id").alias("query_id"), "embedding",
    )
    tasks = shards * slices
    dealt = left.union(right).repartitionById(tasks, F.col("shard") * F.lit(slices) + F.col("slice"))
    found = dealt.sortWithinPartitions("shard", "slice", "dim", F.col("query").asc_nulls_first()).mapInArrow(_search(k, ef), FOUND)
    rank = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
