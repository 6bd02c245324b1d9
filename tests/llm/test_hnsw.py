"""Nearest neighbours of the graphs against brute force."""

import numpy as np
import pytest

from rowferry.llm import hnsw
from rowferry.llm.queries import QUERIES

COLUMNS = "vec_id long, embedding array<double>, shard int, query long, score string"  # names the operator uses itself


def brute(rows, asked, k):
    able = [r for r in rows if r[0] is not None and r[1] and None not in r[1] and np.isfinite(r[1]).all() and np.any(r[1])]
    out = []
    for q in (r for r in able if asked(r[0])):
        found, own = [], False
        for r in able:
            if len(r[1]) != len(q[1]):
                continue
            if not own and r[0] == q[0] and r[1] == q[1]:
                own = True
                continue
            found.append((float(hnsw.euclidean(np.array(r[1]), np.array(q[1])[None])[0]), r[0]))
        out += [(q[0], i, vec, score) for i, (score, vec) in enumerate(sorted(found)[:k], 1)]
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist(), 1, 2, "x") for i in range(150)]
    rows += [(1000 + i, rows[4][1], 1, 2, "x") for i in range(40)]  # copies, more than k
    rows += [(10, rows[10][1], 1, 2, "x"), (20, rows[30][1], 1, 2, "x")]  # a repeated row, a repeated id
    odd = [None, [], [0.0] * 8, [float("nan")] * 8, [1.0, None] + [2.0] * 6, [float("inf")] * 8]
    rows += [(2000 + 10 * i, v, 1, 2, "x") for i, v in enumerate(odd)] + [(None, rows[0][1], 1, 2, "x")]
    rows += [(3000 + 10 * i, v, 1, 2, "x") for i, v in enumerate([[1.0, 2.0], [2.0, 1.0], [-0.0, 3.0], [0.0, 3.0]])]
    rows += [(4000, [1e200] * 5, 1, 2, "x"), (4010, [1.5e200] * 5, 1, 2, "x"), (4020, [1e-200] * 5, 1, 2, "x"), (4030, [-1e308] * 5, 1, 2, "x"), (4040, [1e308] * 5, 1, 2, "x")]
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    for shard_rows in (1 << 14, 40):
        out = hnsw.nearest(df, df.where("vec_id % 10 = 0"), k=10, shard_rows=shard_rows)
        assert out.columns == ["query_id", "rank", "vec_id", "score"]
        found = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out.collect())
        want = sorted(brute(rows, lambda i: i % 10 == 0, 10))
        assert [f[:3] for f in found] == [w[:3] for w in want]
        assert [f[3] for f in found] == pytest.approx([w[3] for w in want], rel=1e-12)
    assert hnsw.nearest(df.where("false"), df.where("false")).collect() == []


@pytest.mark.parametrize("kind", ["even", "clusters", "far mean", "line"])
def test_recall_of_a_graph(kind):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 32))
    if kind == "clusters":
        x = rng.standard_normal((8, 32))[rng.integers(0, 8, 4000)] * 6 + 0.05 * x
    elif kind == "far mean":
        x += 1000
    elif kind == "line":
        x = np.linspace(0, 1, 4000)[:, None] * np.ones(32) + 1e-4 * x
    graph, order = hnsw.Graph.build(x)
    assert sorted(order.tolist()) == list(range(4000))
    queries = np.arange(0, 4000, 50)
    found = graph.search(x[queries])
    hit = 0
    for q, nodes in zip(queries, found, strict=True):
        best = np.argsort(((x - x[q]) ** 2).sum(axis=1))[:11]
        hit += len(set(best) & set(order[nodes[nodes >= 0]]))
    assert hit >= 0.97 * 11 * len(queries)
    for layer, links in enumerate(graph.links):  # flat arrays: neighbours in the layer, none twice, not the node itself
        for node, own in enumerate(links):
            own = own[own >= 0].tolist()
            assert len(own) == len(set(own)) and node not in own and all(0 <= i < len(links) for i in own), (layer, node)


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {w[:1] + w[2:3] for w in brute(rows, lambda i: i % 100 == 0, 10)}
    found = QUERIES["op11_nearest_neighbours"](spark, sf).collect()
    assert len(found) == len(want)
    assert sum((r["query_id"], r["vec_id"]) in want for r in found) >= 0.95 * len(want)
