"""Phrase counts and collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowferry.llm import collocations

COLUMNS = "doc_id long, text string, lang string, phrase string, a long, rank int"  # names the operator uses itself
LEAST = 5


def made(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(12)] + ["Éa", "ß", "x\x00y", "it's"]
    rows = []
    for i in range(120):
        ws = [rng.choice(vocabulary[: rng.choice((3, 16))]) for _ in range(rng.choice((0, 1, 3, 50, 90)))]
        text = "".join(w + rng.choice((" ", " ", " ", "\t ", ", ", ".", "\n", "\x0b", "; ")) for w in ws)
        rows.append((i, text, rng.choice(("en", "de", None)), "p", 1, 2))
    rows += [(500 + i, "one hot leaf of text again and again", "en", "p", 1, 2) for i in range(40)]
    rows += [(0, rows[5][1], "en", None, None, None)] * 3 + [(None, None, "en", None, None, None), (7, "", None, None, None, None), (8, " . \n", "fr", None, None, None)]
    rows += [(600, "aa " * 20_000, "es", None, None, None), (601, "bb cc", "it", None, None, None)]
    return rows


def counted(rows):
    f, n = defaultdict(Counter), Counter()
    for r in rows:
        lang = r[2] if r[2] is not None else "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")):
            ws = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(ws)
            for m in range(1, 5):
                for i in range(len(ws) - m + 1):
                    f[lang][" ".join(ws[i : i + m])] += 1
    return f, n


def expected(rows, least, top, covered=80):
    f, n = counted(rows)
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        inside = {}
        for p, a in often.items():
            ws = p.split(" ")
            for m in range(2, len(ws)):
                for i in range(len(ws) - m + 1):
                    q = " ".join(ws[i : i + m])
                    inside[q] = max(inside.get(q, 0), a)
        scored = []
        for p, a in often.items():
            ws = p.split(" ")
            if len(ws) > 1 and 100 * inside.get(p, 0) < covered * a:
                cuts = [(2000000 * a // (counts[x] + counts[y]), k, counts[x], counts[y]) for k in range(1, len(ws)) for x, y in [(" ".join(ws[:k]), " ".join(ws[k:]))]]
                score, _, left, right = min(cuts)
                scored.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize(("budget", "top"), [(1 << 19, 2000), (60, 25)])  # one group; or groups divided to the last depth
def test_collocations_against_plain_counting(spark, budget, top, monkeypatch):
    rows = made()
    if budget < 100:
        monkeypatch.setattr(collocations, "CHUNK", 64)
        monkeypatch.setattr(collocations, "BLOCK", 500)
        monkeypatch.setattr(collocations, "BUDGET", 10)
    docs = spark.createDataFrame(rows, COLUMNS).repartition(3)
    out = collocations.collocations(docs, LEAST, top, budget=budget)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in out.collect()) == expected(rows, LEAST, top)


def test_all_phrase_counts(spark):
    rows = made(5)
    nodes, totals = collocations.phrase_counts(spark.createDataFrame(rows, COLUMNS), LEAST, 100)
    f, n = counted(rows)
    assert {(r["lang"], r["phrase"]): r["n"] for r in nodes.collect()} == {(k, p): a for k, c in f.items() for p, a in c.items() if a >= LEAST}
    assert {r["lang"]: r["n"] for r in totals.collect()} == {k: v for k, v in n.items() if v}


def test_no_texts_no_phrases(spark):
    assert collocations.collocations(spark.createDataFrame([], COLUMNS)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, "en", "", 1, 1), (2, "a b", "en", "", 1, 1)], COLUMNS)).collect() == []


def test_products_beyond_64_bits(spark):
    a, rest = 9_000_000_000_000_000_000, 9_100_000_000_000_000_000
    nodes = spark.createDataFrame([("en", "x", 1, rest), ("en", "y", 1, rest), ("en", "x y", 2, a)], "lang string, phrase string, depth int, n long")
    totals = spark.createDataFrame([("en", rest)], "lang string, n long")
    keep, collocations.phrase_counts = collocations.phrase_counts, lambda *_: (nodes, totals)
    try:
        (row,) = collocations.collocations(nodes).collect()
    finally:
        collocations.phrase_counts = keep
    assert (row["score"], row["l"], row["r"]) == (2000000 * a // (2 * rest), rest, rest)


def test_slots_are_those_of_spark(spark):
    block = collocations._Block()
    words = ["a", "é", "a long word of more than thirty two bytes".replace(" ", "-"), "x" * 100]
    for lang in ("en", ""):
        block.add(lang, "  ".join(words).encode())
    block.close()
    df = spark.createDataFrame([(block.langs[k], w) for k, w in zip(block.of.tolist(), block.words.to_pylist(), strict=True) if w], "lang string, word string")
    want = [r[0] for r in df.select(F.xxhash64("lang", "word")).collect()]
    assert block.hashes()[1:].view(np.int64).tolist() == want
    assert {w for w in block.words.to_pylist() if w} == {*words, "."}
