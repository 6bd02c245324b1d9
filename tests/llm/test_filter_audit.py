"""The filter audit against a plain loop over documents and orders."""

import random
import re
from itertools import permutations

from rowferry.llm import filter_audit

COLUMNS = "doc_id long, text string, lang string, part string, row long, good int"  # names the operator uses itself
SPACE = re.compile("[\x20\x09-\x0d]+")


def made():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        ws = [rng.choice(vocabulary[: rng.choice((20, 300))]) for _ in range(rng.choice((0, 199, 200, 201, 400)))]
        if i % 3 == 0:
            ws.append("ABC" * 60)
        if i % 4 == 0:
            ws.append("a&b")
        rows.append((i, rng.choice((" ", "\t", "\n ", "\x0b")).join(ws), rng.choice(("en", "de", None, "")), "p", 1, 0))
    rows += [(100 + i, rows[7][1], "en", "p", 1, 0) for i in range(30)]  # copies
    rows += [(200, None, "en", None, None, None), (201, "", None, None, None, None), (None, rows[7][1], "de", None, None, None)]
    rows += [(None, "ÀÉ   A", "fr", None, None, None), (7, rows[7][1], "en", None, None, None), (205, "w " * 50_000, "fr", None, None, None)]
    rows += [(None, f"null id {i}", None, None, None, None) for i in range(20)]
    return rows


LABELS = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 120, 2)] + [(100, 1, 1), (100, 0, None), (None, 1, 1), (103, None, 1), (999, 1, 1)]


def failed(rows):
    least = {}
    for r in rows:
        if r[0] is not None:
            least[r[1] or ""] = min(r[0], least.get(r[1] or "", r[0]))
    out = []
    for r in rows:
        t = r[1] or ""
        ws = [w for w in SPACE.split(t) if w]
        bad = {
            "A": len(ws) < 200,
            "B": 100 * len(set(ws)) < 50 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": r[0] is not None and r[0] > least[t],
        }
        out.append({k for k, v in bad.items() if v})
    return out


def expected(rows, labels):
    fails = failed(rows)
    good, toxic = {x[0] for x in labels if x[1] == 1}, {x[0] for x in labels if x[2] == 1}
    want, shapley = {}, {}
    for part in {r[2] or "" for r in rows}:
        mine = [(f, r[0] is not None and r[0] in good, r[0] is not None and r[0] in toxic) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                redundant = sum(f in x[0] for x in mine) - len(gone)
                left = [x for x in left if f not in x[0]]
                unique = sum(x[0] == {f} for x in mine)
                want[part, order, step] = [len(left), len(gone), redundant, unique, sum(x[1] for x in gone), sum(x[2] for x in gone)]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in want.items()}


def test_audit_against_a_plain_loop(spark):
    rows = made()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    out = filter_audit.audit(docs, labels)
    found = {(r["part"], r["filter_order"], r["step"]): tuple(r[3:]) for r in out.collect()}
    assert found == expected(rows, LABELS)
    assert len(found) == 4 * 600
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_survivors_are_rows(spark):
    rows = made()
    docs = spark.createDataFrame(rows, COLUMNS).repartition(5)
    judged = filter_audit.judged(docs, spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"))
    tables = filter_audit.failing(judged, "ABCDE")
    fails = failed(rows)
    for order in ("EBD", "A", ""):
        want = sorted(str(r[0]) for r, f in zip(rows, fails, strict=True) if not f & set(order))
        assert sorted(str(r["doc_id"]) for r in filter_audit.surviving(judged, tables, order).collect()) == want


def test_no_documents_no_rows(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert filter_audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect() == []


def static_joins(df):
    """Kind of join, keys and type, as planned before anything has run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [(kind, re.sub(r"#\d+L?", "", keys), how) for kind, keys, how in re.findall(r"(\w+Join) \[([^\]]*)\], \[[^\]]*\], (\w+)", plan)]


def test_ids_are_not_broadcast(spark, monkeypatch):
    """The files of small tables look small; what is made of them grows with the documents and stays out of the driver."""
    planned, keep = {}, filter_audit.written

    def seen(df, name):
        planned[name] = static_joins(df)
        return keep(df, name)

    monkeypatch.setattr(filter_audit, "written", seen)
    docs = spark.createDataFrame(made(), COLUMNS).repartition(5)
    labels = keep(spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int"), "labels")  # files, as a small table has them
    filter_audit.audit(docs, labels)
    hot = [("BroadcastHashJoin", "h1, h2", "Inner"), ("BroadcastHashJoin", "h1, h2", "LeftOuter")]  # fewer than HOT_SHARE texts
    merged = [("SortMergeJoin", "h1, h2", "Inner"), ("SortMergeJoin", "row", "LeftOuter"), ("SortMergeJoin", "who", "LeftOuter")]
    assert sorted(planned["audit-judged"]) == hot + merged
    assert set(planned["audit-removed"]) == {("SortMergeJoin", "row, before", "LeftAnti")}
    assert set(planned["audit-redundant"]) == {("SortMergeJoin", "row, before", "LeftSemi")}


def test_survivors_without_broadcasts(spark):
    rows = spark.range(9).selectExpr("id AS row", "'en' AS part", "false AS good", "false AS toxic", "id % 2 = 0 AS A", "id % 3 = 0 AS B")
    tables = filter_audit.failing(rows, "AB")
    left = filter_audit.surviving(rows, tables, "BA")
    assert static_joins(left) == [("SortMergeJoin", "row", "LeftAnti")] * 2
    assert sorted(r["row"] for r in left.collect()) == [1, 5, 7]
