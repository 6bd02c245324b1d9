"""Loads in the order of what they need."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.lookup import ForeignKey, LookupSpec
from rowferry.plans.load import LoadFailed, current_target, load_chain, load_graph
from rowferry.plans.progress import is_complete
from rowferry.plans.spec import TableLoad

TS = "2024-01-01 00:00:00"
SCHEMA = T.StructType([T.StructField("code", T.StringType()), T.StructField("id", T.LongType()), T.StructField("up", T.LongType())])


def load(name, data, priority, needs=(), up=None, **kwargs):
    source = lambda s: s.createDataFrame(data, "code string, id long, ref string")
    drop = lambda df: df.select("code", "id", "up" if up else F.lit(None).cast("long").alias("up"))
    fks = (ForeignKey("ref", up, "up"),) if up else ()
    return TableLoad(name, source, ("code",), SCHEMA, drop, priority=priority, depends_on=needs, foreign_keys=fks, lookup=LookupSpec(name), **kwargs)


def plan(**bad):
    return [
        load("a", [("x", 1, ""), ("y", 2, "")], 1),
        load("b", [("p", 10, "x"), ("q", 11, "nowhere")], 2, up="a"),
        load("c", [("r", 20, "y")], 2, up="a", **bad),
        load("d", [("s", 30, "p")], 3, needs=("a",), up="b"),
        load("e", [("t", 40, "r")], 3, up="c"),
    ]


def test_a_graph_loads_what_the_chain_loads(spark, root):
    chain = load_chain(spark, f"{root}/chain", plan(), TS)
    graph = load_graph(spark, f"{root}/graph", plan(), TS)
    strip = lambda results: [(r.table_id, r.action, r.inserted, r.target_rows) for r in results]
    assert strip(graph) == strip(chain)
    for name in "abcde":
        both = [rows(current_target(spark, f"{root}/{way}", name, SCHEMA)) for way in ("chain", "graph")]
        assert both[0] == both[1]
    assert rows(current_target(spark, f"{root}/graph", "b", SCHEMA)) == [("p", 10, 1), ("q", 11, None)]
    assert {r.action for r in load_graph(spark, f"{root}/graph", plan(), TS)} == {"skip"}


def test_what_needs_a_failed_load_does_not_run(spark, root):
    bad = plan(mode="upsert", options={"condition": "no such column"})
    with pytest.raises(LoadFailed, match=r"(?s)^c: .*not loaded: c, e$"):
        load_graph(spark, root, bad, TS, at_once=2)
    assert [is_complete(spark, root, name) for name in "abcde"] == [True, True, False, True, False]
