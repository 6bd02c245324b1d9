import pytest
from conftest import rows

from rowferry.functions import Columns
from rowferry.operators import quality


@pytest.fixture
def places(spark):
    return spark.createDataFrame([("b", 2), ("a", 1), (None, 3), ("c", None)], "code string, id int")


def test_profile(places):
    # A row without an id comes first in id order, so it is in the sample; its id prints as nothing.
    assert rows(quality.lookup_profile(places, "p", "code", "id")) == [("p", 4, 3, 3, "c,a,b", "1,2,3")]


def test_columns(places):
    assert rows(quality.table_columns({"p": places})) == [("p", 1, "code", "string", 4, 3), ("p", 2, "id", "int", 4, 3)]


def test_search(places):
    assert rows(quality.column_search({"p": places}, "COD")) == [("p", "code", 3, 3, "a", "c", "a,b,c")]
    with pytest.raises(ValueError, match="no column"):
        quality.column_search({"p": places}, "zzz")


def test_presence(places):
    got = rows(quality.table_presence(["p", "regions"], {"p": places, "regions_old": places}))
    assert got == [("p", True, 4, ""), ("regions", False, 0, "regions_old")]


def test_reconcile_counts(places):
    assert rows(quality.reconcile_counts(places, places.limit(1), "p")) == [("p", 4, 1, 3, False)]


def test_compare_keys(spark):
    ddl = "k int, a int, b int"
    source = [(1, 1, None), (2, 1, 2), (3, 1, 1), (4, None, 1), (None, 1, 1), (6, 1, 1), (6, 2, 2), (7, 1, 1), (7, 1, 1)]
    target = [(1, 1, None), (2, 1, 3), (4, 1, None), (5, 0, 0), (None, 1, 1), (6, 2, 2), (6, 1, 1), (7, 1, 1)]
    got = quality.compare_keys(spark.createDataFrame(source, ddl), spark.createDataFrame(target, ddl), ["k"])
    assert dict(tuple(r) for r in got.collect()) == {
        1: "same", 2: "different", 3: "missing", 4: "different", 5: "extra", None: "same", 6: "same", 7: "different",
    }


def test_rejects(spark):
    raw = spark.createDataFrame([("1", 1.0), ("x", None), ("", float("nan")), (None, 2.0)], "t string, n double")
    c = Columns(raw)
    got = rows(quality.rejects(raw, {"whole": ("t", c.integer("t")), "num": ("n", c.integer("n"))}))
    assert got == [("num", 3, 1), ("whole", 2, 1)]
