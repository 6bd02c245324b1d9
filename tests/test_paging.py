import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from rowferry.operators import paging


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")


@pytest.mark.parametrize("strategy", ["rownum", "offset"])
def test_pages_cover_the_table_once(orders, strategy):
    total = orders.count()
    seen = []
    for offset in range(0, total + 400, 400):
        seen += [r[0] for r in paging.page(orders, strategy, ["o_orderkey"], 400, offset=offset).collect()]
    assert seen == sorted(seen) and len(seen) == total == len(set(seen))


def test_keyset_over_a_composite_key(orders):
    keys = ["o_custkey", "o_orderkey"]
    seen, last = [], None
    while True:
        page = paging.page(orders, "cursor", keys, 400, last=last)
        got = [tuple(r) for r in page.select(*keys).collect()]
        if not got:
            break
        seen += got
        last = paging.last_key(page, keys).first()
        assert tuple(last) == got[-1]
    assert seen == sorted(tuple(r) for r in orders.select(*keys).collect())


def test_keyset_filter_reaches_the_scan(orders):
    last = orders.select(F.max("o_orderdate")).first()[0]
    page = paging.page_keyset(orders, ["o_orderdate", "o_orderkey"], 5, [last, 10])
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "GreaterThan(o_orderdate" in plan


def test_a_last_key_of_zero_or_empty_counts(spark):
    df = spark.createDataFrame([(0, ""), (1, "a")], "k int, c string")
    assert rows(paging.page_keyset(df, ["k"], 5, [0])) == [(1, "a")]
    assert rows(paging.page_keyset(df, ["c"], 5, [""])) == [(1, "a")]
    assert paging.last_key(df.where("k = 0"), ["k"]).first()[0] == 0
    assert paging.last_key(df.limit(0), ["k"]).first()[0] is None


def test_row_numbers(spark, orders):
    shuffled = orders.repartition(5, "o_custkey")
    numbered = paging.number_rows(shuffled, ["o_orderdate", "o_orderkey"], partitions=7)
    got = [(r["_rn"], r["o_orderkey"]) for r in numbered.orderBy("_rn").collect()]
    want = [r["o_orderkey"] for r in orders.orderBy("o_orderdate", "o_orderkey").collect()]
    assert got == list(enumerate(want, start=1))


def test_row_numbers_where_one_key_holds_most_rows(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 > 0 THEN 5 ELSE id END AS k", "id AS other")
    numbered = paging.number_rows(df, ["k"], partitions=8, unique_order=False)
    got = numbered.orderBy("_rn").collect()
    assert [r["_rn"] for r in got] == list(range(1, 3001))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    # The hot key is spread over more than one partition, so no task sorted it whole.
    placed = paging.place_rows(df, ["k"], partitions=8, unique_order=False)
    assert placed.where("k = 5").select("__part").distinct().count() > 3


@pytest.mark.parametrize("strategy", ["rownum", "offset"])
def test_pages_come_in_order_at_every_depth(orders, strategy):
    want = [r[0] for r in orders.orderBy("o_orderkey").collect()]
    for offset in (0, 700, len(want) - 20, len(want)):
        got = [r[0] for r in paging.page(orders, strategy, ["o_orderkey"], 50, offset=offset).collect()]
        assert got == want[offset : offset + 50]


def test_pages_over_an_order_with_ties_lose_and_repeat_nothing(spark):
    df = spark.range(60).selectExpr("id % 2 AS k", "nullif(id % 5, 0) AS other", "id").repartition(4, "id")
    want = [tuple(r) for r in df.orderBy("k", "other", "id").collect()]
    numbered = paging.number_rows(df, ["k"], partitions=4, unique_order=False)
    got = {"rownum": [], "offset": [], "cursor": []}
    last = None
    for offset in range(0, 60, 20):
        got["rownum"] += paging.page(numbered, "rownum", ["k"], 20, offset=offset).collect()
        got["offset"] += paging.page(df, "offset", ["k"], 20, offset=offset).collect()
        by_key = paging.page(df, "cursor", ["k"], 20, last=last)
        got["cursor"] += by_key.collect()
        last = paging.last_key(by_key, paging.total_order(df, ["k"])).first()
    for strategy, found in got.items():
        assert [tuple(r) for r in found] == want, strategy
    assert tuple(paging.page_cover(df, ["k"], 20, unique_order=False).first()) == (3, 3, 60, 0, 0)


def test_pages_too_large_for_a_task_are_numbered_over_ranges(orders, monkeypatch):
    monkeypatch.setattr(paging, "TOP_ROWS", 100)
    want = [tuple(r) for r in orders.orderBy("o_custkey", "o_orderkey", "o_orderdate").collect()]
    middle = want[699]
    pages = [
        (paging.page(orders, "offset", ["o_custkey"], 50, offset=700), 700, 50),
        (paging.page(orders, "offset", ["o_custkey"], 300, offset=600), 600, 300),
        (paging.page(orders, "rownum", ["o_custkey"], 300, offset=600), 600, 300),
        (paging.page(orders, "cursor", ["o_custkey"], 300), 0, 300),
        (paging.page(orders, "cursor", ["o_custkey"], 300, last=[middle[1], middle[0]]), 700, 300),
        (paging.page(orders, "offset", ["o_custkey"], 300, offset=len(want) - 10), len(want) - 10, 300),
    ]
    for page, offset, size in pages:
        got = [(r["o_orderkey"], r["o_custkey"], r["o_orderdate"]) for r in page.collect()]
        assert got == want[offset : offset + size]
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert size <= 100 or "TakeOrdered" not in plan and "Limit" not in plan
        assert f"limit={offset + size}" not in plan or offset == 0


def test_page_meta(spark):
    df = spark.range(25).toDF("k")
    assert tuple(paging.page_meta(df, ["k"], 10, [14]).first()) == (10, 24, False)
    assert tuple(paging.page_meta(df, ["k"], 10, [13]).first()) == (10, 23, True)
    assert tuple(paging.page_meta(df, ["k"], 10, [99]).first()) == (0, None, False)


def test_cover_report(spark):
    assert tuple(paging.page_cover(spark.range(25).toDF("k"), ["k"], 10).first()) == (3, 2, 25, 0, 0)


def test_bad_calls(orders):
    with pytest.raises(ValueError, match="unknown paging strategy"):
        paging.page(orders, "random", ["o_orderkey"], 5)
    with pytest.raises(ValueError, match="order columns"):
        paging.page(orders, "offset", [], 5)
    with pytest.raises(ValueError, match="NULL"):
        paging.page_keyset(orders, ["o_orderkey"], 5, [None])
