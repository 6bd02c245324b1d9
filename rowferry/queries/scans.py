"""Scans, pages, filters and counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.functions import contains_any
from rowferry.operators import paging
from rowferry.operators.quality import union_all
from rowferry.queries.registry import query, table
from rowferry.sources import ranges, tables

PAGE = 100


@query(
    "scan_project",
    "SELECT CAST(p_partkey AS VARCHAR) AS part_code, p_name AS part_name, p_brand AS brand, p_type AS part_type FROM part",
)
def scan_project(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("part_code"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("part_type"),
    )


@query(
    "lookup_set_scan",
    """SELECT 'region' AS lookup_name, CAST(r_regionkey AS BIGINT) AS id, r_name AS code FROM region
       UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation
       UNION ALL SELECT 'part_type', min(p_partkey), p_type FROM part GROUP BY p_type""",
)
def lookup_set_scan(spark, d):
    frames = {name: table(spark, d, name) for name in ("region", "nation", "part")}
    lookups = tables.run_statements(
        spark,
        {
            "region": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS code FROM {region}",
            "nation": "SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS code FROM {nation}",
            "part_type": "SELECT min(p_partkey) AS id, p_type AS code FROM {part} GROUP BY p_type",
        },
        **frames,
    )
    return union_all([df.select(F.lit(n).alias("lookup_name"), "id", "code") for n, df in lookups.items()])


@query(
    "scan_page_meta",
    f"""SELECT count(*) AS n_rows, max(o_orderkey) AS last_o_orderkey,
        (SELECT count(*) FROM orders) > {PAGE} AS has_more
        FROM (SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT {PAGE})""",
)
def scan_page_meta(spark, d):
    return paging.page_meta(table(spark, d, "orders"), ["o_orderkey"], PAGE)


@query("page_offset", f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {PAGE} OFFSET 300")
def page_offset(spark, d):
    return paging.page(table(spark, d, "orders"), "offset", ["o_orderkey"], PAGE, offset=300)


@query(
    "page_rownum",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders)
        WHERE rn > 200 AND rn <= 200 + {PAGE}""",
)
def page_rownum(spark, d):
    return paging.page(table(spark, d, "orders"), "rownum", ["o_orderkey"], PAGE, offset=200)


@query("page_keyset", f"SELECT * FROM orders WHERE o_orderkey > 499 ORDER BY o_orderkey LIMIT {PAGE}")
def page_keyset(spark, d):
    return paging.page(table(spark, d, "orders"), "cursor", ["o_orderkey"], PAGE, last=[499])


@query(
    "page_last_key",
    f"""SELECT max(o_orderkey) AS o_orderkey
        FROM (SELECT o_orderkey FROM orders WHERE o_orderkey > 499 ORDER BY o_orderkey LIMIT {PAGE})""",
)
def page_last_key(spark, d):
    return paging.last_key(page_keyset(spark, d), ["o_orderkey"])


def _deep(strategy):
    def run(spark, d):
        orders = table(spark, d, "orders")
        return paging.page(orders, strategy, ["o_orderkey"], PAGE, offset=orders.count() * 7 // 10)

    return run


# Past 100,000 rows at sf0.1.
for _strategy in ("offset", "rownum"):
    query(
        f"page_{_strategy}_deep",
        f"SELECT * FROM orders ORDER BY o_orderkey LIMIT {PAGE} OFFSET (SELECT count(*) * 7 // 10 FROM orders)",
    )(_deep(_strategy))


@query(
    "page_ties",
    """WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderstatus, o_orderkey) - 1 AS rn,
                       (SELECT count(*) // 3 + 1 FROM orders) AS size FROM orders)
       SELECT s.strategy, CAST(rn // size AS INTEGER) AS page, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
              CAST(sum(o_orderkey) AS BIGINT) AS key_sum
       FROM n, (VALUES ('rownum'), ('offset'), ('cursor')) s(strategy) GROUP BY ALL""",
)
def page_ties(spark, d):
    """Three pages over an order of three values, by each strategy: no row lost, none twice."""
    orders, order = table(spark, d, "orders"), ["o_orderstatus"]
    size = orders.count() // 3 + 1
    numbered = paging.number_rows(orders, order, unique_order=False)
    pages, last = [], None
    for i in range(3):
        by_key = paging.page(orders, "cursor", order, size, last=last)
        last = paging.last_key(by_key, paging.total_order(orders, order)).first()
        pages += [
            (i, "rownum", paging.page(numbered, "rownum", order, size, offset=i * size)),
            (i, "offset", paging.page(orders, "offset", order, size, offset=i * size)),
            (i, "cursor", by_key),
        ]
    marked = [df.select(F.lit(s).alias("strategy"), F.lit(i).alias("page"), "o_orderkey") for i, s, df in pages]
    return union_all(marked).groupBy("strategy", "page").agg(
        F.count("*").alias("n_rows"), F.countDistinct("o_orderkey").alias("n_keys"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "page_cover_check",
    f"""WITH n AS (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE} AS p FROM orders),
             g AS (SELECT p, count(*) AS n FROM n GROUP BY p)
        SELECT count(*) AS n_pages, count_if(n = {PAGE})::BIGINT AS full_pages, sum(n)::BIGINT AS rows_in_pages,
               (SELECT count(*) - count(DISTINCT o_orderkey) FROM n) AS repeated_keys,
               (SELECT count(*) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.o_orderkey = o.o_orderkey))
                 AS missing_keys
        FROM g""",
)
def page_cover_check(spark, d):
    return paging.page_cover(table(spark, d, "orders"), ["o_orderkey"], PAGE)


@query(
    "range_split_read",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)
       SELECT CASE WHEN o_orderkey >= lo + 3 * (hi - lo) // 4 THEN 3 WHEN o_orderkey >= lo + 2 * (hi - lo) // 4 THEN 2
                   WHEN o_orderkey >= lo + (hi - lo) // 4 THEN 1 ELSE 0 END AS _slice,
              count(*) AS n_rows, min(o_orderkey) AS least, max(o_orderkey) AS greatest
       FROM orders, b GROUP BY 1""",
)
def range_split_read(spark, d):
    orders = table(spark, d, "orders")
    split = ranges.read_by_predicates(orders, ranges.even_ranges(orders, "o_orderkey", 4))
    return split.groupBy("_slice").agg(
        F.count("*").alias("n_rows"), F.min("o_orderkey").alias("least"), F.max("o_orderkey").alias("greatest")
    )


COUNTED = ("region", "nation", "supplier", "customer", "part", "orders", "lineitem", "events")


@query(
    "row_count",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in COUNTED),
)
def row_count(spark, d):
    return union_all([tables.row_count(table(spark, d, t), t) for t in COUNTED])


@query(
    "param_date_range",
    """SELECT o_orderkey, o_custkey, o_orderdate FROM orders
       WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31'""",
)
def param_date_range(spark, d):
    return tables.run_query(
        spark,
        """SELECT o_orderkey, o_custkey, o_orderdate FROM {orders}
           WHERE o_orderdate >= to_timestamp_ntz(:start, :format) AND o_orderdate <= to_timestamp_ntz(:end, :format)""",
        {"start": "01-JANUARY-1997", "end": "31-DECEMBER-1998", "format": "dd-MMMM-yyyy"},
        orders=table(spark, d, "orders"),
    )


@query("sample_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20")
def sample_rows(spark, d):
    return tables.sample_rows(table(spark, d, "orders"), ["o_orderkey"], 20)


@query("sort_rows", "SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_name, p_partkey")
def sort_rows(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice").orderBy("p_name", "p_partkey")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def top_n(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@query("distinct_values", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_values(spark, d):
    return table(spark, d, "part").select("p_brand", "p_type").distinct()


@query(
    "filter_in_list",
    """SELECT p_partkey, p_brand, p_type FROM part
       WHERE p_type IN ('PROMO', 'ECONOMY', 'SMALL') AND p_brand NOT IN ('Brand#1', 'Brand#2')""",
)
def filter_in_list(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_type")
    return part.where(F.col("p_type").isin("PROMO", "ECONOMY", "SMALL") & ~F.col("p_brand").isin("Brand#1", "Brand#2"))


@query(
    "filter_like",
    "SELECT p_partkey, p_name FROM part WHERE upper(p_name) LIKE '%RING%' OR upper(p_name) LIKE '%BOLT%'",
)
def filter_like(spark, d):
    return table(spark, d, "part").select("p_partkey", "p_name").where(contains_any(F.col("p_name"), ["ring", "bolt"]))
