"""Joins and key resolution."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.joins import Dimension, join_dimensions, rows_with_match, rows_without_match
from rowferry.operators.lookup import (
    ForeignKey,
    LookupSpec,
    build_lookup,
    build_lookups,
    lookup_checks,
    resolve_code,
    resolve_codes,
)
from rowferry.operators.quality import fk_coverage, fk_unresolved, lookup_profile, union_all
from rowferry.queries.registry import query, table


@query(
    "join_inner",
    """SELECT o_orderkey, o_totalprice, c_name, c_mktsegment
       FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate >= TIMESTAMP '1998-01-01'""",
)
def join_inner(spark, d):
    orders = table(spark, d, "orders").where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    customer = table(spark, d, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_totalprice", "c_name", "c_mktsegment"
    )


@query(
    "join_left_lookup",
    """SELECT c_custkey, c_name, n_name AS nation_code FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey <> 2""",
)
def join_left_lookup(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = table(spark, d, "nation").where("n_regionkey <> 2")
    joined = join_dimensions(customer, [Dimension(nation, {"c_nationkey": "n_nationkey"}, {"n_name": "nation_code"})])
    return joined.drop("c_nationkey")


def _places(spark, d):
    nation = Dimension(
        table(spark, d, "nation"),
        {"c_nationkey": "n_nationkey"},
        {"n_name": "nation_code", "n_regionkey": "region_id"},
    )
    region = Dimension(table(spark, d, "region"), {"region_id": "r_regionkey"}, {"r_name": "region_code"})
    return [nation, region]


@query(
    "join_left_chain",
    """SELECT c_custkey, c_name, n_name AS nation_code, r_name AS region_code
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def join_left_chain(spark, d):
    joined = join_dimensions(table(spark, d, "customer"), _places(spark, d))
    return joined.select("c_custkey", "c_name", "nation_code", "region_code")


_STAR_SQL = """SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderstatus AS order_status, p_name AS part_name,
       s_name AS supplier_name, c_name AS customer_name, n_name AS nation_code, r_name AS region_code
FROM lineitem
LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey
LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey"""


@query("join_left_star", _STAR_SQL)
def join_left_star(spark, d):
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    dims = [
        Dimension(
            table(spark, d, "orders"),
            {"l_orderkey": "o_orderkey"},
            {"o_orderstatus": "order_status", "o_custkey": "o_custkey"},
        ),
        Dimension(table(spark, d, "part"), {"l_partkey": "p_partkey"}, {"p_name": "part_name"}),
        Dimension(table(spark, d, "supplier"), {"l_suppkey": "s_suppkey"}, {"s_name": "supplier_name"}),
        Dimension(
            table(spark, d, "customer"),
            {"o_custkey": "c_custkey"},
            {"c_name": "customer_name", "c_nationkey": "c_nationkey"},
        ),
        *_places(spark, d),
    ]
    return join_dimensions(facts, dims).drop("l_partkey", "l_suppkey", "o_custkey", "c_nationkey", "region_id")


@query(
    "join_semi",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def join_semi(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return rows_with_match(table(spark, d, "customer").select("c_custkey", "c_name"), big, ["c_custkey"], unique=True)


@query(
    "join_anti",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def join_anti(spark, d):
    big = table(spark, d, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return rows_without_match(table(spark, d, "customer").select("c_custkey", "c_name"), big, ["c_custkey"], unique=True)


@query(
    "join_optional",
    """SELECT doc_id, lang, quality, CAST(NULL AS VARCHAR) AS reviewer
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def join_optional(spark, d):
    available = {"labels": table(spark, d, "labels")}
    dims = [
        Dimension(available.get("labels"), {"doc_id": "doc_id"}, {"quality": "quality"}, {"quality": "int"}),
        Dimension(available.get("reviews"), {"doc_id": "doc_id"}, {"reviewer": "reviewer"}),
    ]
    return join_dimensions(table(spark, d, "documents").select("doc_id", "lang"), dims)


@query("lookup_build", "SELECT p_name AS code, max(p_partkey) AS id FROM part GROUP BY p_name")
def lookup_build(spark, d):
    return build_lookup(table(spark, d, "part"), "p_name", "p_partkey")


@query(
    "lookup_validate",
    """SELECT 'part' AS table_name, TRUE AS is_there, (SELECT count(p_name) > 0 FROM part) AS has_data, '' AS missing_columns
       UNION ALL SELECT 'orders', TRUE, FALSE, 'o_code'
       UNION ALL SELECT 'reviews', FALSE, FALSE, ''""",
)
def lookup_validate(spark, d):
    wanted = {
        "part": (table(spark, d, "part"), "p_name", "p_partkey"),
        "orders": (table(spark, d, "orders"), "o_code", "o_orderkey"),
        "reviews": (None, "code", "id"),
    }
    return lookup_checks(wanted)


# Codes as a source would carry them: mostly known, some unknown, some empty, some NULL.
NATION_CODE = """CASE CAST(c_custkey % 9 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'NOWHERE' WHEN 2 THEN CAST(NULL AS STRING)
 ELSE concat('NATION_', CAST(c_nationkey AS STRING)) END"""
_CODED_SQL = f"(SELECT c_custkey, c_mktsegment, {NATION_CODE} AS nation_code FROM customer)"
# The lookup lacks the nations of region 0, so that some real codes stay unresolved.
_NATIONS_SQL = "(SELECT n_name AS code, CAST(max(n_nationkey) AS BIGINT) AS id FROM nation WHERE n_regionkey > 0 GROUP BY n_name)"


def coded_customers(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_mktsegment", F.expr(NATION_CODE).alias("nation_code"))


def nation_lookup(spark, d):
    return build_lookup(table(spark, d, "nation").where("n_regionkey > 0"), "n_name", "n_nationkey")


FK_RESOLVE_SQL = f"""SELECT c.c_custkey, c.c_mktsegment, c.nation_code, n.id AS nation_id
FROM {_CODED_SQL} c LEFT JOIN {_NATIONS_SQL} n ON n.code = c.nation_code AND c.nation_code <> ''"""


@query("fk_resolve", FK_RESOLVE_SQL)
def fk_resolve(spark, d):
    return resolve_code(coded_customers(spark, d), "nation_code", nation_lookup(spark, d), "nation_id")


# The codes of an order, as SQL both engines read.
ORDER_CODES = {
    "customer_code": "concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0'))",
    "nation_code": """CASE CAST(o_orderkey % 8 AS INT) WHEN 0 THEN '' WHEN 1 THEN 'NOWHERE'
 ELSE concat('NATION_', CAST(o_orderkey % 30 AS STRING)) END""",
    "region_code": "CASE o_orderstatus WHEN 'P' THEN 'ASIA' WHEN 'F' THEN 'AFRICA' ELSE 'MOON' END",
}
_ORDER_CODES_SQL = ", ".join(f"{text} AS {name}" for name, text in ORDER_CODES.items())


def coded_orders(spark, d, *columns):
    codes = [F.expr(text).alias(name) for name, text in ORDER_CODES.items()]
    return table(spark, d, "orders").select("o_orderkey", *columns, *codes)


@query(
    "fk_resolve_multi",
    f"""SELECT o.o_orderkey, c.id AS customer_id, n.id AS nation_id, r.id AS region_id
        FROM (SELECT o_orderkey, {_ORDER_CODES_SQL} FROM orders) o
        LEFT JOIN (SELECT c_name AS code, max(c_custkey) AS id FROM customer GROUP BY c_name) c ON c.code = o.customer_code
        LEFT JOIN {_NATIONS_SQL} n ON n.code = o.nation_code
        LEFT JOIN (SELECT r_name AS code, CAST(r_regionkey AS BIGINT) AS id FROM region) r ON r.code = o.region_code""",
)
def fk_resolve_multi(spark, d):
    lookups = {
        "customer": build_lookup(table(spark, d, "customer"), "c_name", "c_custkey"),
        "nation": nation_lookup(spark, d),
        "region": build_lookup(table(spark, d, "region"), "r_name", "r_regionkey"),
    }
    keys = [
        ForeignKey("customer_code", "customer", "customer_id"),
        ForeignKey("nation_code", "nation", "nation_id"),
        ForeignKey("region_code", "region", "region_id"),
    ]
    return resolve_codes(coded_orders(spark, d), keys, lookups).select("o_orderkey", "customer_id", "nation_id", "region_id")


@query(
    "fk_missing_lookup",
    f"""SELECT c.c_custkey, n.id AS nation_id, CAST(NULL AS BIGINT) AS segment_id
        FROM {_CODED_SQL} c LEFT JOIN {_NATIONS_SQL} n ON n.code = c.nation_code""",
)
def fk_missing_lookup(spark, d):
    specs = [LookupSpec("nation", "n_name", "n_nationkey"), LookupSpec("segment", "code", "id")]
    lookups = build_lookups({"nation": table(spark, d, "nation").where("n_regionkey > 0")}, specs)
    keys = [ForeignKey("nation_code", "nation", "nation_id"), ForeignKey("c_mktsegment", "segment", "segment_id")]
    return resolve_codes(coded_customers(spark, d), keys, lookups).select("c_custkey", "nation_id", "segment_id")


@query(
    "fk_coverage",
    f"""SELECT 'customer.nation' AS key_name, count(*) AS n_rows,
               count_if(c.nation_code IS NULL OR c.nation_code = '')::BIGINT AS n_empty,
               count(n.id) AS n_resolved,
               count_if(c.nation_code <> '' AND n.id IS NULL)::BIGINT AS n_unresolved,
               count(DISTINCT CASE WHEN c.nation_code <> '' AND n.id IS NULL THEN c.nation_code END) AS n_unresolved_codes
        FROM {_CODED_SQL} c LEFT JOIN {_NATIONS_SQL} n ON n.code = c.nation_code""",
)
def fk_coverage_query(spark, d):
    return fk_coverage(coded_customers(spark, d), "nation_code", nation_lookup(spark, d), "customer.nation")


@query(
    "fk_unresolved",
    f"""SELECT c.nation_code AS code, count(*) AS n_rows
        FROM {_CODED_SQL} c LEFT JOIN {_NATIONS_SQL} n ON n.code = c.nation_code
        WHERE c.nation_code <> '' AND n.id IS NULL GROUP BY 1""",
)
def fk_unresolved_query(spark, d):
    return fk_unresolved(coded_customers(spark, d), "nation_code", nation_lookup(spark, d))


PROFILED = {
    "region": ("r_name", "r_regionkey"),
    "nation": ("n_name", "n_nationkey"),
    "supplier": ("s_name", "s_suppkey"),
    "customer": ("c_name", "c_custkey"),
    "part": ("p_name", "p_partkey"),
}


@query(
    "lookup_profile",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS n_rows, count({code}) AS n_codes, count({key}) AS n_ids,
        (SELECT string_agg({code}, ',' ORDER BY {key}) FROM (SELECT {code}, {key} FROM {t} ORDER BY {key} LIMIT 5)) AS sample_codes,
        (SELECT string_agg(CAST({key} AS VARCHAR), ',' ORDER BY {key}) FROM (SELECT {key} FROM {t} ORDER BY {key} LIMIT 5)) AS sample_ids
        FROM {t}"""
        for t, (code, key) in PROFILED.items()
    ),
)
def lookup_profile_query(spark, d):
    return union_all([lookup_profile(table(spark, d, t), t, code, key) for t, (code, key) in PROFILED.items()])
