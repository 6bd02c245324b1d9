"""Pages from a rank index, reconciliation by hash trees, references found by content."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.containment import references
from rowferry.operators.hash_tree import reconcile_by_tree
from rowferry.operators.paging import page
from rowferry.operators.rank_index import append_rows, build_rank_index, page_by_rank
from rowferry.queries.merges import KEY, source_orders
from rowferry.queries.registry import ORACLE_SQL, query, table

_ORDER = "o_custkey, o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("page_by_rank", f"SELECT * FROM orders ORDER BY {_ORDER} LIMIT 700 OFFSET (SELECT count(*) // 2 FROM orders)")
def page_by_rank_query(spark, d):
    """A page in the middle of a repeated key, from the one or two files that hold it."""
    orders = table(spark, d, "orders")
    index = build_rank_index(orders, ["o_custkey"], rows_per_file=2000)
    return page_by_rank(spark, index, index.n_rows // 2, 700)


@query("page_by_rank_appended", f"SELECT * FROM orders ORDER BY {_ORDER} LIMIT 500 OFFSET (SELECT count(*) - 600 FROM orders)")
def page_by_rank_appended(spark, d):
    """Two thirds of the customers first, the others appended: pages go on counting over the border."""
    orders = table(spark, d, "orders")
    top = orders.agg(F.max("o_custkey")).first()[0] * 2 // 3
    index = build_rank_index(orders.where(F.col("o_custkey") <= top), ["o_custkey"], rows_per_file=2000)
    index = append_rows(index, orders.where(F.col("o_custkey") > top), rows_per_file=2000)
    return page_by_rank(spark, index, index.n_rows - 600, 500)


@query("page_auto", "SELECT * FROM events ORDER BY ts, event_id LIMIT 100 OFFSET 3000")
def page_auto(spark, d):
    """The strategy advised for the rows of the table."""
    return page(table(spark, d, "events"), "auto", ["ts", "event_id"], 100, 3000)


@query("reconcile_tree", ORACLE_SQL["reconcile_keys"])
def reconcile_tree(spark, d):
    """The counts of ``reconcile_keys``, joining only the rows below nodes whose sums differ."""
    halved = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 0.5).otherwise(F.col("o_totalprice"))
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    target = table(spark, d, "orders").where(early).withColumn("o_totalprice", halved)
    return reconcile_by_tree(source_orders(spark, d), target, KEY)


_NEARLY = "CASE WHEN o_orderkey % 5000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END"


@query(
    "reconcile_tree_few",
    f"""SELECT CASE WHEN o_totalprice = changed THEN 'same' ELSE 'different' END AS status, count(*) AS n_keys
        FROM (SELECT *, {_NEARLY} AS changed FROM orders) GROUP BY 1""",
)
def reconcile_tree_few(spark, d):
    """Nearly equal tables: only the leaves with a changed order are joined."""
    orders = table(spark, d, "orders")
    return reconcile_by_tree(orders, orders.withColumn("o_totalprice", F.expr(_NEARLY)), KEY)


_INTEGERS = {
    "region": ("r_regionkey",), "nation": ("n_nationkey", "n_regionkey"), "supplier": ("s_suppkey", "s_nationkey"),
    "customer": ("c_custkey", "c_nationkey"), "part": ("p_partkey", "p_size"), "orders": ("o_orderkey", "o_custkey"),
    "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
}
_VALUES = " UNION ALL ".join(
    f"SELECT DISTINCT '{t}' AS t, '{c}' AS c, {c}::BIGINT AS v FROM {t} WHERE {c} IS NOT NULL" for t, columns in _INTEGERS.items() for c in columns
)


@query(
    "profile_references",
    f"""WITH v AS ({_VALUES}), n AS (SELECT t, c, count(*) AS n FROM v GROUP BY ALL)
        SELECT a.t AS from_table, a.c AS from_column, b.t AS to_table, b.c AS to_column, count(*) AS n_values
        FROM v a JOIN v b ON a.v = b.v AND (a.t, a.c) <> (b.t, b.c) JOIN n ON n.t = a.t AND n.c = a.c
        GROUP BY a.t, a.c, b.t, b.c HAVING count(*) = min(n.n) AND count(*) >= 2""",
)
def profile_references(spark, d):
    """Among all pairs of integer columns of seven tables those whose values are all in the other column."""
    return references({name: table(spark, d, name) for name in _INTEGERS})
