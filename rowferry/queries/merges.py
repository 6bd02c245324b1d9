"""The merge family, duplicates and reconciliation.

The target of every orders merge is an earlier load: the orders placed before
2000, at half price and with status X. The source is today's orders that are not
finished. Some keys are in both, some in only one.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.dedupe import keep_first, keep_last
from rowferry.operators.merge import merge, merge_changes, merge_stats
from rowferry.operators.quality import reconcile_counts, reconcile_keys
from rowferry.queries.registry import LOAD_TS, SQL_LOAD_TS, query, table

KEY = ["o_orderkey"]


def target_orders(spark, d):
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    return (
        table(spark, d, "orders")
        .where(early)
        .withColumns({"o_totalprice": F.col("o_totalprice") * 0.5, "o_orderstatus": F.lit("X")})
    )


def source_orders(spark, d):
    return table(spark, d, "orders").where("o_orderstatus <> 'F'")


WITH_TS = """WITH t AS (SELECT o_orderkey, o_custkey, 'X' AS o_orderstatus, o_totalprice * 0.5 AS o_totalprice,
                  o_orderdate, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
     s AS (SELECT * FROM orders WHERE o_orderstatus <> 'F')
"""
_T_ONLY = "SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"
_S_ONLY = "SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)"


def _orders_merge(spark, d, mode, **options):
    return merge(target_orders(spark, d), source_orders(spark, d), mode, KEY, source_unique=True, **options)


@query("merge_insert", WITH_TS + "SELECT * FROM t UNION ALL SELECT * FROM s")
def merge_insert(spark, d):
    return merge(target_orders(spark, d), source_orders(spark, d), "insert")


INSERT_IGNORE_SQL = WITH_TS + f"SELECT * FROM t UNION ALL {_S_ONLY}"


@query("merge_insert_ignore", INSERT_IGNORE_SQL)
def merge_insert_ignore(spark, d):
    return _orders_merge(spark, d, "insert-ignore")


UPSERT_SQL = WITH_TS + f"{_T_ONLY} UNION ALL SELECT * FROM s"


@query("merge_upsert", UPSERT_SQL)
def merge_upsert(spark, d):
    return merge(target_orders(spark, d), source_orders(spark, d), "upsert", KEY, order_by=["o_orderdate"])


@query("merge_upsert_ignore", INSERT_IGNORE_SQL)
def merge_upsert_ignore(spark, d):
    return _orders_merge(spark, d, "upsert", on_conflict="ignore")


@query(
    "merge_upsert_columns",
    WITH_TS
    + f"""SELECT t.* REPLACE (s.o_totalprice AS o_totalprice) FROM t JOIN s USING (o_orderkey)
          UNION ALL {_T_ONLY} UNION ALL {_S_ONLY}""",
)
def merge_upsert_columns(spark, d):
    return _orders_merge(spark, d, "upsert", update_columns=["o_totalprice"])


@query(
    "merge_upsert_condition",
    WITH_TS
    + f"""SELECT s.* FROM s JOIN t USING (o_orderkey) WHERE s.o_totalprice > t.o_totalprice + 100000
          UNION ALL SELECT t.* FROM t JOIN s USING (o_orderkey) WHERE NOT s.o_totalprice > t.o_totalprice + 100000
          UNION ALL {_T_ONLY} UNION ALL {_S_ONLY}""",
)
def merge_upsert_condition(spark, d):
    return _orders_merge(spark, d, "upsert", condition="s.o_totalprice > t.o_totalprice + 100000")


@query("merge_update", WITH_TS + f"SELECT s.* FROM s JOIN t USING (o_orderkey) UNION ALL {_T_ONLY}")
def merge_update(spark, d):
    return _orders_merge(spark, d, "update")


_STAMPED = "TIMESTAMP '1999-01-01'"


@query(
    "merge_stamp",
    WITH_TS
    + f"""SELECT s.*, {SQL_LOAD_TS} AS updated_at FROM s JOIN t USING (o_orderkey)
          UNION ALL SELECT *, {_STAMPED} FROM ({_T_ONLY})
          UNION ALL SELECT *, CAST(NULL AS TIMESTAMP) FROM ({_S_ONLY})""",
)
def merge_stamp(spark, d):
    target = target_orders(spark, d).withColumn("updated_at", F.lit("1999-01-01").cast("timestamp_ntz"))
    return merge(
        target, source_orders(spark, d), "upsert", KEY, source_unique=True, stamp=("updated_at", LOAD_TS)
    )


@query(
    "merge_delete_insert",
    WITH_TS + "SELECT * FROM t WHERE NOT (o_custkey < 500) UNION ALL SELECT * FROM s",
)
def merge_delete_insert(spark, d):
    target, source = target_orders(spark, d), source_orders(spark, d)
    return merge(target, source, "delete-insert", delete_condition="o_custkey < 500")


@query("merge_sync", WITH_TS + "SELECT *, 'all' AS run FROM s UNION ALL SELECT *, 'kept' FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) UNION ALL SELECT *, 'kept' FROM s")
def merge_sync(spark, d):
    """Once as a true sync that removes what the source lacks, once without removing."""
    true_sync = _orders_merge(spark, d, "sync", delete_missing=True).withColumn("run", F.lit("all"))
    return true_sync.unionByName(_orders_merge(spark, d, "sync").withColumn("run", F.lit("kept")))


@query("load_skip_existing", INSERT_IGNORE_SQL)
def load_skip_existing(spark, d):
    return merge(target_orders(spark, d), source_orders(spark, d), "skip-existing", KEY)


@query("load_fresh_start", "SELECT * FROM orders WHERE o_orderstatus <> 'F'")
def load_fresh_start(spark, d):
    return merge(target_orders(spark, d), source_orders(spark, d), "fresh-start", KEY)


@query(
    "merge_stats",
    WITH_TS
    + """, m AS (SELECT t.o_orderkey AS tk, s.o_orderkey AS sk FROM t FULL JOIN s USING (o_orderkey)),
           n AS (SELECT count_if(tk IS NULL)::BIGINT AS new, count_if(tk IS NOT NULL AND sk IS NOT NULL)::BIGINT AS hit,
                        count_if(sk IS NULL)::BIGINT AS old, count(sk) AS src, count(tk) AS tgt FROM m)
    SELECT 'upsert' AS mode, new AS inserted, hit AS updated, 0::BIGINT AS skipped, 0::BIGINT AS deleted,
           old AS kept, src AS read, 0::BIGINT AS superseded FROM n
    UNION ALL SELECT 'insert-ignore', new, 0, hit, 0, tgt, src, 0 FROM n
    UNION ALL SELECT 'update', 0, hit, new, 0, old, src, 0 FROM n
    UNION ALL SELECT 'sync', new, hit, 0, old, 0, src, 0 FROM n
    UNION ALL SELECT 'fresh-start', src, 0, 0, tgt, 0, src, 0 FROM n""",
)
def merge_stats_query(spark, d):
    target, source = target_orders(spark, d), source_orders(spark, d)
    reports = None
    for mode in ("upsert", "insert-ignore", "update", "sync", "fresh-start"):
        changes = merge_changes(
            target, source, mode, KEY, source_unique=True, delete_missing=(mode == "sync")
        )
        row = merge_stats(changes, source).select(F.lit(mode).alias("mode"), "*")
        reports = row if reports is None else reports.unionByName(row)
    return reports


LINE_KEY = ["l_orderkey", "l_linenumber"]
_LINE_REST = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
)
_LAST_ORDER = ", ".join(f"{c} DESC" for c in ("l_shipdate", *_LINE_REST))
_FIRST_ORDER = ", ".join(("l_shipdate", *_LINE_REST))


def _one_line(order: str, frm: str = "lineitem") -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM {frm}) WHERE rn = 1"""


@query("dedupe_last", _one_line(_LAST_ORDER))
def dedupe_last(spark, d):
    return keep_last(table(spark, d, "lineitem"), LINE_KEY, ["l_shipdate"])


@query("dedupe_first", _one_line(_FIRST_ORDER))
def dedupe_first(spark, d):
    return keep_first(table(spark, d, "lineitem"), LINE_KEY, ["l_shipdate"])


@query(
    "merge_composite_key",
    f"""WITH t AS (SELECT * REPLACE (0.0::DOUBLE AS l_quantity) FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01'),
             s AS ({_one_line(_LAST_ORDER, "(SELECT * FROM lineitem WHERE l_returnflag <> 'N')")})
        SELECT s.* FROM t JOIN s ON t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber
        UNION ALL SELECT t.* FROM t WHERE NOT EXISTS (
            SELECT 1 FROM s WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)
        UNION ALL SELECT s.* FROM s WHERE NOT EXISTS (
            SELECT 1 FROM t WHERE t.l_orderkey = s.l_orderkey AND t.l_linenumber = s.l_linenumber)""",
)
def merge_composite_key(spark, d):
    """Keys repeat on both sides: the last source line wins, and it replaces every target line of its key."""
    lines = table(spark, d, "lineitem")
    early = F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz")
    target = lines.where(early).withColumn("l_quantity", F.lit(0.0))
    source = lines.where("l_returnflag <> 'N'")
    return merge(target, source, "upsert", LINE_KEY, order_by=["l_shipdate"], target_unique=False, target_rows=lines.count())


@query(
    "reconcile_counts",
    WITH_TS
    + """SELECT 'orders' AS table_name, (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
              (SELECT count(*) FROM s) - (SELECT count(*) FROM t) AS difference,
              (SELECT count(*) FROM s) <= (SELECT count(*) FROM t) AS is_complete""",
)
def reconcile_counts_query(spark, d):
    return reconcile_counts(source_orders(spark, d), target_orders(spark, d), "orders")


@query(
    "reconcile_keys",
    """WITH t AS (SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 0.5 ELSE o_totalprice END AS o_totalprice)
                  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
            s AS (SELECT * FROM orders WHERE o_orderstatus <> 'F')
       SELECT CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
                   WHEN s.o_totalprice = t.o_totalprice AND s.o_custkey = t.o_custkey AND s.o_orderstatus = t.o_orderstatus
                        AND s.o_orderdate = t.o_orderdate AND s.o_orderpriority = t.o_orderpriority THEN 'same'
                   ELSE 'different' END AS status, count(*) AS n_keys
       FROM s FULL JOIN t ON s.o_orderkey = t.o_orderkey GROUP BY 1""",
)
def reconcile_keys_query(spark, d):
    halved = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") * 0.5).otherwise(F.col("o_totalprice"))
    early = F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")
    target = table(spark, d, "orders").where(early).withColumn("o_totalprice", halved)
    return reconcile_keys(source_orders(spark, d), target, KEY)
