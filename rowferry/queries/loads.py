"""Declared loads, run for real against snapshots in the shared folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.operators.lookup import ForeignKey, LookupSpec
from rowferry.operators.project import custom_transformer
from rowferry.plans.keyed import KeyedFiles
from rowferry.plans.load import (
    changed_since,
    current_target,
    load_chain,
    load_from_changes,
    load_graph,
    load_in_ranges,
    load_report,
    load_table,
)
from rowferry.plans.progress import latest_progress, load_progress, progress_summary, resume_action_column
from rowferry.plans.spec import TableLoad
from rowferry.queries.clean import STAR_KEYS, _STAR_ORDERS_SQL, star_source, star_transform
from rowferry.queries.merges import INSERT_IGNORE_SQL, KEY, LINE_KEY, UPSERT_SQL, WITH_TS, _LAST_ORDER, _one_line, source_orders, target_orders
from rowferry.queries.registry import LOAD_TS, query, table
from rowferry.session import work_path

ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


# Buckets for the size of the test tables; a bucket of a large table should hold some million rows.
ORDER_FILES = KeyedFiles(8)


def orders_load(source, mode: str, files: KeyedFiles | None = None, **options) -> TableLoad:
    return TableLoad("orders", source, tuple(KEY), ORDERS_SCHEMA, mode=mode, files=files, options=options)


@query("load_table", INSERT_IGNORE_SQL)
def load_table_query(spark, d):
    """An earlier load of old orders, then today's open orders without those it holds already."""
    root = work_path(spark, "load-table")
    load_table(spark, root, orders_load(lambda s: target_orders(s, d), "insert"), LOAD_TS)
    # An increment into a finished table is a new load, so it is merged whatever the progress says.
    load_table(spark, root, orders_load(lambda s: source_orders(s, d), "insert-ignore", source_unique=True), LOAD_TS)
    return current_target(spark, root, "orders", ORDERS_SCHEMA)


def _simple(table_name, code, key, extra=()):
    def build(c):
        columns = {"code": c.string(code), "id": c.integer(key)}
        columns.update({name: c[col] for name, col in extra})
        return columns

    return custom_transformer(build)


_STAR_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("nation_id", T.LongType()),
        T.StructField("region_id", T.LongType()),
        T.StructField("note", T.StringType()),
        T.StructField("finished", T.StringType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("ordered_at", T.TimestampNTZType()),
        T.StructField("migrated_date", T.TimestampNTZType()),
    ]
)


def _coded_schema(*parents: str) -> T.StructType:
    names = [("code", T.StringType()), ("id", T.LongType()), *[(p, T.LongType()) for p in parents]]
    return T.StructType([T.StructField(n, t) for n, t in names])


def chain_loads(d: str, mode: str = "skip-existing") -> list[TableLoad]:
    """region, then nation, then supplier and customer, then orders; each resolves the codes of those before."""

    def reader(name):
        return lambda spark: table(spark, d, name)

    def with_parent(name, key, parent, parent_key, parent_code, out):
        def read(spark):
            codes = table(spark, d, parent).select(F.col(parent_key).alias("__k"), F.col(parent_code).alias(out))
            return table(spark, d, name).join(codes, F.col(key) == F.col("__k"), "left").drop("__k")

        return read

    return [
        TableLoad("region", reader("region"), ("code",), _coded_schema(), _simple("region", "r_name", "r_regionkey"),
                  mode, 1, lookup=LookupSpec("region")),
        TableLoad("nation", with_parent("nation", "n_regionkey", "region", "r_regionkey", "r_name", "region_code"),
                  ("code",), _coded_schema("region_id"),
                  _simple("nation", "n_name", "n_nationkey", [("region_id", "region_id")]), mode, 2,
                  foreign_keys=(ForeignKey("region_code", "region", "region_id"),), lookup=LookupSpec("nation")),
        TableLoad("supplier", with_parent("supplier", "s_nationkey", "nation", "n_nationkey", "n_name", "nation_code"),
                  ("code",), _coded_schema("nation_id"),
                  _simple("supplier", "s_name", "s_suppkey", [("nation_id", "nation_id")]), mode, 3,
                  foreign_keys=(ForeignKey("nation_code", "nation", "nation_id"),), lookup=LookupSpec("supplier")),
        TableLoad("customer", with_parent("customer", "c_nationkey", "nation", "n_nationkey", "n_name", "nation_code"),
                  ("code",), _coded_schema("nation_id"),
                  _simple("customer", "c_name", "c_custkey", [("nation_id", "nation_id")]), mode, 3,
                  foreign_keys=(ForeignKey("nation_code", "nation", "nation_id"),), lookup=LookupSpec("customer")),
        TableLoad("orders", lambda spark: star_source(spark, d), ("order_id",), _STAR_SCHEMA, star_transform(), mode, 4,
                  foreign_keys=STAR_KEYS, options={"source_unique": True}),
    ]


@query("load_chain", _STAR_ORDERS_SQL)
def load_chain_query(spark, d):
    root = work_path(spark, "load-chain")
    load_chain(spark, root, chain_loads(d), LOAD_TS)
    return current_target(spark, root, "orders", _STAR_SCHEMA)


_CHAIN_TABLES = ("region", "nation", "supplier", "customer", "orders")


@query(
    "load_progress",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_id, 1::BIGINT AS run, 'skip-existing' AS mode, count(*) AS read_rows, count(*) AS inserted,
        0::BIGINT AS updated, 0::BIGINT AS skipped, 0::BIGINT AS deleted, count(*) AS target_rows, TRUE AS is_complete,
        {len(_CHAIN_TABLES)}::BIGINT AS total_tables, {len(_CHAIN_TABLES)}::BIGINT AS completed_tables,
        ({" + ".join(f"(SELECT count(*) FROM {u})" for u in _CHAIN_TABLES)})::BIGINT AS total_rows FROM {t}"""
        for t in _CHAIN_TABLES
    ),
)
def load_progress_query(spark, d):
    """The chain run twice: the second run finds every table complete and adds no row to the report."""
    root = work_path(spark, "load-progress")
    load_chain(spark, root, chain_loads(d), LOAD_TS)
    load_chain(spark, root, chain_loads(d), LOAD_TS)
    summary = progress_summary(load_progress(spark, root)).drop("read_rows").withColumn("k", F.lit(1))
    return load_report(spark, root).withColumn("k", F.lit(1)).join(summary, "k").drop("k")


@query(
    "load_resume_plan",
    """WITH p AS (SELECT 'region' AS table_id, TRUE AS is_complete, (SELECT count(*) FROM region) AS target_rows
                  UNION ALL SELECT 'orders', TRUE, (SELECT count(*) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
                  UNION ALL SELECT 'customer', FALSE, 0),
            m AS (SELECT unnest(['skip-existing', 'upsert', 'fresh-start', 'append-only']) AS mode)
       SELECT table_id, mode, is_complete, target_rows,
              CASE WHEN mode IN ('skip-existing', 'append-only') AND is_complete THEN 'skip'
                   WHEN mode = 'fresh-start' AND target_rows > 0 THEN 'clear-and-load'
                   WHEN mode = 'fresh-start' OR target_rows = 0 THEN 'load'
                   WHEN mode = 'skip-existing' THEN 'load-new-rows' ELSE 'merge' END AS action
       FROM p, m""",
)
def load_resume_plan(spark, d):
    """What each strategy would do now, for two loaded tables and one that never ran."""
    root = work_path(spark, "load-resume")
    loads = [chain_loads(d)[0], orders_load(lambda s: target_orders(s, d), "insert")]
    for load in loads:
        load_table(spark, root, load, LOAD_TS)
    wanted = spark.createDataFrame([("region",), ("orders",), ("customer",)], "table_id string")
    state = wanted.join(latest_progress(load_progress(spark, root)), "table_id", "left").select(
        "table_id",
        F.coalesce("is_complete", F.lit(False)).alias("is_complete"),
        F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
    )
    modes = F.array(*[F.lit(m) for m in ("skip-existing", "upsert", "fresh-start", "append-only")])
    asked = state.select("*", F.explode(modes).alias("mode"))
    action = resume_action_column(F.col("mode"), F.col("is_complete"), F.col("target_rows"))
    return asked.withColumn("action", action)


@query("load_upsert_keyed", UPSERT_SQL)
def load_upsert_keyed(spark, d):
    """The upsert over keyed files: only entries that may hold one of today's open orders are read and replaced."""
    root = work_path(spark, "load-keyed")
    load_table(spark, root, orders_load(lambda s: target_orders(s, d), "insert", ORDER_FILES), LOAD_TS)
    load_table(spark, root, orders_load(lambda s: source_orders(s, d), "upsert", ORDER_FILES, source_unique=True), LOAD_TS)
    return current_target(spark, root, "orders", ORDERS_SCHEMA)


@query(
    "load_upsert_partitioned",
    f"SELECT * REPLACE (CASE WHEN l_linenumber = 3 THEN 0.0 ELSE l_quantity END AS l_quantity) FROM ({_one_line(_LAST_ORDER)})",
)
def load_upsert_partitioned(spark, d):
    """The last line of each key, then an upsert into one of seven partitions: the files of the others stay."""
    root, lines = work_path(spark, "load-partitioned"), table(spark, d, "lineitem")
    load = TableLoad(
        "lineitem", lambda s: lines, tuple(LINE_KEY), lines.schema, mode="upsert",
        files=KeyedFiles(2, ("l_linenumber",)), options={"order_by": ["l_shipdate"]},
    )
    load_table(spark, root, load, LOAD_TS)
    held = current_target(spark, root, "lineitem", lines.schema)
    news = held.where("l_linenumber = 3").withColumn("l_quantity", F.lit(0.0))
    load_table(spark, root, replace(load, source=lambda s: news), LOAD_TS)
    return current_target(spark, root, "lineitem", lines.schema)


@query("load_resume_partial", "SELECT * FROM orders")
def load_resume_partial(spark, d):
    """A load in five ranges of the key that dies in the third; the next run does the three that are left."""
    root, ran = work_path(spark, "load-ranges"), []

    def dies_once(df):
        ran.append(1)
        if len(ran) == 3:
            raise ConnectionError("the third range was lost")
        return df

    load = replace(orders_load(lambda s: table(s, d, "orders"), "upsert", ORDER_FILES, source_unique=True), transform=dies_once)
    try:
        load_in_ranges(spark, root, load, "o_orderkey", 5, LOAD_TS)
    except ConnectionError:
        load_in_ranges(spark, root, load, "o_orderkey", 5, LOAD_TS)
    if len(ran) != 6:
        raise AssertionError(f"{len(ran)} ranges ran, not two, one that died and three")
    return current_target(spark, root, "orders", ORDERS_SCHEMA)


@query("load_two_writers", "SELECT * REPLACE (o_totalprice * (2 + o_orderkey % 2) AS o_totalprice) FROM orders")
def load_two_writers(spark, d):
    """Two upserts of different orders at once: one commits first, the other starts over; neither is lost."""
    root, orders = work_path(spark, "load-two"), table(spark, d, "orders")
    load_table(spark, root, orders_load(lambda s: orders, "insert", ORDER_FILES), LOAD_TS)

    def run(odd: int):
        news = orders.where(F.col("o_orderkey") % 2 == odd).withColumn("o_totalprice", F.col("o_totalprice") * (2 + odd))
        return load_table(spark, root, orders_load(lambda s: news, "upsert", ORDER_FILES, source_unique=True), LOAD_TS)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(inheritable_thread_target(spark)(run), (0, 1)))
    return current_target(spark, root, "orders", ORDERS_SCHEMA)


@query(
    "load_changes",
    WITH_TS + "SELECT s.o_orderkey, s.o_totalprice, CASE WHEN t.o_orderkey IS NULL THEN 'inserted' ELSE 'updated' END AS op"
    " FROM s LEFT JOIN t ON t.o_orderkey = s.o_orderkey",
)
def load_changes(spark, d):
    """What the second of two runs changed, from the changes it kept: no comparison of the whole tables."""
    root = work_path(spark, "load-changes")
    load_table(spark, root, orders_load(lambda s: target_orders(s, d), "insert", ORDER_FILES), LOAD_TS)
    second = orders_load(lambda s: source_orders(s, d), "upsert", ORDER_FILES, source_unique=True)
    second = replace(second, keep_changes=True)
    load_table(spark, root, second, LOAD_TS)
    return changed_since(spark, root, second, 1).select("o_orderkey", "o_totalprice", F.col("_op").alias("op"))


@query("load_graph", _STAR_ORDERS_SQL)
def load_graph_query(spark, d):
    """The chain by its dependencies: supplier and customer load side by side."""
    root = work_path(spark, "load-graph")
    load_graph(spark, root, chain_loads(d), LOAD_TS)
    return current_target(spark, root, "orders", _STAR_SCHEMA)


_DOUBLED = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("doubled", T.DoubleType())])


@query("load_follow_changes", f"SELECT o_orderkey, o_totalprice * 2 AS doubled FROM ({UPSERT_SQL})")
def load_follow_changes(spark, d):
    """A table that follows another: its second run reads what the other's second run changed, and nothing else."""
    root = work_path(spark, "load-follow")
    orders = [
        replace(orders_load(lambda s: target_orders(s, d), "insert", ORDER_FILES), keep_changes=True),
        replace(orders_load(lambda s: source_orders(s, d), "upsert", ORDER_FILES, source_unique=True), keep_changes=True),
    ]
    double = lambda df: df.select("o_orderkey", (F.col("o_totalprice") * 2).alias("doubled"))
    follower = TableLoad("doubled", lambda s: None, tuple(KEY), _DOUBLED, double, "upsert", files=ORDER_FILES, options={"source_unique": True})
    for load in orders:
        load_table(spark, root, load, LOAD_TS)
        load_from_changes(spark, root, follower, load, LOAD_TS)
    return current_target(spark, root, "doubled", _DOUBLED)
