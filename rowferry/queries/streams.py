"""Increments on Structured Streaming: each must give what the batch form gives."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.plans.load import current_target, load_table
from rowferry.plans.spec import TableLoad
from rowferry.queries.clean import STAR_KEYS, star_lookups
from rowferry.queries.joins import ORDER_CODES
from rowferry.queries.loads import ORDER_FILES, ORDERS_SCHEMA, orders_load
from rowferry.queries.merges import INSERT_IGNORE_SQL, KEY, UPSERT_SQL, target_orders
from rowferry.queries.registry import LOAD_TS, query, table
from rowferry.session import work_path
from rowferry.streaming.incremental import append_stream, file_stream, merge_stream, resolve_stream


def table_stream(spark, d, name):
    schema = table(spark, d, name).schema
    return file_stream(spark, d, schema, f"{name}.parquet")


@query("stream_append", "SELECT event_id, ts, user_id, upper(event_type) AS event_type, value FROM events")
def stream_append(spark, d):
    """Appended twice: the second run finds nothing new."""
    root = work_path(spark, "stream-append")

    def shape(events):
        return events.select("event_id", "ts", "user_id", F.upper("event_type").alias("event_type"), "value")

    append_stream(table_stream(spark, d, "events"), root, "events", shape)
    return append_stream(table_stream(spark, d, "events"), root, "events", shape)


def _stream_merge(spark, d, name, mode, files=None):
    root = work_path(spark, name)
    load_table(spark, root, orders_load(lambda s: target_orders(s, d), "insert", files), LOAD_TS)
    load = TableLoad("orders", source=lambda s: None, keys=tuple(KEY), schema=ORDERS_SCHEMA, mode=mode, files=files)
    for _ in range(2):
        stream = table_stream(spark, d, "orders").where("o_orderstatus <> 'F'")
        merge_stream(stream, root, load, LOAD_TS, order_by=["o_orderdate"])
    return current_target(spark, root, "orders", ORDERS_SCHEMA)


@query("stream_upsert", UPSERT_SQL)
def stream_upsert(spark, d):
    return _stream_merge(spark, d, "stream-upsert", "upsert")


@query("stream_upsert_keyed", UPSERT_SQL)
def stream_upsert_keyed(spark, d):
    """The increment rewrites the entries that hold its keys, not the target."""
    return _stream_merge(spark, d, "stream-keyed", "upsert", ORDER_FILES)


@query("stream_skip_existing", INSERT_IGNORE_SQL)
def stream_skip_existing(spark, d):
    return _stream_merge(spark, d, "stream-skip", "skip-existing")


@query(
    "stream_fk_resolve",
    f"""SELECT o.o_orderkey, c.id AS customer_id, n.id AS nation_id, r.id AS region_id
        FROM (SELECT o_orderkey, {", ".join(f"{text} AS {name}" for name, text in ORDER_CODES.items())} FROM orders) o
        LEFT JOIN (SELECT c_name AS code, max(c_custkey) AS id FROM customer GROUP BY c_name) c ON c.code = o.customer_code
        LEFT JOIN (SELECT n_name AS code, CAST(n_nationkey AS BIGINT) AS id FROM nation) n ON n.code = o.nation_code
        LEFT JOIN (SELECT r_name AS code, CAST(r_regionkey AS BIGINT) AS id FROM region) r ON r.code = o.region_code""",
)
def stream_fk_resolve(spark, d):
    codes = [F.expr(text).alias(name) for name, text in ORDER_CODES.items()]
    stream = table_stream(spark, d, "orders").select("o_orderkey", *codes)
    resolved = resolve_stream(stream, STAR_KEYS, star_lookups(spark, d))
    rows = resolved.select("o_orderkey", "customer_id", "nation_id", "region_id")
    return append_stream(rows, work_path(spark, "stream-fk"), "orders")
