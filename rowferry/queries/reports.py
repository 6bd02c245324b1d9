"""Reports on columns and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.functions import Columns
from rowferry.operators.quality import column_search, rejects, table_columns, table_presence
from rowferry.queries.registry import (
    DIRTY_ORDER_DATE,
    DIRTY_ORDER_TEXT,
    query,
    sql_float,
    sql_integer,
    table,
)

# The columns of the listed test tables, as Spark types them.
LISTED = {
    "orders": {
        "o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz", "o_orderpriority": "string",
    },
    "lineitem": {
        "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
        "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
        "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
    },
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
}


@query(
    "table_columns",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {i} AS position, '{c}' AS column_name, '{kind}' AS data_type,"
        f" count(*) AS n_rows, count({c}) AS n_present FROM {t}"
        for t, columns in LISTED.items()
        for i, (c, kind) in enumerate(columns.items(), start=1)
    ),
)
def table_columns_query(spark, d):
    return table_columns({t: table(spark, d, t) for t in LISTED})


_SEARCHED = {
    "nation": ("n_nationkey",),
    "supplier": ("s_nationkey",),
    "customer": ("c_nationkey",),
    "part": (),
}


@query(
    "column_search",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count({c}) AS n_present, count(DISTINCT {c}) AS n_distinct,"
        f" CAST(min({c}) AS VARCHAR) AS least, CAST(max({c}) AS VARCHAR) AS greatest,"
        f" (SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM (SELECT DISTINCT {c} AS v FROM {t} WHERE {c} IS NOT NULL ORDER BY v LIMIT 5))"
        f" AS samples FROM {t}"
        for t, columns in _SEARCHED.items()
        for c in columns
    ),
)
def column_search_query(spark, d):
    return column_search({t: table(spark, d, t) for t in _SEARCHED}, "NATION")


@query(
    "table_presence",
    """SELECT 'orders' AS table_name, TRUE AS is_present, count(*) AS n_rows, '' AS similar FROM orders
       UNION ALL SELECT 'customer', TRUE, count(*), '' FROM customer
       UNION ALL SELECT 'lineitems', FALSE, 0, 'lineitem'
       UNION ALL SELECT 'document', FALSE, 0, 'documents'
       UNION ALL SELECT 'reviews', FALSE, 0, ''""",
)
def table_presence_query(spark, d):
    available = {t: table(spark, d, t) for t in ("region", "customer", "orders", "lineitem", "documents")}
    return table_presence(["orders", "customer", "lineitems", "document", "reviews"], available)


@query(
    "clean_rejects",
    f"""WITH x AS (SELECT {DIRTY_ORDER_TEXT} AS dirty, {DIRTY_ORDER_DATE} AS dirty_date FROM orders)
        SELECT 'whole' AS column_name, count_if(dirty <> '')::BIGINT AS n_present,
               count_if(dirty <> '' AND {sql_integer("dirty")} IS NULL)::BIGINT AS n_rejected FROM x
        UNION ALL SELECT 'fraction', count_if(dirty <> '')::BIGINT,
               count_if(dirty <> '' AND {sql_float("dirty")} IS NULL)::BIGINT FROM x
        UNION ALL SELECT 'day', count_if(dirty_date <> '')::BIGINT,
               count_if(dirty_date <> '' AND TRY_CAST(dirty_date AS TIMESTAMP) IS NULL)::BIGINT FROM x""",
)
def clean_rejects(spark, d):
    raw = table(spark, d, "orders").select(
        F.expr(DIRTY_ORDER_TEXT).alias("dirty"), F.expr(DIRTY_ORDER_DATE).alias("dirty_date")
    )
    c = Columns(raw)
    return rejects(
        raw,
        {
            "whole": ("dirty", c.integer("dirty")),
            "fraction": ("dirty", c.float("dirty")),
            "day": ("dirty_date", c.date("dirty_date")),
        },
    )
