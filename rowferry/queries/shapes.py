"""Projections and the scalar converters."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.functions import (
    Columns,
    date_with_default,
    first_present,
    fixed2,
    full_name,
    integer_with_default,
    key_text,
    split_key,
    string_with_default,
)
from rowferry.operators import project
from rowferry.queries.registry import (
    DIRTY_ORDER_DATE,
    DIRTY_ORDER_TEXT,
    LOAD_TS,
    SQL_LOAD_TS,
    query,
    sql_boolean,
    sql_float,
    sql_full_name,
    sql_integer,
    sql_string,
    sql_trim,
    table,
)


@query("transform_passthrough", "SELECT * FROM customer")
def transform_passthrough(spark, d):
    return project.transform_rows(table(spark, d, "customer"))


@query("field_map", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def field_map(spark, d):
    mapper = project.field_mapper({"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    return project.transform_rows(table(spark, d, "customer"), mapper)


@query("lowercase_fields", "SELECT * FROM customer")
def lowercase_fields(spark, d):
    customer = table(spark, d, "customer")
    return project.lowercase_fields(customer.toDF(*[c.upper() for c in customer.columns]))


def _dirty_orders(spark, d):
    return table(spark, d, "orders").select(
        "*", F.expr(DIRTY_ORDER_TEXT).alias("dirty"), F.expr(DIRTY_ORDER_DATE).alias("dirty_date")
    )


_DIRTY_SQL = f"(SELECT *, {DIRTY_ORDER_TEXT} AS dirty, {DIRTY_ORDER_DATE} AS dirty_date FROM orders)"


@query(
    "map_and_convert",
    f"""SELECT o_orderkey AS id, {sql_integer("dirty")} AS whole, {sql_float("dirty2")} AS fraction,
               {sql_string("o_orderpriority")} AS priority, o_orderdate AS ordered_at, o_custkey <> 0 AS has_customer
        FROM (SELECT *, dirty AS dirty2 FROM {_DIRTY_SQL})""",
)
def map_and_convert(spark, d):
    dirty = _dirty_orders(spark, d).withColumn("dirty2", F.col("dirty"))
    return project.map_and_convert(
        dirty,
        {
            "o_orderkey": ("id", "bigint"),
            "dirty": ("whole", "bigint"),
            "dirty2": ("fraction", "double"),
            "o_orderpriority": ("priority", "string"),
            "o_orderdate": ("ordered_at", "timestamp_ntz"),
            "o_custkey": ("has_customer", "boolean"),
        },
    )


_CENTS = "CAST(round(abs(o_totalprice) * 100) AS BIGINT)"
_SQL_TOTAL = f"concat('$', {_CENTS} // 100, '.', lpad(CAST({_CENTS} % 100 AS VARCHAR), 2, '0'))"


@query(
    "computed_fields",
    f"""SELECT o_orderkey, o_totalprice, o_totalprice > 1000 AS is_large_order, {_SQL_TOTAL} AS formatted_total,
               concat(o_orderstatus, ' ', o_orderpriority) AS label
        FROM orders""",
)
def computed_fields(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    computed = project.with_computed_fields(
        orders,
        {
            "is_large_order": F.col("o_totalprice") > 1000,
            "formatted_total": F.concat(F.lit("$"), fixed2(F.col("o_totalprice"))),
            "label": F.concat("o_orderstatus", F.lit(" "), "o_orderpriority"),
        },
    )
    return computed.drop("o_orderstatus", "o_orderpriority")


@query(
    "custom_transform",
    f"""SELECT o_orderkey AS id, o_custkey AS customer_id, o_totalprice AS total, lower(o_orderstatus) AS status,
               o_orderdate AS created_at, o_totalprice > 250000 AS is_large_order, {_SQL_TOTAL} AS formatted_total
        FROM orders""",
)
def custom_transform(spark, d):
    transform = project.custom_transformer(
        lambda c: {
            "id": c["o_orderkey"],
            "customer_id": c["o_custkey"],
            "total": c.float("o_totalprice"),
            "status": F.lower(c["o_orderstatus"]),
            "created_at": c.date("o_orderdate"),
            "is_large_order": c.float("o_totalprice") > 250000,
            "formatted_total": F.concat(F.lit("$"), fixed2(c.float("o_totalprice"))),
        }
    )
    return project.transform_rows(table(spark, d, "orders"), transform)


@query(
    "audit_columns",
    f"""SELECT c_custkey, c_name, {SQL_LOAD_TS} AS created_at, {SQL_LOAD_TS} AS updated_at, FALSE AS deleted,
               TRUE AS is_migrated_data, {SQL_LOAD_TS} AS migrated_date
        FROM customer""",
)
def audit_columns(spark, d):
    fields = {**project.audit_fields(LOAD_TS), **project.migration_fields(LOAD_TS)}
    return project.with_computed_fields(table(spark, d, "customer").select("c_custkey", "c_name"), fields)


@query(
    "first_present",
    """SELECT c_custkey, COALESCE(CAST(NULLIF(c_nationkey, 0) AS VARCHAR),
                                  NULLIF(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END, ''), c_name) AS chosen
       FROM customer""",
)
def first_present_query(spark, d):
    customer = table(spark, d, "customer")
    blank = F.expr("CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_mktsegment END")
    chosen = first_present((F.col("c_nationkey"), "int"), (blank, "string"), (F.col("c_name"), "string"))
    return customer.select("c_custkey", chosen.alias("chosen"))


@query(
    "safe_string",
    f"""SELECT 'document' AS origin, doc_id AS id, {sql_string("text")} AS value, {sql_string("source", 6)} AS bounded
        FROM documents
        UNION ALL
        SELECT 'order', o_orderkey, {sql_string("dirty")}, {sql_string("dirty", 6)} FROM {_DIRTY_SQL}""",
)
def safe_string(spark, d):
    documents, orders = table(spark, d, "documents"), _dirty_orders(spark, d)
    c, o = Columns(documents), Columns(orders)
    return documents.select(
        F.lit("document").alias("origin"), F.col("doc_id").alias("id"), c.string("text").alias("value"),
        c.string("source", 6).alias("bounded"),
    ).unionAll(orders.select(F.lit("order"), "o_orderkey", o.string("dirty"), o.string("dirty", 6)))


@query(
    "normalize_string",
    f"""SELECT o_orderkey, NULLIF({sql_trim("dirty")}, '') AS value,
               substring(NULLIF({sql_trim("dirty")}, ''), 1, 6) AS bounded FROM {_DIRTY_SQL}""",
)
def normalize_string(spark, d):
    orders = _dirty_orders(spark, d)
    c = Columns(orders)
    return orders.select(
        "o_orderkey", c.normalized("dirty").alias("value"), c.normalized("dirty", 6).alias("bounded")
    )


@query(
    "safe_integer",
    f"""SELECT o_orderkey, {sql_integer("dirty")} AS from_text, CAST(trunc(o_totalprice) AS BIGINT) AS from_number
        FROM {_DIRTY_SQL}""",
)
def safe_integer(spark, d):
    orders = _dirty_orders(spark, d)
    c = Columns(orders)
    return orders.select(
        "o_orderkey", c.integer("dirty").alias("from_text"), c.integer("o_totalprice").alias("from_number")
    )


@query(
    "safe_float",
    f"""SELECT o_orderkey, {sql_float("dirty")} AS from_text, CAST(o_custkey AS DOUBLE) AS from_number
        FROM {_DIRTY_SQL}""",
)
def safe_float(spark, d):
    orders = _dirty_orders(spark, d)
    c = Columns(orders)
    return orders.select(
        "o_orderkey", c.float("dirty").alias("from_text"), c.float("o_custkey").alias("from_number")
    )


@query(
    "safe_date",
    f"""SELECT o_orderkey,
               COALESCE(TRY_CAST(dirty_date AS TIMESTAMP), try_strptime(dirty_date, '%d-%B-%Y')) AS from_text,
               epoch_ms(o_orderkey * 1000000) AS from_number, o_orderdate AS from_date
        FROM {_DIRTY_SQL}""",
)
def safe_date(spark, d):
    orders = _dirty_orders(spark, d).withColumn("millis", F.col("o_orderkey") * 1000000)
    c = Columns(orders)
    return orders.select(
        "o_orderkey",
        c.date("dirty_date", ("dd-MMMM-yyyy",)).alias("from_text"),
        c.date("millis").alias("from_number"),
        c.date("o_orderdate").alias("from_date"),
    )


@query(
    "safe_boolean",
    f"""SELECT o_orderkey, {sql_boolean("dirty")} AS from_text, o_custkey % 3 <> 0 AS from_number,
               o_orderstatus = 'F' AS from_flag
        FROM {_DIRTY_SQL}""",
)
def safe_boolean(spark, d):
    orders = _dirty_orders(spark, d).withColumns(
        {"n": F.col("o_custkey") % 3, "b": F.when(F.col("o_orderstatus") == "F", True)}
    )
    c = Columns(orders)
    return orders.select(
        "o_orderkey",
        c.boolean("dirty").alias("from_text"),
        c.boolean("n").alias("from_number"),
        c.boolean("b").alias("from_flag"),
    )


@query(
    "safe_json",
    f"""SELECT o_orderkey, to_json({{'id': o_orderkey, 'status': o_orderstatus, 'note': dirty}}) AS record,
               CASE WHEN dirty IS NOT NULL THEN to_json(dirty) END AS scalar
        FROM {_DIRTY_SQL}""",
)
def safe_json(spark, d):
    orders = _dirty_orders(spark, d).withColumn(
        "r", F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("dirty").alias("note"))
    )
    c = Columns(orders)
    return orders.select("o_orderkey", c.json("r").alias("record"), c.json("dirty").alias("scalar"))


@query(
    "safe_defaults",
    f"""SELECT o_orderkey, COALESCE({sql_integer("dirty")}, 7) AS whole, COALESCE({sql_string("dirty")}, 'none') AS text,
               COALESCE(TRY_CAST(dirty_date AS TIMESTAMP), {SQL_LOAD_TS}) AS at
        FROM {_DIRTY_SQL}""",
)
def safe_defaults(spark, d):
    return _dirty_orders(spark, d).select(
        "o_orderkey",
        integer_with_default(7)(F.col("dirty")).alias("whole"),
        string_with_default("none")(F.col("dirty")).alias("text"),
        date_with_default(LOAD_TS)(F.col("dirty_date")).alias("at"),
    )


@query(
    "string_or_default",
    f"SELECT o_orderkey, COALESCE(NULLIF({sql_string('dirty', 10)}, ''), 'Unknown') AS value FROM {_DIRTY_SQL}",
)
def string_or_default(spark, d):
    orders = _dirty_orders(spark, d)
    return orders.select("o_orderkey", Columns(orders).string_or("dirty", "Unknown", 10).alias("value"))


_MIDDLE = """CASE CAST(c_custkey % 5 AS INT) WHEN 0 THEN 'NULL' WHEN 1 THEN '  ' WHEN 2 THEN CAST(NULL AS STRING)
 WHEN 3 THEN concat(' ', c_mktsegment) ELSE c_mktsegment END"""
_FIRST = "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE c_name END"


@query(
    "full_name",
    f"""SELECT c_custkey, {sql_full_name("f", "m", "f")} AS name, {sql_full_name("m")} AS middle
        FROM (SELECT c_custkey, {_FIRST} AS f, {_MIDDLE} AS m FROM customer)""",
)
def full_name_query(spark, d):
    customer = table(spark, d, "customer").select("c_custkey", F.expr(_FIRST).alias("f"), F.expr(_MIDDLE).alias("m"))
    first, middle = F.col("f"), F.col("m")
    return customer.select(
        "c_custkey", full_name(first, middle, first).alias("name"), full_name(middle).alias("middle")
    )


@query(
    "flag_yn",
    """SELECT p_partkey, CASE WHEN p_size = 1 THEN 'Y' ELSE 'N' END AS size_flag,
              CASE WHEN CASE WHEN p_size > 1 THEN p_size % 3 END = 1 THEN 'Y' ELSE 'N' END AS third_flag,
              COALESCE(p_type = 'PROMO', FALSE) AS is_promo
       FROM part""",
)
def flag_yn(spark, d):
    part = table(spark, d, "part").withColumn("third", F.expr("CASE WHEN p_size > 1 THEN p_size % 3 END"))
    c = Columns(part)
    return part.select(
        "p_partkey",
        c.yn("p_size").alias("size_flag"),
        c.yn("third").alias("third_flag"),
        F.coalesce(F.col("p_type") == "PROMO", F.lit(False)).alias("is_promo"),
    )


@query(
    "split_part_key",
    """WITH k AS (SELECT conv_id, turn, concat(conv_id, '|', COALESCE(CAST(NULLIF(turn, 0) AS VARCHAR), ''), '|', role) AS key_text
                  FROM conversations)
       SELECT key_text, split_part(key_text, '|', 1) AS part_1, split_part(key_text, '|', 2) AS part_2,
              split_part(key_text, '|', 3) AS part_3, upper(split_part(key_text, '|', 3)) AS role_upper FROM k""",
)
def split_part_key(spark, d):
    talk = table(spark, d, "conversations").select(
        key_text(F.col("conv_id"), F.nullif(F.col("turn"), F.lit(0)), F.col("role")).alias("key_text")
    )
    key = F.col("key_text")
    return talk.select(
        "key_text",
        *[split_key(key, i).alias(f"part_{i}") for i in (1, 2, 3)],
        F.upper(split_key(key, 3)).alias("role_upper"),
    )
