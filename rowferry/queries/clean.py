"""Whole-table cleaning jobs: the civil-registration transforms over the test hierarchy."""

from __future__ import annotations

from pyspark.sql import functions as F

from rowferry.operators.joins import Dimension, join_dimensions
from rowferry.operators.lookup import ForeignKey, build_lookup, ready_lookup, resolve_codes
from rowferry.operators.merge import merge_changes
from rowferry.operators.project import custom_transformer, load_time
from rowferry.plans import civil
from rowferry.queries.joins import _ORDER_CODES_SQL, coded_orders
from rowferry.queries.registry import (
    DIRTY_ORDER_TEXT,
    LOAD_TS,
    SQL_LOAD_TS,
    query,
    sql_full_name,
    sql_integer,
    sql_string,
    table,
)

_AUDIT_SQL = f"{SQL_LOAD_TS} AS created_at, {SQL_LOAD_TS} AS updated_at, FALSE AS deleted"


@query(
    "clean_region",
    f"""SELECT r_name AS code, r_name AS name, CAST(r_regionkey * 100 AS VARCHAR) AS post_code, substring(r_name, 1, 2) AS intl_codes,
               r_regionkey <> 0 AS active, CAST(r_regionkey AS VARCHAR) AS uuid, {_AUDIT_SQL} FROM region""",
)
def clean_region(spark, d):
    source = table(spark, d, "region").select(
        F.col("r_regionkey").alias("ID"),
        F.col("r_name").alias("CODE"),
        F.col("r_name").alias("NAME"),
        F.concat(F.lit(" "), (F.col("r_regionkey") * 100).cast("string")).alias("POST_CODE"),
        F.col("r_regionkey").alias("ACTIVE"),
        F.substring("r_name", 1, 2).alias("INTL_CODES"),
    )
    return civil.transform_of("region", LOAD_TS)(source)


@query(
    "clean_country",
    """SELECT substring(n_name, 1, 3) AS country_code, n_name AS country_name_en, n_name AS country_name_fr,
              CAST(NULL AS VARCHAR) AS nationality_en, CAST(NULL AS VARCHAR) AS nationality_fr,
              substring(concat(n_name, '-', CAST(n_regionkey AS VARCHAR), '-world'), 1, 10) AS translate_code, TRUE AS is_active,
              CAST(n_nationkey AS BIGINT) AS online_id FROM nation""",
)
def clean_country(spark, d):
    source = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("ID"),
        F.col("n_name").alias("NAME"),
        F.concat(F.lit("  "), "n_name").alias("CODE"),
        F.concat("n_name", F.lit("-"), F.col("n_regionkey").cast("string"), F.lit("-world")).alias("INTL_CODE"),
    )
    return civil.transform_of("country", LOAD_TS)(source)


@query(
    "clean_nation",
    f"""SELECT n_name AS code, n_name AS name, CAST(NULL AS VARCHAR) AS post_code, n_nationkey % 2 <> 0 AS active,
               CAST(n_nationkey AS VARCHAR) AS uuid, CAST(n_regionkey AS BIGINT) AS region_id, {_AUDIT_SQL} FROM nation""",
)
def clean_nation(spark, d):
    source = table(spark, d, "nation").select(
        F.col("n_nationkey").alias("ID"),
        F.col("n_name").alias("CODE"),
        F.col("n_name").alias("NAME"),
        F.lit("").alias("POST_CODE"),
        (F.col("n_nationkey") % 2).alias("ACTIVE"),
        F.col("n_regionkey").alias("REGION_ID"),
    )
    return civil.transform_of("district", LOAD_TS)(source)


def _nation_codes(spark, d):
    return build_lookup(table(spark, d, "nation"), "n_name", "n_nationkey")


def _place(spark, d, name, prefix, key=None):
    """A test table as a source table of places."""
    return table(spark, d, name).select(
        F.col(key or f"{prefix}_{name}key").alias("ID"), F.col(f"{prefix}_name").alias("CODE"), F.col(f"{prefix}_name").alias("NAME")
    )


@query(
    "clean_council",
    f"""SELECT s_name AS code, s_name AS name, CAST(NULL AS VARCHAR) AS post_code, CAST(s_suppkey * 7 AS VARCHAR) AS mvc_uuid,
               s_suppkey % 2 <> 0 AS active, CAST(s_suppkey AS VARCHAR) AS uuid, CAST(n_nationkey AS BIGINT) AS district_id,
               n_name AS district, {_AUDIT_SQL}
        FROM supplier LEFT JOIN nation ON s_nationkey + s_suppkey % 3 = n_nationkey""",
)
def clean_council(spark, d):
    """Councils with their district; some name one that is not there."""
    tables = {
        "council": table(spark, d, "supplier").select(
            F.col("s_suppkey").alias("ID"),
            (F.col("s_nationkey") + F.col("s_suppkey") % 3).alias("DISTRICT_ID"),
            F.col("s_name").alias("CODE"),
            F.col("s_name").alias("NAME"),
            F.lit("").alias("POST_CODE"),
            (F.col("s_suppkey") % 2).alias("ACTIVE"),
            (F.col("s_suppkey") * 7).cast("string").alias("MVC_UUID"),
        ),
        "district": _place(spark, d, "nation", "n"),
    }
    keys = [ForeignKey("DISTRICT_CODE", "district", "district_ref")]
    return civil.transform_of("council", LOAD_TS)(resolve_codes(civil.council_source(tables), keys, {"district": _nation_codes(spark, d)}))


@query(
    "clean_supplier",
    f"""SELECT s_name AS health_facility_name, s_name AS health_facility_code, CAST(NULL AS BIGINT) AS health_facility_type_id,
               s_suppkey % 3 <> 0 AS is_active, {SQL_LOAD_TS} AS created_date, CAST(NULL AS BIGINT) AS created_by_id,
               {SQL_LOAD_TS} AS updated_date, CAST(NULL AS BIGINT) AS updated_by_id,
               CASE WHEN s_suppkey % 3 = 1 THEN 'Y' ELSE 'N' END AS active, s_name AS code, CAST(NULL AS VARCHAR) AS created_by,
               CAST(NULL AS TIMESTAMP) AS deactivated_at, CAST(NULL AS VARCHAR) AS deactivated_by,
               CAST(NULL AS TIMESTAMP) AS deleted_at, s_name AS name,
               {sql_integer("concat('  ', CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR), ' km')")} AS post_code,
               CAST(NULL AS VARCHAR) AS updated_by, CAST(s_suppkey AS VARCHAR) AS uuid,
               CAST(n_nationkey AS BIGINT) AS council_id, CAST(NULL AS BIGINT) AS council_hierarchy_id, {_AUDIT_SQL}
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
)
def clean_supplier(spark, d):
    nation = Dimension(table(spark, d, "nation"), {"s_nationkey": "n_nationkey"}, {"n_name": "COUNCIL_CODE"})
    source = join_dimensions(table(spark, d, "supplier"), [nation]).select(
        F.col("s_suppkey").alias("ID"),
        F.col("s_name").alias("CODE"),
        F.col("s_name").alias("NAME"),
        F.concat(F.lit("  "), F.floor("s_acctbal").cast("string"), F.lit(" km")).alias("POST_CODE"),
        (F.col("s_suppkey") % 3).alias("ACTIVE"),
        "COUNCIL_CODE",
    )
    keys = [ForeignKey("COUNCIL_CODE", "council", "council_ref")]
    return civil.transform_of("health_facility", LOAD_TS)(resolve_codes(source, keys, {"council": _nation_codes(spark, d)}))


@query(
    "clean_customer",
    f"""SELECT c_custkey AS ward_id, c_name AS code, c_mktsegment AS ward_name, CAST(NULL AS VARCHAR) AS post_code,
               c_custkey % 2 <> 0 AS is_active, c_custkey % 2 <> 0 AS active, CAST(c_custkey AS VARCHAR) AS uuid,
               CAST(n_nationkey AS BIGINT) AS council_id, CAST(r_regionkey AS BIGINT) AS district, n_name AS council,
               n_name AS council_name, {_AUDIT_SQL}
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def clean_customer(spark, d):
    dims = [
        Dimension(
            table(spark, d, "nation"),
            {"c_nationkey": "n_nationkey"},
            {"n_name": "COUNCIL_CODE", "n_regionkey": "region_key"},
        ),
        Dimension(table(spark, d, "region"), {"region_key": "r_regionkey"}, {"r_name": "DISTRICT_CODE"}),
    ]
    source = join_dimensions(table(spark, d, "customer"), dims).select(
        F.col("c_custkey").alias("ID"),
        F.col("c_name").alias("CODE"),
        F.col("c_mktsegment").alias("NAME"),
        F.lit(None).cast("string").alias("POST_CODE"),
        (F.col("c_custkey") % 2).alias("ACTIVE"),
        "COUNCIL_CODE",
        "DISTRICT_CODE",
    )
    keys = [ForeignKey("COUNCIL_CODE", "council", "council_ref"), ForeignKey("DISTRICT_CODE", "district", "district_ref")]
    lookups = {
        "council": _nation_codes(spark, d),
        "district": build_lookup(table(spark, d, "region"), "r_name", "r_regionkey"),
    }
    return civil.transform_of("ward", LOAD_TS)(resolve_codes(source, keys, lookups))


@query(
    "clean_lookup",
    f"SELECT p_partkey AS id, p_brand AS code, p_name AS description, {_AUDIT_SQL} FROM part",
)
def clean_lookup(spark, d):
    source = table(spark, d, "part").select(
        F.col("p_partkey").alias("ID"), F.concat(F.lit(" "), "p_brand").alias("CODE"), F.col("p_name").alias("DESCRIPTION")
    )
    return civil.transform_of("registration_center_type", LOAD_TS)(source)


# An order read as a registration center: the place it has of each kind.
_CENTER_COLUMNS = {
    "ID": "o_orderkey",
    "CODE": "concat('C-', CAST(o_orderkey AS STRING), ' ')",
    "NAME": "o_orderpriority",
    "REGISTRATION_FACILITY": "o_orderkey % 2",
    "PRINTING_FACILITY": "o_orderkey % 3",
    "ACTIVE": "o_orderkey % 5",
    "HEAD_OFFICE": "CASE CAST(o_orderkey % 4 AS INT) WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END",
    "REGION_ID": "o_orderkey % 7",
    "DISTRICT_ID": "o_orderkey % 30",
    "COUNCIL_ID": "o_orderkey % 200",
    "WARD_ID": "CASE WHEN o_orderkey % 3 > 0 THEN o_custkey END",
    "HEALTH_FACILITY_ID": "o_orderkey % 300",
    "REGISTRATION_CENTER_TYPE_ID": "o_orderkey % 6",
}
_CENTER_PLACES = {
    "region": ("region", "r", None),
    "district": ("nation", "n", None),
    "council": ("supplier", "s", "s_suppkey"),
    "ward": ("customer", "c", "c_custkey"),
    "health_facility": ("part", "p", None),
    "registration_center_type": ("region", "r", None),
}


@query(
    "clean_registration_center",
    f"""SELECT CAST(o.ID AS BIGINT) AS mgt_registration_center_id, trim(o.CODE) AS code, trim(o.CODE) AS center_code, o.NAME AS name,
               REGISTRATION_FACILITY <> 0 AS registration_facility, PRINTING_FACILITY <> 0 AS printing_facility, ACTIVE <> 0 AS active,
               HEAD_OFFICE AS head_office, COALESCE(HEAD_OFFICE = 'Y', FALSE) AS is_head_office, CAST(o.ID AS VARCHAR) AS uuid,
               CAST(r.r_regionkey AS BIGINT) AS region_id, CAST(n_nationkey AS BIGINT) AS district_id,
               CAST(s_suppkey AS BIGINT) AS council_id, CAST(c_custkey AS BIGINT) AS ward_id, CAST(f.id AS BIGINT) AS health_facility_id,
               CAST(k.r_regionkey AS BIGINT) AS registration_center_type_id, {_AUDIT_SQL}, {SQL_LOAD_TS} AS activated_at
        FROM (SELECT {", ".join(f"{text} AS {name}" for name, text in _CENTER_COLUMNS.items())} FROM orders) o
        LEFT JOIN region r ON r.r_regionkey = REGION_ID LEFT JOIN nation ON n_nationkey = DISTRICT_ID
        LEFT JOIN supplier ON s_suppkey = COUNCIL_ID LEFT JOIN customer ON c_custkey = WARD_ID
        LEFT JOIN part ON p_partkey = HEALTH_FACILITY_ID LEFT JOIN region k ON k.r_regionkey = REGISTRATION_CENTER_TYPE_ID
        LEFT JOIN (SELECT p_name AS code, max(p_partkey) AS id FROM part GROUP BY 1) f ON f.code = p_name""",
)
def clean_registration_center(spark, d):
    """Centers joined to six tables of places, then six codes resolved."""
    tables = {kind: _place(spark, d, *of) for kind, of in _CENTER_PLACES.items()}
    kinds = tables["registration_center_type"].withColumnRenamed("NAME", "DESCRIPTION")
    centers = table(spark, d, "orders").select(*[F.expr(text).alias(name) for name, text in _CENTER_COLUMNS.items()])
    source = civil.registration_center_source({**tables, "registration_center_type": kinds, "registration_center": centers})
    lookups = {kind: ready_lookup(build_lookup(places, "CODE", "ID")) for kind, places in tables.items()}
    return civil.transform_of("registration_center", LOAD_TS)(resolve_codes(source, civil.CENTER_KEYS, lookups))


# Orders loaded earlier: the target a new load of orders must not repeat.
LOADED_BEFORE = "1997-01-01"

_STAR_ORDERS_SQL = f"""SELECT o.o_orderkey AS order_id, c.id AS customer_id, n.id AS nation_id, r.id AS region_id,
       COALESCE(NULLIF({sql_string("o.dirty", 20)}, ''), 'Unknown') AS note,
       CASE WHEN o.o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS finished, o.o_totalprice AS total,
       o.o_orderdate AS ordered_at, {SQL_LOAD_TS} AS migrated_date
FROM (SELECT *, {DIRTY_ORDER_TEXT} AS dirty, {_ORDER_CODES_SQL} FROM orders) o
LEFT JOIN (SELECT c_name AS code, max(c_custkey) AS id FROM customer GROUP BY c_name) c ON c.code = o.customer_code
LEFT JOIN (SELECT n_name AS code, CAST(n_nationkey AS BIGINT) AS id FROM nation) n ON n.code = o.nation_code
LEFT JOIN (SELECT r_name AS code, CAST(r_regionkey AS BIGINT) AS id FROM region) r ON r.code = o.region_code"""

STAR_KEYS = (
    ForeignKey("customer_code", "customer", "customer_id"),
    ForeignKey("nation_code", "nation", "nation_id"),
    ForeignKey("region_code", "region", "region_id"),
)


def star_lookups(spark, d):
    return {
        "customer": build_lookup(table(spark, d, "customer"), "c_name", "c_custkey"),
        "nation": _nation_codes(spark, d),
        "region": build_lookup(table(spark, d, "region"), "r_name", "r_regionkey"),
    }


def star_source(spark, d):
    return coded_orders(spark, d, "o_orderstatus", "o_totalprice", "o_orderdate", F.expr(DIRTY_ORDER_TEXT).alias("dirty"))


def star_transform():
    return custom_transformer(
        lambda c: {
            "order_id": c["o_orderkey"],
            "customer_id": c["customer_id"],
            "nation_id": c["nation_id"],
            "region_id": c["region_id"],
            "note": c.string_or("dirty", "Unknown", 20),
            "finished": F.when(c["o_orderstatus"] == "F", F.lit("Y")).otherwise(F.lit("N")),
            "total": c.float("o_totalprice"),
            "ordered_at": c.date("o_orderdate"),
            "migrated_date": load_time(LOAD_TS),
        }
    )


@query(
    "clean_orders_star",
    f"""SELECT *, CASE WHEN ordered_at < TIMESTAMP '{LOADED_BEFORE}' THEN 'skipped' ELSE 'inserted' END AS op
        FROM ({_STAR_ORDERS_SQL})""",
)
def clean_orders_star(spark, d):
    """Scan, clean, resolve three keys by code, then leave out what an earlier load holds already."""
    cleaned = star_transform()(resolve_codes(star_source(spark, d), STAR_KEYS, star_lookups(spark, d)))
    earlier = cleaned.where(F.col("ordered_at") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    changes = merge_changes(earlier, cleaned, "skip-existing", ["order_id"], source_unique=True)
    return changes.where("_op <> 'kept'").drop("_live").withColumnRenamed("_op", "op")


# A line item read as a registration: which column plays which part.
_FACT_COLUMNS = {
    "PROVIDED_PIN_NO": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING))",
    "NOTIFICATION_NUMBER": "l_orderkey * 100 + l_linenumber",
    "FIRST_NAME": "CASE WHEN l_linenumber = 1 THEN '  ' ELSE concat(' ', l_returnflag, ' ') END",
    "MIDDLE_NAME": "CASE WHEN l_linestatus = 'F' THEN 'null' ELSE l_linestatus END",
    "LAST_NAME": "concat('part ', CAST(l_partkey AS STRING))",
    "BIRTH_DATE": "l_shipdate",
    "SEX_CODE": "l_returnflag",
    "REGION_BIRTH_ID": "l_suppkey",
    "DISTRICT_BIRTH_ID": "l_quantity",
    "REGION_BIRTH_NAME": "CASE WHEN l_linenumber = 2 THEN '' ELSE l_linestatus END",
    "PLACE_OF_BIRTH_NAME": "CASE WHEN l_linenumber = 3 THEN 'a long place name' END",
    "FACILITY_ID": "concat(CAST(l_suppkey AS STRING), 'x')",
    "REGISTRATION_DATE": "concat(CAST(CAST(l_shipdate AS DATE) AS STRING), ' 08:00:00')",
    "CERTIFICATE_STATUS_ID": "CASE WHEN l_linenumber = 4 THEN 'bad' WHEN l_linenumber = 5 THEN '5' END",
    "MOTHER_FIRST_NAME": "CASE WHEN l_linenumber > 2 THEN 'M' END",
    "MOTHER_SUR_NAME": "l_linestatus",
    "FIRST_PRINTED_DATE": "CASE WHEN l_linenumber = 6 THEN l_shipdate END",
}

_FACT_SQL_VALUES = {
    "provided_pin_no": sql_string("PROVIDED_PIN_NO", 20),
    "notification_no": "CAST(NOTIFICATION_NUMBER AS VARCHAR)",
    "first_name": sql_string("FIRST_NAME", 50),
    "middle_name": sql_string("MIDDLE_NAME", 50),
    "last_name": sql_string("LAST_NAME", 50),
    "birth_date": "BIRTH_DATE",
    "sex_code": "SEX_CODE",
    "region_birth_id": "REGION_BIRTH_ID",
    "district_birth_id": "CAST(trunc(DISTRICT_BIRTH_ID) AS BIGINT)",
    "region_birth_name": f"COALESCE(NULLIF({sql_string('REGION_BIRTH_NAME')}, ''), 'Unknown Region')",
    "district_birth_name": "'Unknown District'",
    "ward_birth_name": "'Unknown Ward'",
    "country_birth_name": "'Tanzania'",
    "place_of_birth_name": f"COALESCE(NULLIF({sql_string('PLACE_OF_BIRTH_NAME', 10)}, ''), 'Hospital')",
    "facility_id": sql_integer("FACILITY_ID"),
    "registration_date": "TRY_CAST(REGISTRATION_DATE AS TIMESTAMP)",
    "registrar_name": "'System Migrated'",
    "mother_first_name": "MOTHER_FIRST_NAME",
    "mother_sur_name": "MOTHER_SUR_NAME",
    "is_migrated_data": "TRUE",
    "migrated_date": SQL_LOAD_TS,
    "certificate_status_id": f"COALESCE({sql_integer('CERTIFICATE_STATUS_ID')}, 1)",
    "last_track_date": SQL_LOAD_TS,
    "child_full_name": sql_full_name("FIRST_NAME", "MIDDLE_NAME", "LAST_NAME"),
    "mother_full_name": sql_full_name("MOTHER_FIRST_NAME", "MOTHER_SUR_NAME"),
    "father_full_name": "''",
    "first_printed_date": "FIRST_PRINTED_DATE",
    "printed_count": "CAST(0 AS BIGINT)",
    "last_printed_date": "FIRST_PRINTED_DATE",
}

_SQL_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _fact_sql() -> str:
    columns = []
    for field in civil.CERTIFICATE_SCHEMA.fields:
        empty = f"CAST(NULL AS {_SQL_TYPES[field.dataType.simpleString()]})"
        columns.append(f"{_FACT_SQL_VALUES.get(field.name, empty)} AS {field.name}")
    parts = ", ".join(f"{text} AS {name}" for name, text in _FACT_COLUMNS.items())
    return f"SELECT {', '.join(columns)} FROM (SELECT {parts} FROM lineitem)"


@query("clean_fact", _fact_sql())
def clean_fact(spark, d):
    """Every line item through the 54-column certificate transform."""
    source = table(spark, d, "lineitem").select(*[F.expr(text).alias(name) for name, text in _FACT_COLUMNS.items()])
    return civil.transform_of("birth_certificate", LOAD_TS)(source)
