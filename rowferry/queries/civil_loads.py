"""The civil-registration plan run whole over the test tables, and its lookups by code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.operators.lookup import build_lookup
from rowferry.plans import civil
from rowferry.plans.load import current_target, load_chain
from rowferry.queries.registry import LOAD_TS, query, table
from rowferry.session import work_path

# Each source relation of the plan as columns of a test table.
_RELATIONS = {
    "country": ("region", {"ID": "r_regionkey", "NAME": "r_name", "CODE": "concat('K', CAST(r_regionkey AS STRING))", "INTL_CODE": "'+1'"}),
    "registration_center_type": ("region", {"ID": "r_regionkey", "CODE": "concat('T', CAST(r_regionkey AS STRING))", "DESCRIPTION": "r_name"}),
    "region": ("region", {"ID": "r_regionkey", "CODE": "r_name", "NAME": "r_name", "POST_CODE": "'1'", "ACTIVE": "1", "INTL_CODES": "'x'"}),
    "district": ("nation", {"ID": "n_nationkey", "CODE": "n_name", "NAME": "n_name", "REGION_ID": "n_regionkey", "POST_CODE": "'2'", "ACTIVE": "1"}),
    "council": ("supplier", {"ID": "s_suppkey", "CODE": "concat('S', CAST(s_suppkey AS STRING))", "NAME": "s_name", "DISTRICT_ID": "s_nationkey",
                             "POST_CODE": "'3'", "ACTIVE": "1", "MVC_UUID": "'u'"}),
    "ward": ("customer", {"ID": "c_custkey", "CODE": "concat('W', CAST(c_custkey AS STRING))", "NAME": "c_name", "COUNCIL_ID": "c_custkey % 13",
                          "POST_CODE": "'4'", "ACTIVE": "1"}),
    "health_facility": ("part", {"ID": "p_partkey", "CODE": "concat('H', CAST(p_partkey AS STRING))", "NAME": "p_name", "COUNCIL_ID": "p_partkey % 17",
                                 "POST_CODE": "'5'", "ACTIVE": "1"}),
    "registration_center": ("orders", {
        "ID": "o_orderkey", "CODE": "concat('C', CAST(o_orderkey AS STRING))", "NAME": "o_orderpriority", "REGION_ID": "o_orderkey % 7",
        "DISTRICT_ID": "o_orderkey % 30", "COUNCIL_ID": "o_orderkey % 11", "WARD_ID": "o_custkey", "HEALTH_FACILITY_ID": "o_orderkey % 100",
        "REGISTRATION_FACILITY": "1", "PRINTING_FACILITY": "0", "ACTIVE": "1", "HEAD_OFFICE": "'N'", "REGISTRATION_CENTER_TYPE_ID": "o_orderkey % 6",
        "REG_TYPE": "'T'"}),
    "person": ("customer", {
        "ID": "c_custkey", "PIN": "c_custkey", "FIRST_NAME": "c_name", "MIDDLE_NAME": "''", "LAST_NAME": "c_mktsegment", "OTHER_NAMES": "''", "NIN": "'n'",
        "DATE_OF_BIRTH": "CAST('2024-01-01' AS TIMESTAMP_NTZ)", "SEX_ID": "c_custkey % 2", "REGION_OF_BIRTH_ID": "c_custkey % 5",
        "DISTRICT_OF_BIRTH_ID": "c_nationkey", "WARD_OF_BIRTH_ID": "c_custkey", "COUNTRY_OF_BIRTH_ID": "c_custkey % 3"}),
    "sex": ("region", {"ID": "r_regionkey", "CODE": "substring(r_name, 1, 1)", "DESCRIPTION": "r_name", "DESC_SWAHILI": "r_name"}),
    "birth_registration": ("orders", {
        "ID": "o_orderkey", "CHILD_ID": "o_custkey", "NOTIFICATION_NUMBER": "o_orderkey", "OLD_REGISTRATION_NUMBER": "''", "REGISTRATION_DATE": "o_orderdate",
        "CREATED_DATE": "o_orderdate + INTERVAL 25 YEAR", "MODIFIED_BY": "o_custkey", "MODIFIED_DATE": "o_orderdate", "PLACE_OF_BIRTH_ID": "o_orderkey % 4",
        "HOSPITAL_ID": "o_orderkey % 9", "HOSPITAL_NAME": "o_orderpriority", "MOTHER_ID": "1", "FATHER_ID": "2", "CERTIFICATE_PRINT_DATE": "o_orderdate",
        "CERTIFICATE_PRINT_BY": "''", "TYPE_OF_BIRTH_ID": "1", "WEIGHT_AT_BIRTH": "3.2", "STATUS_OF_BIRTH": "'S'"}),
}


def civil_relations(spark, d) -> dict[str, DataFrame]:
    return {
        name: table(spark, d, of).select(*(F.expr(text).alias(column) for column, text in columns.items()))
        for name, (of, columns) in _RELATIONS.items()
    }


# Of each target the ids it holds of other tables.
_REFERENCES = {
    "country": (), "registration_center_type": (), "region": (), "district": ("region_id",), "council": ("district_id",),
    "ward": ("council_id", "district"), "health_facility": ("council_id",),
    "registration_center": ("region_id", "district_id", "council_id", "ward_id", "health_facility_id", "registration_center_type_id"),
    "birth_certificate": ("region_birth_id", "district_birth_id", "ward_birth_id", "facility_id", "place_of_birth_id"),
}


def _counted_sql(name: str, frm: str, refs: tuple[str, ...]) -> str:
    held = " + ".join(f"count({r})" for r in refs) or "0"
    total = " + ".join(f"coalesce(sum({r}), 0)" for r in refs) or "0"
    return f"SELECT '{name}' AS table_id, count(*) AS n_rows, ({held})::BIGINT AS n_references, ({total})::BIGINT AS id_sum FROM ({frm})"


@query(
    "load_civil_plan",
    " UNION ALL ".join(
        _counted_sql(name, frm, refs)
        for name, frm, refs in (
            ("country", "SELECT * FROM region", ()),
            ("registration_center_type", "SELECT * FROM region", ()),
            ("region", "SELECT * FROM region", ()),
            ("district", "SELECT n_regionkey AS a FROM nation", ("a",)),
            ("council", "SELECT n_nationkey AS a FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey", ("a",)),
            ("ward", "SELECT s_suppkey AS a, n_nationkey AS b FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey % 13"
             " LEFT JOIN nation ON n_nationkey = s_nationkey", ("a", "b")),
            ("health_facility", "SELECT s_suppkey AS a FROM part LEFT JOIN supplier ON s_suppkey = p_partkey % 17", ("a",)),
            ("registration_center", """SELECT r.r_regionkey AS a, n_nationkey AS b, s_suppkey AS c, c_custkey AS d, p_partkey AS e, k.r_regionkey AS f
              FROM orders LEFT JOIN region r ON r.r_regionkey = o_orderkey % 7 LEFT JOIN nation ON n_nationkey = o_orderkey % 30
              LEFT JOIN supplier ON s_suppkey = o_orderkey % 11 LEFT JOIN customer ON c_custkey = o_custkey
              LEFT JOIN part ON p_partkey = o_orderkey % 100 LEFT JOIN region k ON k.r_regionkey = o_orderkey % 6""", tuple("abcdef")),
            ("birth_certificate", """SELECT c_custkey % 5 AS a, c_nationkey AS b, c_custkey AS c, o_orderkey % 9 AS d, o_orderkey % 4 AS e
              FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderdate + INTERVAL 25 YEAR >= TIMESTAMP '2024-01-01'""", tuple("abcde")),
        )
    ),
)
def load_civil_plan(spark, d):
    """All nine tables loaded in order and read back: rows, ids of other tables, and the sum of those ids."""
    root = work_path(spark, "load-civil")
    loads = civil.civil_plan(civil_relations(spark, d), LOAD_TS)
    load_chain(spark, root, loads, LOAD_TS)
    rows = []
    for load in loads:
        refs = [F.col(r).cast("bigint") for r in _REFERENCES[load.table_id]]
        held = sum((F.count(r) for r in refs), F.lit(0).cast("bigint"))
        total = sum((F.coalesce(F.sum(r), F.lit(0)) for r in refs), F.lit(0).cast("bigint"))
        counted = current_target(spark, root, load.table_id, load.schema).agg(F.count("*").alias("n_rows"), held.alias("n_references"), total.alias("id_sum"))
        rows.append(counted.select(F.lit(load.table_id).alias("table_id"), "*"))
    return reduce(DataFrame.unionAll, rows)


# A line item as a birth whose places are told by codes; some are empty, some nobody knows.
_BIRTH_CODES = {
    "PROVIDED_PIN_NO": "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING))",
    "REGION_CODE": "CASE WHEN l_linenumber = 1 THEN '' ELSE concat('R', CAST(l_suppkey % 7 AS STRING)) END",
    "DISTRICT_CODE": "concat('D', CAST(l_partkey % 30 AS STRING))",
    "WARD_CODE": "CASE WHEN l_linenumber <> 2 THEN concat('W', CAST(l_orderkey % 5000 AS STRING)) END",
    "COUNTRY_CODE": "concat('K', CAST(l_linenumber AS STRING))",
    "FACILITY_CODE": "concat('H', CAST(l_partkey AS STRING))",
    "PLACE_OF_BIRTH_CODE": "l_returnflag",
}


@query(
    "birth_keys",
    f"""SELECT PROVIDED_PIN_NO AS provided_pin_no, r.r_regionkey::BIGINT AS region_birth_id, n_nationkey::BIGINT AS district_birth_id,
               c_custkey AS ward_birth_id, k.r_regionkey::BIGINT AS country_birth_id, p_partkey AS facility_id, CAST(NULL AS BIGINT) AS place_of_birth_id
        FROM (SELECT {", ".join(f"{text} AS {name}" for name, text in _BIRTH_CODES.items())} FROM lineitem) l
        LEFT JOIN region r ON REGION_CODE = concat('R', r.r_regionkey) LEFT JOIN nation ON DISTRICT_CODE = concat('D', n_nationkey)
        LEFT JOIN customer ON WARD_CODE = concat('W', c_custkey) LEFT JOIN region k ON COUNTRY_CODE = concat('K', k.r_regionkey)
        LEFT JOIN part ON FACILITY_CODE = concat('H', p_partkey)""",
)
def birth_keys(spark, d):
    """Six codes of each birth through the preset lookups; the table of places of birth is not there, so its ids are NULL."""

    def coded(name, prefix, key, code, id_col):
        return table(spark, d, name).select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias(code), F.col(key).alias(id_col))

    lookups = civil.birth_lookups(
        {
            "region": coded("region", "R", "r_regionkey", "code", "id"),
            "district": coded("nation", "D", "n_nationkey", "code", "id"),
            "ward": coded("customer", "W", "c_custkey", "code", "ward_id"),
            "country": coded("region", "K", "r_regionkey", "country_code", "id"),
            "health_facility": coded("part", "H", "p_partkey", "code", "health_facility_id"),
        }
    )
    source = table(spark, d, "lineitem").select(*(F.expr(text).alias(name) for name, text in _BIRTH_CODES.items()))
    cleaned = civil.transform_of("birth_certificate", LOAD_TS)(civil.births_by_code(source, lookups))
    return cleaned.select("provided_pin_no", *(f"{p}_birth_id" for p in ("region", "district", "ward", "country")), "facility_id", "place_of_birth_id")


@query(
    "clean_alternative_keys",
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN concat('N', c_nationkey) WHEN c_custkey % 3 = 1 THEN concat('N', c_nationkey + 5) END AS code,
              n_nationkey::BIGINT AS council_id, CAST(NULL AS BIGINT) AS district_id
       FROM customer LEFT JOIN nation ON n_nationkey = CASE WHEN c_custkey % 3 = 0 THEN c_nationkey WHEN c_custkey % 3 = 1 THEN c_nationkey + 5 END""",
)
def clean_alternative_keys(spark, d):
    """Wards whose council's code stands in one of two columns, or in none; no lookup of districts is there."""
    wards = table(spark, d, "customer").select(
        F.col("c_custkey").alias("ID"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))).otherwise("").alias("COUNCIL_ID"),
        F.when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("N"), (F.col("c_nationkey") + 5).cast("string"))).alias("COUNCIL_CODE"),
    )
    councils = table(spark, d, "nation").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_nationkey").alias("id"))
    out = civil.resolved_by_any_code(wards, "ward", {"council": build_lookup(councils), "district": None})
    return out.select(F.col("ID").alias("id"), F.col("council_any").alias("code"), F.col("council_ref").alias("council_id"), F.col("district_ref").alias("district_id"))
