"""Queries over the test tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowferry.functions.convert import FLOAT_PREFIX, INTEGER_PREFIX, WHITESPACE

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# One load time for every query: results must not depend on the clock.
LOAD_TS = "2024-01-01 00:00:00"
SQL_LOAD_TS = f"TIMESTAMP '{LOAD_TS}'"


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Dirty texts, written in SQL both engines read, so that both start from the same rows.
DIRTY_ORDER_TEXT = """CASE CAST(o_orderkey % 7 AS INT)
 WHEN 0 THEN concat('  ', CAST(o_orderkey AS STRING), 'abc')
 WHEN 1 THEN ''
 WHEN 2 THEN '   '
 WHEN 3 THEN CAST(NULL AS STRING)
 WHEN 4 THEN concat('-', CAST(o_custkey AS STRING), '.5e1x')
 WHEN 5 THEN '99999999999999999999'
 ELSE concat(chr(9), ' ', o_orderpriority, chr(10)) END"""

DIRTY_ORDER_DATE = """CASE CAST(o_orderkey % 6 AS INT)
 WHEN 0 THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
 WHEN 1 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), ' 10:30:00')
 WHEN 2 THEN '2024-13-01'
 WHEN 3 THEN ''
 WHEN 4 THEN concat('15-', CASE WHEN o_orderstatus = 'F' THEN 'JANUARY' ELSE 'March' END, '-1999')
 ELSE CAST(NULL AS STRING) END"""

_WS = "'" + WHITESPACE + "'"


# The converters again, as SQL text for DuckDB.
def sql_trim(x: str) -> str:
    return f"trim({x}, {_WS})"


def sql_string(x: str, n: int | None = None) -> str:
    text = sql_trim(f"NULLIF({x}, '')")
    return f"substring({text}, 1, {n})" if n else text


def sql_integer(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(ltrim({x}, {_WS}), '{INTEGER_PREFIX}', 0), '') AS BIGINT)"


def sql_float(x: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract(ltrim({x}, {_WS}), '{FLOAT_PREFIX}', 0), '') AS DOUBLE)"


def sql_boolean(x: str) -> str:
    return f"COALESCE({x} <> '', FALSE)"


def sql_full_name(*parts: str) -> str:
    kept = f"list_filter([{', '.join(parts)}], lambda p: p IS NOT NULL AND {sql_trim('p')} <> '' AND lower(p) <> 'null')"
    return f"COALESCE(array_to_string({kept}, ' '), '')"
