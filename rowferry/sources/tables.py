"""Reading tables and running parameterised query text."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table of the folder; with a schema, columns of another name or type are an error."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if schema is not None:
        check_schema(df, schema, name)
    return df


def check_schema(df: DataFrame, schema: T.StructType, name: str = "table") -> None:
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wrong = [
        f"{f.name} {f.dataType.simpleString()} (found {have.get(f.name, 'nothing')})"
        for f in schema.fields
        if have.get(f.name) != f.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"{name} does not have the declared columns: {', '.join(wrong)}")


def run_query(
    spark: SparkSession, text: str, params: Mapping[str, Any] | None = None, **tables: DataFrame
) -> DataFrame:
    """Run query text with ``:name`` parameters, which are bound and never spliced, over ``{table}`` frames."""
    return spark.sql(text, args=dict(params or {}), **tables)


def run_statements(
    spark: SparkSession, statements: Mapping[str, str], params: Mapping[str, Any] | None = None, **tables: DataFrame
) -> dict[str, DataFrame]:
    """Several named queries, each its own DataFrame."""
    return {name: run_query(spark, text, params, **tables) for name, text in statements.items()}


def query_text(folder: str, name: str) -> str:
    """The text of ``name.sql`` in a folder, white space collapsed. Values go in as ``:name`` parameters."""
    return " ".join(Path(folder, f"{name}.sql").read_text(encoding="utf8").split())


def query_names(folder: str) -> list[str]:
    """Queries of a folder, by name; none when there is no such folder."""
    return sorted(p.stem for p in Path(folder).glob("*.sql"))


def split_statements(text: str) -> list[str]:
    """The statements of a text in which each ends with ``;`` at a line's end."""
    parts = re.split(r";[ \t]*(?:\n|$)", text)
    return [" ".join(part.split()) for part in parts if part.strip()]


def sample_rows(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in a declared order, so that the sample is the same on every run."""
    return df.orderBy(*order_by).limit(n)


def row_count(df: DataFrame, name: str) -> DataFrame:
    """One row ``(table_name, n_rows)``; a Parquet count is answered from the file footers."""
    return df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")


def catalog_row_count(spark: SparkSession, table: str) -> int:
    """Rows of a catalog table: its collected statistic when there is one, otherwise a count; 0 if it is not there."""
    if not spark.catalog.tableExists(table):
        return 0
    described = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Statistics'").first()
    if described and "rows" in described["data_type"]:
        return int(described["data_type"].split(" rows")[0].split(" ")[-1])
    return spark.table(table).count()


def find_tables(spark: SparkSession, pattern: str, databases: Sequence[str] = ()) -> list[str]:
    """Catalog tables whose name matches a pattern (``*`` any text, ``|`` or), in these databases or the current one."""
    found = []
    for database in databases or [spark.catalog.currentDatabase()]:
        if spark.catalog.databaseExists(database):
            found += [f"{database}.{t.name}" for t in spark.catalog.listTables(database, pattern) if not t.isTemporary]
    return sorted(found)


def locate_tables(spark: SparkSession, names: Sequence[str], databases: Sequence[str]) -> dict[str, str | None]:
    """For each name the first database that has such a table, or None."""
    return {
        name: next((db for db in databases if spark.catalog.tableExists(f"{db}.{name}")), None) for name in names
    }


def date_range(df: DataFrame, column: str, start: str, end: str | None = None, fmt: str = "dd-MMMM-yyyy") -> DataFrame:
    """Rows from ``start`` up to and including ``end``, both written as in ``fmt``.

    The bounds fold to literals and reach the scan; text that does not parse is an error.
    """

    def at(text: str) -> Column:
        return F.to_timestamp_ntz(F.lit(text), F.lit(fmt))

    rows = df.where(F.col(column) >= at(start))
    return rows if end is None else rows.where(F.col(column) <= at(end))
