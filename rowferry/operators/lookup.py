"""Code-to-id lookups and foreign-key resolution.

A lookup is a two-column table ``code STRING, id BIGINT`` with one row per code.
No join here carries a broadcast hint by itself: Catalyst broadcasts a side its
statistics prove small, and AQE one it measured. ``ready_lookup`` adds the hint
after measuring the lookup, and lays a larger one down for a sort-merge join whose
hot codes AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions.convert import as_text, kind_of
from rowferry.session import work_path


@dataclass(frozen=True)
class LookupSpec:
    """Where the codes of one table live."""

    table: str
    code_col: str = "code"
    id_col: str = "id"
    depends_on: tuple[str, ...] = ()


@dataclass(frozen=True)
class ForeignKey:
    """Resolve ``source_col`` through the lookup of ``table`` into ``out_col``."""

    source_col: str
    table: str
    out_col: str


@dataclass(frozen=True)
class LookupCheck:
    exists: bool
    has_data: bool
    missing_columns: tuple[str, ...]

    @property
    def usable(self) -> bool:
        return self.exists and self.has_data and not self.missing_columns


def validate_lookup(df: DataFrame | None, code_col: str, id_col: str) -> LookupCheck:
    """Does the table exist, have both columns, and hold at least one code?"""
    if df is None:
        return LookupCheck(False, False, ())
    missing = tuple(c for c in (code_col, id_col) if c not in df.columns)
    if missing:
        return LookupCheck(True, False, missing)
    found = bool(df.where(F.col(code_col).isNotNull()).select(code_col).take(1))
    return LookupCheck(True, found, ())


def lookup_checks(tables: Mapping[str, tuple[DataFrame | None, str, str]]) -> DataFrame:
    """The same questions as rows of one plan: a row per wanted ``name: (table, code column, id column)``.

    Looks for one code in each usable table when the result is read, and at no rows of the others.
    """
    anything = next(df for df, _, _ in tables.values() if df is not None)
    rows = []
    for name, (df, code_col, id_col) in tables.items():
        missing = [] if df is None else [c for c in (code_col, id_col) if c not in df.columns]
        usable = df is not None and not missing
        codes = df.where(F.col(code_col).isNotNull()) if usable else anything.limit(0)
        rows.append(
            codes.select(F.lit(1).alias("one")).limit(1).agg((F.count("one") > 0).alias("has_data")).select(
                F.lit(name).alias("table_name"), F.lit(df is not None).alias("is_there"), "has_data",
                F.lit(",".join(missing)).alias("missing_columns"),
            )
        )
    return reduce(DataFrame.unionByName, rows)


def build_lookup(df: DataFrame, code_col: str = "code", id_col: str = "id", order_by: str | None = None) -> DataFrame:
    """One row per code; of several ids the last by ``order_by`` wins (the largest id when not given).

    The aggregate combines on the map side, so a code repeated without end still
    reaches the shuffle as one row per task.
    """
    code = as_text(F.col(code_col), df.schema[code_col].dataType)
    id_value = F.col(id_col).try_cast("bigint")
    rank = F.col(order_by) if order_by else id_value
    return (
        df.where(F.col(code_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(code.alias("code"))
        .agg(F.max_by(id_value, F.struct(rank, id_value) if order_by else rank).alias("id"))
    )


def lookup_key(col: Column, dtype: T.DataType | str = "string") -> Column:
    """The text a code is looked up by; empty, zero and NULL are never looked up."""
    if kind_of(dtype) == "string":
        return F.nullif(col, F.lit(""))
    if kind_of(dtype) in ("integral", "fractional"):
        return as_text(F.when(col != 0, col), dtype)
    return col.cast("string")


def is_broadcast(df: DataFrame) -> bool:
    """Whether the frame carries a broadcast hint, as ``ready_lookup`` gives it."""
    return df._jdf.logicalPlan().getClass().getSimpleName() == "ResolvedHint"


def resolve_code(df: DataFrame, source_col: str, lookup: DataFrame | None, out_col: str) -> DataFrame:
    """Add ``out_col``: the id of the code, NULL when unknown or when there is no lookup.

    A broadcast lookup is joined by the code alone. Otherwise rows without a code would
    all meet in one partition: beside the code they carry the number of the task that
    read them, which a rerun repeats and no row of the lookup has. The shuffle then
    stands right below both sides of the join, the shape in which AQE splits a hot code.
    """
    if lookup is None:
        return df.withColumn(out_col, F.lit(None).cast("bigint"))
    key, salt = f"__code_{out_col}", f"__salt_{out_col}"
    code = lookup_key(F.col(f"`{source_col}`"), df.schema[source_col].dataType)
    left, right = df.withColumn(key, code), lookup.select(F.col("code").alias(key), F.col("id").alias(out_col))
    if is_broadcast(lookup):
        return left.join(F.broadcast(right), key, "left").select(*df.columns, out_col)
    left = left.withColumn(salt, F.when(F.col(key).isNull(), F.spark_partition_id()).otherwise(-1))
    return left.join(right.withColumn(salt, F.lit(-1)), [key, salt], "left").select(*df.columns, out_col)


def resolve_codes(
    df: DataFrame, keys: Sequence[ForeignKey], lookups: Mapping[str, DataFrame | None]
) -> DataFrame:
    """Resolve every key in turn; a lookup that is not there gives typed NULLs."""
    for key in keys:
        df = resolve_code(df, key.source_col, lookups.get(key.table), key.out_col)
    return df


def build_lookups(
    tables: Mapping[str, DataFrame | None], specs: Sequence[LookupSpec]
) -> dict[str, DataFrame | None]:
    """A lookup per spec; tables that are missing, empty or without the columns give None."""
    built: dict[str, DataFrame | None] = {}
    for spec in specs:
        df = tables.get(spec.table)
        usable = validate_lookup(df, spec.code_col, spec.id_col).usable
        built[spec.table] = build_lookup(df, spec.code_col, spec.id_col) if usable else None
    return built


def rebuild_lookup(df: DataFrame | None, spec: LookupSpec) -> DataFrame:
    """The lookup of a table just loaded: not being able to build it is an error."""
    check = validate_lookup(df, spec.code_col, spec.id_col)
    if not check.usable:
        raise ValueError(f"cannot build the lookup of {spec.table}: {check}")
    return build_lookup(df, spec.code_col, spec.id_col)


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and an upper estimate of their bytes, in one scan: text by its length, the rest by type width."""
    per_row = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        kind = kind_of(field.dataType)
        if kind == "string" or isinstance(field.dataType, T.BinaryType):
            per_row = per_row + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind == "other":
            per_row = per_row + F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
        else:
            per_row = per_row + F.lit(16)
    row = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(per_row), F.lit(0)).alias("b")).first()
    return row["n"], row["b"]


# A side is broadcast when it was counted and measured to be at most this large.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def measures_small(df: DataFrame, n_rows: int | None = None, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame may be broadcast. Only one of few enough rows has its bytes measured."""
    n_rows = df.count() if n_rows is None else n_rows
    return n_rows <= BROADCAST_ROWS and measure(df)[1] <= max_bytes


def ready_lookup(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A lookup in the form many joins should use it.

    One that measures small is broadcast. A larger one is written once to the shared
    folder and read back: it is not built again for every join, and its join then
    shuffles both sides directly, which is the shape in which AQE splits a hot code.
    """
    if measures_small(lookup, max_bytes=max_bytes):
        return F.broadcast(lookup)
    spark = lookup.sparkSession
    path = work_path(spark, "lookup")
    lookup.write.parquet(path)
    return spark.read.schema(lookup.schema).parquet(path)


def ready_lookups(lookups: Mapping[str, DataFrame | None]) -> dict[str, DataFrame | None]:
    """Every lookup made ready once, for joins that run again and again, as those of a stream do."""
    return {name: df if df is None or is_broadcast(df) else ready_lookup(df) for name, df in lookups.items()}
