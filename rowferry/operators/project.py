"""Reshape a table: rename, retype, compute, stamp, conform to a declared schema."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowferry.functions import Columns
from rowferry.session import compile_in_parts

Transform = Callable[[DataFrame], DataFrame]


def transform_rows(df: DataFrame, fn: Transform | None = None) -> DataFrame:
    """Apply a DataFrame transform; none means pass through."""
    return df if fn is None else df.transform(fn)


def _need(df: DataFrame, names) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")


def map_fields(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; a column outside the map is dropped, so the scan never reads it."""
    _need(df, mapping)
    return df.select(*[F.col(f"`{old}`").alias(new) for old, new in mapping.items()])


def field_mapper(mapping: Mapping[str, str]) -> Transform:
    return lambda df: map_fields(df, mapping)


def lowercase_fields(df: DataFrame) -> DataFrame:
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        raise ValueError(f"columns collide in lower case: {df.columns}")
    return df.toDF(*lowered)


_CONVERTERS = {
    "string": lambda c, n: c.string(n),
    "bigint": lambda c, n: c.integer(n),
    "double": lambda c, n: c.float(n),
    "timestamp_ntz": lambda c, n: c.date(n),
    "boolean": lambda c, n: c.boolean(n),
}


def map_and_convert(df: DataFrame, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rename and convert: ``{old: (new, type)}`` with the lenient converter of that type."""
    _need(df, mapping)
    unknown = sorted({t for _, t in mapping.values()} - set(_CONVERTERS))
    if unknown:
        raise ValueError(f"no converter to {unknown}; there are {sorted(_CONVERTERS)}")
    c = Columns(df)
    return df.select(*[_CONVERTERS[t](c, old).alias(new) for old, (new, t) in mapping.items()])


def with_computed_fields(df: DataFrame, fields: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(fields))


def custom_transformer(build: Callable[[Columns], Mapping[str, Column]]) -> Transform:
    """A transform from a function that gives the target columns of a row, by name."""

    def apply(df: DataFrame) -> DataFrame:
        compile_in_parts(df.sparkSession)
        return df.select(*[col.alias(name) for name, col in build(Columns(df)).items()])

    return apply


def load_time(load_ts: str) -> Column:
    """One load time for the whole run, so that a rerun gives the same rows."""
    return F.lit(load_ts).cast("timestamp_ntz")


def audit_fields(load_ts: str) -> dict[str, Column]:
    return {"created_at": load_time(load_ts), "updated_at": load_time(load_ts), "deleted": F.lit(False)}


def migration_fields(load_ts: str) -> dict[str, Column]:
    return {"is_migrated_data": F.lit(True), "migrated_date": load_time(load_ts)}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in declared order and type; anything else is an error."""
    extra = sorted(set(df.columns) - set(schema.names))
    if extra:
        raise ValueError(f"columns outside the target schema: {extra}")
    _need(df, schema.names)
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
