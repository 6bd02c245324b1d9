"""Reports on tables: profiles, key coverage, columns, presence, reconciliation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.functions.convert import kind_of
from rowferry.operators.lookup import lookup_key, resolve_code

SAMPLE = 5


def lookup_profile(df: DataFrame, name: str, code_col: str, id_col: str, sample: int = SAMPLE) -> DataFrame:
    """One row: rows, rows with a code, rows with an id, and the first codes and ids by id, as text."""
    counts = df.agg(
        F.count("*").alias("n_rows"), F.count(code_col).alias("n_codes"), F.count(id_col).alias("n_ids")
    ).withColumn("table_name", F.lit(name))
    # The sample is cut by a top-k before it is collected into one row.
    head = df.select(F.col(id_col).alias("i"), F.col(code_col).cast("string").alias("c")).orderBy("i", "c").limit(sample)
    pairs = F.sort_array(F.collect_list(F.struct("i", "c")))
    sampled = head.agg(
        F.array_join(F.transform(pairs, lambda p: p["c"]), ",").alias("sample_codes"),
        F.array_join(F.transform(pairs, lambda p: p["i"].cast("string")), ",").alias("sample_ids"),
    ).withColumn("table_name", F.lit(name))
    return counts.join(sampled, "table_name").select(
        "table_name", "n_rows", "n_codes", "n_ids", "sample_codes", "sample_ids"
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _code_counts(df: DataFrame, source_col: str) -> DataFrame:
    """Rows per code, counted before the lookup is joined: a hot code joins as one row."""
    key = lookup_key(F.col(source_col), df.schema[source_col].dataType)
    return df.groupBy(key.alias("code")).agg(F.count("*").alias("n_rows"))


def fk_coverage(df: DataFrame, source_col: str, lookup: DataFrame | None, name: str) -> DataFrame:
    """One row: rows, rows without a code, resolved and unresolved rows, distinct unresolved codes."""
    counted = resolve_code(_code_counts(df, source_col), "code", lookup, "found")
    n, has, hit = F.col("n_rows"), F.col("code").isNotNull(), F.col("found").isNotNull()

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    return counted.agg(
        rows(F.lit(True)).alias("n_rows"),
        rows(~has).alias("n_empty"),
        rows(has & hit).alias("n_resolved"),
        rows(has & ~hit).alias("n_unresolved"),
        F.count_if(has & ~hit).alias("n_unresolved_codes"),
    ).select(F.lit(name).alias("key_name"), "*")


def fk_unresolved(df: DataFrame, source_col: str, lookup: DataFrame) -> DataFrame:
    """Codes the lookup does not know, with the rows that carry them."""
    counted = _code_counts(df, source_col).where(F.col("code").isNotNull())
    return counted.join(lookup.select("code"), "code", "left_anti")


def table_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """A row per column: table, position from 1, name, type, rows and non-NULL rows."""
    return union_all([_columns_of(name, df) for name, df in tables.items()])


def _columns_of(table: str, df: DataFrame) -> DataFrame:
    fields = df.schema.fields
    counted = df.agg(
        F.count("*").alias("n"), *[F.count(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("n").alias("n_rows"),
                F.col(f"c{i}").alias("n_present"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return counted.select(F.inline(rows))


def column_search(tables: Mapping[str, DataFrame], word: str, sample: int = SAMPLE) -> DataFrame:
    """Columns whose name holds the word: how many values they have, the least, the greatest, and the first few as text."""
    found = []
    for table, df in tables.items():
        for f in df.schema.fields:
            if word.lower() not in f.name.lower():
                continue
            values = df.select(F.col(f"`{f.name}`").alias("v"))
            named = (F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"))
            counts = values.agg(
                F.count("v").alias("n_present"),
                F.count_distinct("v").alias("n_distinct"),
                F.min("v").cast("string").alias("least"),
                F.max("v").cast("string").alias("greatest"),
            ).select(*named, "*")
            # distinct values are cut by a top-k before they are collected into one row
            head = values.where("v is not null").distinct().orderBy("v").limit(sample)
            samples = F.array_join(F.transform(F.sort_array(F.collect_list("v")), lambda v: v.cast("string")), ",")
            found.append(counts.join(head.agg(samples.alias("samples")).select(*named, "samples"), ["table_name", "column_name"]))
    if not found:
        raise ValueError(f"no column name holds {word!r}")
    return union_all(found)


def table_presence(wanted: Sequence[str], available: Mapping[str, DataFrame]) -> DataFrame:
    """A row per wanted table: there or not, how many rows, and available names that look alike.

    A name looks alike when it holds the wanted one, or its first six letters.
    """
    rows = []
    for name in wanted:
        alike = sorted(a for a in available if a != name and (name in a or name[:6] in a))
        there = name in available
        frame = available[name] if there else next(iter(available.values())).limit(0)
        rows.append(
            frame.agg(F.count("*").alias("n_rows")).select(
                F.lit(name).alias("table_name"),
                F.lit(there).alias("is_present"),
                "n_rows",
                F.lit(",".join(alike)).alias("similar"),
            )
        )
    return union_all(rows)


def reconcile_counts(source: DataFrame, target: DataFrame, name: str) -> DataFrame:
    """One row: source rows, target rows, whether the target holds as many."""
    sides = source.select(F.lit(1).alias("s"), F.lit(0).alias("t")).unionAll(
        target.select(F.lit(0).alias("s"), F.lit(1).alias("t"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_rows"), F.coalesce(F.sum("t"), F.lit(0)).alias("target_rows")
    )
    return counts.select(
        F.lit(name).alias("table_name"),
        "*",
        (F.col("source_rows") - F.col("target_rows")).alias("difference"),
        (F.col("source_rows") <= F.col("target_rows")).alias("is_complete"),
    )


def compare_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """A row per key: ``missing`` (source only), ``extra`` (target only), ``different`` or ``same``.

    Both sides are reduced to one row per key and task before they meet, so a hot
    key does not travel whole, and NULL keys compare as equal. Contents compare by
    two independent row hashes over all copies of the key.
    """
    columns = [c for c in (columns or source.columns) if c not in keys]

    def side(df: DataFrame, flag: int) -> DataFrame:
        values = [F.col(f"`{c}`") for c in columns] or [F.lit(0)]
        # Hashing a NULL passes the seed on, so the NULL pattern is hashed with the values.
        nulls = [v.isNull() for v in values]
        return df.select(
            *keys,
            F.lit(flag).alias("__side"),
            F.xxhash64(*values, *nulls).alias("__h1"),
            F.hash(*nulls, *values).alias("__h2"),
        )

    both = side(source, 0).unionAll(side(target, 1))

    def digest(flag: int) -> Column:
        mine = F.col("__side") == flag
        return F.struct(
            F.count_if(mine),
            F.bit_xor(F.when(mine, F.col("__h1"))),
            F.min(F.when(mine, F.col("__h1"))),
            F.max(F.when(mine, F.col("__h1"))),
            F.max(F.when(mine, F.col("__h2"))),
        )

    per_key = both.groupBy(*keys).agg(
        F.count_if(F.col("__side") == 0).alias("__ns"),
        F.count_if(F.col("__side") == 1).alias("__nt"),
        (digest(0) == digest(1)).alias("__same"),
    )
    status = (
        F.when(F.col("__nt") == 0, F.lit("missing"))
        .when(F.col("__ns") == 0, F.lit("extra"))
        .when(F.col("__same"), F.lit("same"))
        .otherwise(F.lit("different"))
    )
    return per_key.select(*keys, status.alias("status"))


def reconcile_keys(
    source: DataFrame, target: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None
) -> DataFrame:
    """Keys per status of ``compare_keys``."""
    return compare_keys(source, target, keys, columns).groupBy("status").agg(F.count("*").alias("n_keys"))


def rejects(raw: DataFrame, converted: Mapping[str, tuple[str, Column]]) -> DataFrame:
    """Values a converter gave up on: ``{report name: (raw column, converted)}`` → present, rejected per column.

    One scan counts every column.
    """
    counted = raw.agg(
        *[
            F.count_if(_present(raw, source)).alias(f"p{i}")
            for i, (source, _) in enumerate(converted.values())
        ],
        *[
            F.count_if(_present(raw, source) & col.isNull()).alias(f"r{i}")
            for i, (source, col) in enumerate(converted.values())
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"), F.col(f"p{i}").alias("n_present"), F.col(f"r{i}").alias("n_rejected")
            )
            for i, name in enumerate(converted)
        ]
    )
    return counted.select(F.inline(rows))


def _present(df: DataFrame, name: str) -> Column:
    col = F.col(f"`{name}`")
    return col.isNotNull() & (col != "") if kind_of(df.schema[name].dataType) == "string" else col.isNotNull()
