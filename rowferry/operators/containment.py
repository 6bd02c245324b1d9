"""Which columns refer to which: value containment between columns, by content and not by name.

One pass over each table gives every column a theta sketch of its distinct values with its
least and greatest value. Pairs of columns of one kind are then ruled out by their ranges and
by the estimated share of values they have in common, and only pairs that may hold are
verified exactly, by an anti join of distinct values. Small columns have exact sketches; where
a sketch is too coarse to decide, the pair is verified, so no containment is lost to an estimate.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowferry.functions.convert import kind_of
from rowferry.operators.quality import union_all

LG_ENTRIES = 12  # a sketch keeps up to 4,096 hashes, some 32 KB
LEAST_SHARE = 0.8  # an estimated share below this rules a pair out: five standard errors at ENOUGH kept values
ENOUGH = 600


def column_sketches(tables: Mapping[str, DataFrame], kinds: tuple[str, ...] = ("integral", "string")) -> DataFrame:
    """A row for each column of those kinds: ``table_name``, ``column_name``, ``kind``, ``least``, ``greatest``, ``n_distinct``, ``sketch``."""
    rows = []
    for table, df in tables.items():
        fields = [f for f in df.schema.fields if kind_of(f.dataType) in kinds]
        if not fields:
            continue
        aggregates = []
        for i, f in enumerate(fields):
            value = F.col(f"`{f.name}`").cast("bigint") if kind_of(f.dataType) == "integral" else F.col(f"`{f.name}`")
            aggregates += [
                F.min(value).cast("string").alias(f"least{i}"), F.max(value).cast("string").alias(f"greatest{i}"),
                F.theta_sketch_agg(value, LG_ENTRIES).alias(f"sketch{i}"), F.count(value).alias(f"n{i}"),
            ]
        one = df.agg(*aggregates)
        cells = [
            F.struct(
                F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(kind_of(f.dataType)).alias("kind"),
                F.col(f"least{i}").alias("least"), F.col(f"greatest{i}").alias("greatest"), F.col(f"n{i}").alias("n"), F.col(f"sketch{i}").alias("sketch"),
            )
            for i, f in enumerate(fields)
        ]
        rows.append(one.select(F.inline(F.array(*cells))).where("n > 0"))
    return union_all(rows).withColumn("n_distinct", F.theta_sketch_estimate("sketch")).drop("n")


def possible_references(sketches: DataFrame) -> DataFrame:
    """Pairs of columns whose ranges and sketches do not rule out that every value of the first is in the second."""
    a = sketches.select(*(F.col(c).alias(f"a_{c}") for c in sketches.columns))
    b = sketches.select(*(F.col(c).alias(f"b_{c}") for c in sketches.columns))
    other = (F.col("a_table_name") != F.col("b_table_name")) | (F.col("a_column_name") != F.col("b_column_name"))
    number = F.col("a_kind") == "integral"

    def at_most(x: str, y: str):
        return F.when(number, F.col(x).try_cast("bigint") <= F.col(y).try_cast("bigint")).otherwise(F.col(x) <= F.col(y))

    inside = at_most("b_least", "a_least") & at_most("a_greatest", "b_greatest")
    pairs = a.join(b, F.col("a_kind") == F.col("b_kind")).where(other & inside)
    both = F.theta_sketch_estimate(F.theta_intersection("a_sketch", "b_sketch"))
    # values of the first that the coarser sketch of the two can be expected to keep
    kept = F.col("a_n_distinct") * (1 << LG_ENTRIES) / F.greatest(F.lit(1 << LG_ENTRIES), F.col("a_n_distinct"), F.col("b_n_distinct"))
    exact = (F.col("a_n_distinct") <= (1 << LG_ENTRIES) // 2) & (F.col("b_n_distinct") <= (1 << LG_ENTRIES) // 2)
    may = F.when(exact, both >= F.col("a_n_distinct")).otherwise((kept < ENOUGH) | (both >= LEAST_SHARE * F.col("a_n_distinct")))
    return pairs.where(may).select("a_table_name", "a_column_name", "b_table_name", "b_column_name", "a_n_distinct", "b_n_distinct")


def references(tables: Mapping[str, DataFrame], kinds: tuple[str, ...] = ("integral",), least_distinct: int = 2) -> DataFrame:
    """Verified containments: ``from_table``, ``from_column``, ``to_table``, ``to_column``, ``n_values``.

    A column with fewer than ``least_distinct`` values refers to nothing. The pairs to
    verify are as many as columns allow, whatever the rows: they come to the driver.
    """
    pairs = possible_references(column_sketches(tables, kinds)).collect()
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for p in pairs:
        one, other = (
            tables[t].select(F.col(f"`{c}`").alias("v")).where("v IS NOT NULL").distinct()
            for t, c in ((p["a_table_name"], p["a_column_name"]), (p["b_table_name"], p["b_column_name"]))
        )
        marked = one.join(other.withColumn("held", F.lit(True)), "v", "left")
        counted = marked.agg(F.count("*").alias("n_values"), F.count_if(F.col("held").isNull()).alias("n_missing"))
        names = (F.lit(p[f"{side}_{kind}_name"]).alias(f"{word}_{kind}") for side, word in (("a", "from"), ("b", "to")) for kind in ("table", "column"))
        rows.append(counted.where(f"n_missing = 0 AND n_values >= {least_distinct}").select(*names, "n_values"))
    empty = spark.createDataFrame([], "from_table string, from_column string, to_table string, to_column string, n_values long")
    return reduce(DataFrame.unionByName, rows, empty)
