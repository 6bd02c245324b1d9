"""Reconciliation by hash trees: only what differs is joined.

The rows of a table fall on ``2 ** bits`` leaves by a hash of their key. A leaf holds the
number of its keys and rows and order-free sums of row hashes, so a tree is built by one
aggregation with map-side combine and can be kept: the next comparison reads no row of a
side that has not changed. A node above sums ``2 ** STEP`` nodes. Two trees are compared
from the root down, and only below nodes that differ; the rows of the leaves that differ
are then compared key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.operators.quality import compare_keys

STEP = 4
LANES = 2


def leaf_of(keys: Sequence[str], bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(7), *keys), 64 - bits)


def _sums(values: Sequence[Column]) -> list[Column]:
    """Sums of the halves of 64-bit hashes: they cannot overflow below two thousand million rows a node."""
    out = []
    for lane in range(LANES):
        h = F.xxhash64(F.lit(lane), *values)
        halves = (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))
        out += [F.sum(half).alias(f"s{2 * lane + i}") for i, half in enumerate(halves)]
    return out


SUMS = [f"s{i}" for i in range(2 * LANES)]


def hash_leaves(df: DataFrame, keys: Sequence[str], bits: int = 12, columns: Sequence[str] | None = None) -> DataFrame:
    """The leaves of a table: ``node``, its rows, and its sums. NULLs are hashed as values of their own."""
    values = [F.col(f"`{c}`") for c in (columns or df.columns)]
    nulls = [v.isNull() for v in values]
    return df.groupBy(leaf_of(keys, bits).alias("node")).agg(F.count("*").alias("n"), *_sums([*values, *nulls]))


def level_above(nodes: DataFrame) -> DataFrame:
    up = F.shiftright("node", STEP).alias("node")
    return nodes.groupBy(up).agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in SUMS))


def _unequal(one: DataFrame, other: DataFrame) -> DataFrame:
    """Nodes of a level that are not the same in both trees, or stand in one only."""
    a = one.select("node", F.struct("n", *SUMS).alias("a"))
    b = other.select("node", F.struct("n", *SUMS).alias("b"))
    return a.join(b, "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")


def differing_leaves(one: DataFrame, other: DataFrame, bits: int) -> DataFrame:
    """Leaves that differ, found from the top; a level is read only below what differs above it."""
    levels = [(one, other)]
    for _ in range(0, bits, STEP):
        levels.append((level_above(levels[-1][0]), level_above(levels[-1][1])))
    apart = None
    for a, b in reversed(levels):
        if apart is not None:
            below = apart.withColumnRenamed("node", "above")
            a, b = (x.join(below, F.shiftright(x["node"], STEP) == F.col("above"), "left_semi") for x in (a, b))
        apart = _unequal(a, b)
    return apart


def compare_by_tree(
    source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = 12, leaves: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """``compare_keys`` for the keys of leaves that differ; all other keys are the same on both sides.

    ``leaves`` are kept leaves of the two sides, over the same columns and bits. At most
    ``2 ** bits`` leaves are broadcast to pick the rows.
    """
    columns = [c for c in source.columns if c in target.columns]
    one, other = leaves or (hash_leaves(source, keys, bits, columns), hash_leaves(target, keys, bits, columns))
    apart = F.broadcast(differing_leaves(one, other, bits).withColumnRenamed("node", "__leaf"))

    def within(df: DataFrame) -> DataFrame:
        return df.select(*columns).join(apart, leaf_of(keys, bits) == F.col("__leaf"), "left_semi")

    return compare_keys(within(source), within(target), keys)


def reconcile_by_tree(
    source: DataFrame, target: DataFrame, keys: Sequence[str], bits: int = 12, leaves: tuple[DataFrame, DataFrame] | None = None
) -> DataFrame:
    """Keys per status, as ``reconcile_keys`` counts them, where each key stands once on a side.

    Keys of leaves that agree are counted by the leaves.
    """
    columns = [c for c in source.columns if c in target.columns]
    one, other = leaves or (hash_leaves(source, keys, bits, columns), hash_leaves(target, keys, bits, columns))
    found = compare_by_tree(source, target, keys, bits, (one, other)).groupBy("status").agg(F.count("*").alias("n_keys"))
    alike = one.join(differing_leaves(one, other, bits), "node", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_keys"))
    same = alike.where("n_keys > 0").select(F.lit("same").alias("status"), "n_keys")
    return found.unionByName(same).groupBy("status").agg(F.sum("n_keys").alias("n_keys"))
