"""Filter interaction audit: what each filter removes, loses or repeats, in every order.

1. Every document gets a row number and is judged by all filters in one scan of the texts;
   what is laid down is narrow (no text). A copy is told by 128 hashed bits of its text:
   the least id of each repeated text is joined back. Texts that more than one document in
   ``1 / HOT_SHARE`` shares are at most ``HOT_SHARE`` rows; these are broadcast, so a group
   of copies of any size stays spread over all tasks.
2. For each filter the rows that fail it are stored as a table of ids (``failing``).
3. What a filter meets depends on the set of the filters before it, not on their order:
   32 sets stand for all prefixes of all 120 orders. Each failing id asks for each set that
   lacks its filter, with the set as part of the join key: a left-anti join against the ids
   that the set's filters fail gives what is removed there, a left-semi join what was
   redundant. Both are counted by part before anything is shuffled again. Survivors are
   the documents of the part without what the steps removed; label losses are counted on
   the removed rows.

Joins by ids or by hashes ask for a merge join: Spark guesses their sides by the size of
the files, packed and before sets are told out, and would send through the driver what it
cannot hold.

``surviving`` returns the rows themselves that an order of filters leaves.

Defined cases: a null or empty text has no words, no letters and no signs, and equals other
such texts; a null language is the part "" ; a null ``doc_id`` is smaller than none and has
no labels; repeated rows are documents of their own, and rows that repeat one id are not
smaller than each other; of several label rows for one id, one that says 1 is enough; an
empty table has no part and gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import written

COPY = "E"
HOT_SHARE = 1000


def words(text: Column) -> Column:
    """Maximal runs of other characters than space, tab, newlines and feeds."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that one text decides alone; ``text`` is not null."""
    ws = words(text)
    letters = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    capitals = F.char_length(text) - F.char_length(F.translate(text, letters, ""))
    return {
        "A": F.size(ws) < 200,
        "B": F.size(F.array_distinct(ws)) * 100 < F.size(ws) * 50,
        "C": capitals * 100 > F.char_length(text) * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``row``, ``part``, ``good``, ``toxic`` and one flag a filter, for each document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text.alias("text"))
    rows = written(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "part",
            F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text", F.char_length("text")).alias("h2"),
            *(c.alias(k) for k, c in conditions(F.col("text")).items()),
        ),
        "audit-rows",
    )
    total = rows.count()
    repeated = rows.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1 AND least IS NOT NULL")
    repeated = written(repeated, "audit-copies")
    hot = F.col("n") * HOT_SHARE > total  # fewer than HOT_SHARE groups can be as large
    first = rows.join(F.broadcast(repeated.where(hot).select("h1", "h2", "least")), ["h1", "h2"], "left")
    copies = first.where("doc_id > least").select("row")
    rest = first.where("least IS NULL").drop("least").join(repeated.where(~hot).select("h1", "h2", "least").hint("merge"), ["h1", "h2"])
    copies = copies.union(rest.where("doc_id > least").select("row")).withColumn(COPY, F.lit(True))
    told = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    # rows without an id find no label; their own number spreads them over the tasks (a column of its own would be folded into a condition)
    told = told.select(F.struct("doc_id", F.lit(-1).cast("long").alias("spread")).alias("who"), "good", "toxic").hint("merge")
    spread = F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(-1)
    rows = rows.withColumn("who", F.struct("doc_id", spread.alias("spread"))).join(told, "who", "left")
    no = F.lit(False)
    rows = rows.join(copies, "row", "left")
    return written(
        rows.select("row", "doc_id", "part", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"), "A", "B", "C", "D", F.coalesce(COPY, no).alias(COPY)),
        "audit-judged",
    )


def failing(rows: DataFrame, filters: str) -> dict[str, DataFrame]:
    """One stored table of ids for each filter: the rows that fail it."""
    return {f: written(rows.where(F.col(f)).select("row", "part", "good", "toxic"), f"audit-fails-{f}") for f in filters}


def surviving(rows: DataFrame, tables: dict[str, DataFrame], order: str) -> DataFrame:
    """The rows that fail none of the filters of ``order``."""
    return reduce(lambda left, f: left.join(tables[f].select("row").hint("merge"), "row", "left_anti"), order, rows)


def _sets(filters: str, letter: str, inside: bool) -> Column:
    """All sets of filters, as bits, that hold the letter or do not."""
    bit = 1 << filters.index(letter)
    return F.explode(F.array(*(F.lit(s).cast("byte") for s in range(1 << len(filters)) if bool(s & bit) == inside)))


def steps(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Removed and redundant rows by part, filter and set of earlier filters."""
    filters = "".join(tables)
    asked = reduce(
        DataFrame.union,
        (t.select("row", "part", "good", "toxic", F.lit(f).alias("filter"), _sets(filters, f, False).alias("before")) for f, t in tables.items()),
    )
    blocked = reduce(DataFrame.union, (t.select("row", _sets(filters, f, True).alias("before")) for f, t in tables.items())).hint("merge")
    by = ["part", "filter", "before"]
    removed = asked.join(blocked, ["row", "before"], "left_anti").groupBy(by).agg(
        F.count("*").alias("removed"), F.count_if("good").alias("good_lost"), F.count_if("toxic").alias("toxic_lost")
    )
    redundant = asked.join(blocked, ["row", "before"], "left_semi").groupBy(by).agg(F.count("*").alias("redundant"))
    return written(removed, "audit-removed"), written(redundant, "audit-redundant")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step, zeros included."""
    rows = judged(docs, labels)
    tables = failing(rows, "ABCDE")
    removed, redundant = steps(tables)
    orders = F.array(*(F.lit("".join(o)) for o in permutations(tables)))
    parts = rows.groupBy("part").agg(F.count("*").alias("total")).withColumn("filter_order", F.explode(orders))
    grid = parts.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(tables)))))
    earlier = F.expr("substring(filter_order, 1, step - 1)")
    before = reduce(Column.__add__, (F.when(F.contains(earlier, F.lit(f)), 1 << i).otherwise(0) for i, f in enumerate(tables)))
    grid = grid.select("*", F.expr("substring(filter_order, step, 1)").alias("filter"), before.cast("byte").alias("before"))
    by = ["part", "filter", "before"]
    grid = grid.join(removed, by, "left").join(redundant, by, "left").na.fill(0, ["removed", "good_lost", "toxic_lost", "redundant"])
    so_far = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("part", "filter")
    return grid.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(so_far)).alias("kept"), "removed", "redundant",
        F.max(F.when(F.col("step") == len(tables), F.col("removed"))).over(whole).alias("unique_fails"),
        "good_lost", "toxic_lost", F.sum("removed").over(whole).alias("shapley"),
    )
