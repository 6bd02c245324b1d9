"""Document fingerprints: a homomorphic multiset hash, in native column expressions.

A text is the multiset of its paragraphs (lines). Each paragraph hashes to a wide vector,
and a fingerprint is the sum of these vectors, each lane modulo 2^32:

* one lane counts paragraphs,
* eight lanes are sums of 32-bit hashes (256 bits): equal for equal multisets in any order,
  and for no others but by accident,
* 64 lanes count, bit by bit, how many paragraphs have that bit of a hash set. Twice a
  count less the number of paragraphs is a sum of random signs, so the lanes of two texts,
  multiplied, estimate the paragraphs they share: that is their likeness.

Sums make it incremental: ``combine`` adds the paragraphs of another text, ``remove`` takes
them away, neither needs the text again.

Defined cases: a null text counts as empty; an empty text is one empty paragraph; equal
texts have equal fingerprints; likeness is 1 for equal fingerprints and at least 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WIDE = 8
SIGNS = 64
WORD = 0xFFFFFFFF
PAIR = 0x0000000100000001  # two counters side by side
PER_BUCKET = 512  # documents to a bucket of the order
BUCKETS = 100_000


def _total(items: Column, term) -> Column:
    return F.aggregate(items, F.lit(0).cast("long"), lambda acc, x: acc + term(x))


def paragraph_hashes(text: Column) -> Column:
    """Per paragraph a struct of five 64-bit hashes."""

    def one(p: Column) -> Column:
        strong = F.sha2(p, 256)
        return F.array(*(F.xxhash64(strong, F.lit(i)) for i in range(5)))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), one)


def lanes(hashes: Column) -> Column:
    """The fingerprint as an array of lanes. ``hashes`` should be a column, not an expression: it is read once a lane pair."""
    wide = []
    for i in range(WIDE // 2):
        wide.append(_total(hashes, lambda h, i=i: h[i].bitwiseAND(WORD)).bitwiseAND(WORD))
        wide.append(_total(hashes, lambda h, i=i: F.shiftrightunsigned(h[i], 32)).bitwiseAND(WORD))
    signs = []
    for k in range(SIGNS // 2):
        both = _total(hashes, lambda h, k=k: F.shiftrightunsigned(h[4], k).bitwiseAND(F.lit(PAIR)))
        signs.append(both)
    # a pair of counters is one number until here
    split = F.flatten(F.transform(F.array(*signs), lambda s: F.array(s.bitwiseAND(WORD), F.shiftrightunsigned(s, 32))))
    return F.concat(F.array(F.size(hashes).cast("long"), *wide), split)


def combine(a: Column, b: Column) -> Column:
    """The fingerprint of both texts together."""
    return F.zip_with(a, b, lambda x, y: (x + y).bitwiseAND(WORD))


def remove(a: Column, b: Column) -> Column:
    """The fingerprint without the paragraphs of ``b``."""
    return F.zip_with(a, b, lambda x, y: (x - y + F.lit(WORD + 1)).bitwiseAND(WORD))


def text_form(fp: Column) -> Column:
    return F.lower(F.array_join(F.transform(fp, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def sign_sums(fp: Column) -> Column:
    """The sums of random signs of a fingerprint."""
    return F.transform(F.slice(fp, 2 + WIDE, SIGNS), lambda c: (c * 2 - fp[0]).cast("double"))


def likeness(a: Column, b: Column, sums_a: Column, sums_b: Column) -> Column:
    """Shared paragraphs over the mean of both, as the fingerprints tell."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    both = dot(sums_a, sums_a) + dot(sums_b, sums_b)
    near = F.when(both > 0, 2 * dot(sums_a, sums_b) / both).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), near)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``next_text``: the text of the next document by ascending id, the first after the last.

    Documents are dealt over buckets of neighbouring ids; the first document of a bucket is
    copied to the end of the one before, so each text is shuffled once and no task sees more
    than a few buckets. Documents that share an id follow each other by text; one without
    an id has no next and is no next: it gets an empty one.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = rows.where("doc_id is not null")
    n, low, high = known.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    alone = rows.where("doc_id is null").withColumn("next_text", F.lit(""))
    if not n:
        return alone
    buckets = max(1, min(BUCKETS, n // PER_BUCKET))
    width = -(-(high - low + 1) // buckets)
    place = F.floor((F.col("doc_id") - F.lit(low)) / F.lit(width)).cast("long")
    full = known.groupBy(place.alias("bucket")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    if full.agg(F.max("n")).first()[0] > 16 * max(PER_BUCKET, n // BUCKETS):
        # ids far from even: equal parts by quantile instead
        cuts = known.select(F.percentile_approx("doc_id", [i / min(buckets, 1000) for i in range(1, min(buckets, 1000))] or [0.5], 100_000)).first()[0]
        place = _part(F.col("doc_id"), sorted(set(cuts)), 0)
        full = known.groupBy(place.alias("bucket")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
    # one row a bucket, at most BUCKETS + 1
    order = Window.orderBy("bucket")
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = full.select(
        F.coalesce(F.lead("first_id").over(order), F.first("first_id").over(everything)).alias("doc_id"),
        F.col("bucket"),
        F.lead("first_id").over(order).isNull().alias("around"),
    )
    own = known.select(place.alias("bucket"), F.lit(False).alias("around"), "doc_id", F.lit(False).alias("copied"), "text")
    copies = known.join(F.broadcast(heads), "doc_id").select("bucket", "around", "doc_id", F.lit(True).alias("copied"), "text")
    following = F.lead("text").over(Window.partitionBy("bucket").orderBy("around", "copied", "doc_id", "text"))
    both = own.union(copies).withColumn("next_text", following).where(~F.col("copied"))
    return both.select("doc_id", "text", F.coalesce("next_text", F.lit("")).alias("next_text")).union(alone)


def _part(value: Column, cuts: list[int], start: int) -> Column:
    """The number of cuts at or below a value, by halving."""
    if not cuts:
        return F.lit(start).cast("long")
    mid = len(cuts) // 2
    return F.when(value < cuts[mid], _part(value, cuts[:mid], start)).otherwise(_part(value, cuts[mid + 1 :], start + mid + 1))


def edited_halves(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text (second half from the next document), and their likeness."""
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half))
    rows = rows.withColumn("edited", edited)
    rows = rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        *(paragraph_hashes(F.col(c)).alias(f"h_{c}") for c in ("text", "edited", "next_text")),
    )
    rows = rows.select("doc_id", "n_chars", "edited_sha256", *(lanes(F.col(f"h_{c}")).alias(f"f_{c}") for c in ("text", "edited", "next_text")))
    rows = rows.select("*", *(sign_sums(F.col(f"f_{c}")).alias(f"s_{c}") for c in ("text", "edited", "next_text")))

    def near(c: str) -> Column:
        return likeness(F.col("f_text"), F.col(f"f_{c}"), F.col("s_text"), F.col(f"s_{c}"))

    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        text_form(F.col("f_text")).alias("fingerprint"),
        text_form(F.col("f_edited")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next_text").alias("near_next"),
    )
