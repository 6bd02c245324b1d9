"""Language ID by a blended-spectrum string kernel.

Two texts are compared by the character n-grams (n = 1, 2, 3) that both hold, counted by
presence, each order normalised by the number of n-grams of either text:
``k(x, y) = sum over n of |G_n(x) & G_n(y)| / sqrt(|G_n(x)| |G_n(y)|) / 3``.
N-grams are hashed to 2^16 places an order.

Training is bounded by documented parameters: of the distinct labelled texts with a letter
of each language the ``per_language`` with the least hashes, all if there are fewer, of which ``landmarks`` in all serve as Nyström
landmarks. One-versus-rest kernel ridge regression is solved on the driver over that
sample; what reaches the driver is one bit map a sampled text, 24 KB however long the text
is. A prediction needs the kernel values of a text against the landmarks times the ridge
coefficients; as the kernel is linear in presence vectors, landmarks and coefficients fold
into one weight for each n-gram and language, and a batch of texts is scored by one product
of its presence matrix with the weights. Every text is read whole.

Defined cases: a null text, or one without a letter, is ``und`` with score 0, and so is
every text when no labelled text was given; ties go to the language that sorts first; other columns ride
along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowferry.llm.common import of_worker, ship

ORDERS = (1, 2, 3)
PLACES = 1 << 16
PER_LANGUAGE = 250
LANDMARKS = 256
RIDGE = 1e-3
LANGUAGES = 1000  # more labels than this are an error, not a language column
UND = "und"
LEAST_SCORE = 0.05  # a text below has next to nothing in common with any language learned; clean ones of two or three letters have 0.12


def ngram_places(text: str) -> Iterator[np.ndarray]:
    """The places of the n-grams of each order, lower-cased."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    h = np.zeros(len(code), np.uint64)
    for n in ORDERS:
        if len(code) < n:
            yield np.zeros(0, np.int64)
            continue
        h = h[: len(code) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(1)
        yield ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.int64)


def presence(text: str, out: np.ndarray) -> None:
    """Set the places of the text in ``out``, which holds zeros, one row an order."""
    for row, places in enumerate(ngram_places(text)):
        out[row, places] = True


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def with_letter(text: Column) -> Column:
    """The same for a column; null for null."""
    return text.rlike(r"\p{L}")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    of_worker("langid", dict)
    flags = np.zeros((len(ORDERS), PLACES), bool)
    for part in batches:
        for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
            if has_letter(text):
                flags[:] = False
                presence(text, flags)
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([np.packbits(flags).tobytes()], pa.binary())], names=["lang", "bits"])


class Model:
    """Languages, and their weight for each place of each order."""

    def __init__(self, languages: list[str], weights: np.ndarray):
        self.languages, self.weights = languages, weights

    def score(self, flags: np.ndarray) -> np.ndarray:
        """``flags``: texts by orders by places; returns texts by languages."""
        out = np.zeros((len(flags), len(self.languages)), np.float64)
        for row in range(len(ORDERS)):
            size = np.maximum(flags[:, row].sum(axis=1, dtype=np.int64), 1)
            out += (flags[:, row].astype(np.float32) @ self.weights[row]) / np.sqrt(size)[:, None]
        return out


def unpack(bits: list[bytes], row: int) -> np.ndarray:
    """The presence vectors of one order."""
    step = PLACES // 8
    packed = np.frombuffer(b"".join(b[row * step : (row + 1) * step] for b in bits), np.uint8)
    return np.unpackbits(packed).reshape(len(bits), PLACES).astype(np.float32)


def solve(langs: list[str], bits: list[bytes], landmarks: int = LANDMARKS, ridge: float = RIDGE, step: int = 64) -> Model:
    """Nyström kernel ridge regression, one language against the rest; unpacks the landmarks and ``step`` texts at a time."""
    languages = sorted(set(langs))
    if not languages:
        return Model([], np.zeros((len(ORDERS), PLACES, 0), np.float32))
    y = np.array([[float(x == name) for name in languages] for x in langs])
    # landmarks in turn from each language, so that a rare one has its share
    seen: dict[str, int] = {}
    turns = []
    for i, lang in enumerate(langs):
        seen[lang] = seen.get(lang, 0) + 1
        turns.append((seen[lang], lang, i))
    chosen = [i for _, _, i in sorted(turns)[:landmarks]]

    def scaled(lot: list[int], row: int) -> np.ndarray:
        x = unpack([bits[i] for i in lot], row)
        x /= np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None]
        return x

    kernel = np.zeros((len(langs), len(chosen)))
    for row in range(len(ORDERS)):
        marks = scaled(chosen, row)
        for a in range(0, len(langs), step):
            kernel[a : a + step] += scaled(list(range(a, min(a + step, len(langs)))), row) @ marks.T / len(ORDERS)
        del marks  # before those of the next order are made
    inner = kernel[chosen]
    alpha = np.linalg.solve(kernel.T @ kernel + ridge * len(langs) * inner + 1e-6 * np.eye(len(chosen)), kernel.T @ y)
    weights = np.stack([scaled(chosen, row).T @ alpha.astype(np.float32) / len(ORDERS) for row in range(len(ORDERS))])
    return Model(languages, weights)


def train(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS) -> Model:
    """Fit on ``per_language`` texts of each language, or on all it has."""
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(text_col, F.lit("langid")).alias("place"))
    rows = rows.where(F.col("lang").isNotNull() & with_letter(F.col("text")))
    # copies of one text count once, else a large group of copies fills the sample or leaves none for it
    least = Window.partitionBy("lang").orderBy("place")
    picked = rows.select("lang", "place").distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= per_language)
    bounds = {r["lang"]: r["m"] for r in picked.groupBy("lang").agg(F.max("place").alias("m")).limit(LANGUAGES + 1).collect()}
    if len(bounds) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not bounds:
        return solve([], [])
    bound = F.create_map(*(F.lit(v) for pair in bounds.items() for v in pair))
    picked = rows.where(F.col("place") <= bound[F.col("lang")]).select("lang", "text").dropDuplicates(["lang", "text"])
    sample = picked.mapInArrow(_features, "lang string, bits binary")
    found = sorted((r["lang"], bytes(r["bits"])) for r in sample.limit(2 * per_language * len(bounds)).collect())
    return solve([lang for lang, _ in found], [b for _, b in found], landmarks)


def _predict(model, text_at: int | None, step: int = 32):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_worker("langid", dict)
        m: Model = model.value
        flags = np.zeros((step, len(ORDERS), PLACES), bool)
        for part in batches:
            texts = (part.column("text") if text_at is None else part.column("carry").flatten()[text_at]).to_pylist()
            langs, scores = [UND] * len(texts), [0.0] * len(texts)
            todo = [i for i, t in enumerate(texts) if m.languages and has_letter(t)]
            for a in range(0, len(todo), step):
                lot = todo[a : a + step]
                flags[: len(lot)] = False
                for k, i in enumerate(lot):
                    presence(texts[i], flags[k])
                out = m.score(flags[: len(lot)])
                best = out.argmax(axis=1)
                for k, i in enumerate(lot):
                    langs[i], scores[i] = m.languages[best[k]], float(min(1.0, max(0.0, out[k, best[k]])))
            yield pa.RecordBatch.from_arrays(
                [part.column("carry"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["carry", "lang_pred", "score"]
            )

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``carry`` (all columns, or all but the text), ``lang_pred`` and ``score``; only the text is looked at."""
    spark = docs.sparkSession
    ship(spark)
    columns = [c for c in docs.columns if keep_text or c != text_col]
    carried = F.struct(*(F.col(f"`{c}`") for c in columns)).alias("carry")
    # a text that is carried crosses to Python once
    rows = docs.select(carried) if keep_text else docs.select(carried, F.col(text_col).alias("text"))
    at = columns.index(text_col) if keep_text else None
    carry = rows.schema["carry"].dataType.simpleString()
    return rows.mapInArrow(_predict(spark.sparkContext.broadcast(model), at), f"carry {carry}, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training; one without an id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
