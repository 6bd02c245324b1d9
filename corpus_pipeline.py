"""A corpus from raw documents to packed sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir); its rows are written as Parquet and read
again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm import langid, ngram_join, packing, pii, substring
from rowferry.llm.common import written
from rowferry.llm.queries import WORD_BPE


def _documents(rows: DataFrame, like: DataFrame) -> DataFrame:
    """``carry`` and ``text`` back in the columns of the documents, their length renewed."""
    carried = rows.schema["carry"].dataType.names
    out = []
    for f in like.schema.fields:
        if f.name == "n_chars":
            column = F.when(F.col("text").isNotNull(), F.char_length("text"))
        else:
            column = F.col(f"carry.`{f.name}`") if f.name in carried else F.col(f.name)
        out.append(column.cast(f.dataType).alias(f.name))
    return rows.select(*out)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: null texts, texts without a letter, and what scores below ``LEAST_SCORE`` in every language.

    Where no label was there to learn from, every text with a letter stays.
    """
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    if not model.languages:
        return docs.where(langid.with_letter(F.col("text")))
    found = langid.predict(docs, model)
    return found.where((F.col("lang_pred") != langid.UND) & (F.col("score") >= langid.LEAST_SCORE)).select("carry.*")


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number of each row, ``row``, that is the same whenever the rows are read again."""
    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return written(docs.withColumn("row", F.monotonically_increasing_id()), "pipeline-rows")
    # rows of files: the number of the file, then the place in it
    place = docs.metadataColumn("_metadata")
    placed = docs.select("*", place["file_path"].alias("file"), place["row_index"].alias("at"))
    files = placed.select("file").distinct().coalesce(1).sort("file").withColumn("nth", F.monotonically_increasing_id())
    files = written(files, "pipeline-files")
    row = F.shiftleft("nth", 40) + F.col("at")
    return placed.join(F.broadcast(files), "file").select(*(f"`{c}`" for c in docs.columns), row.alias("row"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents one row stays, with the smallest id; repeated rows and null ids are rows like others."""
    rows = _numbered(docs)
    found = ngram_join.similar_documents(rows, id_col="row").select(F.col("doc_id").alias("row"), "component_id")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    stay = rows.select("row", "doc_id").join(found, "row").groupBy("component_id").agg(F.min(order)["row"].alias("row"))
    return rows.join(stay, "row", "left_semi").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that stand elsewhere too are cut."""
    return _documents(substring.remove_repeats(docs), docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities become surrogates."""
    return _documents(pii.replace_entities(docs), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place."""
    out = packing.pack_documents(docs.select("doc_id", "text"), WORD_BPE)
    return out.select("carry.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("personal_data", personal_data),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# SQL cannot express a trained classifier, keyed surrogates or a genetic packing.
ORACLE_SQL = None
