"""The operators bound to the test tables, beside their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowferry.llm import bpe_lexicon, collocations, embedding, filter_audit, fingerprint, hnsw, html_text, langid, ngram_join, packing, pii, substring, token_counts
from rowferry.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs, texts=False).select("carry.doc_id", "n_words", "n_removed", "kept_sha256")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, WORD_BPE).select("carry.doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.limits(token_counts.length_histogram(table(spark, sf_dir, "documents").select("text"), BYTE_BPE))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("carry.doc_id", langid.held_out(F.col("carry.doc_id")).alias("held_out"), "lang_pred", "score")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_halves(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe_lexicon.encode(docs, BYTE_BPE, decode=True)
    return out.select(
        "carry.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("carry.page_id", "carry.url", "text")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text")).select("carry.doc_id", "text", "n_entities")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_best_fit_packing,
        op3_embedding_near_dedup,
        op4_token_counts,
        op5_language_id,
        op6_fingerprints,
        op7_bpe,
        op8_ngram_jaccard,
        op9_html_text,
        op10_pii_surrogates,
        op11_nearest_neighbours,
        op12_filter_audit,
        op13_collocations,
    )
}

_SPACE = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    """Rows ``doc_id, p, word`` of a table expression, in DuckDB."""
    trimmed = rf"regexp_replace(coalesce({text}, ''), '^{_SPACE}|{_SPACE}$', '', 'g')"
    return f"""
    split AS (SELECT doc_id, CASE WHEN {trimmed} = '' THEN [] ELSE string_split_regex({trimmed}, '{_SPACE}') END AS ws FROM documents),
    words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM split)"""


ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": f"""
WITH {_words('text')},
starts AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS s FROM split WHERE len(ws) >= 35),
windows AS (SELECT doc_id, s, array_to_string(ws[s:s + 34], ' ') AS w FROM starts),
repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM windows WHERE w IN (SELECT w FROM repeated)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT split.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)""",
    "op3_embedding_near_dedup": """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND label IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON least.a = vec_id LEFT JOIN degree ON degree.a = vec_id""",
    "op8_ngram_jaccard": f"""
WITH RECURSIVE {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
starts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS s FROM split WHERE len(ws) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(ws[s:s + 4], ' ') AS g FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM documents d JOIN least ON least.a = d.doc_id LEFT JOIN sizes USING (doc_id)""",
    "op12_filter_audit": r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
judged AS (
  SELECT part, concat(
    CASE WHEN len(ws) < 200 THEN 'A' END,
    CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' END,
    CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
    CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS fails,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
    coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
  FROM texts),
kinds AS (SELECT part, fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
grid AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
met AS (
  SELECT *, contains(fails, f) AS hit, len(before) > 0 AND len(translate(fails, before, '')) < len(fails) AS gone FROM kinds, grid),
counted AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT gone AND NOT hit), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (hit AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (hit AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted""",
    "op13_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM split GROUP BY lang),
sizes AS (SELECT unnest([1, 2, 3, 4]) AS m),
starts AS (SELECT lang, ws, m, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS s FROM split, sizes),
f AS (SELECT lang, m, array_to_string(ws[s:s + m - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 30),
long AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE m > 1),
cuts AS (SELECT lang, phrase, a, m, ws, unnest(range(1, m)) AS k FROM long),
scored AS (
  SELECT c.lang, c.phrase, c.a, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT b.lang, array_to_string(b.ws[s:s + t.m - 1], ' ') AS phrase, max(b.a) AS longer
  FROM (SELECT *, unnest([1, 2, 3]) AS s FROM long WHERE m > 2) b JOIN (SELECT unnest([2, 3]) AS m) t ON t.m < b.m AND s + t.m - 1 <= b.m
  GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
