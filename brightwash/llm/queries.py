"""Registered queries of this subpackage: ``opN_<name>`` and their SQL.

Each query applies its operator, with production parameters, to its whole
table and derives the stated columns from the operator's own result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, contamination, fingerprints, langid, lm, packing, pages, pii, simhash, suffixes, toxicity, variants, vectors
from .common import id_remainder, table

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op2_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op3_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it holds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", "m.item_id", "m.distance", (1 - F.col("m.distance") / F.col("m.item_bytes")).alias("similarity"), "m.start", "m.end"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, WORD_TOKENIZER, capacity=4096, end_id=1)


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 10) == 0
    return lm.score_texts(docs, training=~held_out).withColumn("held_out", held_out).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find_spans(docs, pii.train(docs)).drop("text", "redacted")


def op7_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.train(docs.filter(~held_out))
    found = langid.identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op9_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"), length=400)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 3) == 1
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs, min_count=10, max_words=3, top=2000, covered_percent=50)


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.next_likeness(table(spark, sf_dir, "documents"), samples=64, shingle=2)


def op13_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.spelling_variants(docs, min_length=5, min_count=3).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_itq": op2_itq,
    "op3_contamination": op3_contamination,
    "op4_packing": op4_packing,
    "op5_lm": op5_lm,
    "op6_pii": op6_pii,
    "op7_pages": op7_pages,
    "op8_langid": op8_langid,
    "op9_suffixes": op9_suffixes,
    "op10_toxicity": op10_toxicity,
    "op11_collocations": op11_collocations,
    "op12_fingerprints": op12_fingerprints,
    "op13_variants": op13_variants,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP11_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces
), phrases AS (
  SELECT lang, 1 AS words, unnest(w) AS phrase FROM split
  UNION ALL
  SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
  UNION ALL
  SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM split
), f AS (
  SELECT lang, words, phrase, count(*) AS a FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM f WHERE words >= 2 AND a >= 10
), cuts AS (
  SELECT lang, words, phrase, a, k,
         array_to_string(string_split(phrase, ' ')[1:k], ' ') AS head,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM candidates, (VALUES (1), (2)) AS t(k) WHERE k < words
), scored AS (
  SELECT c.*, h.a AS l, r.a AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (h.a::HUGEINT * r.a) AS BIGINT) AS score
  FROM cuts c
  JOIN f h ON h.lang = c.lang AND h.phrase = c.head
  JOIN f r ON r.lang = c.lang AND r.phrase = c.rest
), lowest AS (
  SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
), inner_pairs AS (
  SELECT lang, max(a) AS longer, pair FROM (
    SELECT lang, a, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                            array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS pair
    FROM candidates WHERE words = 3)
  GROUP BY lang, pair
), ranked AS (
  SELECT s.lang, s.phrase, s.a, s.l, s.r, s.score,
         row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN inner_pairs p ON p.lang = s.lang AND p.pair = s.phrase
  WHERE s.place = 1 AND (p.longer IS NULL OR 100 * p.longer < 50 * s.a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

# the other operators rest on a hash function, tokenizer or trained model that
# DuckDB lacks
ORACLE_SQL: dict[str, str] = {"op11_collocations": OP11_SQL}
