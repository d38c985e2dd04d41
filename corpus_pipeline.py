"""Corpus pipeline: ``documents`` to packed training sequences.

Each stage works on all documents that its predecessor kept and returns the
columns of ``documents``, those that it does not name untouched whatever they
are called; the last returns the packed pieces. ``run`` applies
them in order and writes what each returns to the shared folder, so a lost
executor costs at most one stage.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from brightwash.llm import contamination, langid, packing, pii, simhash  # noqa: E402
from brightwash.llm.common import table, written  # noqa: E402
from brightwash.llm.queries import WORD_TOKENIZER  # noqa: E402


def _carried(docs: DataFrame, *used: str) -> DataFrame:
    """The columns ``used`` and, as one struct ``rest``, all others: whatever
    their names, they meet no column that an operator adds."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(*used, F.struct(*rest or [F.lit(None).alias("none")]).alias("rest"))


def _restored(found: DataFrame, columns: list[str], **own: Column) -> DataFrame:
    """The columns of the documents again, in their order; ``own`` gives those
    that the stage read, all others are as they came."""
    return found.select(*[own[c].alias(c) if c in own else F.col("rest").getField(c).alias(c) for c in columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a text or a letter go; a missing language is filled in,
    or stays missing if no document has one to learn from."""
    model = langid.train(docs)
    found = langid.identify(_carried(docs, "text", "lang"), model)
    found = found.filter(F.col("lang_pred") != langid.UNKNOWN if model.langs else F.col("text").rlike(r"\p{L}"))
    known = F.when(F.col("lang_pred") != langid.UNKNOWN, F.col("lang_pred"))
    return _restored(found, docs.columns, text=F.col("text"), lang=F.coalesce("lang", known))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays
    (one without an id only if no other has one); of repeated rows one stays."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    rows = written(docs.select(F.monotonically_increasing_id().alias("row"), whole), "numbered")
    texts = rows.select("row", F.col("doc.text").alias("text"))
    groups = simhash.near_duplicates(texts, id_col="row", shingle=3, max_bits=2)
    least = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    members = groups.join(rows.select("row", F.col("doc.doc_id").alias("doc_id")), "row")
    keep = members.groupBy("component_id").agg(F.min(least).alias("first"))
    return rows.join(keep.select("first.row"), "row", "left_semi").select("doc.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. One without a text holds none;
    with an empty benchmark all stay."""
    found = contamination.find_items(_carried(docs, "text"), table(spark, sf_dir, "benchmark"))
    return _restored(found.filter(F.size("matches") == 0), docs.columns, text=F.col("text"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets, and n_chars follows; a
    text without any, or null, stays as it is."""
    found = pii.find_spans(_carried(docs, "text", "n_chars"), pii.train(docs))
    size = F.when(F.col("spans") != "", F.char_length("redacted").cast("long")).otherwise(F.col("n_chars"))
    return _restored(found, docs.columns, text=F.col("redacted"), n_chars=size)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces placed in sequences of at most 4,096 tokens."""
    return packing.pack_documents(docs, WORD_TOKENIZER, capacity=4096, end_id=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("decontaminate", decontaminate),
    ("redact_pii", redact_pii),
    ("pack", pack),
]

# trained models, tokenizer ids and hashes that DuckDB does not have
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
