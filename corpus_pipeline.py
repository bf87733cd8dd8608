"""The corpus pipeline: stages over `documents`, each one written and read again before the next.

Every stage takes the session, the documents its predecessor kept and the folder of the tables. All but
the last return the columns of `documents`.

A null text counts as the empty text throughout, and very long texts are worked on whole. An empty table
gives an empty result in every stage. Repeated rows are judged alike by the quality and language stages,
are one group in the near-duplicate stage, and are masked and packed each for itself.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import language_id, near_dup, packing, pii, quality
from ticketlake.llm.common import id_fold, on_workers, staged, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Score from which on a document is good enough, as in the query of the classifier.
GOOD = 0.3
SEQUENCE_TOKENS, END_ID = 4096, 1
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Smaller batches than in single queries: an executor's heap, grown by the stages before, stays beside them.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; labels of held-out ids are not learned from."""
    on_workers(spark, BATCH)
    labels = table(spark, sf_dir, "labels").filter(id_fold(F.col("doc_id"), 5) != 0)
    model = quality.fit(docs, labels)
    return docs.filter(quality.score_column(model, F.col("text")) >= GOOD)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; undetermined ones go, unless no language was learned."""
    on_workers(spark, BATCH)
    model = language_id.fit(docs)
    if not model.langs:
        return docs
    labelled = language_id.identify(docs, model, out="_language")
    return labelled.filter(F.col("_language.lang") != language_id.UNDETERMINED).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id."""
    on_workers(spark, BATCH)
    return near_dup.deduplicated(docs)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked and their length counted again."""
    masked = pii.find_pii(docs, out="_pii").withColumn("text", pii.masked(F.col("text"), F.col("_pii")))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in training sequences."""
    on_workers(spark, BATCH)
    pieces = packing.token_pieces(docs.select("doc_id", "text"), TOKENIZER, SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality), ("language", known_language), ("near_dup", one_of_each), ("pii", without_pii),
    ("packing", packed),
]
#: No stage but the masking of personal data can be told in SQL; tests compare with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole `documents` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
