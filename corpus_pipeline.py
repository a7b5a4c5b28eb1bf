"""The corpus pipeline: stages that each call one operator of ``tabloom.llm`` on what the stage before kept.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of ``docs``; the last returns the packed
pieces. Stages have no SQL equivalent: language and packing are learned or ordered by hashes, so tests hold the
pipeline against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabloom.llm.common import table, written
from tabloom.llm.crf_language import keep_known_languages
from tabloom.llm.curve_packing import pack_documents
from tabloom.llm.deobfuscate import mask_documents
from tabloom.llm.exact_dedup import drop_copies
from tabloom.llm.ngram_join import drop_near_duplicates

LEAST_CERTAINTY = 0.4  # mean over a text's words of their best language's probability
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose words no language fits, go; texts that mix languages stay.

    Null and empty texts have no letters and go. Rows with a null doc_id, repeated rows and very long texts are judged
    like all others; an empty table stays empty.
    """
    return keep_known_languages(spark, docs, LEAST_CERTAINTY)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, a null one before none; null and empty texts are equal.

    Repeated rows leave one row; texts of any length are compared whole; an empty table stays empty.
    """
    return drop_copies(spark, docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of near duplicates the document with the smallest doc_id stays; ties go to the text's digest.

    Null and blank texts are groups of their own and stay; null doc_ids come after all others; an empty table stays empty.
    """
    return drop_near_duplicates(spark, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts, plain or disguised, is replaced by its kind; all rows and null texts stay as they are."""
    return mask_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences along the space-filling curve: every document in pieces, a null text as an empty one."""
    return pack_documents(spark, docs)


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("PII", personal_data),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
