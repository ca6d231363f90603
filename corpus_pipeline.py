"""From raw documents to packed batches: five stages, each over all that the one before it kept.

Every stage is a function of (spark, docs, sf_dir); what it returns is written as Parquet and read again as the next
one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm._common import cut, documents
from tidemark.llm.langid import keep_languages
from tidemark.llm.line_dedup import drop_frequent_lines
from tidemark.llm.packing import pack
from tidemark.llm.pii import replace_pii
from tidemark.llm.simhash import drop_near_copies


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, hence without a language, go."""
    return keep_languages(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that at least 10 documents have go from all of them."""
    return drop_frequent_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays."""
    return drop_near_copies(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes surrogates."""
    return replace_pii(docs)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Items in batches of one padded length."""
    return pack(docs)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("personal_data", personal_data), ("batches", batches)]

#: Language prediction, fingerprints and the library's tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
