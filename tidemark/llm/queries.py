"""One thin query for each corpus operator, over the whole documents table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm._common import documents
from tidemark.llm.bpe import bpe_encode_decode
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.langid import language_id
from tidemark.llm.licenses import licence_scan
from tidemark.llm.line_dedup import line_dedup
from tidemark.llm.merkle import fingerprint_edits
from tidemark.llm.packing import pack
from tidemark.llm.pii import surrogate_pii
from tidemark.llm.simhash import simhash_near_dedup
from tidemark.llm.token_files import token_files

Query = Callable[[SparkSession, str], DataFrame]


def op1_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode_decode(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup(documents(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


def op5_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir)).drop("spans")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir)).drop("drop_words")


def op9_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan(documents(spark, sf_dir)).drop("notices")


def op10_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_pii(documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    own = (op1_bpe_codec, op2_simhash, op3_token_files, op4_exact_dedup, op5_merkle, op6_packing, op7_language_id, op8_line_dedup, op9_licence_scan, op10_pii_surrogates)
    return {f.__name__: f for f in own}


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(length(text), 0) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), g AS (
  SELECT body, count(*) AS group_size, arg_min(doc_id, row(-n, doc_id)) AS keep_id FROM d GROUP BY body
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.body) AS text_sha256
FROM d JOIN g USING (body)
"""


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS th FROM documents
), l AS (
  SELECT rid, doc_id, th, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d
), k AS (
  SELECT rid, doc_id, th, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), f AS (
  -- a document is a doc_id with its text: rows that repeat both are one
  SELECT key FROM (SELECT DISTINCT key, doc_id, th FROM k WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE key IN (SELECT key FROM f)) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE key NOT IN (SELECT key FROM f)), '')) AS kept_sha256
FROM k GROUP BY rid
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": OP4_SQL, "op8_line_dedup": OP8_SQL}
