"""Names of columns held against a dictionary of words: what they are made of, and what they break."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Longest name, and names that SQL keeps for itself.
MAX_NAME = 30
RESERVED = "ALL AND ANY AS BETWEEN BY CASE CHECK CREATE CROSS DATE DEFAULT DELETE DISTINCT DROP ELSE END EXISTS FOREIGN FROM GROUP HAVING IN INDEX INSERT INTO IS JOIN KEY LIKE NOT NULL ON OR ORDER PRIMARY SELECT SET TABLE THEN TO UNION UNIQUE UPDATE USER USING VALUES VIEW WHEN WHERE WITH".split()


def decompose(names: DataFrame, words: DataFrame) -> DataFrame:
    """parts(name, pos, word, meaning, domain) of names(name, ..) split at "_"; words(word, meaning, domain): domain only for classifiers."""
    each = names.select("name", F.posexplode(F.split("name", "_")).alias("pos", "word"))
    return each.join(words, "word", "left").select("name", "pos", "word", "meaning", "domain")


def name_violations(names: DataFrame, words: DataFrame) -> DataFrame:
    """names(name, domain) with violations: unknown words, a last word that is no classifier, another domain, length, reserved words."""
    parts = decompose(names.select("name"), words)
    told = parts.groupBy("name").agg(
        F.array_sort(F.collect_set(F.when(F.col("meaning").isNull(), F.concat(F.lit("unknown word "), "word")))).alias("unknown"),
        F.max_by("domain", "pos").alias("last"),
        F.max_by("word", "pos").alias("last_word"),
    )
    joined = names.join(told, "name")
    rest = F.array_compact(F.array(
        F.when(F.col("last").isNull(), F.concat(F.lit("no classifier at the end: "), "last_word")),
        F.when(F.col("last") != F.col("domain"), F.concat(F.lit("domain should be "), "last")),
        F.when(F.length("name") > MAX_NAME, F.lit(f"longer than {MAX_NAME}")),
        F.when(F.upper("name").isin(*RESERVED), F.lit("reserved")),
    ))
    return joined.select("name", "domain", F.concat("unknown", rest).alias("violations"))
