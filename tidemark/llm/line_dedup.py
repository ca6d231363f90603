"""Line dedup with DataFrame functions only (operator 8).

Lines become 128-bit hashes; texts never travel with them. The hashes are range-partitioned, ordered by document and
position inside a partition, and streamed: where the document changes, a hash meets a new document. A hash is split
over SALTS ranges by document, so one that every document holds still spreads; the counts of its parts then add up.
Only keep bitmaps, 64 lines to a word and words without dropped lines left out at the end, go back to the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm._common import carried, cut, partitions, pick, restored

#: What a key loses at both ends: space, tab, line feed, vertical tab, form feed, carriage return.
ENDS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ranges over which the documents of one line are spread.
SALTS = 32


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    bare = F.trim(line, F.lit(ENDS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(text: Column, min_chars: int) -> Column:
    """Two independent hashes of each line's key, null where the key is shorter than min_chars."""
    # keys in an array of their own, so that each is made once whatever looks at it
    keys = F.transform(_lines(text), line_key)
    return F.transform(keys, lambda key: F.when(F.length(key) >= min_chars, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))))


def occurrences(rows: DataFrame, min_chars: int) -> DataFrame:
    """doc, th, h1, h2, pos, salt: a row for each line with a key; doc and th (hash of the text) name the row."""
    each = rows.select("doc", "th", F.posexplode(_hashes(F.col("text"), min_chars)).alias("pos", "h")).where("h is not null")
    return each.select("doc", "th", "pos", "h.h1", "h.h2", F.expr(f"cast(pmod(xxhash64(doc, th), {SALTS}) as int)").alias("salt"))


def first_occurrences(occ: DataFrame, parts: int) -> DataFrame:
    """occ with new_doc: 1 where its hash meets a document for the first time (in order of document and position)."""
    ranged = occ.repartitionByRange(parts, "h1", "h2", "salt")
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc", "th", "pos")
    before = F.lag(F.struct("doc", "th")).over(stream)
    return ranged.withColumn("new_doc", F.when(before.eqNullSafe(F.struct("doc", "th")), 0).otherwise(1))


def frequent_lines(occ: DataFrame, min_docs: int, parts: int) -> DataFrame:
    """h1, h2, salt of the lines found in at least min_docs documents, a row for each salt that has some of them."""
    parts_of = first_occurrences(occ, parts).groupBy("h1", "h2", "salt").agg(F.sum("new_doc").alias("docs"))
    whole = parts_of.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.collect_list("salt").alias("salts"))  # SALTS at most
    return whole.where(F.col("docs") >= min_docs).select("h1", "h2", F.explode("salts").alias("salt"))


def drop_bitmaps(occ: DataFrame, frequent: DataFrame) -> DataFrame:
    """doc, th, words: bit pos % 64 of words[pos / 64] is 1 where that line goes; rows without such lines are absent."""
    bits = occ.join(frequent, ["h1", "h2", "salt"], "left_semi").groupBy("doc", "th", F.expr("pos div 64").cast("int").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(pos % 64 as int)))").alias("bits"))
    sparse = bits.groupBy("doc", "th").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    dense = F.expr("transform(sequence(0, array_max(map_keys(m))), w -> coalesce(try_element_at(m, w), 0L))")
    return sparse.select("doc", "th", dense.alias("words"))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, texts: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_lines, n_dropped, kept_sha256, drop_words (the bitmap), with texts also kept.

    Lines whose key is in at least min_docs documents go from all of them; keys below min_chars code points stay. Null
    and empty texts are one empty line. Rows that repeat a doc_id with another text are documents of their own; rows
    that repeat both are one. A null doc_id is like any other. Other columns are ignored; no rows give none.
    """
    rows = _rows(docs)
    joined = rows.join(_bitmaps(rows, min_docs, min_chars), ["doc", "th"], "left")
    kept = _kept()
    out = joined.select(
        F.col("id").alias("doc_id"), F.size(_lines(F.col("text"))).cast("long").alias("n_lines"), _dropped().alias("n_dropped"), F.sha2(kept, 256).alias("kept_sha256"), F.col("words").alias("drop_words"), *([kept.alias("kept")] if texts else [])
    )
    return out


def _rows(docs: DataFrame) -> DataFrame:
    """id, text, and doc, th: the same without nulls, as join keys."""
    rows = pick(docs, doc_id="bigint", text="string")
    return rows.select(F.col("doc_id").alias("id"), "text", *_names())


def _names() -> list[Column]:
    return [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")]


def _bitmaps(rows: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    occ = cut(occurrences(rows, min_chars), "lines")  # hashes only; the texts are not read for them again
    return drop_bitmaps(occ, frequent_lines(occ, min_docs, partitions(rows.sparkSession)))


def _kept() -> Column:
    return F.when(F.col("words").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.expr("array_join(filter(split(coalesce(text, ''), '\\n', -1), (x, i) -> (shiftright(coalesce(get(words, cast(i div 64 as int)), 0L), i % 64) & 1L) = 0L), '\\n')"))


def _dropped() -> Column:
    return F.coalesce(F.expr("aggregate(transform(words, w -> bit_count(w)), 0L, (a, b) -> a + b)"), F.lit(0).cast("long"))


def drop_frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """docs with the frequent lines gone from text and n_chars set anew where lines went; all rows and columns stay."""
    rows = carried(docs, doc_id="bigint", text="string", n_chars="bigint").select("row", "text", "n_chars", *_names())
    joined = rows.join(_bitmaps(rows, min_docs, min_chars), ["doc", "th"], "left").withColumn("kept", F.when(F.col("words").isNull(), F.col("text")).otherwise(_kept()))
    return restored(joined, docs.columns, text=F.col("kept"), n_chars=F.when(F.col("words").isNull(), F.col("n_chars")).otherwise(F.length("kept").cast("long")))
