"""Lines of documents: label and value pairs, captions, and what a document says of itself.

Everything is a long table with ordinals, lines(doc, line_no, text); order is a column, never a list's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T
from tidemark.plans.staging import sorted_side


def by_line():
    return Window.partitionBy("doc").orderBy("line_no")


def explode_lines(texts: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """lines(doc, line_no, text) of whole texts, split at line feeds; trimmed, without blank ones."""
    each = texts.select(F.col(doc).alias("doc"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "raw"))
    return each.select("doc", "line_no", T.trim_control("raw").alias("text")).where("text <> ''")


def label_pairs(lines: DataFrame) -> DataFrame:
    """pairs(doc, line_no, label, value, number) of lines "label : value".

    A line that begins with a colon is the value of a line before that is no pair itself. A pair without a value takes
    the next line unless that is a pair. Pairs that end without a value are dropped.
    """
    told = lines.withColumn("is_pair", T.is_label_line("text"))  # once a line: the window carries it to the neighbours
    near = told
    for name, side in (("before", F.lag), ("after", F.lead)):
        near = near.withColumn(name, side("text").over(by_line())).withColumn(f"{name}_pair", side("is_pair").over(by_line()))
    goes_on = (F.startswith("text", F.lit(":")) | F.startswith("text", F.lit("："))) & F.col("before").isNotNull() & ~F.col("before_pair")
    kept = near.withColumn("goes_on", goes_on).where("goes_on OR is_pair")
    own = kept.withColumn("own", T.trim_control(F.when(F.col("goes_on"), F.expr("substr(text, 2)")).otherwise(T.behind_colon("text"))))
    next_ = ~F.col("goes_on") & (F.col("own") == "") & F.col("after").isNotNull() & ~F.col("after_pair")
    pair = F.struct(
        F.when(F.col("goes_on"), F.col("before")).otherwise(F.regexp_extract("text", T.LABEL_LINE, 1)).alias("label"),
        F.when(next_, T.trim_control("after")).otherwise(F.col("own")).alias("value"),
        T.line_number(F.when(F.col("goes_on"), F.col("before")).otherwise(F.col("text"))).alias("number"),
    )
    # a filter would be pushed below and make all that again
    solid = F.filter(F.array(pair), lambda p: ~T.is_blank(p["value"]))
    return own.select("doc", "line_no", F.explode(solid).alias("p")).select("doc", "line_no", "p.label", "p.value", "p.number")


def with_items(df: DataFrame, synonyms: DataFrame, label: str = "label", out: str = "item_cd", normal: str | None = None) -> DataFrame:
    """df with out, the item that a label names: by its whole, else its part before brackets, else that inside.

    synonyms(label, item_cd) is a dictionary; Spark broadcasts it while it is below the threshold. normal: the column that
    has the label in its normal form already, if any. Labels without brackets have no parts to look for.
    """
    own = F.col(normal) if normal else T.normalise_label(label)
    bracket = F.contains("_n", F.lit("("))
    keys = df.withColumn("_n", own).withColumn("_o", F.when(bracket, T.outer_part("_n"))).withColumn("_i", F.when(bracket, T.inner_part("_n")))
    for key in ("_n", "_o", "_i"):
        keys = keys.join(synonyms.select(F.col("label").alias(key), F.col("item_cd").alias(key + "_hit")), key, "left")
    return keys.select(*df.columns, F.coalesce("_n_hit", "_o_hit", "_i_hit").alias(out))


def pair_facts(pairs: DataFrame, synonyms: DataFrame) -> DataFrame:
    """facts(doc, pos, number, label, item_cd, value) of pairs: known labels, and unknown ones worth keeping (normalised)."""
    known = with_items(pairs.withColumn("normal", T.normalise_label("label")), synonyms, normal="normal")
    kept = known.where(F.col("item_cd").isNotNull() | T.keeps_unknown_label("normal", "value"))
    return kept.select("doc", F.col("line_no").alias("pos"), "number", F.col("normal").alias("label"), "item_cd", "value")


def nearest_captions(lines: DataFrame) -> DataFrame:
    """lines with caption: of two lines before and two after, the first that is a caption (before goes first, the farther one too)."""
    near = [F.lag("text", 2).over(by_line()), F.lag("text", 1).over(by_line()), F.lead("text", 1).over(by_line()), F.lead("text", 2).over(by_line())]
    return lines.withColumn("caption", F.coalesce(*[F.when(T.is_caption(c), T.trim_control(c)) for c in near]))


def candidate_lines(paragraphs: DataFrame, cells: DataFrame) -> DataFrame:
    """lines(doc, line_no, text): paragraphs first, then the lines of tables' cells, of neighbours that repeat only one.

    paragraphs(doc, pos, text), cells(doc, tbl, row, col, text). Only lines of tables are dropped as repeats.
    """
    by_row = Window.partitionBy("doc", "tbl", "row").orderBy("col")
    trimmed = cells.withColumn("text", T.trim_control(F.coalesce("text", F.lit(""))))
    once = trimmed.withColumn("before", F.lag("text").over(by_row))
    once = once.where(F.col("before").isNull() | (F.col("before") != F.col("text")))
    inner = once.select("doc", "tbl", "row", "col", F.posexplode(F.split("text", "\n", -1)).alias("k", "raw")).select("doc", "tbl", "row", "col", "k", T.trim_control("raw").alias("text"))
    own = paragraphs.select("doc", F.lit(-1).alias("tbl"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.col("pos").cast("int").alias("k"), T.trim_control("text").alias("text"))
    order = Window.partitionBy("doc").orderBy("tbl", "row", "col", "k")
    every = own.unionByName(inner).where("text <> ''").withColumn("before", F.lag("text").over(order))
    kept = every.where((F.col("tbl") < 0) | F.col("before").isNull() | (F.col("before") != F.col("text")))
    return kept.select("doc", (F.row_number().over(order) - 1).alias("line_no"), "text")


def _first(value: Column, order: Column, when: Column) -> Column:
    return F.min_by(F.when(when, value), F.when(when, order))


def document_meta(lines: DataFrame, titled: DataFrame, guesses: DataFrame) -> DataFrame:
    """meta(doc, BODY_AGNCY_NM, NOTI_NO, NOTI_DT, NOTI_PSN, NOTI_TTL) of candidate lines.

    titled(doc): documents whose tables name a title, for which none is guessed; guesses(doc, title): those that tables
    suggest. Else the line after the number is the title, where it is no pair, date or signer.
    """
    near = lines.withColumn("before", F.lag("text").over(by_line())).withColumn("after", F.lead("text").over(by_line()))
    found = near.withColumn("hit", T.notice_number("text", "before"))
    start = F.min(F.when(F.col("hit").isNotNull(), F.col("line_no"))).over(Window.partitionBy("doc"))
    found = found.withColumn("start", start).withColumn("here", F.col("line_no") == F.col("start"))
    later = F.col("line_no") >= F.coalesce("start", F.lit(0))
    # in a when() what is dear is made for the few lines that pass the first test
    pure = F.when(later & F.col("text").rlike(r"^[\d\s.년월일:～~’'-]*\z"), T.date_iso("text").isNotNull() & ~T.is_label_line("text"))
    plain = F.when(F.col("here") & F.col("after").isNotNull(), ~T.is_label_line("after") & T.date_iso("after").isNull() & ~T.is_signer("after"))
    meta = found.groupBy("doc").agg(
        F.max(F.when(F.col("here"), F.col("hit.agency"))).alias("BODY_AGNCY_NM"),
        F.max(F.when(F.col("here"), F.col("hit.number"))).alias("NOTI_NO"),
        _first(F.col("text"), F.col("line_no"), pure).alias("NOTI_DT"),
        _first(T.signer_name("text"), F.col("line_no"), later & T.is_signer("text")).alias("NOTI_PSN"),
        F.max(F.when(plain, T.unspaced("after"))).alias("next_title"),
    )
    named = titled.select("doc").distinct().withColumn("named", F.lit(True))
    joined = meta.join(sorted_side(named), "doc", "left").join(sorted_side(guesses), "doc", "left")
    title = F.when(F.col("named").isNull(), F.coalesce("title", "next_title"))
    return joined.select("doc", "BODY_AGNCY_NM", "NOTI_NO", "NOTI_DT", "NOTI_PSN", title.alias("NOTI_TTL"))


def title_guesses(cells: DataFrame) -> DataFrame:
    """guesses(doc, title) from each document's first table.

    A table of one column whose first cell has a notice number gives its second row's first line; else the first cell
    that is a number line followed by a line that may be a title.
    """
    table = cells.withColumn("first", F.min("tbl").over(Window.partitionBy("doc"))).where("tbl = first").withColumn("text", F.coalesce("text", F.lit("")))
    form = table.groupBy("doc").agg(
        F.max("col").alias("last_col"), F.max("row").alias("last_row"), F.max(F.when((F.col("row") == 0) & (F.col("col") == 0), F.col("text"))).alias("head"), F.max(F.when((F.col("row") == 1) & (F.col("col") == 0), F.col("text"))).alias("second")
    )
    number = f"{T.NOTICE_WORD}\\s*{T.SERIAL}"
    first_line = T.trim_control(F.get(F.split("second", "\n", 2), F.lit(0)))
    by_form = form.where((F.col("last_col") == 0) & (F.col("last_row") >= 1) & F.col("head").rlike(number)).select("doc", F.nullif(first_line, F.lit("")).alias("form_title"))
    # a cell: blank lines, a number line, blank lines, then the line to judge
    head = rf"^\s*(?:고\s*시|공\s*고|허\s*가\s*번\s*호|승\s*인\s*번\s*호|면\s*허\s*번\s*호)\s*{T.SERIAL}\s*$"
    solid = F.filter(F.transform(F.split("text", "\n", -1), lambda x: T.trim_control(x)), lambda x: x != "")
    judged = table.withColumn("solid", solid).where(F.get("solid", F.lit(0)).rlike(head)).withColumn("next", F.get("solid", F.lit(1)))
    fits = (T.utf16_length("next") <= 60) & ~T.is_label_line("next") & T.date_iso("next").isNull() & ~T.is_signer("next")
    by_cell = judged.where(fits).groupBy("doc").agg(F.min_by("next", F.struct("row", "col")).alias("cell_title"))
    return by_form.join(by_cell, "doc", "full").select("doc", F.coalesce("form_title", "cell_title").alias("title")).where("title IS NOT NULL")
