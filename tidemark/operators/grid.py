"""Tables of documents as long cells: cleaning, merged cells, and the facts that tables state.

cells(doc, tbl, row, col, text) holds every coordinate of a grid, merged ones repeated; spans(doc, tbl, row, col, row_span,
col_span) holds the cells as they were drawn. Facts keep where they came from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T
from tidemark.operators.lines import label_pairs, with_items
from tidemark.plans.staging import sized, staged

TABLE = ["doc", "tbl"]
ROW = ["doc", "tbl", "row"]
#: A row is a header where at least this part of its cells are labels that items know; at most so many rows are.
HEADER_PART, HEADER_ROWS = 0.6, 2


def trimmed(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", T.trim_control(F.coalesce("text", F.lit(""))))


def clean_grid(cells: DataFrame) -> DataFrame:
    """cells without empty rows, then without empty columns, with new_row and new_col; row and col stay the original ones.

    The first row that stays says how wide the grid is: further columns are dropped, and rows that are shorter are
    filled with empty cells.
    """
    rows = trimmed(cells).withColumn("used", F.max((F.col("text") != "").cast("int")).over(Window.partitionBy(*ROW))).where("used = 1").drop("used")
    first = F.min("row").over(Window.partitionBy(*TABLE))
    rows = rows.withColumn("first", first).withColumn("width", F.sum((F.col("row") == F.col("first")).cast("int")).over(Window.partitionBy(*TABLE)))
    inside = rows.where("col < width")
    used = inside.where("text <> ''").select(*TABLE, "col").distinct()
    used = used.withColumn("new_col", F.row_number().over(Window.partitionBy(*TABLE).orderBy("col")) - 1)
    kept = rows.select(*ROW).distinct().withColumn("new_row", F.row_number().over(Window.partitionBy(*TABLE).orderBy("row")) - 1)
    full = kept.join(used, TABLE)  # rows times columns of one table, which is what a grid is
    return full.join(inside.select(*ROW, "col", "text"), [*ROW, "col"], "left").select(*ROW, "col", "new_row", "new_col", F.coalesce("text", F.lit("")).alias("text"))


def dedupe_neighbours(cells: DataFrame) -> DataFrame:
    """cells, trimmed, without those that equal the cell on their left."""
    left = F.lag("text").over(Window.partitionBy(*ROW).orderBy("col"))
    return trimmed(cells).withColumn("left", left).where("left IS NULL OR left <> text").drop("left")


def span_owners(spans: DataFrame) -> DataFrame:
    """owners(doc, tbl, row, col, owner) of tables that have a merged cell: each coordinate's cell, where cells lie over one another the last drawn."""
    merged = sized(spans, *TABLE).withColumn("merged", F.max(((F.col("row_span") > 1) | (F.col("col_span") > 1)).cast("int")).over(Window.partitionBy(*TABLE))).where("merged = 1")
    owner = F.struct(F.col("row").alias("r"), F.col("col").alias("c"))
    down = merged.select(*TABLE, owner.alias("owner"), "col", "col_span", F.explode(F.expr("sequence(row, row + greatest(row_span, 1) - 1)")).alias("row"))
    each = down.select(*TABLE, "owner", "row", F.explode(F.expr("sequence(col, col + greatest(col_span, 1) - 1)")).alias("col"))
    return each.groupBy(*ROW, "col").agg(F.max("owner").alias("owner"))


def logical_cells(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """cells without those that go on what is on their left, with span_aware.

    With merged cells known, that is a coordinate of the same cell; else one with the same text. Repeats downwards stay.
    """
    owners = span_owners(spans)
    aware = owners.select(*TABLE).distinct().withColumn("span_aware", F.lit(True))
    across = Window.partitionBy(*ROW).orderBy("col")
    joined = trimmed(cells).join(aware, TABLE, "left").join(owners, [*ROW, "col"], "left").withColumn("span_aware", F.coalesce("span_aware", F.lit(False)))
    goes_on = F.when(F.col("span_aware"), F.col("owner").isNotNull() & F.col("owner").eqNullSafe(F.lag("owner").over(across))).otherwise(F.col("text").eqNullSafe(F.lag("text").over(across)))
    return joined.withColumn("goes_on", goes_on).where("NOT goes_on").select(*ROW, "col", "text", "span_aware")


def header_rows(cleaned: DataFrame, synonyms: DataFrame) -> DataFrame:
    """heads(doc, tbl, header_rows): tables whose first one or two cleaned rows are headers, and have a row below.

    Of neighbours that repeat only one counts; at least two cells with content, HEADER_PART of them known.
    """
    top = cleaned.where(F.col("new_row") < HEADER_ROWS)
    left = F.lag("text").over(Window.partitionBy(*TABLE, "new_row").orderBy("new_col"))
    once = top.withColumn("left", left).where("(left IS NULL OR left <> text) AND text <> ''")
    known = with_items(once.withColumnRenamed("text", "label"), synonyms)
    judged = known.groupBy(*TABLE, "new_row").agg(F.count(F.lit(1)).alias("n"), F.count("item_cd").alias("known"))
    good = judged.where((F.col("n") >= 2) & (F.col("known") >= F.ceil(F.col("n") * HEADER_PART)))
    heads = good.groupBy(*TABLE).agg(F.max(F.when(F.col("new_row") == 0, 1)).alias("first"), F.max(F.when(F.col("new_row") == 1, 1)).alias("second")).where("first = 1")
    height = cleaned.groupBy(*TABLE).agg((F.max("new_row") + 1).alias("height"))
    n = F.when(F.col("second").isNotNull() & (F.col("height") > 2), 2).otherwise(1)
    return heads.join(height, TABLE).where("height > 1").select(*TABLE, n.alias("header_rows"))


def header_columns(cleaned: DataFrame, heads: DataFrame, synonyms: DataFrame) -> DataFrame:
    """columns(doc, tbl, new_col, col, raw_label, label, item_cd): the lowest level that an item knows, else upper levels, else "upper lower"."""
    levels = cleaned.join(heads, TABLE).where("new_row < header_rows").select(*TABLE, "new_col", "col", "new_row", F.col("text").alias("level"))
    # of levels that repeat only one; the lowest first
    wide = levels.groupBy(*TABLE, "new_col", "col").agg(F.max(F.when(F.col("new_row") == 0, F.col("level"))).alias("upper"), F.max(F.when(F.col("new_row") == 1, F.col("level"))).alias("second"))
    low = F.when(F.coalesce("second", F.lit("")) != "", F.col("second")).otherwise(F.col("upper"))
    high = F.when((F.coalesce("second", F.lit("")) != "") & (F.col("upper") != "") & (F.col("upper") != F.col("second")), F.col("upper"))
    tries = wide.select(*TABLE, "new_col", "col", low.alias("lower"), high.alias("higher")).withColumn("both", F.concat_ws(" ", "higher", "lower"))
    for name in ("lower", "higher", "both"):
        tries = with_items(tries, synonyms, name, f"{name}_cd")
    raw = F.when(F.col("lower_cd").isNotNull() | F.col("higher").isNull(), F.col("lower")).when(F.col("higher_cd").isNotNull(), F.col("higher")).when(F.col("both_cd").isNotNull(), F.col("both")).otherwise(F.col("lower"))
    code = F.coalesce("lower_cd", F.when(F.col("higher").isNotNull(), F.coalesce("higher_cd", "both_cd")))
    return tries.select(*TABLE, "new_col", "col", raw.alias("raw_label")).withColumn("label", T.normalise_label("raw_label")).join(tries.select(*TABLE, "new_col", code.alias("item_cd")), [*TABLE, "new_col"])


def list_facts(cells: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Facts of tables with headers: each row below them is a record. Tables that state nothing so are not here."""
    cleaned = staged(clean_grid(cells), "cleaned")
    heads = staged(header_rows(cleaned, synonyms), "heads")
    columns = staged(header_columns(cleaned, heads, synonyms).drop("col"), "columns")
    body = cleaned.join(heads, TABLE).where("new_row >= header_rows").join(columns, [*TABLE, "new_col"]).withColumn("value", T.flat_value("text"))
    kept = body.where((F.col("value") != "") & (F.col("item_cd").isNotNull() | T.keeps_unknown_label("label", "value")))
    return kept.select(*TABLE, F.lit("header_list").alias("kind"), F.col("row").alias("record_row"), F.lit("column").alias("origin"), "row", "col", "raw_label", "label", "item_cd", "value")


def pair_cells(logical: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Facts of neighbours label and value in a row, from left to right: a cell that was taken as a value is no label.

    A value that is itself a known label is none. Unknown labels need to be worth keeping and without a colon.
    """
    right = F.lead(F.struct("col", "text")).over(Window.partitionBy(*ROW).orderBy("col"))
    known = with_items(logical.withColumnRenamed("text", "raw_label"), synonyms, "raw_label").withColumnRenamed("raw_label", "text")
    pairs = known.withColumn("right", right).withColumn("right_cd", F.lead("item_cd").over(Window.partitionBy(*ROW).orderBy("col"))).withColumn("value", T.flat_value("right.text"))
    label = T.normalise_label("text")
    fits = (F.col("text") != "") & ~F.col("text").contains("\n") & F.coalesce(F.col("value") != "", F.lit(False)) & F.col("right_cd").isNull()
    fits = fits & (F.col("item_cd").isNotNull() | (~F.col("text").rlike("[:：]") & T.keeps_unknown_label(label, "value")))
    state = pairs.select(*ROW, F.struct("col", fits.alias("fits"), F.col("right.col").alias("at"), F.col("text").alias("raw_label"), label.alias("label"), "item_cd", "value").alias("c"))
    rows = state.groupBy(*ROW).agg(F.array_sort(F.collect_list("c")).alias("cs")).where(F.exists("cs", lambda c: c["fits"]))
    # taken: the last place that became a value; a pair may start anywhere but there
    fold = "aggregate(cs, struct(-1 AS taken, cast(array() AS array<int>) AS starts), (a, c) -> CASE WHEN c.fits AND c.col <> a.taken THEN struct(c.at AS taken, concat(a.starts, array(c.col)) AS starts) ELSE a END)"
    chosen = rows.select(*ROW, "cs", F.expr(fold)["starts"].alias("starts")).select(*ROW, F.explode(F.expr("filter(cs, c -> array_contains(starts, c.col))")).alias("c"))
    return chosen.select(*TABLE, F.lit("label_value").alias("kind"), F.lit(-1).alias("record_row"), F.lit("label_pair").alias("origin"), "row", F.col("c.at").alias("col"), "c.raw_label", "c.label", "c.item_cd", "c.value")


def in_cell_facts(logical: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Facts of pairs "label : value" inside cells."""
    cell = F.struct(*ROW, "col")
    lines = logical.where(F.col("text").rlike("[:：]")).select(cell.alias("doc"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "text"))
    known = with_items(label_pairs(lines), synonyms).withColumn("raw_label", F.col("label")).withColumn("label", T.normalise_label("label"))
    kept = known.where(F.col("item_cd").isNotNull() | T.keeps_unknown_label("label", "value"))
    return kept.select("doc.doc", "doc.tbl", F.lit("label_value").alias("kind"), F.lit(-1).alias("record_row"), F.lit("in_cell").alias("origin"), "doc.row", "doc.col", "raw_label", "label", "item_cd", "value", "line_no")


def interpret(cells: DataFrame, spans: DataFrame, synonyms: DataFrame) -> DataFrame:
    """facts(doc, tbl, kind, record_row, origin, row, col, raw_label, label, item_cd, value, pos) of all tables.

    Tables with headers give records; the others pairs of neighbours, then pairs inside cells. pos orders a table's facts.
    """
    lists = staged(list_facts(cells, synonyms), "lists")
    logical = staged(logical_cells(cells, spans).join(lists.select(*TABLE).distinct(), TABLE, "left_anti"), "logical")
    every = lists.withColumn("part", F.lit(0)).withColumn("line_no", F.lit(0)).unionByName(pair_cells(logical, synonyms).withColumn("part", F.lit(1)).withColumn("line_no", F.lit(0))).unionByName(in_cell_facts(logical, synonyms).withColumn("part", F.lit(2)))
    order = Window.partitionBy(*TABLE).orderBy("part", "row", "col", "line_no")
    return every.withColumn("pos", F.row_number().over(order)).drop("part", "line_no")


def table_kinds(cells: DataFrame, facts: DataFrame) -> DataFrame:
    """kinds(doc, tbl, kind, n_rows, n_cols, n_facts): header_list, label_value, or unknown where a table states nothing."""
    size = cells.groupBy(*TABLE).agg((F.max("row") + 1).alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    own = facts.groupBy(*TABLE).agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n_facts"))
    return size.join(own, TABLE, "left").select(*TABLE, F.coalesce("kind", F.lit("unknown")).alias("kind"), "n_rows", "n_cols", F.coalesce("n_facts", F.lit(0)).cast("long").alias("n_facts"))


def table_summary(kinds: DataFrame, facts: DataFrame) -> DataFrame:
    """summary(doc, n_tables, n_facts, n_mapped, n_unmapped, unmapped): unmapped labels once each, by first appearance."""
    seen = facts.where("item_cd IS NULL").groupBy("doc", "label").agg(F.min(F.struct("tbl", "pos")).alias("at"))
    labels = seen.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("at", "label"))).alias("l")).select("doc", F.col("l.label").alias("unmapped"))
    counts = facts.groupBy("doc").agg(F.count(F.lit(1)).alias("n_facts"), F.count("item_cd").alias("n_mapped"))
    tables = kinds.groupBy("doc").agg(F.count(F.lit(1)).alias("n_tables"))
    joined = tables.join(counts, "doc", "left").join(labels, "doc", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return joined.select("doc", "n_tables", zero(F.col("n_facts")).alias("n_facts"), zero(F.col("n_mapped")).alias("n_mapped"), zero(F.col("n_facts") - F.col("n_mapped")).alias("n_unmapped"), F.coalesce("unmapped", F.array().cast("array<string>")).alias("unmapped"))
