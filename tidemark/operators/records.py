"""Records of documents: merged facts, dispositions, normal forms, and the split into item and label values.

facts(doc, record, source, tbl, pos, number, label, item_cd, value); a smaller source speaks first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T

META = ("BODY_AGNCY_NM", "NOTI_NO", "NOTI_DT", "NOTI_TTL", "NOTI_PSN")
PERIOD, PERIOD_START, PERIOD_END = "WORK_PRD", "WORK_PRD_ST", "WORK_PRD_EN"
RECORD = ["doc", "record"]


def first_writer_wins(facts: DataFrame) -> DataFrame:
    """values(doc, record, key, mapped, value): of facts with content, each item's and each unknown label's first.

    The order is source, tbl, pos; a group folds before it is shuffled.
    """
    key = F.coalesce("item_cd", "label").alias("key")
    order = F.struct("source", "tbl", "pos")
    solid = facts.where(~T.is_blank("value")).select(*RECORD, key, F.col("item_cd").isNotNull().alias("mapped"), order.alias("at"), T.trim_control("value").alias("value"))
    return solid.groupBy(*RECORD, "key", "mapped").agg(F.min_by("value", "at").alias("value"))


def disposition_blocks(pairs: DataFrame, attributes: list[str]) -> DataFrame:
    """pairs with record, the disposition (from 0) that each is part of, of documents that state two or more.

    pairs(doc, pos, number, label, item_cd, value) in order of pos. A new block begins where the number is 1 and its item, one of
    attributes, has been filled in the block at hand. The fold runs over one document's pairs at a time.
    """
    item = F.when(F.col("item_cd").isin(*attributes), F.col("item_cd"))
    rows = pairs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("pos", "number", item.alias("item"), "label", "item_cd", "value"))).alias("ps"))
    fold = """aggregate(ps, struct(0 AS block, cast(array() AS array<string>) AS filled, cast(array() AS array<int>) AS blocks), (a, p) ->
        CASE WHEN p.number = 1 AND p.item IS NOT NULL AND array_contains(a.filled, p.item)
             THEN struct(a.block + 1 AS block, array(p.item) AS filled, concat(a.blocks, array(a.block + 1)) AS blocks)
             ELSE struct(a.block AS block, CASE WHEN p.item IS NULL THEN a.filled ELSE array_union(a.filled, array(p.item)) END AS filled, concat(a.blocks, array(a.block)) AS blocks) END)"""
    told = rows.select("doc", "ps", F.expr(fold).alias("f")).where("f.block > 0")
    each = told.select("doc", F.posexplode(F.arrays_zip(F.col("ps").alias("p"), F.col("f.blocks").alias("record"))).alias("i", "z"))
    return each.select("doc", F.col("z.record").alias("record"), "z.p.pos", "z.p.number", "z.p.label", "z.p.item_cd", "z.p.value")


def assemble(base: DataFrame, rows: DataFrame) -> DataFrame:
    """values of the records that count: rows where a document has any, with what they lack of META from base; else base.

    base and rows are values of first_writer_wins; base has record 0 only. A document without any value has no row here.
    """
    many = rows.select("doc").distinct()
    alone = base.join(many, "doc", "left_anti")
    meta = base.where(F.col("mapped") & F.col("key").isin(*META)).select("doc", "key", "mapped", "value")
    passed = rows.select(*RECORD).distinct().join(meta, "doc").join(rows.where("mapped").select(*RECORD, "key"), [*RECORD, "key"], "left_anti")
    return alone.unionByName(rows).unionByName(passed.select(*rows.columns))


def normalise_records(values: DataFrame) -> DataFrame:
    """values with approval numbers and dates apart, dates and the period in ISO form, and addresses found in names.

    Dates that are none become unknown labels under their item; so does a period neither half of which is a date. A key
    that is there already is never replaced by what is found here.
    """
    # a record's values are few: one shuffle brings them together, and all else happens inside the row
    whole = values.groupBy(*RECORD).agg(F.collect_list(F.struct("key", "mapped", "value")).alias("v"))
    one = whole.withColumn("m", F.map_from_entries(F.transform(F.filter("v", lambda x: x["mapped"]), lambda x: F.struct(x["key"], x["value"]))))
    get = lambda k: F.try_element_at("m", F.lit(k))
    one = one.withColumn("apv", T.approval_parts(get("APV_NO"))).withColumn("halves", T.range_halves(get(PERIOD))).withColumn("noti_dt", T.date_iso(get("NOTI_DT")))
    one = one.withColumn("apv_dt", F.coalesce(get("APV_DT"), F.col("apv.date"))).withColumn("apv_iso", T.date_iso("apv_dt"))
    one = one.withColumn("start", F.coalesce(get(PERIOD_START), T.date_iso("halves.lo"))).withColumn("end", F.coalesce(get(PERIOD_END), T.date_iso("halves.hi")))
    fields = {
        "APV_NO": F.col("apv.number"), "NOTI_DT": F.col("noti_dt"), "APV_DT": F.col("apv_iso"), PERIOD_START: F.col("start"), PERIOD_END: F.col("end"),
        "APLC_ADDR": F.coalesce(get("APLC_ADDR"), T.address(get("APLC_NM"))),
    }
    extras = {"NOTI_DT": F.when(F.col("noti_dt").isNull(), get("NOTI_DT")), "APV_DT": F.when(F.col("apv_iso").isNull(), F.col("apv_dt")), PERIOD: F.when(F.col("start").isNull() & F.col("end").isNull(), get(PERIOD))}
    made = [F.struct(F.lit(k).alias("key"), F.lit(mapped).alias("mapped"), v.alias("value")) for kind, mapped in ((fields, True), (extras, False)) for k, v in kind.items()]
    one = one.withColumn("rest", F.filter("v", lambda x: ~(x["mapped"] & x["key"].isin(*fields, PERIOD)))).withColumn("made", F.filter(F.array(*made), lambda x: x["value"].isNotNull()))
    # an unknown label that was there first stays
    fresh = F.filter("made", lambda x: ~F.exists("rest", lambda r: (r["key"] == x["key"]) & (r["mapped"] == x["mapped"])))
    return one.select(*RECORD, F.explode(F.concat("rest", fresh)).alias("e")).select(*RECORD, "e.*")


def split_values(values: DataFrame, fields: DataFrame) -> DataFrame:
    """rows(doc, record, target, name, value): target item for attributes the dictionary knows, label for unknown keys.

    fields(item_cd, scope). Keys of the attachment itself are neither. A period is one literal, and only where both halves are
    there in order. Labels that are one but for blanks around them come once, unknown items before others.
    """
    known = values.join(fields.select(F.col("item_cd").alias("key"), "scope"), "key", "left").withColumn("scope", F.when(F.col("mapped"), F.col("scope")))
    rows = known.groupBy(*RECORD).agg(F.collect_list(F.struct("key", "mapped", "scope", "value")).alias("v"))
    part = lambda x: x["key"].isin(PERIOD_START, PERIOD_END) & x["mapped"]
    out = lambda target, name, value: F.struct(F.lit(target).alias("target"), name.alias("name"), value.alias("value"))
    items = F.transform(F.filter("v", lambda x: (x["scope"] == "attribute") & ~part(x) & ~T.is_blank(x["value"])), lambda x: out("item", x["key"], x["value"]))
    end = lambda k: F.get(F.filter("v", lambda x: x["mapped"] & (x["key"] == k)), F.lit(0))["value"]
    period = F.filter(F.array(out("item", F.lit(PERIOD), T.range_literal(end(PERIOD_START), end(PERIOD_END)))), lambda x: x["value"].isNotNull())
    loose = F.filter("v", lambda x: x["scope"].isNull() & ~part(x) & ~T.is_blank(x["key"]) & ~T.is_blank(x["value"]))
    sorted_ = F.array_sort(F.transform(loose, lambda x: F.struct(F.trim(x["key"]).alias("name"), (~x["mapped"]).alias("late"), x["key"].alias("key"), x["value"].alias("value"))))
    rows = rows.select(*RECORD, F.concat(items, period).alias("items"), sorted_.alias("loose"))
    first = F.filter("loose", lambda x, i: (i == 0) | (F.get("loose", i - 1)["name"] != x["name"]))
    labels = F.transform(first, lambda x: out("label", x["name"], x["value"]))
    return rows.select(*RECORD, F.explode(F.concat("items", labels)).alias("e")).select(*RECORD, "e.*")


def number_dispositions(rows: DataFrame, records: DataFrame) -> DataFrame:
    """rows with dsps_sn: records(doc, record) numbered from 1 in order, those without rows too, so that numbers have gaps."""
    nth = F.row_number().over(Window.partitionBy("doc").orderBy("record"))
    return rows.join(records.select(*RECORD).distinct().withColumn("dsps_sn", nth), RECORD)


def body_chars(paragraphs: DataFrame, cells: DataFrame, captions: DataFrame) -> DataFrame:
    """sizes(doc, body_char_cnt): characters with content of paragraphs, of every cell of a grid, and of captions."""
    each = [df.select("doc", T.solid_chars("text").cast("long").alias("n")) for df in (paragraphs, cells, captions)]
    return each[0].unionByName(each[1]).unionByName(each[2]).groupBy("doc").agg(F.sum("n").alias("body_char_cnt"))


def unmapped_report(attachments: DataFrame, rows: DataFrame, texts: DataFrame, width: int = 1000) -> DataFrame:
    """Attachments (doc, excluded) that load but have no item value: doc, labels (name: value, in order), excerpt of the text.

    texts(doc, pos, text). The excerpt is the first characters of all texts by lines, with a sign where it ends early.
    """
    bare = attachments.where("NOT excluded").select("doc").join(rows.where("target = 'item'").select("doc").distinct(), "doc", "left_anti")
    labels = rows.where("target = 'label'").groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("record", "name", "value"))).alias("l"))
    shown = F.transform("l", lambda x: F.concat_ws(": ", x["name"], x["value"]))
    body = texts.groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("body"))
    joined = bare.join(labels, "doc", "left").join(body, "doc", "left")
    cut = F.when(F.length("body") > width, F.concat(F.left("body", F.lit(width)), F.lit("…"))).otherwise(F.coalesce("body", F.lit("")))
    return joined.select("doc", F.coalesce(shown, F.array().cast("array<string>")).alias("labels"), cut.alias("excerpt"))
