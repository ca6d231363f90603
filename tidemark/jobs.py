"""The verbs: detect, extract, tables, map, load, render and dict, each from DataFrames to DataFrames.

pipeline() is all of them over a folder. `python -m tidemark.jobs VERB IN OUT` runs one and ends with 1 where a file failed.
tables, map, load and render take documents, or with --raw the JSON that extract wrote. load and pipeline add to the
warehouse in OUT/warehouse: attachments that come again replace theirs, all others stay.
"""

from __future__ import annotations

import argparse
import os
import shlex
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T
from tidemark.operators import grid, keys, lines, records, sinks, survey, warehouse
from tidemark.operators.classify import classify_title
from tidemark.plans import dictionaries
from tidemark.plans.staging import staged
from tidemark.sources import read as R
from tidemark.sources.sniff import document_format, extension, in_order, scan_files


def setting(name: str, default: str | None = None, files: tuple[str, ...] = (".env", "application.properties")) -> str | None:
    """A setting: the environment's, else that of the first file that has it, else the default. KEY_NAME and key.name are one."""
    env = name.upper().replace(".", "_").replace("-", "_")
    if env in os.environ:
        return os.environ[env]
    for path in files:
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                for row in f:
                    key, sign, value = row.strip().partition("=")
                    if sign and not key.startswith("#") and key.strip().removeprefix("export ").strip() in (name, env):
                        return value.strip().strip("\"'")
    return default


@dataclass
class Mapped:
    """What mapping gives: attachments (one row for each document), records' values, item and label rows, dispositions."""

    files: DataFrame
    values: DataFrame
    rows: DataFrame
    facts: DataFrame


def detect(files: DataFrame) -> DataFrame:
    """The survey of files(path, content): scanned, native or failed, and why."""
    raw = R.read_documents(files)
    sizes = files.select("path", F.coalesce(F.length("content"), F.lit(0)).alias("size"), document_format("content").alias("fmt"), extension("path").alias("ext"))
    joined = raw.join(sizes, raw.atch_file_path == sizes.path)
    kind = survey.classify_failure(F.col("size"), F.col("fmt"), F.col("ext"), F.col("protection"), F.col("error"), F.col("message"))
    return survey.survey(joined.select("path", "ext", "text_chars", "n_images", F.when(F.col("error").isNotNull(), kind).alias("kind"), F.col("message").alias("error")))


def extract(files: DataFrame, engine: str | None = None, ocr_command: list[str] | None = None, image_folder: str | None = None) -> DataFrame:
    return R.read_documents(files, engine, ocr_command, image_folder)


def tables(raw: DataFrame, synonyms: DataFrame) -> DataFrame:
    return grid.interpret(R.table_cells(raw), R.table_spans(raw), synonyms)


def map_documents(raw: DataFrame, threshold: int = 5000) -> Mapped:
    """Records of raw documents that were read without an error: merged, normalised, split into item and label values."""
    spark = raw.sparkSession
    synonyms, fields = dictionaries.synonym_dim(spark), dictionaries.field_dim(spark)
    attributes = [i.code for i in dictionaries.items() if i.scope == "attribute"]
    paragraphs, cells = staged(R.paragraphs(raw), "paragraphs"), staged(R.table_cells(raw), "cells")
    solid = paragraphs.where(~T.is_blank("text"))
    nth = F.row_number().over(Window.partitionBy("doc").orderBy("pos")) - 1
    own_lines = staged(solid.select("doc", nth.alias("line_no"), T.trim_control("text").alias("text")), "lines")
    facts = staged(grid.interpret(cells, R.table_spans(raw), synonyms), "facts")
    body = staged(lines.candidate_lines(own_lines.select("doc", F.col("line_no").alias("pos"), "text"), cells), "body")
    titled = facts.where("kind <> 'header_list' AND item_cd = 'NOTI_TTL'").select("doc")
    meta = lines.document_meta(body, titled, lines.title_guesses(cells))
    shape = ["doc", "record", "source", "tbl", "pos", "number", "label", "item_cd", "value"]
    codes = ["BODY_AGNCY_NM", "NOTI_NO", "NOTI_DT", "NOTI_PSN", "NOTI_TTL"]
    told = meta.select("doc", F.explode(F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(c).alias("item_cd"), F.col(c).alias("value")) for i, c in enumerate(codes)])).alias("m")).select("doc", "m.*")
    put = lambda df, source, record=0: df.withColumn("source", F.lit(source)).withColumn("record", F.lit(record) if isinstance(record, int) else record)
    none = lambda df, **c: df.withColumns({k: F.lit(v) for k, v in c.items() if k not in df.columns})
    from_meta = none(put(told, 0), tbl=0, number=0).withColumn("label", F.col("item_cd"))
    from_lines = none(put(lines.pair_facts(lines.label_pairs(own_lines), synonyms), 1), tbl=0)
    from_tables = none(put(facts.where("kind <> 'header_list'"), 2), number=0)
    base = staged(records.first_writer_wins(from_meta.select(*shape).unionByName(from_lines.select(*shape)).unionByName(from_tables.select(*shape))), "base")
    # rows of lists are records by table and row
    listed = facts.where("kind = 'header_list'")
    order = F.dense_rank().over(Window.partitionBy("doc").orderBy("tbl", "record_row")) - 1
    from_lists = none(put(listed.withColumn("r", order), 0, F.col("r")), number=0)
    blocks = records.disposition_blocks(lines.pair_facts(lines.label_pairs(body), synonyms), attributes).join(listed.select("doc").distinct(), "doc", "left_anti")
    from_blocks = none(put(blocks, 0, F.col("record")), tbl=0)
    rows = staged(records.first_writer_wins(from_lists.select(*shape).unionByName(from_blocks.select(*shape))), "rows")
    normal = staged(records.normalise_records(records.assemble(base, rows)), "records")
    split = staged(records.number_dispositions(records.split_values(normal, fields), normal), "split")
    title = base.where("mapped AND key = 'NOTI_TTL'").select("doc", F.col("value").alias("title"))
    sizes = records.body_chars(paragraphs, cells, R.captions(raw))
    first = normal.where("mapped").withColumn("least", F.min("record").over(Window.partitionBy("doc"))).where("record = least").groupBy("doc").agg(*[F.max(F.when(F.col("key") == c, F.col("value"))).alias(c) for c in ("NOTI_NO", "NOTI_DT", "NOTI_TTL")])
    files = raw.select(F.col("atch_file_path").alias("doc"), "atch_file_nm", "atch_file_path", "file_extn_nm", "actl_file_extn_nm", "scan_yn", "extc_engn_nm").join(title, "doc", "left").join(sizes, "doc", "left").join(first, "doc", "left")
    chars = F.coalesce("body_char_cnt", F.lit(0))
    key = keys.file_key("atch_file_nm")
    attached = files.select(
        "doc", key["noti_sn"].alias("NOTI_SN"), key["atch_sn"].alias("ATCH_SN"), F.col("atch_file_nm").alias("ATCH_FILE_NM"), F.col("atch_file_path").alias("ATCH_FILE_PATH"), T.skip_reason(chars, threshold).alias("EXCL_RSN_CTNT"), F.col("file_extn_nm").alias("FILE_EXTN_NM"),
        F.col("actl_file_extn_nm").alias("ACTL_FILE_EXTN_NM"), T.yes_no("scan_yn").alias("SCAN_YN"), F.col("extc_engn_nm").alias("EXTC_ENGN_NM"), classify_title("title").alias("NOTI_KND_CD"), "NOTI_NO", "NOTI_DT", "NOTI_TTL",
    )
    return Mapped(staged(attached, "files"), normal, split, facts)


def load_rows(mapped: Mapped, images: DataFrame, failures: DataFrame) -> dict[str, DataFrame]:
    """Rows by table of what came in: attachments (failures last, so they win), items, labels, images. Excluded ones bring no values."""
    files = warehouse.file_rows(mapped.files)
    open_ = files.where("PROC_STTS_CD = 'OK'").select("doc", "NOTI_SN", "ATCH_SN")
    rows = mapped.rows.join(open_, "doc")
    items = rows.where("target = 'item'").select("NOTI_SN", "ATCH_SN", F.col("dsps_sn").alias("DSPS_SN"), F.col("name").alias("NOTI_ITEM_CD"), F.lit(1).alias("RPT_SN"), F.col("value").alias("ITEM_VAL_CTNT"))
    labels = rows.where("target = 'label'").select("NOTI_SN", "ATCH_SN", F.col("dsps_sn").alias("DSPS_SN"), F.col("name").alias("ITEM_LBL_NM"), F.col("value").alias("ITEM_VAL_CTNT"))
    good, items = warehouse.route_violations(files.drop("doc"), items)
    both = warehouse.union_with_failures(good, failures)
    fine = both.where("PROC_STTS_CD <> 'FAIL'").select("NOTI_SN", "ATCH_SN")
    out = {"OS_ATCH_FILE_DTL": both, "OS_NOTI_ITEM_VAL_DTL": items, "OS_NOTI_LBL_VAL_DTL": labels, "OS_ATCH_IMG_DTL": warehouse.image_rows(images)}
    return {n: df if n == "OS_ATCH_FILE_DTL" else df.join(fine, ["NOTI_SN", "ATCH_SN"], "left_semi") for n, df in out.items()}


def images_of(raw: DataFrame) -> DataFrame:
    """(NOTI_SN, ATCH_SN, pos, name, path) of raw documents' images, by the keys in the documents' names."""
    key = keys.file_key(F.element_at(F.split("doc", "/"), -1))
    return R.image_rows(raw).select(key["noti_sn"].alias("NOTI_SN"), key["atch_sn"].alias("ATCH_SN"), "pos", "name", "path")


def failures_of(raw: DataFrame) -> DataFrame:
    """The failures among read documents, with their kinds, as warehouse.failure_rows takes them."""
    key = keys.file_key("atch_file_nm")
    size = F.when(F.col("message").contains("empty"), 0).otherwise(1)
    kind = survey.classify_failure(size, F.col("sniffed"), F.col("file_extn_nm"), F.col("protection"), F.col("error"), F.col("message"))
    bad = raw.where("error IS NOT NULL")
    return bad.select(key["noti_sn"].alias("NOTI_SN"), key["atch_sn"].alias("ATCH_SN"), F.col("atch_file_nm").alias("file_name"), F.col("atch_file_path").alias("file_path"), F.lit("extract").alias("stage"), kind.alias("kind"), "message")


def mapped_parts(raw: DataFrame, threshold: int = 5000) -> tuple[Mapped, DataFrame, DataFrame]:
    """(what was mapped, images, failures) of read documents, which are staged once: nothing is parsed twice."""
    raw = staged(raw, "raw")
    return map_documents(raw.where("error IS NULL"), threshold), images_of(raw.where("error IS NULL")), failures_of(raw)


def pipeline(spark: SparkSession, folder: str, ocr_command: list[str] | None = None, threshold: int = 5000, engine: str | None = None, image_folder: str | None = None) -> tuple[Mapped, DataFrame, DataFrame]:
    """(what was mapped, images, failures) of all documents below a folder; each file is parsed once."""
    return mapped_parts(extract(scan_files(spark, folder), engine, ocr_command, image_folder), threshold)


def render(raw: DataFrame) -> DataFrame:
    """(doc, html): each document's tables as one HTML page."""
    from tidemark.operators.render import html_document, html_tables

    pages = html_tables(R.table_cells(raw), R.table_spans(raw)).groupBy("doc").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tbl", "html"))), lambda x: x["html"]), "").alias("html"))
    return pages.select("doc", html_document("html", "doc").alias("html"))


def review(spark: SparkSession, folder: str) -> dict[str, str]:
    """The reports on what map wrote: extras, and types of notices."""
    from tidemark.operators.render import extras_report, types_report

    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    return {"extras": extras_report(read("files"), read("values")), "notice_types": types_report(read("files"))}


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("verb", choices=["detect", "extract", "tables", "map", "load", "render", "dict", "pipeline"])
    parser.add_argument("source", help="a folder of documents; with --raw, of the JSON that extract wrote; for dict, of what map wrote")
    parser.add_argument("target")
    parser.add_argument("--engine", help="reads all files, whatever they are, and takes none for a scan")
    parser.add_argument("--ocr", default=setting("ocr.command"), help="the command that reads scans")
    parser.add_argument("--threshold", type=int, default=int(setting("load.max-body-chars", "5000")))
    parser.add_argument("--raw", action="store_true")
    parser.add_argument("--review", action="store_true", help="dict: reports on what map wrote, too")
    a = parser.parse_args(args)
    spark = SparkSession.builder.appName(f"tidemark {a.verb}").getOrCreate()
    if a.verb == "dict":
        from tidemark.operators.render import item_document, standard_document, type_document

        dictionaries.checked(spark)
        texts = {"items": item_document(), "types": type_document(), "standard": standard_document()} | (review(spark, a.source) if a.review else {})
        for name, text in texts.items():
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{a.target}/{name}")
        return 0
    images = f"{a.target}/images" if a.verb in ("extract", "map", "load", "pipeline") else None
    if a.raw:
        good, lost = R.read_json(spark, a.source, R.READ_SCHEMA)
        raw = good.unionByName(lost.select(F.col("path").alias("atch_file_path"), F.element_at(F.split("path", "/"), -1).alias("atch_file_nm"), F.lit("json").alias("file_extn_nm"), F.lit("JSONDecodeError").alias("error"), F.lit("the file is no JSON").alias("message")), allowMissingColumns=True)
    else:
        raw = extract(scan_files(spark, a.source), a.engine, shlex.split(a.ocr) if a.ocr else None, images) if a.verb != "detect" else None
    if a.verb == "detect":
        found = detect(scan_files(spark, a.source))
        in_order(found).write.mode("overwrite").parquet(f"{a.target}/survey")
        sinks.summary_text(survey.survey_totals(spark.read.parquet(f"{a.target}/survey"))).show(truncate=False)
        return int(not spark.read.parquet(f"{a.target}/survey").where("status = 'FAILED'").isEmpty())
    if a.verb == "extract":
        raw = staged(raw, "raw")
        raw.write.mode("overwrite").parquet(f"{a.target}/raw")
        sinks.write_json(raw, a.target, "json")
        return int(not raw.where("error IS NOT NULL").isEmpty())
    if a.verb in ("tables", "render"):
        out = tables(raw, dictionaries.synonym_dim(spark)) if a.verb == "tables" else render(raw)
        out.write.mode("overwrite").parquet(f"{a.target}/{'tables' if a.verb == 'tables' else 'html'}")
        return 0
    mapped, found, failures = mapped_parts(raw, a.threshold)
    failures = staged(failures, "failures")
    out = {"files": mapped.files, "values": mapped.values, "rows": mapped.rows}
    for name, df in out.items():
        df.write.mode("overwrite").parquet(f"{a.target}/{name}")
    if a.verb in ("load", "pipeline"):
        rows = load_rows(mapped, found, warehouse.failure_rows(failures))
        warehouse.load(warehouse.open_store(spark, f"{a.target}/warehouse"), rows)
        sinks.summary_text(warehouse.load_stats(rows["OS_ATCH_FILE_DTL"], rows["OS_NOTI_ITEM_VAL_DTL"])).show(truncate=False)
    sinks.failures_report(failures, mapped.files.count() + failures.count()).write.mode("overwrite").json(f"{a.target}/failures")
    return int(not failures.isEmpty())


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
