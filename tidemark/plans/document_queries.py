"""Queries that write documents out of columns, read them back through the engine, and hold the result against the columns."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import jobs
from tidemark.functions import text as T
from tidemark.operators import geometry, keys, lines, sinks, survey, views, warehouse
from tidemark.plans.queries import query, read
from tidemark.plans.staging import folder, sized, sorted_side, spread, staged
from tidemark.sources import images, make, sniff
from tidemark.sources import read as R
from tidemark.streaming import ingest



def drawing(red: int = 0) -> bytes:
    rgb = np.full((60, 80, 3), 255, np.uint8)
    rgb[12:48, 10:70] = (red, 0, 0)
    return images.encode_png(rgb)


def _notices(rows: DataFrame, path, texts: list, cells=None, picture: bytes | None = None) -> DataFrame:
    """rows -> (path, texts, cells, picture) as make.documents takes them."""
    return rows.select(path.alias("path"), F.array(*texts).cast("array<string>").alias("texts"), (F.lit(None) if cells is None else cells).cast("array<array<string>>").alias("cells"), F.lit(picture).cast("binary").alias("picture"))


# ---- readers

READ_SQL = """SELECT c_custkey, 'p' AS kind, 0 AS row, 0 AS col, c_name AS text FROM customer UNION ALL SELECT c_custkey, 'p', 1, 0, c_mktsegment FROM customer
UNION ALL SELECT c_custkey, 't', 0, 0, 'key' FROM customer UNION ALL SELECT c_custkey, 't', 0, 1, CAST(c_custkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 't', 1, 0, 'nation' FROM customer UNION ALL SELECT c_custkey, 't', 1, 1, CAST(c_nationkey AS VARCHAR) FROM customer"""


def _read_back(spark, d, fmt: str) -> DataFrame:
    """Two paragraphs and a table of every customer."""
    s = lambda c: F.col(c).cast("string")
    cells = F.array(F.array(F.lit("key"), s("c_custkey")), F.array(F.lit("nation"), s("c_nationkey")))
    files = make.documents(_notices(read(spark, d, "customer"), F.concat(s("c_custkey"), F.lit(f".{fmt}")), [F.col("c_name"), F.col("c_mktsegment")], cells), fmt)
    raw = staged(jobs.extract(files), "raw")
    own = F.substring_index("doc", ".", 1).cast("long").alias("c_custkey")
    texts = R.paragraphs(raw).select(own, F.lit("p").alias("kind"), F.col("pos").alias("row"), F.lit(0).alias("col"), "text")
    return texts.unionByName(R.table_cells(raw).select(own, F.lit("t").alias("kind"), "row", "col", "text"))


@query(READ_SQL)
def read_hml(spark, d):
    return _read_back(spark, d, "hml")


@query(READ_SQL)
def read_hwpx(spark, d):
    return _read_back(spark, d, "hwpx")


@query(READ_SQL)
def read_hwp5(spark, d):
    return _read_back(spark, d, "hwp")


@query(READ_SQL)
def read_hwp3(spark, d):
    return _read_back(spark, d, "hwp3")


@query(READ_SQL)
def read_pdf(spark, d):
    return _read_back(spark, d, "pdf")


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'NATIVE' WHEN 1 THEN 'SCANNED' WHEN 2 THEN 'NATIVE' ELSE 'FAILED' END AS status, CASE WHEN n_nationkey % 4 = 3 THEN 'EMPTY_FILE' END AS kind FROM nation")
def scan_verdicts(spark, d):
    """Text and a picture, a picture only, neither, and no bytes at all."""
    n = read(spark, d, "nation")
    text = F.when(F.col("n_nationkey") % 4 == 0, F.col("n_name")).otherwise("")
    made = lambda rows, picture: make.documents(_notices(rows, F.concat("n_nationkey", F.lit(".hml")), [text], None, picture), "hml")
    files = made(n.where("n_nationkey % 4 < 2"), drawing()).unionByName(made(n.where("n_nationkey % 4 = 2"), None)).unionByName(n.where("n_nationkey % 4 = 3").select(F.concat("n_nationkey", F.lit(".hml")).alias("path"), F.lit(b"").alias("content")))
    return jobs.detect(files).select(F.substring_index("path", ".", 1).cast("int").alias("n_nationkey"), "status", "kind")


@query("SELECT p_partkey, ['NOT_COMPOUND_FILE', 'NOT_ZIP', 'PDF_LOAD', 'EMPTY_FILE', 'UNSUPPORTED_EXT', 'XML_PARSE'][p_partkey % 6 + 1] AS kind, 'extract' AS stage, ['hwp', 'hwpx', 'pdf', 'hml', 'doc', 'hml'][p_partkey % 6 + 1] AS ext FROM part")
def broken_files(spark, d):
    """Files whose bytes are none of their format's, and what the failure of each is called."""
    kind = (F.col("p_partkey") % 6 + 1).cast("int")
    ext = F.element_at(F.array(*map(F.lit, ("hwp", "hwpx", "pdf", "hml", "doc", "hml"))), kind)
    data = F.when(kind == 4, "").when(kind == 6, "<?xml version='1.0'?><HWPML><open").otherwise(F.col("p_name"))
    files = read(spark, d, "part").select(F.concat("p_partkey", F.lit("_1_x."), ext).alias("path"), F.encode(data, "UTF-8").alias("content"))
    raw = staged(jobs.extract(spread(files, "path")), "raw")
    found = jobs.failures_of(raw).select(F.col("NOTI_SN").cast("long").alias("p_partkey"), "kind", "file_path")
    told = raw.select(*sinks.failure_row("extract"))
    return found.join(told, found.file_path == told.file).select("p_partkey", "kind", "stage", "ext")


@query("""SELECT event_id, CASE user_id % 9 WHEN 0 THEN 'OUT_OF_MEMORY' WHEN 1 THEN 'FILE_ACCESS' WHEN 2 THEN 'EMPTY_FILE' WHEN 3 THEN 'PASSWORD_PROTECTED' WHEN 4 THEN 'DRM_PROTECTED' WHEN 5 THEN 'DISTRIBUTION_TRUNCATED' WHEN 6 THEN 'ENCRYPTED' WHEN 7 THEN 'ZIP_CORRUPT' ELSE 'IO' END AS kind FROM events""")
def failure_kinds(spark, d):
    """The rules in their order: each row also has what a later rule would take."""
    k = F.col("user_id") % 9
    pick = lambda *v: F.element_at(F.array(*[F.lit(x).cast("string") for x in v]), (k + 1).cast("int"))
    error = pick("MemoryError", "FileNotFoundError", "OSError", "Locked", "Locked", "Locked", "ValueError", "BadZipFile", "OSError")
    message = pick("password", "password", "x", "x", "x", "x", "needs a password", "x", "cut off")
    lock, fmt = pick("DRM", None, "DRM", "PASSWORD", "DRM", "TRUNCATED", None, None, None), pick("hwp", "hwp", "hwp", "hwp", "hwp", "hwp", "hwpx", "hwpx", "hwp9")
    kind = survey.classify_failure(F.when(k == 2, 0).otherwise(9), fmt, F.lit("hwp"), lock, error, message)
    return read(spark, d, "events").select("event_id", kind.alias("kind"))


@query("SELECT event_type, count(*) FILTER (WHERE event_type = 'error') AS n_failed, count(*) FILTER (WHERE event_type <> 'error' AND value < 50 AND user_id % 3 > 0) AS n_scanned FROM events GROUP BY 1 HAVING n_failed + n_scanned > 0")
def survey_filters(spark, d):
    """A file without text but with pictures is a scan, one with an error has failed, all others are native."""
    bad = F.col("event_type") == "error"
    found = read(spark, d, "events").select(F.col("event_type").alias("path"), F.lit("hwp").alias("ext"), F.when(F.col("value") < 50, 0).otherwise(F.col("value")).alias("text_chars"), (F.col("user_id") % 3).alias("n_images"), F.lit("OTHER").alias("kind"), F.when(bad, "why").alias("error"))
    out = survey.survey(found)
    return survey.failed_files(out).unionByName(survey.scanned_files(out)).groupBy(F.col("path").alias("event_type")).agg(F.count_if(F.col("status") == "FAILED").alias("n_failed"), F.count_if(F.col("status") == "SCANNED").alias("n_scanned"))


#: Reads a mark that the document hides in its markup, as a stand-in for a recogniser: the contract is what is shown.
OCR = (
    "import json,re,sys\na=sys.argv\nmark=re.search(rb'<!--(.*?)-->',open(a[a.index('--source-file')+1],'rb').read()).group(1).decode()\n"
    "t='<table><tr><td>'+mark+'</td><td>'+a[a.index('--file-type')+1]+'</td></tr></table>'\n"
    "json.dump({'blocks':[{'label':'text','content':mark},{'label':'seal','content':'x'},{'label':'table','content':t}]},open(a[a.index('--output')+1],'w'))"
)


@query("SELECT n_nationkey, 'ocr' AS engine, n_name AS text, n_name || ',hml' AS cells FROM nation")
def ocr_scans(spark, d):
    """Scans go to an outer program and come back as paragraphs and tables, without seals."""
    files = make.documents(_notices(read(spark, d, "nation"), F.concat("n_nationkey", F.lit("_"), "n_name", F.lit(".hml")), [], None, drawing()), "hml")
    mark = F.concat(F.lit("<!--"), F.regexp_extract("path", r"^\d+_(.*)\.hml$", 1), F.lit("--></HWPML>"))
    marked = files.select("path", F.encode(F.replace(F.decode("content", "UTF-8"), F.lit("</HWPML>"), mark), "UTF-8").alias("content"))
    raw = jobs.extract(marked, None, [sys.executable, "-c", OCR])
    text, table = F.filter("content", lambda c: c["type"] == "paragraph"), F.filter("content", lambda c: c["type"] == "table")
    return raw.select(F.substring_index("atch_file_nm", "_", 1).cast("int").alias("n_nationkey"), F.col("extc_engn_nm").alias("engine"), F.array_join(F.transform(text, lambda c: c["text"]), ",").alias("text"), F.array_join(F.flatten(F.flatten(F.transform(table, lambda c: c["grid"]))), ",").alias("cells"))


@query("SELECT n_nationkey, n_nationkey || '_1_x_img0.png' AS name, 1 AS img_sn FROM nation WHERE n_nationkey % 5 <> 0")
def saved_images(spark, d):
    """Pictures that pass the sieve are put into files, and the rows' paths lead to them; specks do not pass."""
    n, speck = read(spark, d, "nation"), images.encode_png(np.full((60, 80, 3), 255, np.uint8))
    made = lambda rows, picture: make.documents(_notices(rows, F.concat("n_nationkey", F.lit("_1_x.hwpx")), [F.col("n_name")], None, picture), "hwpx")
    target = folder(spark, "images")
    raw = staged(jobs.extract(made(n.where("n_nationkey % 5 <> 0"), drawing()).unionByName(made(n.where("n_nationkey % 5 = 0"), speck)), image_folder=target), "raw")
    rows = warehouse.image_rows(jobs.images_of(raw))
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(target).select(F.regexp_replace("path", "^file:/*", "/").alias("IMG_FILE_PATH"))
    return rows.join(there, "IMG_FILE_PATH").select(F.col("NOTI_SN").alias("n_nationkey"), F.col("IMG_CPTN_CTNT").alias("name"), F.col("IMG_SN").alias("img_sn"))


@query("""SELECT n_nationkey || '_1_' || n_name || CASE n_nationkey % 3 WHEN 0 THEN '.HWP' ELSE '.hml' END AS name, CASE n_nationkey % 3 WHEN 1 THEN 0 ELSE CAST(length(n_name) AS BIGINT) END AS size,
  row_number() OVER (ORDER BY n_nationkey || '_1_' || n_name || CASE n_nationkey % 3 WHEN 0 THEN '.HWP' ELSE '.hml' END) AS nth FROM nation""")
def listed_files(spark, d):
    """Documents below a folder in the order of their paths, whatever their case, empty ones too; other files are passed over."""
    target = folder(spark, "listed")

    def put(batches):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root)
        for b in batches:
            for r in b.to_pylist():
                ext, data = ("HWP", "hml", "hml")[r["n_nationkey"] % 3], b"" if r["n_nationkey"] % 3 == 1 else r["n_name"].encode()
                for name, body in ((f"{r['n_nationkey']}_1_{r['n_name']}.{ext}", data), (f"{r['n_nationkey']}.txt", b"no document")):
                    with store.open_output_stream(f"{root}/{name}") as out:
                        out.write(body)
            yield b

    read(spark, d, "nation").select("n_nationkey", "n_name").mapInArrow(put, "n_nationkey int, n_name string").write.format("noop").mode("overwrite").save()
    files = sniff.in_order(sniff.scan_files(spark, target).select("path", "length"))
    order = F.row_number().over(Window.orderBy("path")).cast("long")  # a folder's listing, for people
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("size"), order.alias("nth"))


@query("SELECT s_suppkey, s_name AS text FROM supplier")
def raw_json_roundtrip(spark, d):
    """Raw documents as JSON and back; a field that readers do not know is passed over."""
    files = make.documents(_notices(read(spark, d, "supplier"), F.concat("s_suppkey", F.lit(".hml")), [F.col("s_name")]), "hml")
    target = folder(spark, "json")
    sinks.write_json(jobs.extract(files).withColumn("unknown", F.lit(1)), target, "raw")
    raw = spark.read.schema(R.RAW_SCHEMA).json(f"{target}/raw")
    return R.paragraphs(raw).select(F.substring_index("doc", ".", 1).cast("long").alias("s_suppkey"), "text")


@query("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'pdf' WHEN page_id % 3 = 1 THEN 'hml' ELSE 'html' END AS key FROM pages")
def routing_keys(spark, d):
    """What the bytes say goes before what the name says."""
    head = F.when(F.col("page_id") % 3 == 0, "%PDF-1.4 ").when(F.col("page_id") % 3 == 1, '<?xml version="1.0"?><HWPML>').otherwise("")
    return read(spark, d, "pages").select("page_id", sniff.routing_key(F.encode(F.concat(head, "html"), "UTF-8"), F.concat("url", F.lit("/x.HTML"))).alias("key"))


@query("SELECT s_suppkey, round((s_suppkey % 30 + 10) * 36 / 4800.0, 6) AS ink, round(greatest((s_suppkey % 30 + 10) / 80.0, 0.6), 6) AS spread, CASE WHEN s_suppkey % 2 = 0 THEN 1.0 ELSE 0.0 END AS red, s_suppkey % 2 = 1 OR (s_suppkey % 30 + 10) * 36 / 4800.0 > 0.6 AS kept FROM supplier")
def image_measures(spark, d):
    """Drawings of known ink, black or red; small red ones are stamps, and stamps are no content."""

    def run(batches):
        for b in batches:
            out = []
            for k in b.column(0).to_pylist():
                rgb = np.full((60, 80, 3), 255, np.uint8)
                rgb[12:48, 5 : 15 + k % 30] = (200 if k % 2 == 0 else 0, 0, 0)
                m = images.measure(images.decode(images.encode_png(rgb)))
                out.append((k, round(m.ink, 6), round(m.spread, 6), m.red, images.keep(m)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)] if out else [pa.array([], t) for t in (pa.int64(), *[pa.float64()] * 3, pa.bool_())], ["s_suppkey", "ink", "spread", "red", "kept"])

    return read(spark, d, "supplier").select("s_suppkey").mapInArrow(run, "s_suppkey long, ink double, spread double, red double, kept boolean")


# ---- notices as a whole

NOTICE_SQL = "n AS (SELECT o_orderkey AS doc, '고시 제' || year(o_orderdate) || '-' || o_custkey || '호' AS no, strftime(o_orderdate, '%Y-%m-%d') AS dt, o_orderpriority AS loc, o_orderstatus AS st FROM orders)"
#: Customers as posts: a day and a place for each.
PERMIT_SQL = NOTICE_SQL.replace("FROM orders", "FROM (SELECT c_custkey AS o_orderkey, c_nationkey AS o_custkey, CAST(DATE '1995-01-01' + CAST(c_custkey % 3000 AS INTEGER) AS DATE) AS o_orderdate, c_mktsegment AS o_orderpriority, c_name AS o_orderstatus FROM customer)")
META_SQL = "SELECT doc, 'BODY_AGNCY_NM' AS key, '군산지방해양수산청' AS value FROM n UNION ALL SELECT doc, 'NOTI_NO', no FROM n UNION ALL SELECT doc, 'NOTI_DT', dt FROM n UNION ALL SELECT doc, 'NOTI_PSN', '군산지방해양수산청장' FROM n"


def _notice_lines():
    number = F.concat(F.lit("군산지방해양수산청 고시 제"), F.year("o_orderdate"), F.lit("-"), F.col("o_custkey"), F.lit("호"))
    return [number, F.lit("공유수면 점용ㆍ사용 허가 고시"), F.date_format("o_orderdate", "yyyy. M. d."), F.concat(F.lit("1. 위치 : "), "o_orderpriority"), F.concat(F.lit("2. 담당부서 : "), "o_orderstatus"), F.lit("군산지방해양수산청장")]


@query(f"WITH {PERMIT_SQL} {META_SQL} UNION ALL SELECT doc, 'NOTI_TTL', '공유수면 점용ㆍ사용 허가 고시' FROM n UNION ALL SELECT doc, 'LOC', loc FROM n UNION ALL SELECT doc, '담당부서', st FROM n")
def notices_mapped(spark, d):
    """Whole notices through extraction and mapping: what the document says of itself, known items and unknown labels."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int"))
    rows = read(spark, d, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.col("c_nationkey").alias("o_custkey"), day.alias("o_orderdate"), F.col("c_mktsegment").alias("o_orderpriority"), F.col("c_name").alias("o_orderstatus"))
    files = make.documents(_notices(rows, F.concat("o_orderkey", F.lit(".hml")), _notice_lines()), "hml")
    return jobs.mapped_parts(jobs.extract(files))[0].values.select(F.substring_index("doc", ".", 1).cast("long").alias("doc"), "key", "value")


@query(f"WITH {NOTICE_SQL} {META_SQL} UNION ALL SELECT doc, 'NOTI_TTL', CASE doc % 3 WHEN 0 THEN loc WHEN 1 THEN '공유수면 점용ㆍ사용 허가 고시' END FROM n")
def document_meta(spark, d):
    """The title is the tables' guess where there is one, else the line behind the number; none where the tables name it."""
    o = read(spark, d, "orders")
    body = o.select(F.col("o_orderkey").alias("doc"), F.posexplode(F.array(*_notice_lines())).alias("line_no", "text"))
    guesses = o.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("doc"), F.col("o_orderpriority").alias("title"))
    meta = lines.document_meta(body, o.where("o_orderkey % 3 = 2").select(F.col("o_orderkey").alias("doc")), guesses)
    codes = ("BODY_AGNCY_NM", "NOTI_NO", "NOTI_DT", "NOTI_PSN", "NOTI_TTL")
    each = meta.select("doc", F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in codes])).alias("e")).select("doc", "e.*")
    return each.select("doc", "key", F.when(F.col("key") == "NOTI_DT", T.date_iso("value")).otherwise(F.col("value")).alias("value"))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name WHEN 1 THEN c_mktsegment END AS title FROM customer WHERE c_custkey % 4 < 2")
def title_guesses(spark, d):
    """A form of one column, a number with a line below it in a cell, a cell whose next line is a label, and a second table."""
    k, none = F.col("c_custkey") % 4, F.array().cast("array<string>")
    one = F.when(k == 0, F.array(F.lit("고시 제1호"), F.concat("c_name", F.lit("\n둘째 줄")))).when(k == 1, F.array(F.concat(F.lit("\n고시 제2-3호\n\n"), "c_mktsegment"))).when(k == 2, F.array(F.lit("고시 제3호\n위치 : 여기"))).otherwise(F.array(F.lit("다른 것")))
    two = F.when(k == 3, F.array(F.lit("고시 제1호"), F.col("c_name"))).otherwise(none)
    # the second form has two columns, so that it is no form
    cells = read(spark, d, "customer").select(F.col("c_custkey").alias("doc"), k.alias("k"), F.posexplode(F.array(one, two)).alias("tbl", "rows")).select("doc", "k", "tbl", F.posexplode("rows").alias("row", "text"))
    wide = cells.where("k = 1").select("doc", "tbl", "row", F.lit(1).alias("col"), F.lit("").alias("text"))
    return lines.title_guesses(cells.select("doc", "tbl", "row", F.lit(0).alias("col"), "text").unionByName(wide)).select(F.col("doc").alias("c_custkey"), "title")


@query("SELECT n_nationkey, CAST(i AS INTEGER) AS line_no, CASE i WHEN 0 THEN '첫 줄' WHEN 1 THEN n_name WHEN 2 THEN 'b' ELSE n_name END AS text FROM nation, (SELECT unnest([0, 1, 2, 3]) AS i)")
def candidate_lines(spark, d):
    """Paragraphs first; of tables, cells that repeat their neighbour or the line before come once."""
    n = read(spark, d, "nation").select(F.col("n_nationkey").alias("doc"), "n_name")
    paragraphs = n.select("doc", F.posexplode(F.array(F.lit("첫 줄"), F.lit("  "), F.concat(F.lit(" "), "n_name"))).alias("pos", "text"))
    grid = F.array(F.array(F.col("n_name"), F.col("n_name"), F.concat("n_name", F.lit("\nb"))), F.array(F.lit("b"), F.lit(""), F.col("n_name")))
    cells = n.select("doc", F.lit(0).alias("tbl"), F.posexplode(grid).alias("row", "cs")).select("doc", "tbl", "row", F.posexplode("cs").alias("col", "text"))
    return lines.candidate_lines(paragraphs, cells).select(F.col("doc").alias("n_nationkey"), F.col("line_no").cast("int").alias("line_no"), "text")


@query("""WITH l AS (SELECT s_nationkey AS doc, s_suppkey, s_name, CAST(row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS INTEGER) AS dsps FROM supplier)
SELECT doc, dsps, 'APLC_NM' AS key, s_name AS value FROM l UNION ALL SELECT doc, dsps, 'AREA', CAST(s_suppkey AS VARCHAR) FROM l UNION ALL SELECT doc, dsps, 'NOTI_NO', '고시 제' || doc || '호' FROM l""")
def record_assembly(spark, d):
    """A nation's suppliers as a list: rows become records, each with what the document says of itself; the rest of it goes."""
    s = read(spark, d, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", "s_name"))).alias("rows"))
    cells = F.concat(F.array(F.array(F.lit("성명"), F.lit("면적"))), F.transform("rows", lambda r: F.array(r["s_name"], r["s_suppkey"].cast("string"))))
    files = make.documents(_notices(s, F.concat("s_nationkey", F.lit(".hwpx")), [F.concat(F.lit("고시 제"), "s_nationkey", F.lit("호")), F.lit("1. 목적 : 양식")], cells), "hwpx")
    values = jobs.mapped_parts(jobs.extract(files))[0].values
    nth = F.dense_rank().over(Window.partitionBy("doc").orderBy("record")).cast("int")
    return values.select(F.substring_index("doc", ".", 1).cast("int").alias("doc"), nth.alias("dsps"), "key", "value")


# ---- loads


def _attachments(rows: DataFrame, v: str) -> dict[str, DataFrame]:
    """Attachments 1 and 2 of every post, with an item, a label and two pictures each."""
    files = rows.select(F.col("c_custkey").cast("int").alias("NOTI_SN"), F.explode(F.array(F.lit(1), F.lit(2))).alias("ATCH_SN"), "c_name", "c_mktsegment")
    at, one = ["NOTI_SN", "ATCH_SN"], F.lit(1)
    none = F.when(F.col("c_mktsegment") == "BUILDING", None).otherwise(F.concat(F.lit("/"), "c_name"))
    pictures = files.select(*at, F.posexplode(F.array(none, F.lit("/b"))).alias("pos", "path")).withColumn("name", F.concat(F.lit(v), "pos"))
    return {
        "OS_ATCH_FILE_DTL": files.select(*at, F.col("c_name").alias("ATCH_FILE_NM"), F.lit("OK").alias("PROC_STTS_CD"), F.lit("N").alias("SCAN_YN"), F.lit("OCU_PRM").alias("NOTI_KND_CD"), F.lit(v).alias("NOTI_TTL")),
        "OS_ATCH_IMG_DTL": warehouse.image_rows(pictures),
        "OS_NOTI_ITEM_VAL_DTL": files.select(*at, one.alias("DSPS_SN"), F.when(F.col("ATCH_SN") == 1, "LOC").otherwise("OLD_CODE").alias("NOTI_ITEM_CD"), one.alias("RPT_SN"), F.concat(F.lit(v), "c_mktsegment").alias("ITEM_VAL_CTNT")),
        "OS_NOTI_LBL_VAL_DTL": files.select(*at, one.alias("DSPS_SN"), F.lit("특이").alias("ITEM_LBL_NM"), F.lit(v).alias("ITEM_VAL_CTNT")),
    }


@query("""WITH f AS (SELECT c_custkey AS NOTI_SN, a AS ATCH_SN, c_mktsegment AS m, CASE WHEN c_custkey % 3 = 0 AND a = 1 THEN 'new' ELSE 'old' END AS v, 'C' || (c_custkey % 10) AS post FROM customer, (SELECT unnest([1, 2]) AS a))
SELECT CAST(NOTI_SN AS INTEGER) AS NOTI_SN, ATCH_SN, v AS title, CASE ATCH_SN WHEN 1 THEN v || m END AS loc, CASE WHEN ATCH_SN = 2 THEN 2 ELSE 1 END::BIGINT AS n_labels, CASE WHEN m = 'BUILDING' THEN 1 ELSE 2 END::BIGINT AS n_images, CASE WHEN NOTI_SN % 3 = 0 THEN 'd' END AS dept, CAST(NOTI_SN % 7 AS INTEGER) AS agency FROM f""")
def load_twice(spark, d):
    """Two loads into a warehouse: attachments that come again replace theirs with all children, others of their posts stay; posts merge."""
    c = read(spark, d, "customer")
    store = warehouse.open_store(spark, folder(spark, "warehouse"), 8)
    agencies = c.select((F.col("c_custkey") % 7).cast("int").alias("INSTT_SN"), F.lit("a").alias("INSTT_NM"), F.lit("LOCL").alias("INSTT_KND_CD")).distinct()
    posts = c.select(F.col("c_custkey").cast("int").alias("NOTI_SN"), (F.col("c_custkey") % 7).cast("int").alias("INSTT_SN"))
    warehouse.load(store, _attachments(c, "old"), posts, agencies)
    again = c.where("c_custkey % 3 = 0")
    came = {n: df.where("ATCH_SN = 1") for n, df in _attachments(again, "new").items()}
    warehouse.load(store, came, again.select(F.col("c_custkey").cast("int").alias("NOTI_SN"), F.lit(None).cast("int").alias("INSTT_SN"), F.lit("d").alias("CHRG_DEPT_NM")))
    t, at = store.tables(), ["NOTI_SN", "ATCH_SN"]
    count = lambda name, alias: sorted_side(t[name].groupBy(*at).agg(F.count(F.lit(1)).alias(alias)))
    loc = t["OS_NOTI_ITEM_VAL_DTL"].where("NOTI_ITEM_CD = 'LOC'").select(*at, F.col("ITEM_VAL_CTNT").alias("loc"))
    out = t["OS_ATCH_FILE_DTL"].join(sorted_side(loc), at, "left").join(count("OS_NOTI_LBL_VAL_DTL", "n_labels"), at).join(count("OS_ATCH_IMG_DTL", "n_images"), at).join(sorted_side(t["OS_NOTI_BAS"].select("NOTI_SN", "INSTT_SN", "CHRG_DEPT_NM")), "NOTI_SN")
    return out.select(*at, F.col("NOTI_TTL").alias("title"), "loc", "n_labels", "n_images", F.col("CHRG_DEPT_NM").alias("dept"), F.col("INSTT_SN").alias("agency"))


@query("SELECT c_custkey AS NOTI_SN, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'FAIL' ELSE 'OK' END AS status, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 'LOAD' END AS step, CAST(CASE WHEN c_custkey % 3 = 0 THEN 500 ELSE length(c_name) END AS INTEGER) AS n_title, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0 THEN 0 ELSE 1 END::BIGINT AS n_values FROM customer")
def load_violations(spark, d):
    """A title that is too long or a value that is null makes the attachment a failure of the load, without values."""
    k = F.col("c_custkey")
    c = read(spark, d, "customer").select(k.alias("NOTI_SN"), F.lit(1).alias("ATCH_SN"), F.when(k % 3 == 0, F.repeat("c_name", F.lit(99))).otherwise(F.col("c_name")).alias("NOTI_TTL"), F.when(k % 5 != 0, F.lit("v")).alias("v"))
    files = c.select("NOTI_SN", "ATCH_SN", F.lit("n").alias("ATCH_FILE_NM"), F.lit("OK").alias("PROC_STTS_CD"), F.lit("N").alias("SCAN_YN"), "NOTI_TTL")
    values = c.select("NOTI_SN", "ATCH_SN", F.lit(1).alias("DSPS_SN"), F.lit("LOC").alias("NOTI_ITEM_CD"), F.lit(1).alias("RPT_SN"), F.col("v").alias("ITEM_VAL_CTNT"))
    files, values = warehouse.route_violations(files, values)
    n = values.groupBy("NOTI_SN").agg(F.count(F.lit(1)).alias("n"))
    return files.join(n, "NOTI_SN", "left").select("NOTI_SN", F.col("PROC_STTS_CD").alias("status"), F.col("FAIL_STEP_CD").alias("step"), F.length("NOTI_TTL").alias("n_title"), F.coalesce("n", F.lit(0)).alias("n_values"))


@query("""WITH l AS (SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, l_partkey * 100000 + l_suppkey AS pos, l_linestatus AS name, CASE WHEN l_returnflag <> 'N' THEN '/' || l_suppkey END AS path FROM lineitem),
u AS (SELECT NOTI_SN, ATCH_SN, pos, min(name) AS name, max(path) AS path FROM l GROUP BY 1, 2, 3)
SELECT NOTI_SN, ATCH_SN, CAST(row_number() OVER (PARTITION BY NOTI_SN, ATCH_SN ORDER BY pos) AS INTEGER) AS IMG_SN, name AS IMG_CPTN_CTNT, path AS IMG_FILE_PATH FROM u WHERE path IS NOT NULL""")
def image_numbers(spark, d):
    """Pictures without a file go before the others are numbered."""
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), (F.col("l_partkey") * 100000 + F.col("l_suppkey")).alias("pos"), F.col("l_linestatus").alias("name"), F.when(F.col("l_returnflag") != "N", F.concat(F.lit("/"), "l_suppkey")).alias("path"))
    once = li.groupBy("NOTI_SN", "ATCH_SN", "pos").agg(F.min("name").alias("name"), F.max("path").alias("path"))
    return warehouse.image_rows(once)


@query("SELECT l_orderkey AS doc, CAST(pos AS INTEGER) AS pos, path FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS pos, 'p' || l_linenumber AS path, count(*) OVER (PARTITION BY l_orderkey) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE pos < 3")
def images_bound(spark, d):
    """Pictures and files meet by their numbers; what has no partner is left out."""
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), "l_linenumber").distinct()
    saved = li.select("doc", (F.row_number().over(Window.partitionBy("doc").orderBy("l_linenumber")) - 1).alias("img_no"), F.concat(F.lit("p"), "l_linenumber").alias("path"))
    pictures = li.select("doc").distinct().select("doc", F.explode(F.array(*map(F.lit, range(3)))).alias("pos"))
    return sinks.bind_paths(pictures, saved)


@query("""WITH d2 AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1), d1 AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1)
SELECT coalesce(d2.o_custkey, d1.o_custkey) AS o_custkey, CASE WHEN d2.n IS NULL THEN 'first' ELSE 'second' END AS day, coalesce(d2.n, d1.n) AS n FROM d1 FULL JOIN d2 ON d1.o_custkey = d2.o_custkey""")
def daily_increment(spark, d):
    """Two days' files through a stream that ends when it has read them: a key's rows are those of the last day that had it."""
    source, table = folder(spark, "days"), folder(spark, "table")
    schema = "o_custkey long, day string"
    for day, odd in (("first", 0), ("second", 1)):
        own = read(spark, d, "orders").where(F.col("o_orderkey") % 2 == odd).select(F.col("o_custkey").cast("long").alias("o_custkey"), F.lit(day).alias("day"))
        own.write.parquet(f"{source}/{day}")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1_000_000).parquet(source)
        ingest.available_now(stream, ingest.replace_by_key(table, ["o_custkey"], 8), f"{table}-checkpoint").awaitTermination()
    return ingest.current(spark, table).groupBy("o_custkey", "day").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH f AS (SELECT s_nationkey AS INSTT_SN, s_suppkey AS o, s_name AS nm FROM supplier UNION ALL SELECT c_nationkey, 1000000 + c_custkey, c_name FROM customer) SELECT INSTT_SN, arg_min(nm, o) AS INSTT_NM, 'K' AS INSTT_KND_CD FROM f GROUP BY 1""")
def agencies_of_files(spark, d):
    """Agencies of what was read and of what failed, once each; the first word on a number counts."""
    one = lambda t, n, o, nm: read(spark, d, t).select(o.alias("load_order"), F.col(n).alias("INSTT_SN"), F.col(nm).alias("INSTT_NM"), F.lit("K").alias("INSTT_KND_CD"))
    return warehouse.first_agencies(one("supplier", "s_nationkey", F.col("s_suppkey"), "s_name").unionByName(one("customer", "c_nationkey", F.col("c_custkey") + 1000000, "c_name")))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey > 0 THEN CAST(c_custkey AS INTEGER) ELSE CAST(c_custkey + 7 AS INTEGER) END AS sn, CASE WHEN c_custkey % 2 = 0 AND c_custkey > 0 THEN 3 ELSE CAST(c_custkey % 9 AS INTEGER) END AS atch, n_name AS board FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey % 2 = 0")
def attachment_keys(spark, d):
    """Stored keys, and those of old files by their names; the board by the first folder, where it is known."""
    k = F.col("c_custkey")
    files = read(spark, d, "customer").select("c_custkey", F.concat("c_nationkey", F.lit("/sub/x.hwp")).alias("rel_path"), F.when(k % 2 == 0, k).otherwise(0).alias("stored"), F.concat_ws("_", k + 7, k % 9, F.lit("a.hwp")).alias("name"))
    boards = read(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("string").alias("folder"), F.col("n_name").alias("board"))
    key = keys.attachment_key(F.col("stored"), F.lit(3), F.col("name"))
    return keys.file_boards(files, boards).select("c_custkey", key["noti_sn"].alias("sn"), key["atch_sn"].alias("atch"), "board")


@query("SELECT o_orderkey, ['detect', 'extract', 'save', 'load', NULL][o_custkey % 5 + 1] AS step, CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS yn FROM orders")
def step_codes(spark, d):
    code = F.element_at(F.array(*map(F.lit, (" dtct", "EXTC", "Save ", "load", "other"))), (F.col("o_custkey") % 5 + 1).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", survey.step_of(code).alias("step"), T.yes_no(F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus") == "F")).alias("yn"))


@query(r"""WITH f AS (SELECT doc_id, replace(trim(regexp_replace(text, '[\x09-\x0D ]+', ' ', 'g'), ' '), '|', '\|') AS t FROM documents)
SELECT doc_id, CASE WHEN t = '' THEN '—' WHEN length(t) > 60 THEN left(t, 59) || '…' ELSE t END AS cell FROM f WHERE t IS NOT NULL""")
def markdown_cells(spark, d):
    return read(spark, d, "documents").where("text IS NOT NULL").select("doc_id", T.markdown_cell("text").alias("cell"))


@query("SELECT s_nationkey AS page, CASE WHEN s_suppkey % 2 = 0 THEN 'V' ELSE 'H' END AS kind, CAST(s_suppkey % 9 AS INTEGER) AS at, CAST(sum(s_suppkey % 50 + 1) AS DOUBLE) AS length, CAST(min(s_suppkey % 13) AS DOUBLE) AS lo, CAST(max(s_suppkey % 13 + s_suppkey % 50 + 1) AS DOUBLE) AS hi FROM supplier GROUP BY 1, 2, 3")
def edge_sums(spark, d):
    """The pieces of rules at one rounded coordinate together."""
    k = F.col("s_suppkey")
    return geometry.rules(read(spark, d, "supplier").select(F.col("s_nationkey").alias("page"), F.when(k % 2 == 0, "V").otherwise("H").alias("kind"), (k % 9 + (k % 3 - 1) * 0.2).alias("at"), (k % 13).cast("double").alias("lo"), (k % 13 + k % 50 + 1).cast("double").alias("hi")))


TILES = "t AS (SELECT c_nationkey AS page, c_custkey AS id, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS i FROM customer)"


def _tiles(spark, d):
    """Tiles of a page in two columns of strips: neighbours in a row share an edge, so do rows."""
    nth = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) - 1
    t = read(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("page"), F.col("c_custkey").cast("long").alias("id"), nth.alias("i"))
    x, y = (F.col("i") % 2 * 100).cast("double"), (F.floor(F.col("i") / 2) * 50).cast("double")
    return t.select("page", "id", x.alias("x0"), y.alias("y0"), (x + 100).alias("x1"), (y + 50).alias("y1"), F.lit(200).cast("long").alias("width"), F.lit(100).cast("long").alias("height"))


@query(f"WITH {TILES} SELECT a.page, a.id AS a, b.id AS b, CASE WHEN b.i = a.i + 1 AND a.i % 2 = 0 THEN 'right' ELSE 'below' END AS side FROM t a JOIN t b ON a.page = b.page AND (b.i = a.i + 1 AND a.i % 2 = 0 OR b.i = a.i + 2)")
def tile_pairs(spark, d):
    return geometry.abutting(_tiles(spark, d)).select(F.col("page").cast("int").alias("page"), "a", "b", "side")


@query(f"""WITH {TILES}, p AS (SELECT page, count(*) AS n FROM t GROUP BY 1) SELECT page, 400 AS width, n // 2 * 100 AS height, n // 2 * 2 AS tiles FROM p WHERE n >= 2 UNION ALL SELECT page, 200, 100, 1 FROM p WHERE n % 2 = 1""")
def tile_merge(spark, d):
    """All full rows of tiles become one picture, however high; a tile that is left alone stays."""
    out = geometry.merge_tiles(_tiles(spark, d), max_pixels=sys.maxsize)
    return out.select(F.col("page").cast("int").alias("page"), F.col("width").cast("int").alias("width"), F.col("height").cast("long").alias("height"), F.size("ids").cast("long").alias("tiles"))


@query("SELECT 'n: ' || count(*) AS line FROM events UNION ALL SELECT 'n_failed: ' || count(*) FILTER (WHERE event_type = 'error') FROM events")
def console_summary(spark, d):
    totals = read(spark, d, "events").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("n_failed"))
    return sinks.summary_text(totals)


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CAST(l_suppkey AS INTEGER) AS DSPS_SN, max(CAST(l_quantity AS BIGINT)) AS v FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2, 3")
def disposition_pairs(spark, d):
    """The area of the dispositions at one place: items of a disposition meet by its number, whatever others lack."""
    li = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), F.col("l_suppkey").cast("int").alias("DSPS_SN"), "l_returnflag", F.col("l_quantity").cast("long").alias("q"))
    one = lambda code, v: F.struct(F.lit(code).alias("NOTI_ITEM_CD"), v.cast("string").alias("ITEM_VAL_CTNT"))
    # of an attachment's lines with one supplier, those returned are a disposition at one place
    at = sized(li, "NOTI_SN", "ATCH_SN", "DSPS_SN").groupBy("NOTI_SN", "ATCH_SN", "DSPS_SN", "l_returnflag").agg(F.max("q").alias("q"))
    only = at.where("l_returnflag = 'R'").unionByName(at.where("l_returnflag <> 'R'").withColumn("DSPS_SN", -F.col("DSPS_SN") - F.ascii("l_returnflag") * 1000000))
    items = only.select("NOTI_SN", "ATCH_SN", "DSPS_SN", F.explode(F.array(one("LOC", F.col("l_returnflag")), one("AREA", F.col("q")))).alias("e")).select("NOTI_SN", "ATCH_SN", "DSPS_SN", "e.*")
    out = views.paired_values(items, "AREA", "LOC", "R")
    return out.select("NOTI_SN", "ATCH_SN", "DSPS_SN", F.col("ITEM_VAL_CTNT").cast("long").alias("v"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS s, CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS e FROM orders WHERE o_orderkey % 4 > 0")
def range_sql_function(spark, d):
    """The warehouse's function over period literals, in SQL; a date that the calendar lacks is no period."""
    views.range_function(spark)
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.concat(F.lit("["), day, F.lit(","), F.when(F.col("o_orderkey") % 4 > 0, day).otherwise("2024-02-30"), F.lit("]"))
    read(spark, d, "orders").select("o_orderkey", text.alias("v")).createOrReplaceTempView("periods_of_orders")
    return spark.sql("SELECT o_orderkey, cast(p.start_dt AS string) AS s, cast(p.end_dt AS string) AS e FROM (SELECT o_orderkey, FC_OS_ISO_DATERANGE(v) AS p FROM periods_of_orders) WHERE p IS NOT NULL")
