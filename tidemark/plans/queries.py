"""The operators as queries over the test tables, each with SQL that says the same.

Text operators are shown by round trips: a query writes a notice out of columns, reads it back with the operator, and the SQL
reads the columns themselves. Where SQL cannot say it, there is none, and tests hold the operator against a plain version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T
from tidemark.operators import geometry, governance, grid, keys, lines, records, render, sinks, survey, views, warehouse
from tidemark.operators.classify import classify_title
from tidemark.plans import dictionaries
from tidemark.plans.dictionaries import NoticeType
from tidemark.plans.staging import sized
from tidemark.sources import crawl, sniff

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---- the warehouse as the tables have it

FILES_SQL = """files AS (SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CASE max(l_returnflag) WHEN 'A' THEN 'OK' WHEN 'R' THEN 'FAIL' ELSE 'SKIP' END AS PROC_STTS_CD, count(*) AS n
  FROM lineitem GROUP BY 1, 2)"""
VALUES_SQL = """vals AS (SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, 'LOC' AS c, p_name AS v FROM lineitem JOIN part ON p_partkey = l_partkey
  UNION ALL SELECT l_orderkey, l_linenumber, 'AREA', CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'PRPS', l_linestatus FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'WORK_PRD', strftime(l_shipdate, '%Y-%m-%d') FROM lineitem)"""


def files_of(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.max("l_returnflag") == "A", "OK").when(F.max("l_returnflag") == "R", "FAIL").otherwise("SKIP")
    return read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN")).agg(status.alias("PROC_STTS_CD"))


def values_of(spark: SparkSession, d: str) -> DataFrame:
    """Item values: the unpivot of four columns; RPT_SN tells repeated lines apart."""
    li = read(spark, d, "lineitem").join(read(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    one = lambda code, v: F.struct(F.lit(code).alias("NOTI_ITEM_CD"), v.alias("ITEM_VAL_CTNT"))
    each = F.explode(F.array(one("LOC", F.col("p_name")), one("AREA", F.col("l_quantity").cast("long").cast("string")), one("PRPS", F.col("l_linestatus")), one("WORK_PRD", F.date_format("l_shipdate", "yyyy-MM-dd"))))
    return li.select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), each.alias("e")).select("NOTI_SN", "ATCH_SN", "e.*")


def images_of(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"))


def posts_of(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_orderkey").alias("NOTI_SN"), F.col("o_custkey").alias("INSTT_SN"), F.col("o_orderstatus").alias("BBS_STTS_CD"), F.col("o_orderstatus").alias("CHRG_DEPT_NM"), F.lit(None).cast("string").alias("CHRG_PSN_NM"), "o_orderpriority", "o_orderdate", "o_totalprice")


def agencies_of(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "customer").select(F.col("c_custkey").alias("INSTT_SN"), F.col("c_name").alias("INSTT_NM"))


@query(f"""WITH {FILES_SQL}, {VALUES_SQL}, pv AS (SELECT NOTI_SN, ATCH_SN,
  string_agg(DISTINCT v, ' | ' ORDER BY v) FILTER (WHERE c = 'LOC') AS LOC_VAL_CTNT, string_agg(DISTINCT v, ' | ' ORDER BY v) FILTER (WHERE c = 'AREA') AS AREA_VAL_CTNT,
  string_agg(DISTINCT v, ' | ' ORDER BY v) FILTER (WHERE c = 'PRPS') AS PRPS_VAL_CTNT, string_agg(DISTINCT v, ' | ' ORDER BY v) FILTER (WHERE c = 'WORK_PRD') AS WORK_PRD_VAL_CTNT FROM vals GROUP BY 1, 2)
SELECT f.NOTI_SN, f.ATCH_SN, c_name AS INSTT_NM, o_orderstatus AS CHRG_DEPT_NM, upper(o_orderpriority) AS NOTI_KND_NM, LOC_VAL_CTNT, AREA_VAL_CTNT, PRPS_VAL_CTNT, WORK_PRD_VAL_CTNT, CAST(f.n AS INTEGER) AS ATCH_IMG_CNT
FROM files f JOIN orders ON o_orderkey = f.NOTI_SN LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN pv ON pv.NOTI_SN = f.NOTI_SN AND pv.ATCH_SN = f.ATCH_SN WHERE f.PROC_STTS_CD = 'OK'""")
def core_item_view(spark: SparkSession, d: str) -> DataFrame:
    posts = posts_of(spark, d)
    files = files_of(spark, d).join(posts.select("NOTI_SN", F.col("o_orderpriority").alias("NOTI_KND_CD")), "NOTI_SN")
    types = posts.select(F.col("o_orderpriority").alias("NOTI_KND_CD")).distinct().withColumn("NOTI_KND_NM", F.upper("NOTI_KND_CD"))
    return views.core_item_view(files, posts, agencies_of(spark, d), types, values_of(spark, d), images_of(spark, d), ("LOC", "AREA", "PRPS", "WORK_PRD")).drop("CHRG_PSN_NM")


@query("SELECT l_orderkey AS NOTI_SN, count(*) AS n_files, max(l_linenumber) AS last_sn FROM lineitem GROUP BY 1 HAVING count(*) <> max(l_linenumber)")
def gap_detection(spark, d):
    return views.attachment_gaps(images_of(spark, d))


@query(f"WITH {FILES_SQL} SELECT c_custkey AS INSTT_SN, c_name AS INSTT_NM, o_orderstatus AS BBS_STTS_CD, count(*) AS n_files, count(*) FILTER (WHERE PROC_STTS_CD = 'OK') AS n_ok FROM files JOIN orders ON o_orderkey = NOTI_SN JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3")
def agency_counts(spark, d):
    return views.agency_counts(agencies_of(spark, d), posts_of(spark, d), files_of(spark, d))


@query("SELECT c_custkey AS INSTT_SN, c_name AS INSTT_NM FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def no_post_agencies(spark, d):
    return views.agencies_without_posts(agencies_of(spark, d), posts_of(spark, d).where("o_orderpriority = '1-URGENT'"))


CRAWLS_SQL = "crawls AS (SELECT user_id AS INSTT_SN, CASE WHEN event_type = 'error' OR value < 20 THEN 'FAIL' ELSE 'OK' END AS st, CAST(ts AS DATE) AS dt FROM events)"


def crawls_of(spark, d):
    status = F.when((F.col("event_type") == "error") | (F.col("value") < 20), "FAIL").otherwise("OK")
    return read(spark, d, "events").select(F.col("user_id").alias("INSTT_SN"), status.alias("CRWL_STTS_CD"), F.to_date("ts").alias("CRWL_DT"), F.lit(1).cast("long").alias("NOTI_CNT"))


@query(f"WITH {CRAWLS_SQL} SELECT c_custkey AS INSTT_SN, c_name AS INSTT_NM FROM customer WHERE c_custkey IN (SELECT INSTT_SN FROM crawls WHERE st = 'OK') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH')")
def crawl_ok_no_post(spark, d):
    return views.crawled_without_posts(agencies_of(spark, d), crawls_of(spark, d), posts_of(spark, d).where("o_orderpriority = '2-HIGH'"))


@query(f"WITH {CRAWLS_SQL} SELECT a.INSTT_SN, a.n_failed, a.last_dt, c_name AS INSTT_NM FROM (SELECT INSTT_SN, count(*) AS n_failed, max(dt) AS last_dt FROM crawls WHERE st = 'FAIL' GROUP BY 1) a LEFT JOIN customer ON c_custkey = a.INSTT_SN")
def crawl_failures(spark, d):
    return views.crawl_failures(crawls_of(spark, d), agencies_of(spark, d))


@query(f"""WITH {CRAWLS_SQL}, a AS (SELECT INSTT_SN, count(*) AS n_crawled FROM crawls WHERE st = 'OK' GROUP BY 1), b AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT a.INSTT_SN, n_crawled, c_name AS INSTT_NM, coalesce(n, 0) AS n_loaded FROM a JOIN customer ON c_custkey = a.INSTT_SN LEFT JOIN b ON o_custkey = a.INSTT_SN WHERE n_crawled <> coalesce(n, 0)""")
def crawl_reconcile(spark, d):
    return views.reconcile(crawls_of(spark, d), posts_of(spark, d), agencies_of(spark, d))


@query(f"WITH {CRAWLS_SQL} SELECT c_custkey AS INSTT_SN, c_name AS INSTT_NM FROM customer WHERE NOT EXISTS (SELECT 1 FROM crawls WHERE INSTT_SN = c_custkey AND dt = DATE '2024-01-02')")
def not_run_today(spark, d):
    return views.not_crawled_on(agencies_of(spark, d), crawls_of(spark, d), "2024-01-02")


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, nullif(o_orderstatus, 'P') AS board_no, nullif(l_linestatus, 'F') AS body_no FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(l_linestatus, 'F')")
def number_mismatches(spark, d):
    """A number that is missing on one side only is another number; missing on both it is none."""
    posts = read(spark, d, "orders").select(F.col("o_orderkey").alias("NOTI_SN"), F.nullif("o_orderstatus", F.lit("P")).alias("NOTI_NO"))
    files = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), F.nullif("l_linestatus", F.lit("F")).alias("NOTI_NO"))
    return views.number_mismatches(posts, files)


@query("""SELECT DISTINCT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CAST(l_suppkey AS INTEGER) AS DSPS_SN, '[' || strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(l_shipdate, '%Y-%m-%d') || ']' AS period FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) AND CAST(o_orderdate AS DATE) < DATE '1996-02-01' AND CAST(l_shipdate AS DATE) >= DATE '1996-01-01'""")
def range_overlap(spark, d):
    """Periods as literals "[start,end]"; inverted ones are none."""
    li = read(spark, d, "lineitem").join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    at = [F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN")]
    values = li.select(*at, F.col("l_suppkey").cast("int").alias("DSPS_SN"), F.lit("WORK_PRD").alias("NOTI_ITEM_CD"), T.range_literal(iso("o_orderdate"), iso("l_shipdate")).alias("ITEM_VAL_CTNT"))
    out = views.overlapping(values, li.select(*at).distinct(), "1996-01-01", "1996-02-01")
    return out.select("NOTI_SN", "ATCH_SN", "DSPS_SN", F.col("ITEM_VAL_CTNT").alias("period")).distinct()


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS s, strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS e, '[' || strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') || ']' AS lit FROM orders""")
def range_split(spark, d):
    text = F.concat(F.date_format("o_orderdate", "yyyy. M. d."), F.lit("부터 "), F.date_format(F.date_add("o_orderdate", 30), "yyyy년 M월 d일"), F.lit("까지"))
    halves = read(spark, d, "orders").select("o_orderkey", T.range_halves(text).alias("h"))
    out = halves.select("o_orderkey", T.date_iso("h.lo").alias("s"), T.date_iso("h.hi").alias("e"))
    return out.withColumn("lit", T.range_literal("s", "e"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso FROM orders")
def date_to_iso(spark, d):
    """Four notations, and one that names no date."""
    day = F.col("o_orderdate")
    forms = [F.date_format(day, "yyyy. M. d."), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy년 M월 d일"), F.concat(F.date_format(day, "yyyy"), F.lit("/"), F.date_format(day, "M/d")), F.lit("2024. 13. 5.")]
    text = F.element_at(F.array(*forms), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return read(spark, d, "orders").select("o_orderkey", T.date_iso(text).alias("iso"))


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS LOC, o_orderpriority AS PRPS, strftime(o_orderdate, '%Y-%m-%d') AS APV_DT, o_orderstatus AS other FROM orders""")
def label_scan_roundtrip(spark, d):
    """Values on the label's line, on the next line, and behind a colon at the head of a line."""
    o = read(spark, d, "orders")
    text = F.concat_ws("\n", F.concat(F.lit("1. 점용ㆍ사용 장소 : "), F.col("o_custkey").cast("string")), F.lit("2. 목 적 :"), F.col("o_orderpriority"), F.lit("허가일자"), F.concat(F.lit(": "), F.date_format("o_orderdate", "yyyy. M. d.")), F.concat(F.lit("- 기타구분 : "), F.col("o_orderstatus")))
    pairs = lines.label_pairs(lines.explode_lines(o.select(F.col("o_orderkey").alias("doc"), text.alias("text"))))
    facts = lines.pair_facts(pairs, dictionaries.synonym_dim(spark))
    of = lambda c: F.max(F.when(F.col("item_cd") == c, F.col("value")))
    return facts.groupBy(F.col("doc").alias("o_orderkey")).agg(of("LOC").alias("LOC"), of("PRPS").alias("PRPS"), T.date_iso(of("APV_DT")).alias("APV_DT"), F.max(F.when(F.col("item_cd").isNull(), F.col("value"))).alias("other"))


@query("SELECT n_nationkey, v, CASE v WHEN 0 THEN 'LOC' WHEN 1 THEN 'AREA' WHEN 2 THEN 'APLC_NM' WHEN 3 THEN 'PRPS' END AS item_cd FROM nation, (SELECT unnest([0, 1, 2, 3, 4]) AS v)")
def canonical_lookup(spark, d):
    """Labels with enumeration, blanks, other dots and brackets, and one that no item knows."""
    forms = F.array(F.lit("□ 1. 점용ㆍ사용 장소 :"), F.lit("나. 면 적(㎡)"), F.lit("성명(또는 명칭)"), F.lit("점용․사용의 목적"), F.col("n_name"))
    rows = read(spark, d, "nation").select("n_nationkey", F.posexplode(forms).alias("v", "label"))
    return lines.with_items(rows, dictionaries.synonym_dim(spark)).select("n_nationkey", "v", "item_cd")


@query("SELECT p_partkey, length(replace(p_name, ' ', '')) BETWEEN 1 AND 20 AND p_partkey % 3 = 0 AND p_partkey % 2 = 0 AS kept FROM part")
def extras_filter(spark, d):
    """Unknown labels are kept where they are short, without digits and with brackets in pairs, and their value has content."""
    label = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 3 == 1, "7").when(F.col("p_partkey") % 3 == 2, "(").otherwise(""))
    value = F.when(F.col("p_partkey") % 2 == 0, "값").otherwise("--")
    return read(spark, d, "part").select("p_partkey", T.keeps_unknown_label(T.normalise_label(label), value).alias("kept"))


@query("SELECT o_orderkey, '제' || o_custkey || '호' AS number, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders")
def approval_split(spark, d):
    text = F.concat(F.lit("제"), F.col("o_custkey").cast("string"), F.lit("호("), F.date_format("o_orderdate", "yyyy. M. d."), F.lit(")"))
    return read(spark, d, "orders").select("o_orderkey", T.approval_parts(text).alias("a")).select("o_orderkey", F.col("a.number").alias("number"), T.date_iso("a.date").alias("date"))


@query("SELECT c_custkey, '부산광역시 강서구 녹산로 ' || c_custkey AS address FROM customer")
def address_extract(spark, d):
    text = F.concat(F.lit("신청인 주소: 부산광역시 강서구 녹산로 "), F.col("c_custkey").cast("string"), F.lit(" (연락처 없음)"))
    return read(spark, d, "customer").select("c_custkey", T.address(text).alias("address"))


@query("SELECT o_orderkey, '군산지방해양수산청' AS agency, '고시 제' || year(o_orderdate) || '-' || o_custkey || '호' AS number FROM orders")
def notice_no_extract(spark, d):
    """Numbers on one line, and under a header without the word."""
    serial = F.concat(F.lit("제"), F.year("o_orderdate").cast("string"), F.lit("- "), F.col("o_custkey").cast("string"), F.lit(" 호"))
    one = F.concat(F.lit("군산지방해양수산청 고 시 "), serial)
    two = F.concat(F.lit("군산지방해양수산청  "), serial)
    even = F.col("o_orderkey") % 2 == 0
    text = read(spark, d, "orders").select("o_orderkey", F.when(even, one).otherwise(two).alias("line"), F.when(even, "알림").otherwise("고 시 문").alias("before"))
    return text.select("o_orderkey", T.notice_number("line", "before").alias("n")).select("o_orderkey", "n.agency", "n.number")


@query("SELECT s_suppkey, s_suppkey % 2 = 0 AS signer, upper(s_name) AS title FROM supplier")
def signer_and_spacing(spark, d):
    name = F.when(F.col("s_suppkey") % 2 == 0, "부 산 지방 해양수산청장 ***").otherwise("담당자 연락처")
    apart = F.array_join(F.split(F.upper("s_name"), ""), " ")
    return read(spark, d, "supplier").select("s_suppkey", T.is_signer(name).alias("signer"), T.unspaced(apart).alias("title"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 0 THEN '<표 ' || n_nationkey || '> ' || n_name WHEN n_nationkey % 3 = 1 THEN '그림 ' || n_nationkey || ' ' || n_name END AS caption FROM nation")
def caption_nearest(spark, d):
    """Of a notice's four lines about the third one, the caption."""
    n = F.col("n_nationkey").cast("string")
    cap = F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lit("<표 "), n, F.lit("> "), F.col("n_name"))).otherwise(F.concat(F.lit("그림 "), n, F.lit(" "), F.col("n_name")))
    rows = F.when(F.col("n_nationkey") % 3 == 0, F.array(cap, F.lit("가"), F.lit("여기"), F.lit("나"))).when(F.col("n_nationkey") % 3 == 1, F.array(F.lit("가"), F.lit("나"), F.lit("여기"), F.lit("다"), cap)).otherwise(F.array(F.lit("가"), F.lit("여기"), F.lit("나")))
    text = read(spark, d, "nation").select(F.col("n_nationkey").alias("doc"), F.posexplode(rows).alias("line_no", "text"))
    return lines.nearest_captions(text).where("text = '여기'").select(F.col("doc").alias("n_nationkey"), "caption")


# ---- titles and types

PART_TYPES = [NoticeType("RING_SMALL", "s", "m", 9, (("small", "ring"), ("large", "gear"))), NoticeType("RING", "t", "m", 8, (("ring",),)), NoticeType("ECO", "p", "m", 7, (("economy",),)), NoticeType("PROMO", "u", "m", 5, (("promo",), ("bolt", "standard")))]
TITLE_SQL = "lower(replace(p_type || ' ' || p_name, ' ', ''))"
TYPE_SQL = f"""CASE WHEN ({TITLE_SQL} LIKE '%small%' AND {TITLE_SQL} LIKE '%ring%') OR ({TITLE_SQL} LIKE '%large%' AND {TITLE_SQL} LIKE '%gear%') THEN 'RING_SMALL' WHEN {TITLE_SQL} LIKE '%ring%' THEN 'RING' WHEN {TITLE_SQL} LIKE '%economy%' THEN 'ECO'
  WHEN {TITLE_SQL} LIKE '%promo%' OR ({TITLE_SQL} LIKE '%bolt%' AND {TITLE_SQL} LIKE '%standard%') THEN 'PROMO' END"""


def _titles(spark, d):
    return read(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_type", "p_name").alias("title"))


@query(f"SELECT p_partkey, {TYPE_SQL} AS type_cd FROM part")
def title_classify(spark, d):
    return _titles(spark, d).select("p_partkey", classify_title("title", PART_TYPES).alias("type_cd"))


@query(f"SELECT {TYPE_SQL} AS NOTI_KND_CD, count(*) AS n FROM part GROUP BY 1 HAVING {TYPE_SQL} IS NOT NULL")
def type_distribution(spark, d):
    files = _titles(spark, d).select(classify_title("title", PART_TYPES).alias("NOTI_KND_CD"))
    return views.type_distribution(files, spark.createDataFrame([(t.code,) for t in PART_TYPES], "NOTI_KND_CD string"))


@query(f"SELECT {TITLE_SQL} AS title, count(*) AS n, min(p_type || ' ' || p_name) AS example, count(*) >= 3 AS repeats FROM part WHERE {TYPE_SQL} IS NULL GROUP BY 1")
def unclassified_titles(spark, d):
    return views.unclassified_titles(_titles(spark, d).select(classify_title("title", PART_TYPES).alias("NOTI_KND_CD"), F.col("title").alias("NOTI_TTL")))


TITLES = (
    ("공유수면 점용ㆍ사용 변경허가 고시", "OCU_CHG_PRM"), ("공유수면 매립 실시계획 변경 승인", "RIM_CHG_APV"), ("점용·사용료 감면 고시", "FEE_RED"), ("공유수면 관리 및 매립에 관한 법률에 따른 허가", "OCU_PRM"),
    ("방치선박 제거 공고", "ETC_ABD_RMV"), ("입찰 공고", "ETC_BID_NOT"), ("주간 식단표", None), ("공유수면 점용·사용 실시계획 신고 수리", "IMP_RAC"),
)


@query("SELECT o_orderkey, CASE o_orderkey % 8 " + " ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(TITLES) if c) + " END AS type_cd FROM orders")
def notice_types(spark, d):
    """The dictionary's own types over titles that also name a place and a number."""
    title = F.element_at(F.array(*[F.lit(t) for t, _ in TITLES]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    rows = read(spark, d, "orders").select("o_orderkey", F.concat(title, F.lit(" ("), "o_custkey", F.lit(")")).alias("title"))
    return rows.select("o_orderkey", classify_title("title").alias("type_cd"))


@query(r"SELECT doc_id, CAST(length(regexp_replace(text, '\s', '', 'g')) AS BIGINT) AS chars, length(regexp_replace(text, '\s', '', 'g')) > 5000 AS excluded FROM documents")
def body_size_policy(spark, d):
    chars = T.solid_chars("text").cast("long")
    return read(spark, d, "documents").select("doc_id", chars.alias("chars"), T.skip_reason(chars).isNotNull().alias("excluded"))


# ---- keys in names


@query("SELECT s_suppkey, CAST(s_suppkey AS INTEGER) AS noti_sn, CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey % 7 AS INTEGER) ELSE 1 END AS atch_sn FROM supplier")
def file_key_parse(spark, d):
    number = F.col("s_suppkey").cast("string")
    name = F.when(F.col("s_suppkey") % 2 == 0, F.concat_ws("_", number, (F.col("s_suppkey") % 7).cast("string"), F.col("s_name"))).otherwise(F.concat_ws("_", number, F.lit("20240101093000"), F.col("s_name")))
    key = keys.file_key(F.concat(name, F.lit(".v1.hwp")))
    return read(spark, d, "supplier").select("s_suppkey", key["noti_sn"].alias("noti_sn"), key["atch_sn"].alias("atch_sn"))


@query("""SELECT n_nationkey, CAST(n_nationkey + 1 AS INTEGER) AS folder_no, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END AS sub_no, replace(n_name, '_', ' ') || CASE n_nationkey % 3 WHEN 0 THEN '지방해양수산청' WHEN 1 THEN '시청' ELSE '부' END AS agency,
  CASE WHEN n_nationkey % 5 = 0 THEN 'GZT' WHEN n_nationkey % 3 = 0 THEN 'MOF' WHEN n_nationkey % 3 = 1 THEN 'LOCL' ELSE 'CNTL' END AS kind, CASE WHEN n_nationkey % 4 = 0 THEN 'CLSD' ELSE 'POST' END AS board FROM nation""")
def folder_parse(spark, d):
    n = F.col("n_nationkey")
    tail = F.when(n % 4 == 0, "_지난고시").when(n % 4 == 1, "_고시공고").otherwise("")
    end = F.element_at(F.array(F.lit("지방해양수산청"), F.lit("시청"), F.lit("부")), (n % 3 + 1).cast("int"))
    name = F.concat((n + 1).cast("string"), F.when(n % 2 == 0, "_1").otherwise(""), F.lit("_"), F.when(n % 5 == 0, "전자관보_").otherwise(""), F.col("n_name"), end, tail)
    return read(spark, d, "nation").select("n_nationkey", keys.folder_parts(name).alias("f")).select("n_nationkey", "f.*")


@query("""WITH f AS (SELECT s_nationkey AS folder_no, s_suppkey % 2 AS sub_no, n_name || '-' || (s_suppkey % 3) AS agency FROM supplier JOIN nation ON n_nationkey = s_nationkey),
w AS (SELECT folder_no, agency, min(sub_no) AS sub, count(*) OVER (PARTITION BY folder_no) AS n FROM f GROUP BY 1, 2)
SELECT folder_no, agency, CAST(CASE WHEN n = 1 THEN folder_no ELSE (SELECT max(folder_no) FROM f) + row_number() OVER (PARTITION BY n = 1 ORDER BY folder_no, sub, agency) END AS INTEGER) AS agency_no FROM w""")
def agency_renumber(spark, d):
    s = read(spark, d, "supplier").join(read(spark, d, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    folders = s.select(F.col("s_nationkey").alias("folder_no"), (F.col("s_suppkey") % 2).alias("sub_no"), F.concat_ws("-", "n_name", (F.col("s_suppkey") % 3).cast("string")).alias("agency"), F.lit("CNTL").alias("kind"), F.lit("POST").alias("board"))
    return keys.renumber_agencies(folders).select("folder_no", "agency", F.col("agency_no").cast("int").alias("agency_no")).distinct()


@query("""WITH p AS (SELECT l_orderkey AS noti_sn, l_linenumber AS atch_sn, l_partkey || '/' || l_suppkey || '/' || l_shipdate || '/' || l_extendedprice AS path FROM lineitem)
SELECT noti_sn, atch_sn, count(*) - 1 AS n FROM p GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_keys(spark, d):
    path = F.concat_ws("/", *[F.col(c).cast("string") for c in ("l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")])
    files = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("noti_sn"), F.col("l_linenumber").alias("atch_sn"), path.alias("path"))
    return keys.duplicate_keys(files).groupBy("noti_sn", "atch_sn").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '전자관보_' || c_name || '청' ELSE c_mktsegment END AS agency FROM customer")
def gazette_agency(spark, d):
    gazette = F.col("c_custkey") % 3 == 0
    remark = F.concat(F.lit('관보 "'), F.col("c_name"), F.lit('청고시" 게재'))
    return read(spark, d, "customer").select("c_custkey", keys.post_agency(F.when(gazette, "전자관보").otherwise(F.col("c_mktsegment")), F.when(gazette, remark)).alias("agency"))


# ---- bytes


DOCUMENT_HEADS = (("D0CF11E0A1B11AE1", "hwp"), (b"HWP Document File V3.00".hex(), "hwp3"), ("504B0304", "hwpx"), (b"%PDF-1.4".hex(), "pdf"), (b'<?xml version="1.0"?><HWPML>'.hex(), "hml"), (b"nothing".hex(), None))


def _of(table: tuple, k, of: int) -> Column:
    """One of a small table's entries by a number; nulls stay."""
    return F.element_at(F.array(*[F.lit(row[of]) for row in table]), (k % len(table) + 1).cast("int"))


@query("SELECT p_partkey, ['hwp', 'hwp3', 'hwpx', 'pdf', 'hml', NULL][p_partkey % 6 + 1] AS fmt, coalesce(['hwp', 'hwpx', 'pdf', 'hml'][p_partkey % 4 + 1] <> ['hwp', 'hwp3', 'hwpx', 'pdf', 'hml', NULL][p_partkey % 6 + 1], false) AS mislabelled FROM part")
def format_sniff(spark, d):
    """Every head under every extension, each with a part's name behind it."""
    k = F.col("p_partkey")
    content = F.concat(F.unhex(_of(DOCUMENT_HEADS, k, 0)), F.encode("p_name", "UTF-8"))
    name = F.concat("p_partkey", F.lit("."), F.element_at(F.array(*map(F.lit, ("hwp", "HWPX", "pdf", "hml"))), (k % 4 + 1).cast("int")))
    return sniff.tagged(read(spark, d, "part").select("p_partkey", name.alias("path"), content.alias("content"))).select("p_partkey", F.col("actl_file_extn_nm").alias("fmt"), "mislabelled")


IMAGE_HEADS = (
    ("FFD8FF", None, "jpg"), ("89504E470D0A1A0A", "x.gif", "png"), ("474946383961", None, "gif"), ("424D46000000", None, "bmp"), ("49492A00", None, "tif"), ("524946460000000057454250", None, "webp"), ("D7CDC69A", None, "wmf"), ("00000100", None, "ico"),
    ("D0CF11E0A1B11AE1", None, "ole"), (b"<svg xmlns=''/>".hex(), None, "svg"), (b"abcd".hex(), "image/x-emf", "emf"), (b"abcd".hex(), "BIN0001.PCX", "pcx"), (b"abcd".hex(), "x.exe", "bin"),
)


@query("SELECT s_suppkey, [" + ", ".join(f"'{k}'" for _, _, k in IMAGE_HEADS) + "][s_suppkey % 13 + 1] AS kind FROM supplier")
def image_sniff(spark, d):
    """What bytes say goes first, then a hint that is known, a name or a media type."""
    k = F.col("s_suppkey")
    rows = read(spark, d, "supplier").select("s_suppkey", F.concat(F.unhex(_of(IMAGE_HEADS, k, 0)), F.encode("s_name", "UTF-8")).alias("content"), _of(IMAGE_HEADS, k, 1).cast("string").alias("hint"))
    return rows.select("s_suppkey", sniff.image_type("content", "hint").alias("kind"))


# ---- grids


def _line_cells(spark, d):
    """An order's lines as a table: part, quantity, flag; every third line is empty."""
    li = sized(read(spark, d, "lineitem"), "l_orderkey").withColumn("row", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")) - 1)
    shown = lambda c: F.when(F.col("row") % 3 == 2, "").otherwise(F.col(c).cast("string"))
    texts = F.array(shown("l_returnflag"), F.lit(" "), shown("l_linestatus"), shown("l_suppkey"))
    return li.select(F.col("l_orderkey").alias("doc"), F.lit(0).alias("tbl"), "row", F.posexplode(texts).alias("col", "text"))


LINE_SQL = "l AS (SELECT l_orderkey AS doc, l_returnflag AS a, l_linestatus AS b, CAST(l_suppkey AS VARCHAR) AS c, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) - 1 AS r FROM lineitem)"


@query(f"WITH {LINE_SQL}, k AS (SELECT *, row_number() OVER (PARTITION BY doc ORDER BY r) - 1 AS nr FROM l WHERE r % 3 <> 2) SELECT doc, r AS row, nr AS new_row, 0 AS new_col, a AS text FROM k UNION ALL SELECT doc, r, nr, 1, b FROM k UNION ALL SELECT doc, r, nr, 2, c FROM k")
def grid_clean(spark, d):
    out = grid.clean_grid(_line_cells(spark, d))
    return out.select("doc", F.col("row").cast("long").alias("row"), F.col("new_row").cast("long").alias("new_row"), F.col("new_col").cast("int").alias("new_col"), "text")


@query(f"WITH {LINE_SQL} SELECT doc, r AS row, 0 AS col, a AS text FROM l WHERE r % 3 <> 2 UNION ALL SELECT doc, r, 2, b FROM l WHERE r % 3 <> 2 UNION ALL SELECT doc, r, 3, c FROM l WHERE r % 3 <> 2 UNION ALL SELECT doc, r, 1, '' FROM l WHERE r % 3 <> 2 UNION ALL SELECT doc, r, 0, '' FROM l WHERE r % 3 = 2")
def consecutive_dedupe(spark, d):
    return grid.dedupe_neighbours(_line_cells(spark, d)).select("doc", F.col("row").cast("long").alias("row"), "col", "text")


@query("SELECT o_orderkey AS doc, 0 AS row, 0 AS col, 0 AS r0, 0 AS c0 FROM orders UNION ALL SELECT o_orderkey, 0, 1, 0, 0 FROM orders UNION ALL SELECT o_orderkey, 1, 0, 0, 0 FROM orders UNION ALL SELECT o_orderkey, 1, 1, 0, 0 FROM orders UNION ALL SELECT o_orderkey, 0, 2, 0, 2 FROM orders")
def span_owner(spark, d):
    spans = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), F.lit(0).alias("tbl"), F.explode(F.expr("array(named_struct('row', 0, 'col', 0, 'row_span', 2, 'col_span', 2), named_struct('row', 0, 'col', 2, 'row_span', 1, 'col_span', 1))")).alias("s")).select("doc", "tbl", "s.*")
    return grid.span_owners(spans).select("doc", "row", "col", F.col("owner.r").alias("r0"), F.col("owner.c").alias("c0"))


def _no_spans(spark):
    return spark.createDataFrame([], "doc long, tbl int, row int, col int, row_span int, col_span int, text string")


@query("SELECT n_regionkey AS doc, CAST(r AS INTEGER) AS record_row, item_cd, CASE item_cd WHEN 'APLC_NM' THEN n_name ELSE CAST(n_nationkey AS VARCHAR) || 'm2' END AS value FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS r FROM nation), (SELECT unnest(['APLC_NM', 'AREA']) AS item_cd)")
def header_list(spark, d):
    """A region's nations as a table with a header."""
    n = read(spark, d, "nation").withColumn("row", F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")))
    body = n.select(F.col("n_regionkey").cast("long").alias("doc"), "row", F.posexplode(F.array(F.col("n_name"), F.concat(F.col("n_nationkey").cast("string"), F.lit("m2")))).alias("col", "text"))
    head = read(spark, d, "region").select(F.col("r_regionkey").cast("long").alias("doc"), F.lit(0).alias("row"), F.posexplode(F.array(F.lit("성 명"), F.lit("점용 면적"))).alias("col", "text"))
    cells = head.unionByName(body).withColumn("tbl", F.lit(0))
    facts = grid.interpret(cells, _no_spans(spark), dictionaries.synonym_dim(spark))
    return facts.where("kind = 'header_list'").select(F.col("doc").cast("int").alias("doc"), "record_row", "item_cd", "value")


@query("SELECT c_custkey AS doc, 'LOC' AS key, c_name AS value FROM customer UNION ALL SELECT c_custkey, '특이', c_mktsegment FROM customer UNION ALL SELECT c_custkey, 'PRPS', CAST(c_nationkey AS VARCHAR) FROM customer")
def label_pairs(spark, d):
    """A form: label and value side by side, a value that must not become a label, and a pair inside a cell."""
    rows = F.array(F.array(F.lit("위치"), F.col("c_name"), F.lit("특이"), F.col("c_mktsegment")), F.array(F.concat(F.lit("점용 목적 : "), F.col("c_nationkey").cast("string")), F.lit(""), F.lit(""), F.lit("")))
    cells = read(spark, d, "customer").select(F.col("c_custkey").alias("doc"), F.lit(0).alias("tbl"), F.posexplode(rows).alias("row", "cs")).select("doc", "tbl", "row", F.posexplode("cs").alias("col", "text"))
    facts = grid.interpret(cells, _no_spans(spark), dictionaries.synonym_dim(spark))
    return facts.select("doc", F.coalesce("item_cd", "label").alias("key"), "value")


@query("SELECT c_custkey AS doc, 2::BIGINT AS n_tables, 3::BIGINT AS n_facts, 2::BIGINT AS n_mapped, 1::BIGINT AS n_unmapped, '특이' AS unmapped FROM customer")
def table_doc_summary(spark, d):
    rows = F.array(F.array(F.lit("위치"), F.col("c_name"), F.lit("특이"), F.col("c_mktsegment")), F.array(F.lit("목적"), F.col("c_mktsegment"), F.lit(""), F.lit("")))
    cells = read(spark, d, "customer").select(F.col("c_custkey").alias("doc"), F.explode(F.array(F.lit(0), F.lit(1))).alias("tbl"), F.posexplode(rows).alias("row", "cs")).where("tbl = 0 OR row = 0").select("doc", "tbl", "row", F.posexplode("cs").alias("col", "raw"))
    cells = cells.select("doc", "tbl", "row", "col", F.when(F.col("tbl") == 1, "").otherwise(F.col("raw")).alias("text"))
    facts = grid.interpret(cells, _no_spans(spark), dictionaries.synonym_dim(spark))
    out = grid.table_summary(grid.table_kinds(cells, facts), facts)
    return out.withColumn("unmapped", F.array_join("unmapped", ","))


# ---- records


def _line_facts(spark, d):
    li = read(spark, d, "lineitem").withColumn("pos", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")))
    return li.select(F.col("l_orderkey").alias("doc"), F.lit(0).alias("record"), (F.col("l_linenumber") % 2).alias("source"), F.lit(0).alias("tbl"), "pos", F.lit(0).alias("number"), F.lit("x").alias("label"), F.concat(F.lit("C"), F.col("l_returnflag")).alias("item_cd"), F.when(F.col("l_linestatus") == "F", " ").otherwise(F.col("l_suppkey").cast("string")).alias("value"))


@query("""WITH l AS (SELECT l_orderkey AS doc, l_linenumber % 2 AS source, 'C' || l_returnflag AS key, CAST(l_suppkey AS VARCHAR) AS value, l_linestatus, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS pos FROM lineitem)
SELECT doc, key, arg_min(value, source * 1000000 + pos) AS value FROM l WHERE l_linestatus <> 'F' GROUP BY 1, 2""")
def first_writer_wins(spark, d):
    return records.first_writer_wins(_line_facts(spark, d)).select("doc", "key", "value")


@query("SELECT o_orderkey AS doc, r AS record, 'LOC' AS key, o_orderpriority || r AS value FROM orders, (SELECT unnest([0, 1, 2]) AS r) UNION ALL SELECT o_orderkey, r, 'PRPS', o_orderstatus FROM orders, (SELECT unnest([0, 1, 2]) AS r)")
def disposition_split(spark, d):
    """Three numbered blocks; numbering that starts again without a repeated item starts none."""
    one = lambda r: [F.concat(F.lit("1. 위치 : "), F.col("o_orderpriority"), F.lit(str(r))), F.concat(F.lit("2. 목적 : "), F.col("o_orderstatus"))]
    text = F.array(*one(0), *one(1), *one(2))
    rows = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), F.posexplode(text).alias("line_no", "text"))
    facts = lines.pair_facts(lines.label_pairs(rows), dictionaries.synonym_dim(spark))
    out = records.disposition_blocks(facts, [i.code for i in dictionaries.items() if i.scope == "attribute"])
    return out.select("doc", "record", F.col("item_cd").alias("key"), "value")


@query("""SELECT o_orderkey AS doc, 'item' AS target, 'APV_NO' AS name, '제' || o_custkey || '호' AS value FROM orders UNION ALL SELECT o_orderkey, 'item', 'APV_DT', strftime(o_orderdate, '%Y-%m-%d') FROM orders
UNION ALL SELECT o_orderkey, 'item', 'WORK_PRD', '[' || strftime(o_orderdate, '%Y-%m-%d') || ',' || strftime(o_orderdate + INTERVAL 9 DAY, '%Y-%m-%d') || ']' FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, 'label', 'WORK_PRD', '미정' FROM orders WHERE o_orderkey % 3 = 2 UNION ALL SELECT o_orderkey, 'item', 'APLC_NM', '홍길동 부산광역시 강서구 녹산로 ' || o_custkey FROM orders UNION ALL SELECT o_orderkey, 'item', 'APLC_ADDR', '부산광역시 강서구 녹산로 ' || o_custkey FROM orders""")
def normalise_and_split(spark, d):
    """Approval number and date apart, periods kept, inverted ones gone, and those that are none as labels; an address out of a name."""
    day, later, before = F.date_format("o_orderdate", "yyyy. M. d."), F.date_format(F.date_add("o_orderdate", 9), "yyyy. M. d."), F.date_format(F.date_add("o_orderdate", -9), "yyyy. M. d.")
    period = F.when(F.col("o_orderkey") % 3 == 0, F.concat_ws(" ~ ", day, later)).when(F.col("o_orderkey") % 3 == 1, F.concat_ws(" ~ ", day, before)).otherwise("미정")
    number = F.concat(F.lit("제"), F.col("o_custkey").cast("string"), F.lit("호 ("), day, F.lit(")"))
    name = F.concat(F.lit("홍길동 부산광역시 강서구 녹산로 "), F.col("o_custkey").cast("string"))
    one = lambda k, v: F.struct(F.lit(k).alias("key"), F.lit(True).alias("mapped"), v.alias("value"))
    values = read(spark, d, "orders").select(F.col("o_orderkey").alias("doc"), F.lit(0).alias("record"), F.explode(F.array(one("APV_NO", number), one("WORK_PRD", period), one("APLC_NM", name))).alias("e")).select("doc", "record", "e.*")
    return records.split_values(records.normalise_records(values), dictionaries.field_dim(spark)).select("doc", "target", "name", "value")


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CAST(l_suppkey % 3 AS INTEGER) AS DSPS_SN, max(l_shipmode) AS A, max(l_flag) AS B FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN l_returnflag END AS l_shipmode, CASE WHEN l_partkey % 2 = 1 THEN l_returnflag END AS l_flag FROM lineitem) GROUP BY 1, 2, 3")
def eav_pivot_by_record(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), (F.col("l_suppkey") % 3).cast("int").alias("DSPS_SN"), F.when(F.col("l_partkey") % 2 == 0, "A").otherwise("B").alias("NOTI_ITEM_CD"), F.col("l_returnflag").alias("ITEM_VAL_CTNT"))
    return views.record_pivot(rows, ("A", "B"))


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, count(DISTINCT l_suppkey % 3) AS n_dispositions FROM lineitem GROUP BY 1, 2")
def disposition_counts(spark, d):
    return views.disposition_counts(read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"), (F.col("l_suppkey") % 3).alias("DSPS_SN")))


@query("SELECT l_orderkey AS doc, CAST(rank() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS BIGINT) AS dsps_sn, l_linenumber AS record FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) q QUALIFY l_linenumber % 2 = 0")
def record_holes(spark, d):
    """Dispositions are numbered before those without values drop out."""
    every = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc"), F.col("l_linenumber").alias("record")).distinct()
    return records.number_dispositions(every.where("record % 2 = 0"), every).select("doc", F.col("dsps_sn").cast("long").alias("dsps_sn"), "record")


# ---- loads


@query("SELECT o_orderkey AS NOTI_SN, CASE WHEN o_orderkey % 4 = 0 THEN 'NEW' ELSE o_orderpriority END AS a, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderstatus END AS b FROM orders UNION ALL SELECT -1, 'NEW', 'x'")
def upsert_coalesce(spark, d):
    """What comes as null leaves what was there."""
    old = read(spark, d, "orders").select(F.col("o_orderkey").alias("NOTI_SN"), F.col("o_orderpriority").alias("a"), F.when(F.col("o_orderkey") % 8 != 0, F.col("o_orderstatus")).alias("b"))
    new = old.where("NOTI_SN % 4 = 0").select("NOTI_SN", F.lit("NEW").alias("a"), F.lit(None).cast("string").alias("b"))
    return warehouse.upsert_merge(old, new.unionByName(spark.createDataFrame([(-1, "NEW", "x")], "NOTI_SN long, a string, b string")), ["NOTI_SN"])


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CASE WHEN l_linenumber = 1 THEN 'again' ELSE 'first' END AS v, CASE WHEN l_linenumber = 1 THEN 1 ELSE count(*) END AS n FROM lineitem GROUP BY 1, 2")
def replace_attachment(spark, d):
    """Attachments that come again replace theirs with all children; siblings stay."""
    files = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN"))
    old = {"OS_ATCH_FILE_DTL": files.distinct().withColumn("v", F.lit("first"))} | {n: files.withColumn("x", F.lit(1)) for n in warehouse.CHILDREN}
    came = files.where("ATCH_SN = 1").distinct()
    out = warehouse.replace_attachments(old, {"OS_ATCH_FILE_DTL": came.withColumn("v", F.lit("again"))} | {n: came.withColumn("x", F.lit(1)) for n in warehouse.CHILDREN})
    counts = out["OS_ATCH_IMG_DTL"].groupBy("NOTI_SN", "ATCH_SN").agg(F.count(F.lit(1)).alias("n"))
    return out["OS_ATCH_FILE_DTL"].join(counts, ["NOTI_SN", "ATCH_SN"])


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, CASE WHEN max(l_returnflag) = 'R' THEN 'FAIL' ELSE 'OK' END AS PROC_STTS_CD FROM lineitem GROUP BY 1, 2")
def failure_union(spark, d):
    """A failure with the key of a success replaces it."""
    li = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("NOTI_SN"), F.col("l_linenumber").alias("ATCH_SN")).agg(F.max("l_returnflag").alias("f"))
    good = li.select("NOTI_SN", "ATCH_SN", F.lit("OK").alias("PROC_STTS_CD"))
    bad = li.where("f = 'R'").select("NOTI_SN", "ATCH_SN", F.lit("x").alias("file_name"), F.lit("/x").alias("file_path"), F.lit("extract").alias("stage"), F.lit("OTHER").alias("kind"), F.lit("why").alias("message"))
    return warehouse.union_with_failures(good, warehouse.failure_rows(bad)).select("NOTI_SN", "ATCH_SN", "PROC_STTS_CD")


@query("SELECT l_orderkey AS NOTI_SN, l_linenumber AS ATCH_SN, count(*) AS n FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1, 2")
def cascade_delete(spark, d):
    files = images_of(spark, d)
    tables = {"OS_NOTI_BAS": read(spark, d, "orders").select(F.col("o_orderkey").alias("NOTI_SN")), "OS_ATCH_FILE_DTL": files.distinct(), "OS_ATCH_IMG_DTL": files.withColumn("IMG_SN", F.lit(1))}
    out = warehouse.delete_cascade(tables, "OS_NOTI_BAS", tables["OS_NOTI_BAS"].where("NOTI_SN % 3 = 0"))
    return out["OS_ATCH_IMG_DTL"].groupBy("NOTI_SN", "ATCH_SN").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT l_orderkey, l_linenumber, arg_max(l_suppkey, l_partkey * 1000000 + l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2")
def last_write_wins(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") * 1000000 + F.col("l_suppkey")).alias("o"), "l_suppkey")
    return warehouse.last_by(rows, ["l_orderkey", "l_linenumber"], ["o"])


@query("SELECT count(*) FILTER (WHERE f = 'A') AS n_ok, count(*) FILTER (WHERE f = 'R') AS n_failed, count(*) FILTER (WHERE f = 'N') AS n_skipped, (SELECT 4 * count(*) FROM lineitem) AS n_values FROM (SELECT max(l_returnflag) AS f FROM lineitem GROUP BY l_orderkey, l_linenumber)")
def load_stats(spark, d):
    return warehouse.load_stats(files_of(spark, d), values_of(spark, d))


@query("SELECT o_orderkey, CAST((o_orderkey % 2 = 0)::INT + (o_orderkey % 3 = 0)::INT + (o_orderkey % 5 = 0)::INT AS INTEGER) AS n_violations FROM orders")
def domain_validation(spark, d):
    """A null where none may be, a text that is too long, and a hash of another form."""
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select("o_orderkey", F.when(k % 2 != 0, k.cast("int")).alias("NOTI_SN"), F.when(k % 3 == 0, F.repeat(F.lit("가"), F.lit(51))).otherwise("제1호").alias("NOTI_NO"), F.when(k % 5 == 0, "xyz").otherwise(F.sha2(k.cast("string"), 256)).alias("SRC_KEY_HASH"))
    return warehouse.validated(rows, "OS_NOTI_BAS").select("o_orderkey", F.size("violations").alias("n_violations"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_same FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_check(spark, d):
    return warehouse.repeated_keys(read(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]).distinct()


@query("SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def foreign_key_check(spark, d):
    return warehouse.orphans(read(spark, d, "orders").select("o_orderkey"), read(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"])


@query("SELECT sha256(regexp_replace(url, '^https?://', '')) AS src_key_hash, count(*) AS n FROM pages GROUP BY 1")
def hash_key_dedupe(spark, d):
    from tidemark.streaming.ingest import once_by_source

    posts = read(spark, d, "pages").select(F.regexp_replace("url", "^https?://", "").alias("src_key"))
    counts = posts.groupBy(T.key_hash("src_key").alias("src_key_hash")).agg(F.count(F.lit(1)).alias("n"))
    return once_by_source(posts).join(counts, "src_key_hash").select("src_key_hash", "n")


# ---- reports


@query("SELECT count(*) AS n, count(*) FILTER (WHERE event_type = 'view') AS n_scanned, count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS n_native, count(*) FILTER (WHERE event_type = 'error') AS n_failed, round(count(*) FILTER (WHERE event_type = 'view') / count(*) FILTER (WHERE event_type <> 'error'), 3) AS scanned_ratio FROM events")
def scan_survey(spark, d):
    return survey.survey_totals(_survey(spark, d))


def _survey(spark, d):
    status = F.when(F.col("event_type") == "view", "SCANNED").when(F.col("event_type") == "error", "FAILED").otherwise("NATIVE")
    return read(spark, d, "events").select(F.concat(F.lit("f"), F.lpad(F.col("event_id").cast("string"), 9, "0")).alias("path"), (F.col("user_id") % 4).cast("string").alias("ext"), status.alias("status"), F.when(F.col("event_type") == "error", F.element_at(F.array(F.lit("OTHER"), F.lit("IO"), F.lit("XML_PARSE")), (F.col("user_id") % 3 + 1).cast("int"))).alias("kind"))


@query("SELECT CAST(user_id % 4 AS VARCHAR) AS ext, count(*) FILTER (WHERE event_type = 'view') AS n_scanned, count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS n_native, count(*) FILTER (WHERE event_type = 'error') AS n_failed FROM events GROUP BY 1")
def survey_by_ext(spark, d):
    return survey.survey_by_ext(_survey(spark, d))


@query("""WITH f AS (SELECT 'f' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS path, ['OTHER', 'IO', 'XML_PARSE'][user_id % 3 + 1] AS kind FROM events WHERE event_type = 'error')
SELECT kind, count(*) AS n, array_to_string(list_sort(list(path))[1:3], ',') AS samples FROM f GROUP BY 1""")
def failure_samples(spark, d):
    return survey.failure_samples(_survey(spark, d)).withColumn("samples", F.array_join("samples", ","))


@query("""WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[\\x09-\\x0D ]+')) AS label FROM documents)
SELECT label AS ITEM_LBL_NM, count(*) AS n_values, count(DISTINCT doc_id) AS n_posts FROM w WHERE label <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""")
def label_top20(spark, d):
    words = read(spark, d, "documents").select(F.col("doc_id").alias("NOTI_SN"), F.explode(F.split("text", r"[\x09-\x0D ]+")).alias("ITEM_LBL_NM")).where("ITEM_LBL_NM <> ''")
    return views.label_ranking(words)


@query("""WITH w AS (SELECT source AS label, doc_id AS doc, lang AS value FROM documents) SELECT label, count(*) AS n, count(DISTINCT doc) AS n_docs, arg_min(value, doc) AS example FROM w GROUP BY 1""")
def unmapped_frequency(spark, d):
    return views.unmapped_labels(read(spark, d, "documents").select(F.col("source").alias("label"), F.col("doc_id").alias("doc"), F.lit(0).alias("pos"), F.col("lang").alias("value")))


@query("SELECT f AS item_cd, CAST(n AS BIGINT) AS n, CAST(CAST(floor(100.0 * n / t + 0.5) AS BIGINT) AS VARCHAR) || '%' AS percent FROM (SELECT count(*) AS t, count(quality) AS q, count(toxic) FILTER (WHERE toxic = 1) AS x FROM documents d LEFT JOIN labels l USING (doc_id)), LATERAL (SELECT unnest(['q', 'x', 'z']) AS f, unnest([q, x, 0]) AS n)")
def field_coverage(spark, d):
    docs, labels = read(spark, d, "documents"), read(spark, d, "labels")
    one = lambda k, v: F.struct(F.lit(k).alias("key"), F.lit(True).alias("mapped"), v.cast("string").alias("value"))
    values = docs.join(labels, "doc_id").select(F.explode(F.array(one("q", F.col("quality")), one("x", F.when(F.col("toxic") == 1, 1)))).alias("e")).select("e.*")
    total = docs.count()
    return views.field_coverage(values, spark.createDataFrame([("q",), ("x",), ("z",)], "item_cd string"), total)


@query("SELECT doc_id AS doc, lang AS labels, left(text, 1000) || CASE WHEN length(text) > 1000 THEN '…' ELSE '' END AS excerpt FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id) AND lang <> 'es'")
def unmapped_report(spark, d):
    docs = read(spark, d, "documents")
    files = docs.select(F.col("doc_id").alias("doc"), (F.col("lang") == "es").alias("excluded"))
    items = read(spark, d, "labels").select(F.col("doc_id").alias("doc"), F.lit(0).alias("record"), F.lit("item").alias("target"), F.lit("q").alias("name"), F.lit("1").alias("value"))
    labels = docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("record"), F.lit("label").alias("target"), F.lit("lang").alias("name"), F.col("lang").alias("value"))
    out = records.unmapped_report(files, items.unionByName(labels), docs.select(F.col("doc_id").alias("doc"), F.lit(0).alias("pos"), "text"))
    return out.select("doc", F.array_join(F.transform("labels", lambda x: F.substring_index(x, ": ", -1)), ",").alias("labels"), "excerpt")


@query("SELECT CASE l_returnflag WHEN 'R' THEN 'EXTC' ELSE 'DTCT' END AS FAIL_STEP_CD, l_linestatus AS FAIL_KND_CD, count(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2")
def failure_breakdown(spark, d):
    rows = read(spark, d, "lineitem").select(F.when(F.col("l_returnflag") == "N", "OK").otherwise("FAIL").alias("PROC_STTS_CD"), F.when(F.col("l_returnflag") == "R", "EXTC").otherwise("DTCT").alias("FAIL_STEP_CD"), F.col("l_linestatus").alias("FAIL_KND_CD"))
    return views.failure_breakdown(rows)


# ---- pages


@query("""WITH p AS (SELECT p_brand, CAST(p_size AS DOUBLE) * 2 AS x FROM part GROUP BY ALL), g AS (SELECT *, CASE WHEN x - lag(x) OVER (PARTITION BY p_brand ORDER BY x) > 3 THEN 1 ELSE 0 END AS gap FROM p),
c AS (SELECT *, sum(gap) OVER (PARTITION BY p_brand ORDER BY x) AS cluster FROM g) SELECT p_brand, CAST(cluster AS BIGINT) AS cluster, count(*) AS n, min(x) AS lo, max(x) AS hi FROM c GROUP BY 1, 2""")
def cluster_coords(spark, d):
    points = read(spark, d, "part").select("p_brand", (F.col("p_size").cast("double") * 2).alias("x")).distinct()
    return geometry.cluster(points, ["p_brand"], "x").groupBy("p_brand", "cluster").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))


@query("""WITH v AS (SELECT s_nationkey AS page, min(s_acctbal) AS lo, max(s_acctbal) AS hi, s_suppkey % 4 AS k FROM supplier GROUP BY 1, 4), h AS (SELECT DISTINCT c_nationkey AS page, CAST(round(c_acctbal / 100) * 100 AS INTEGER) AS at FROM customer)
SELECT h.page, h.at, count(v.page) AS n_crossed FROM h LEFT JOIN v ON v.page = h.page AND h.at BETWEEN v.lo - 5 AND v.hi + 5 GROUP BY 1, 2""")
def h_line_crossing(spark, d):
    v = read(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("page"), (F.col("s_suppkey") % 4).alias("k")).agg(F.min("s_acctbal").alias("lo"), F.max("s_acctbal").alias("hi"))
    h = read(spark, d, "customer").select(F.col("c_nationkey").alias("page"), (F.round(F.col("c_acctbal") / 100) * 100).cast("int").alias("at")).distinct()
    return geometry.crossing(h, v).select("page", "at", "n_crossed")


@query("""WITH b AS (SELECT s_nationkey AS page, s_acctbal AS t, s_acctbal + 500 AS u FROM supplier) SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM b WHERE page = c_nationkey AND c_acctbal BETWEEN t AND u)""")
def band_anti_join(spark, d):
    bands = read(spark, d, "supplier").select(F.col("s_nationkey").alias("page"), F.col("s_acctbal").alias("top"), (F.col("s_acctbal") + 500).alias("bottom"))
    rows = read(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("page"), F.col("c_acctbal").alias("center"))
    return geometry.outside_bands(rows, bands).select("c_custkey")


@query("SELECT page_id, replace(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), chr(13), ''), chr(10), '<br>') AS html FROM pages")
def html_escape(spark, d):
    return read(spark, d, "pages").select("page_id", T.html_escape("html").alias("html"))


@query("SELECT n_nationkey, 0 AS tbl, 0 AS row, c AS col, CASE c WHEN 0 THEN n_name ELSE 'x & y' END AS text FROM nation, (SELECT unnest([0, 1]) AS c) UNION ALL SELECT n_nationkey, 0, 1, c, CASE c WHEN 0 THEN n_name ELSE CAST(n_regionkey AS VARCHAR) END FROM nation, (SELECT unnest([0, 1]) AS c)")
def html_table_grid(spark, d):
    """A cell over two rows stands in both."""
    html = F.concat(F.lit('<p>a</p><TABLE><tr><td rowspan="2">'), F.col("n_name"), F.lit("</td><td>x &amp; y</td></tr><tr><td>"), F.col("n_regionkey").cast("string"), F.lit("</td></tr></TABLE>"))
    return render.html_cells(read(spark, d, "nation").select("n_nationkey", html.alias("html")), "n_nationkey", "html")


@query("SELECT n_nationkey, 0 AS row, 0 AS col, n_name AS text FROM nation UNION ALL SELECT n_nationkey, 0, 1, CAST(n_regionkey AS VARCHAR) FROM nation UNION ALL SELECT n_nationkey, 1, 0, 'a' FROM nation UNION ALL SELECT n_nationkey, 1, 1, 'b' FROM nation")
def markdown_table_parse(spark, d):
    text = F.concat(F.lit("말머리\n| "), F.col("n_name"), F.lit(" | "), F.col("n_regionkey").cast("string"), F.lit(" |\n| --- | :-: |\n| a | b |\n끝"))
    return render.markdown_cells(read(spark, d, "nation").select("n_nationkey", text.alias("text")), "n_nationkey", "text")


@query("SELECT r_regionkey AS doc, '<table><tr><td colspan=\"2\">' || r_name || '</td></tr><tr><td>a&lt;b</td><td>c</td></tr></table>' AS html FROM region")
def html_render(spark, d):
    r = read(spark, d, "region").select(F.col("r_regionkey").alias("doc"), "r_name", F.lit(0).alias("tbl"))
    cells = r.select("doc", "tbl", F.explode(F.array(*[F.struct(F.lit(i).alias("row"), F.lit(j).alias("col"), t.alias("text")) for i, j, t in ((0, 0, F.col("r_name")), (0, 1, F.col("r_name")), (1, 0, F.lit("a<b")), (1, 1, F.lit("c")))])).alias("c")).select("doc", "tbl", "c.*")
    spans = r.select("doc", "tbl", F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(1).alias("row_span"), F.lit(2).alias("col_span"))
    return render.html_tables(cells, spans).select("doc", "html")


@query("SELECT n_nationkey, n_name || ' bold code 2' AS text FROM nation")
def markdown_plain(spark, d):
    text = F.concat(F.lit("## "), F.col("n_name"), F.lit(" **bold** `code` $^{2}$"))
    return read(spark, d, "nation").select("n_nationkey", render.plain_markdown(text).alias("text"))


# ---- events


@query("SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    from tidemark.streaming.ingest import event_windows as windows

    return windows(read(spark, d, "events")).select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("""WITH e AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def event_sessions(spark, d):
    from tidemark.streaming.ingest import event_sessions as sessions

    return sessions(read(spark, d, "events")).select("user_id", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


# ---- names, sheets, sinks


@query("""SELECT CASE WHEN c_custkey % 5 = 0 THEN 'INSTT_NM_' || c_custkey || '_NM' WHEN c_custkey % 5 = 1 THEN 'C' || c_custkey || '_DT' WHEN c_custkey % 5 = 2 THEN 'C' || c_custkey || '_XYZ' ELSE 'C' || c_custkey || '_NM' END AS name,
  CASE WHEN c_custkey % 5 = 0 THEN 'unknown word ' || c_custkey WHEN c_custkey % 5 = 1 THEN 'unknown word C' || c_custkey || ',domain should be D_DT' WHEN c_custkey % 5 = 2 THEN 'unknown word C' || c_custkey || ',unknown word XYZ,no classifier at the end: XYZ' ELSE 'unknown word C' || c_custkey END AS violations FROM customer""")
def name_governance(spark, d):
    """Names of columns: words that the standard lacks, ends that classify nothing, and domains that are not their last word's."""
    words = spark.createDataFrame([("INSTT", "agency", None), ("NOTI", "notice", None), ("NM", "name", "D_NM"), ("DT", "date", "D_DT")], "word string, meaning string, domain string")
    k, own = F.col("c_custkey") % 5, F.concat(F.lit("C"), "c_custkey")
    name = F.when(k == 0, F.concat(F.lit("INSTT_NM_"), "c_custkey", F.lit("_NM"))).when(k == 1, F.concat(own, F.lit("_DT"))).when(k == 2, F.concat(own, F.lit("_XYZ"))).otherwise(F.concat(own, F.lit("_NM")))
    names = read(spark, d, "customer").select(name.alias("name"), F.lit("D_NM").alias("domain"))
    return governance.name_violations(names, words).select("name", F.array_join("violations", ",").alias("violations"))


def _sheet(spark, d):
    o = read(spark, d, "orders").join(read(spark, d, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
    gazette = F.col("o_orderkey") % 7 == 0
    return o.select(
        F.col("o_orderkey").alias("seq"), F.when(gazette, "전자관보").otherwise(F.col("c_name")).alias("agency"), F.col("o_orderpriority").alias("title"), F.lit("d").alias("dept"), F.lit("p").alias("person"), F.lit("t").alias("phone"), F.lit("n").alias("notice_no"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy. M. d.")).alias("posted"), F.concat(F.lit("a"), F.lit("\n \nb ")).alias("attachments"), F.when(gazette, F.concat(F.lit('"'), F.col("c_name"), F.lit('고시" 참조'))).alias("remark"),
    )


@query("SELECT CASE WHEN o_orderkey % 7 = 0 THEN '전자관보_' || c_name ELSE c_name END AS agency, min(CAST(o_orderdate AS DATE)) AS first_dt, max(CAST(o_orderdate AS DATE)) AS last_dt FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1")
def crawl_sheet_posts(spark, d):
    return crawl.crawl_period(crawl.crawl_posts(_sheet(spark, d)))


@query("SELECT CAST(o_orderkey AS INTEGER) AS NOTI_SN, n AS ATCH_SN, CASE n WHEN 1 THEN 'a' ELSE 'b' END AS ATCH_FILE_NM FROM orders, (SELECT unnest([1, 2]) AS n)")
def crawl_sheet_attachments(spark, d):
    return crawl.crawl_attachments(_sheet(spark, d))


def _failures(bad, total):
    """The totals of a report, and a checksum over its rows."""
    bad = bad.select(F.col("l_linenumber").cast("string").alias("file_name"), F.lit("extract").alias("stage"), F.lit("OTHER").alias("kind"), F.lit("m").alias("message"))
    return sinks.failures_report(bad, total).agg(F.max("total").alias("total"), F.max("failed").alias("failed"), F.sum(F.col("file_name").cast("long")).alias("checksum"))


@query("SELECT (SELECT count(*) FROM lineitem) AS total, count(*) AS failed, CAST(sum(l_linenumber) AS BIGINT) AS checksum FROM lineitem WHERE l_returnflag = 'R'")
def failures_report(spark, d):
    """The report of all failures."""
    li = read(spark, d, "lineitem")
    return _failures(li.where("l_returnflag = 'R'"), li.count())


@query("SELECT s_suppkey, CAST(x AS INTEGER) AS col, CAST(CASE WHEN s_suppkey % 2 = 0 AND x = 0 THEN 2 ELSE 1 END AS INTEGER) AS col_span FROM supplier, (SELECT unnest([0, 1]) AS x) WHERE NOT (s_suppkey % 2 = 0 AND x = 1) UNION ALL SELECT s_suppkey, 0, 1 FROM supplier WHERE s_suppkey % 2 = 0 UNION ALL SELECT s_suppkey, 1, 1 FROM supplier WHERE s_suppkey % 2 = 0")
def edge_grid(spark, d):
    """Boxes of tables as rows and columns: every other table has a wide cell above two."""
    box = lambda x0, y0, x1, y1: F.struct(F.lit(x0).alias("x0"), F.lit(y0).alias("y0"), F.lit(x1).alias("x1"), F.lit(y1).alias("y1"))
    two = [box(0, 5, 10, 9), box(10, 5, 20, 9)]
    boxes = F.when(F.col("s_suppkey") % 2 == 0, F.array(box(0, 0, 20, 5), *two)).otherwise(F.array(*two))
    cells = read(spark, d, "supplier").select("s_suppkey", F.explode(boxes).alias("b")).select("s_suppkey", "b.*")
    return geometry.edge_grid(cells, ["s_suppkey"]).select("s_suppkey", F.col("col").cast("int").alias("col"), F.col("col_span").cast("int").alias("col_span"))
