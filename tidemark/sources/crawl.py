"""Crawled sheets as warehouse rows: posts with their attachments, and the log of what was crawled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators.keys import post_agency


def crawl_posts(sheet: DataFrame, kind: str = "FULL_CRAWL") -> DataFrame:
    """OS_NOTI_BAS rows of (seq, agency, title, dept, person, phone, notice_no, posted, remark): dates in any known form, the gazette's agency out of the remark."""
    date = F.coalesce(F.col("posted").try_cast("date"), T.date_iso("posted").try_cast("date"))
    return sheet.select(
        F.col("seq").cast("int").alias("NOTI_SN"), post_agency("agency", "remark").alias("agency"), F.col("title").alias("BBS_TTL"), F.lit(kind).alias("CRWL_KND_CD"), F.col("dept").alias("CHRG_DEPT_NM"),
        F.col("person").alias("CHRG_PSN_NM"), F.col("phone").alias("TEL_NO"), F.col("notice_no").alias("NOTI_NO"), date.alias("NOTI_DT"), T.key_hash(F.concat_ws("|", "agency", "title", "notice_no", "posted")).alias("SRC_KEY_HASH"),
    )


def crawl_attachments(sheet: DataFrame) -> DataFrame:
    """(NOTI_SN, ATCH_SN, ATCH_FILE_NM) of attachments, a line each in a cell; blank lines are none."""
    each = sheet.select(F.col("seq").cast("int").alias("NOTI_SN"), F.posexplode(F.filter(F.split("attachments", "\n"), lambda x: F.trim(x) != "")).alias("pos", "name"))
    return each.select("NOTI_SN", (F.col("pos") + 1).alias("ATCH_SN"), F.trim("name").alias("ATCH_FILE_NM"))


def crawl_log(summary: DataFrame, day: str, kind: str = "FULL_CRAWL") -> DataFrame:
    """OS_CRWL_LOG_DTL rows of (no "12_1", agency, site_url, post_cnt, file_cnt): boards of one agency are rows of their own."""
    number = F.regexp_extract("no", r"^(\d+)", 1).try_cast("int")
    return summary.select(number.alias("INSTT_SN"), F.lit(day).cast("date").alias("CRWL_DT"), F.lit(kind).alias("CRWL_KND_CD"), F.lit("OK").alias("CRWL_STTS_CD"), F.col("site_url").alias("INSTT_BBS_URL"), F.col("post_cnt").cast("int").alias("NOTI_CNT"), F.col("file_cnt").cast("int").alias("ATCH_FILE_CNT"))


def crawl_period(posts: DataFrame) -> DataFrame:
    """The days that posts of each agency span."""
    return posts.groupBy("agency").agg(F.min("NOTI_DT").alias("first_dt"), F.max("NOTI_DT").alias("last_dt"))
