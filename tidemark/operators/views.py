"""The core-item view and the questions that are put to the warehouse.

What fans out is folded before it is joined. Dimensions are left for Spark to broadcast below its threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.plans.staging import sized

ATTACHMENT = ["NOTI_SN", "ATCH_SN"]
CORE = ("LOC", "AREA", "PRPS", "APLC_NM", "WORK_PRD", "APLC_ADDR")


def joined_values(value: Column | str, when: Column) -> Column:
    """The distinct values of the rows where when holds, in order, with " | " between them; null for none."""
    return F.nullif(F.array_join(F.array_sort(F.collect_set(F.when(when, value if isinstance(value, Column) else F.col(value)))), " | "), F.lit(""))


def pivot_items(values: DataFrame, codes=CORE) -> DataFrame:
    """One row for each attachment: <code>_VAL_CTNT for each of codes."""
    own = values.where(F.col("NOTI_ITEM_CD").isin(*codes))
    return own.groupBy(*ATTACHMENT).agg(*[joined_values("ITEM_VAL_CTNT", F.col("NOTI_ITEM_CD") == c).alias(f"{c}_VAL_CTNT") for c in codes])


def image_counts(images: DataFrame) -> DataFrame:
    return images.groupBy(*ATTACHMENT).agg(F.count(F.lit(1)).cast("int").alias("ATCH_IMG_CNT"))


def attachment_summary(values: DataFrame, images: DataFrame, codes=CORE) -> DataFrame:
    """pivot_items and image_counts in one: values and images go through one shuffle by attachment, and repeats fold in it."""
    at = [F.col(c) for c in ATTACHMENT]
    none = F.lit(None).cast("string")
    own = values.where(F.col("NOTI_ITEM_CD").isin(*codes)).select(*at, "NOTI_ITEM_CD", "ITEM_VAL_CTNT", F.lit(0).alias("n"))
    both = own.unionByName(images.select(*at, none.alias("NOTI_ITEM_CD"), none.alias("ITEM_VAL_CTNT"), F.lit(1).alias("n")))
    once = both.repartition(*ATTACHMENT).groupBy(*ATTACHMENT, "NOTI_ITEM_CD", "ITEM_VAL_CTNT").agg(F.sum("n").alias("n"))
    listed = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_list(F.when(F.col("NOTI_ITEM_CD") == c, F.col("ITEM_VAL_CTNT")))), " | "), F.lit(""))
    return once.groupBy(*ATTACHMENT).agg(*[listed(c).alias(f"{c}_VAL_CTNT") for c in codes], F.sum("n").cast("int").alias("ATCH_IMG_CNT"))


def core_item_view(files: DataFrame, posts: DataFrame, agencies: DataFrame, types: DataFrame, values: DataFrame, images: DataFrame, codes=CORE) -> DataFrame:
    """A row for each attachment that is OK: who, what kind, its core items and how many images."""
    ok = files.where("PROC_STTS_CD = 'OK'").select(*ATTACHMENT, "NOTI_KND_CD")
    # by attachment first, where both sides lie together already; posts last, on what is left
    out = ok.join(attachment_summary(values, images, codes), ATTACHMENT, "left")
    out = out.join(posts.select("NOTI_SN", "INSTT_SN", "CHRG_DEPT_NM", "CHRG_PSN_NM"), "NOTI_SN")
    out = out.join(agencies.select("INSTT_SN", "INSTT_NM"), "INSTT_SN", "left").join(types.select("NOTI_KND_CD", "NOTI_KND_NM"), "NOTI_KND_CD", "left")
    return out.select(*ATTACHMENT, "INSTT_NM", "CHRG_DEPT_NM", "CHRG_PSN_NM", "NOTI_KND_NM", *[f"{c}_VAL_CTNT" for c in codes], F.coalesce("ATCH_IMG_CNT", F.lit(0)).alias("ATCH_IMG_CNT"))


def register(spark, tables: dict[str, DataFrame]) -> None:
    """Temporary views of all tables, the core-item view and the range function, for queries in SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    core_item_view(*[tables[n] for n in ("OS_ATCH_FILE_DTL", "OS_NOTI_BAS", "OS_INSTT_BAS", "OS_NOTI_KND_TC", "OS_NOTI_ITEM_VAL_DTL", "OS_ATCH_IMG_DTL")]).createOrReplaceTempView("OS_ATCH_CORE_ITEM_VW")
    range_function(spark)


def range_function(spark) -> None:
    """FC_OS_ISO_DATERANGE(text): struct(start_dt, end_dt) of "[a,b]", null where either half is no date."""
    half = lambda i: f"try_cast(nullif(regexp_extract(x, r'^\\[(\\d{{4}}-\\d{{2}}-\\d{{2}}),(\\d{{4}}-\\d{{2}}-\\d{{2}})\\]$', {i}), '') AS date)"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION FC_OS_ISO_DATERANGE(x STRING) RETURNS STRUCT<start_dt: DATE, end_dt: DATE> RETURN "
        f"CASE WHEN {half(1)} IS NOT NULL AND {half(2)} IS NOT NULL THEN named_struct('start_dt', {half(1)}, 'end_dt', {half(2)}) END"
    )


def record_pivot(values: DataFrame, codes) -> DataFrame:
    """One row for each disposition of an attachment: the value of each code."""
    return values.where(F.col("NOTI_ITEM_CD").isin(*codes)).groupBy(*ATTACHMENT, "DSPS_SN").agg(*[F.max(F.when(F.col("NOTI_ITEM_CD") == c, F.col("ITEM_VAL_CTNT"))).alias(c) for c in codes])


def disposition_counts(values: DataFrame) -> DataFrame:
    return values.groupBy(*ATTACHMENT).agg(F.countDistinct("DSPS_SN").alias("n_dispositions"))


def attachment_gaps(files: DataFrame) -> DataFrame:
    """Posts whose attachments are not numbered through: as many as the highest number."""
    return files.groupBy("NOTI_SN").agg(F.count(F.lit(1)).alias("n_files"), F.max("ATCH_SN").alias("last_sn")).where("n_files <> last_sn")


def label_ranking(labels: DataFrame, n: int = 20) -> DataFrame:
    """The most frequent labels that no item knows: n_values, n_posts; of equals in the labels' order."""
    return labels.groupBy("ITEM_LBL_NM").agg(F.count(F.lit(1)).alias("n_values"), F.countDistinct("NOTI_SN").alias("n_posts")).orderBy(F.desc("n_values"), "ITEM_LBL_NM").limit(n)


def agency_counts(agencies: DataFrame, posts: DataFrame, files: DataFrame) -> DataFrame:
    """Attachments by agency and board: n_files, n_ok. Files fold to their posts before posts join agencies."""
    per_post = files.groupBy("NOTI_SN").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("PROC_STTS_CD") == "OK").alias("ok"))
    return agencies.join(posts, "INSTT_SN").join(per_post, "NOTI_SN").groupBy("INSTT_SN", "INSTT_NM", "BBS_STTS_CD").agg(F.sum("n").alias("n_files"), F.sum("ok").alias("n_ok"))


def agencies_without_posts(agencies: DataFrame, posts: DataFrame) -> DataFrame:
    return agencies.join(posts.select("INSTT_SN"), "INSTT_SN", "left_anti")


def crawled_without_posts(agencies: DataFrame, crawls: DataFrame, posts: DataFrame) -> DataFrame:
    """Agencies with a crawl that ended well but without a post."""
    good = crawls.where("CRWL_STTS_CD = 'OK'").select("INSTT_SN").distinct()
    return agencies.join(good, "INSTT_SN", "left_semi").join(posts.select("INSTT_SN"), "INSTT_SN", "left_anti")


def crawl_failures(crawls: DataFrame, agencies: DataFrame) -> DataFrame:
    """Crawls that failed, by agency; those without one are a group of their own."""
    return crawls.where("CRWL_STTS_CD = 'FAIL'").groupBy("INSTT_SN").agg(F.count(F.lit(1)).alias("n_failed"), F.max("CRWL_DT").alias("last_dt")).join(agencies, "INSTT_SN", "left")


def reconcile(crawls: DataFrame, posts: DataFrame, agencies: DataFrame) -> DataFrame:
    """Agencies whose crawls counted other than what was loaded: n_crawled, n_loaded."""
    crawled = crawls.where("CRWL_STTS_CD = 'OK' AND INSTT_SN IS NOT NULL").groupBy("INSTT_SN").agg(F.sum("NOTI_CNT").alias("n_crawled"))
    loaded = posts.groupBy("INSTT_SN").agg(F.count(F.lit(1)).alias("n_loaded"))
    both = crawled.join(agencies, "INSTT_SN").join(loaded, "INSTT_SN", "left").withColumn("n_loaded", F.coalesce("n_loaded", F.lit(0)))
    return both.where("n_crawled <> n_loaded")


def not_crawled_on(agencies: DataFrame, crawls: DataFrame, day: str) -> DataFrame:
    return agencies.join(crawls.where(F.col("CRWL_DT") == F.lit(day).cast("date")).select("INSTT_SN"), "INSTT_SN", "left_anti")


def number_mismatches(posts: DataFrame, files: DataFrame) -> DataFrame:
    """Attachments whose own notice number is not their board's; null is a value of its own."""
    a, b = posts.alias("a"), files.alias("b")
    return a.join(b, F.col("a.NOTI_SN") == F.col("b.NOTI_SN")).where(~F.col("a.NOTI_NO").eqNullSafe(F.col("b.NOTI_NO"))).select("b.NOTI_SN", "b.ATCH_SN", F.col("a.NOTI_NO").alias("board_no"), F.col("b.NOTI_NO").alias("body_no"))


def overlapping(values: DataFrame, files: DataFrame, low: str, high: str, code: str = "WORK_PRD") -> DataFrame:
    """Attachments with a period that has a day in [low, high)."""
    period = values.where(F.col("NOTI_ITEM_CD") == code).withColumn("p", T.literal_range("ITEM_VAL_CTNT"))
    hit = period.where(T.overlaps(F.col("p"), F.lit(low).cast("date"), F.lit(high).cast("date")))
    return files.join(hit.select(*ATTACHMENT, "DSPS_SN", "ITEM_VAL_CTNT"), ATTACHMENT)


def paired_values(items: DataFrame, code: str, where_code: str, where_value: str) -> DataFrame:
    """Values of one item in the dispositions in which another has a given value."""
    slot = [*ATTACHMENT, "DSPS_SN"]
    items = sized(items, *slot)
    at = items.where((F.col("NOTI_ITEM_CD") == where_code) & (F.col("ITEM_VAL_CTNT") == where_value)).select(*slot).distinct()
    return items.where(F.col("NOTI_ITEM_CD") == code).join(at, slot, "left_semi")


def failure_breakdown(files: DataFrame) -> DataFrame:
    return files.where("PROC_STTS_CD = 'FAIL'").groupBy("FAIL_STEP_CD", "FAIL_KND_CD").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "FAIL_STEP_CD", "FAIL_KND_CD")


def unmapped_labels(labels: DataFrame, least: int = 1) -> DataFrame:
    """Labels that no item knows: n, n_docs and the first value, of those seen at least so often. labels(doc, pos, label, value)."""
    out = labels.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("doc").alias("n_docs"), F.min_by("value", F.struct("doc", "pos")).alias("example"))
    return out.where(F.col("n") >= least).orderBy(F.desc("n"), "label")


def field_coverage(values: DataFrame, fields: DataFrame, n_records: Column | int) -> DataFrame:
    """fields(item_cd, ..) with n, the records with content there, and percent of n_records as text, halves up."""
    got = values.where("mapped").where(~T.is_blank("value")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0)).cast("long")
    total = F.lit(n_records) if isinstance(n_records, int) else n_records
    percent = F.coalesce(F.round(F.try_divide(n.cast("double") * 100, total), 0), F.lit(0.0)).cast("long")
    return fields.join(got, fields["item_cd"] == got["key"], "left").select(*fields.columns, n.alias("n"), F.concat(percent.cast("string"), F.lit("%")).alias("percent"))


def type_distribution(files: DataFrame, types: DataFrame) -> DataFrame:
    """Attachments by type, the most frequent first, of equals by code."""
    return files.where("NOTI_KND_CD IS NOT NULL").groupBy("NOTI_KND_CD").agg(F.count(F.lit(1)).alias("n")).join(types, "NOTI_KND_CD", "left").orderBy(F.desc("n"), "NOTI_KND_CD")


def unclassified_titles(files: DataFrame) -> DataFrame:
    """Titles without a type, by their normal form: n, an example, and whether there are three or more."""
    out = files.where(F.col("NOTI_KND_CD").isNull() & ~T.is_blank("NOTI_TTL")).groupBy(T.normalise_title("NOTI_TTL").alias("title")).agg(F.count(F.lit(1)).alias("n"), F.min("NOTI_TTL").alias("example"))
    return out.withColumn("repeats", F.col("n") >= 3).orderBy(F.desc("n"), "title")


def classification_split(files: DataFrame) -> DataFrame:
    """One row: n_classified, n_untitled, n_unclassified."""
    known, titled = F.col("NOTI_KND_CD").isNotNull(), ~T.is_blank("NOTI_TTL")
    return files.agg(F.count_if(known).alias("n_classified"), F.count_if(~known & ~titled).alias("n_untitled"), F.count_if(~known & titled).alias("n_unclassified"))
