"""Keys that names carry: of posts and attachments in file names, of agencies in folder names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T

# Marks in folder names, and codes.
FOLDER = r"^(\d{1,4})(?:_(\d{1,3}))?_(.+)$"
CLOSED, OPEN = r"(?:지난|이전|완료|종료|만료)", r"^(?:게시중|게시|고시공고|공고|고시|자료)"
GAZETTE = "전자관보"
GAZETTE_REMARK = r'"([^"]+?)고시"'
LOCAL_ENDS = r"(?:시청|군청|구청|도청|시|군|구|도)$"
MARITIME_END = "지방해양수산청"


def folder_parts(name: Column | str) -> Column:
    """struct(folder_no, sub_no, agency, kind, board) of {no}[_{sub}]_{name..}[_{board}]; null for other names or without an agency."""
    text = T.trim_control(F.col(name) if isinstance(name, str) else name)
    raw = F.split(F.regexp_extract(text, FOLDER, 3), "_", -1)
    # empty parts at the end do not count
    used = F.slice(raw, F.lit(1), F.greatest(F.lit(0), F.array_max(F.transform(raw, lambda x, i: F.when(x != "", i + 1).otherwise(0)))))
    last = T.trim_control(F.get(used, F.size(used) - 1))
    marked = (F.size(used) > 1) & (last.rlike(CLOSED) | last.rlike(OPEN))
    board = F.when((F.size(used) > 1) & last.rlike(CLOSED), "CLSD").otherwise("POST")
    body = F.slice(used, F.lit(1), F.size(used) - F.when(marked, 1).otherwise(0))
    gazette = (T.trim_control(F.get(body, F.lit(0))) == GAZETTE) & (F.size(body) > 1)
    words = F.filter(F.transform(F.when(gazette, F.slice(body, F.lit(2), F.size(body))).otherwise(body), lambda x: T.trim_control(x)), lambda x: x != "")
    agency = F.array_join(words, " ")
    kind = F.when(gazette, "GZT").when(agency.endswith(MARITIME_END), "MOF").when(agency.rlike(LOCAL_ENDS), "LOCL").otherwise("CNTL")
    sub = F.coalesce(F.regexp_extract(text, FOLDER, 2).try_cast("int"), F.lit(0))
    made = F.struct(F.regexp_extract(text, FOLDER, 1).try_cast("int").alias("folder_no"), sub.alias("sub_no"), agency.alias("agency"), kind.alias("kind"), board.alias("board"))
    return F.when(text.rlike(FOLDER) & (agency != ""), made)


def gazette_agency(remark: Column | str) -> Column:
    return F.nullif(T.trim_control(F.regexp_extract(F.col(remark) if isinstance(remark, str) else remark, GAZETTE_REMARK, 1)), F.lit(""))


def is_gazette(agency: Column | str) -> Column:
    return F.coalesce(T.trim_control(F.col(agency) if isinstance(agency, str) else agency) == GAZETTE, F.lit(False))


def post_agency(agency: Column | str, remark: Column | str) -> Column:
    """The agency of a crawled post; the gazette's posts name theirs in a remark."""
    found = gazette_agency(remark)
    return F.when(is_gazette(agency) & found.isNotNull(), F.concat(F.lit(GAZETTE + "_"), found)).otherwise(F.col(agency) if isinstance(agency, str) else agency)


def file_key(name: Column | str) -> Column:
    """struct(noti_sn, atch_sn, crawled) of {post}_{attachment}_{title} or {post}_{title}.

    Other names get a negative key out of their text, the same at every run; collisions show as repeated keys.
    """
    name = F.col(name) if isinstance(name, str) else name
    stem = F.when(name.rlike(r"(?s)^.+\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    many, one = r"^(\d{1,9})_(\d{1,2})_(.+)$", r"^(\d{1,9})_(.+)$"
    as_int = lambda p, i: F.regexp_extract(stem, p, i).try_cast("int")
    fallback = (-(F.abs(F.xxhash64(name)) % 2_000_000_000) - 1).cast("int")
    return (
        F.when(stem.rlike(many), F.struct(as_int(many, 1).alias("noti_sn"), as_int(many, 2).alias("atch_sn"), F.lit(True).alias("crawled")))
        .when(stem.rlike(one), F.struct(as_int(one, 1).alias("noti_sn"), F.lit(1).alias("atch_sn"), F.lit(True).alias("crawled")))
        .otherwise(F.struct(fallback.alias("noti_sn"), F.lit(1).alias("atch_sn"), F.lit(False).alias("crawled")))
    )


def attachment_key(stored_sn: Column, stored_atch: Column, name: Column) -> Column:
    """The stored key, or where it is 0 or missing that of the name."""
    return F.when(F.coalesce(stored_sn, F.lit(0)) == 0, file_key(name)).otherwise(F.struct(stored_sn.cast("int").alias("noti_sn"), stored_atch.cast("int").alias("atch_sn"), F.lit(True).alias("crawled")))


def renumber_agencies(folders: DataFrame) -> DataFrame:
    """boards(folder_no, sub_no, agency, kind, board) with agency_no: the folder's number, where only one agency has it.

    Agencies that share a number all get new ones, from the highest on, in the order of number, sub-number and name.
    The numbering runs over agencies, not over files: a few rows.
    """
    who = folders.groupBy("folder_no", "agency").agg(F.min("sub_no").alias("sub"))
    shared = who.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("folder_no")))
    top = folders.agg(F.max("folder_no").alias("top")).withColumn("one", F.lit(1))
    moved = shared.where("n > 1").withColumn("one", F.lit(1)).join(top, "one").withColumn("agency_no", F.col("top") + F.row_number().over(Window.partitionBy("one").orderBy("folder_no", "sub", "agency")))
    numbers = shared.where("n = 1").select("folder_no", "agency", F.col("folder_no").alias("agency_no")).unionByName(moved.select("folder_no", "agency", "agency_no"))
    return folders.join(numbers, ["folder_no", "agency"])


def file_boards(files: DataFrame, boards: DataFrame, path: str = "rel_path") -> DataFrame:
    """files with their board's columns, by the first part of the path under the root; without one they are null."""
    return files.withColumn("folder", F.get(F.split(path, "/"), F.lit(0))).join(boards, "folder", "left")


def duplicate_keys(files: DataFrame) -> DataFrame:
    """files(path, noti_sn, atch_sn) whose key an earlier path has: with first_path, the one before by order of paths."""
    by = Window.partitionBy("noti_sn", "atch_sn").orderBy("path")
    return files.withColumn("first_path", F.first("path").over(by)).withColumn("nth", F.row_number().over(by)).where("nth > 1").drop("nth")
