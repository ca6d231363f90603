"""The warehouse: its tables, what they accept, and loads that can run again.

Tables are DataFrames by name; a load takes the old ones and what came in and gives the new ones, so that a writer can
stage all of them and swap. Nothing here depends on the order in which rows happen to lie: what is later says so.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import text as T
from tidemark.operators.store import Store
from tidemark.plans.dictionaries import item_dim, type_dim
from tidemark.plans.staging import sorted_side, staged, task_count

# The domains' limits and the tables' columns (name, domain, whether it may be null), keys first.
TEXT_LIMITS = {"NO": 50, "CD": 25, "NM": 300, "TTL": 500, "PATH": 1000, "DSCR": 1000, "SE": 4, "ID": 20, "URL": 2000}
SQL_TYPES = {"SN": "INT", "CNT": "INT", "SEQ": "INT", "DT": "DATE", "DTM": "TIMESTAMP", "AMT": "DECIMAL(18,3)", "RT": "DECIMAL(7,4)", "QTY": "DECIMAL(38,18)"}
AUDIT = "FRST_REG_DTM:DTM! LAST_CHG_DTM:DTM!"
TABLES = {
    "OS_INSTT_BAS": ("INSTT_SN", f"INSTT_SN:SN! INSTT_NM:NM! INSTT_KND_CD:CD! {AUDIT}"),
    "OS_NOTI_BAS": ("NOTI_SN", f"NOTI_SN:SN! INSTT_SN:SN BBS_STTS_CD:CD SRC_KEY_CTNT:CTNT SRC_KEY_HASH:HASH BBS_URL:URL BBS_TTL:TTL CRWL_KND_CD:CD CHRG_DEPT_NM:NM CHRG_PSN_NM:NM TEL_NO:NO NOTI_NO:NO NOTI_DT:DT {AUDIT}"),
    "OS_CRWL_LOG_DTL": ("CRWL_LOG_SN", "CRWL_LOG_SN:SN! INSTT_SN:SN CRWL_DT:DT! CRWL_KND_CD:CD CRWL_STTS_CD:CD! INSTT_BBS_URL:URL NOTI_CNT:CNT ATCH_FILE_CNT:CNT FAIL_MSG_CTNT:CTNT"),
    "OS_NOTI_KND_TC": ("NOTI_KND_CD", f"NOTI_KND_CD:CD! NOTI_KND_NM:NM! HRNK_NOTI_KND_NM:NM! {AUDIT}"),
    "OS_NOTI_ITEM_TC": ("NOTI_ITEM_CD", f"NOTI_ITEM_CD:CD! NOTI_ITEM_NM:NM! ITEM_SRS_NM:NM ITEM_VAL_TY_CD:CD! CORE_ITEM_YN:YN! {AUDIT}"),
    "OS_ATCH_FILE_DTL": ("NOTI_SN ATCH_SN", f"NOTI_SN:SN! ATCH_SN:SN! ATCH_FILE_NM:NM! ATCH_FILE_PATH:PATH PROC_STTS_CD:CD! FAIL_STEP_CD:CD FAIL_KND_CD:CD FAIL_MSG_CTNT:CTNT EXCL_RSN_CTNT:CTNT FILE_EXTN_NM:NM ACTL_FILE_EXTN_NM:NM SCAN_YN:YN! EXTC_ENGN_NM:NM NOTI_KND_CD:CD NOTI_NO:NO NOTI_DT:DT NOTI_TTL:TTL {AUDIT}"),
    "OS_ATCH_IMG_DTL": ("NOTI_SN ATCH_SN IMG_SN", f"NOTI_SN:SN! ATCH_SN:SN! IMG_SN:SN! IMG_CPTN_CTNT:CTNT! IMG_FILE_PATH:PATH! {AUDIT}"),
    "OS_NOTI_ITEM_VAL_DTL": ("NOTI_SN ATCH_SN DSPS_SN NOTI_ITEM_CD RPT_SN", f"NOTI_SN:SN! ATCH_SN:SN! DSPS_SN:SN! NOTI_ITEM_CD:CD! RPT_SN:SN! ITEM_VAL_CTNT:CTNT! {AUDIT}"),
    "OS_NOTI_LBL_VAL_DTL": ("NOTI_SN ATCH_SN DSPS_SN ITEM_LBL_NM", f"NOTI_SN:SN! ATCH_SN:SN! DSPS_SN:SN! ITEM_LBL_NM:NM! ITEM_VAL_CTNT:CTNT! {AUDIT}"),
}
ATTACHMENT = ["NOTI_SN", "ATCH_SN"]
CHILDREN = ("OS_ATCH_IMG_DTL", "OS_NOTI_ITEM_VAL_DTL", "OS_NOTI_LBL_VAL_DTL")
#: Tables that grow with what is loaded; the others are dimensions, which Spark may broadcast.
GROWING = ("OS_NOTI_BAS", "OS_ATCH_FILE_DTL", *CHILDREN)
#: child table, parent table, columns on both sides, whether the child goes with the parent.
REFERENCES = (
    ("OS_NOTI_BAS", "OS_INSTT_BAS", ["INSTT_SN"], False), ("OS_CRWL_LOG_DTL", "OS_INSTT_BAS", ["INSTT_SN"], False), ("OS_ATCH_FILE_DTL", "OS_NOTI_BAS", ["NOTI_SN"], True), ("OS_ATCH_FILE_DTL", "OS_NOTI_KND_TC", ["NOTI_KND_CD"], False),
    ("OS_ATCH_IMG_DTL", "OS_ATCH_FILE_DTL", ATTACHMENT, True), ("OS_NOTI_ITEM_VAL_DTL", "OS_ATCH_FILE_DTL", ATTACHMENT, True), ("OS_NOTI_ITEM_VAL_DTL", "OS_NOTI_ITEM_TC", ["NOTI_ITEM_CD"], False), ("OS_NOTI_LBL_VAL_DTL", "OS_ATCH_FILE_DTL", ATTACHMENT, True),
)


def columns(table: str) -> list[tuple[str, str, bool]]:
    """(name, domain, nullable) of a table's columns."""
    return [(n, d.rstrip("!"), not d.endswith("!")) for n, d in (c.split(":") for c in TABLES[table][1].split())]


def keys(table: str) -> list[str]:
    return TABLES[table][0].split()


def schema(table: str) -> str:
    return ", ".join(f"{n} {SQL_TYPES.get(d, 'STRING')}" for n, d, _ in columns(table))


def create_tables(spark: SparkSession, database: str, fmt: str = "parquet") -> None:
    """Makes the tables that a database lacks."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in TABLES:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({schema(table)}) USING {fmt}")


def violations(df: DataFrame, spec: list[tuple[str, str, bool]]) -> Column:
    """An array of what a row breaks: nulls where none may be, texts too long, flags and hashes of another form."""
    found = []
    for name, domain, nullable in spec:
        c = F.col(name)
        if not nullable:
            found.append(F.when(c.isNull(), F.lit(f"{name} is null")))
        if domain in TEXT_LIMITS:
            found.append(F.when(T.utf16_length(c) > TEXT_LIMITS[domain], F.lit(f"{name} is longer than {TEXT_LIMITS[domain]}")))
        if domain == "YN":
            found.append(F.when(~c.isin("Y", "N"), F.lit(f"{name} is neither Y nor N")))
        if domain == "HASH":
            found.append(F.when(~c.rlike("^[0-9a-f]{64}$"), F.lit(f"{name} is no hash")))
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def validated(df: DataFrame, table: str) -> DataFrame:
    """df with violations, an array, for the columns of table that it has."""
    return df.withColumn("violations", violations(df, [c for c in columns(table) if c[0] in df.columns]))


def repeated_keys(df: DataFrame, by: list[str]) -> DataFrame:
    """The rows whose key others have too, with n_same."""
    return df.withColumn("n_same", F.count(F.lit(1)).over(Window.partitionBy(*by))).where("n_same > 1")


def orphans(child: DataFrame, parent: DataFrame, by: list[str]) -> DataFrame:
    """Rows of child that name a parent which is not there; nulls name none."""
    named = child.dropna(subset=by)
    return named.join(parent.select(*by).distinct(), by, "left_anti")


def upsert(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """old with the rows of new in place of those with their keys; new has each key once."""
    return old.join(new.select(*by), by, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert_merge(old: DataFrame, new: DataFrame, by: list[str]) -> DataFrame:
    """old with what new says; what new leaves null stays as it was."""
    rest = [c for c in old.columns if c not in by]
    a, b = old.alias("a"), new.alias("b")
    same = None
    for k in by:
        same = (F.col(f"a.{k}") == F.col(f"b.{k}")) if same is None else same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    merged = [F.coalesce(F.col(f"b.{c}"), F.col(f"a.{c}")).alias(c) if c in new.columns else F.col(f"a.{c}").alias(c) for c in by + rest]
    return a.join(b, same, "full").select(*merged).select(*old.columns)


def fold_batch(new: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row for each key of a batch: each column's last value that is not null, by order."""
    rest = [c for c in new.columns if c not in [*by, order]]
    return new.groupBy(*by).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in rest])


def last_by(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order, columns of order left out."""
    rest = [c for c in df.columns if c not in by and c not in order]
    return df.groupBy(*by).agg(F.max(F.struct(*order, *rest)).alias("r")).select(*by, *[f"r.{c}" for c in rest])


def delete_cascade(tables: dict[str, DataFrame], table: str, gone: DataFrame) -> dict[str, DataFrame]:
    """The tables without the rows of table whose key gone has, nor those that go with them."""
    out, todo = dict(tables), [(table, gone.select(*keys(table)).distinct())]
    while todo:
        name, lost = todo.pop()
        rows = out[name]
        dead = rows.join(lost, lost.columns, "left_semi")
        for child, parent, by, follows in REFERENCES:
            if parent == name and follows and child in out:
                lost_children = out[child].join(dead.select(*by).distinct(), by, "left_semi")
                todo.append((child, lost_children.select(*keys(child))))
        out[name] = rows.join(lost, lost.columns, "left_anti")
    return out


def replace_attachments(tables: dict[str, DataFrame], came: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with attachments replaced, each with all its children; those of the same post that did not come stay."""
    names = ("OS_ATCH_FILE_DTL", *CHILDREN)
    n = task_count(*(tables[x] for x in names), *(came[x] for x in names if x in came))
    dealt = lambda df: df.repartition(n, *ATTACHMENT)  # noqa: E731  all alike, so that they meet without another shuffle
    slots = dealt(came["OS_ATCH_FILE_DTL"].select(*ATTACHMENT)).distinct()
    out = dict(tables)
    for name in names:
        kept = dealt(tables[name]).join(slots, ATTACHMENT, "left_anti")
        out[name] = kept.unionByName(dealt(came[name]), allowMissingColumns=True) if name in came else kept
    return out


def file_rows(results: DataFrame) -> DataFrame:
    """Attachment rows of results(NOTI_SN, ATCH_SN, ATCH_FILE_NM, .., EXCL_RSN_CTNT, NOTI_DT as text): SKIP where excluded, else OK; dates that the calendar lacks are null."""
    return results.withColumn("PROC_STTS_CD", F.when(F.col("EXCL_RSN_CTNT").isNull(), "OK").otherwise("SKIP")).withColumn("NOTI_DT", F.col("NOTI_DT").try_cast("date"))


def failure_rows(failures: DataFrame, boards: DataFrame | None = None) -> DataFrame:
    """Attachment rows of failures(NOTI_SN, ATCH_SN, file_name, file_path, stage, kind, message): FAIL, never scanned, no values."""
    step = {"detect": "DTCT", "extract": "EXTC", "save": "SAVE", "load": "LOAD"}
    code = F.create_map(*[F.lit(x) for kv in step.items() for x in kv])
    out = failures.select(*ATTACHMENT, F.col("file_name").alias("ATCH_FILE_NM"), F.col("file_path").alias("ATCH_FILE_PATH"), F.lit("FAIL").alias("PROC_STTS_CD"), F.try_element_at(code, F.lower("stage")).alias("FAIL_STEP_CD"), F.col("kind").alias("FAIL_KND_CD"), F.nullif("message", F.lit("null")).alias("FAIL_MSG_CTNT"), F.lit("N").alias("SCAN_YN"))
    return out if boards is None else out.join(boards, "ATCH_FILE_PATH", "left")


def union_with_failures(files: DataFrame, failures: DataFrame) -> DataFrame:
    """Both as attachment rows, one for each key: failures are written last and so replace a success."""
    both = files.withColumn("load_order", F.lit(0)).unionByName(failures.withColumn("load_order", F.lit(1)), allowMissingColumns=True)
    return last_by(both, ATTACHMENT, ["load_order"])


def image_rows(images: DataFrame) -> DataFrame:
    """images(NOTI_SN, ATCH_SN, pos, name, path) -> rows numbered from 1, those without a path left out first."""
    nth = F.row_number().over(Window.partitionBy(*ATTACHMENT).orderBy("pos"))
    return images.where("path IS NOT NULL").select(*ATTACHMENT, nth.alias("IMG_SN"), F.col("name").alias("IMG_CPTN_CTNT"), F.col("path").alias("IMG_FILE_PATH"))


def route_violations(files: DataFrame, values: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, values) where attachments with a row that breaks a rule have become failures of the load, without values."""
    bad_files = validated(files, "OS_ATCH_FILE_DTL").where("size(violations) > 0").select(*ATTACHMENT, F.array_join("violations", "; ").alias("why"))
    bad_values = validated(values, "OS_NOTI_ITEM_VAL_DTL").where("size(violations) > 0").groupBy(*ATTACHMENT).agg(F.min(F.array_join("violations", "; ")).alias("why"))
    bad = bad_files.unionByName(bad_values).groupBy(*ATTACHMENT).agg(F.min("why").alias("why"))
    joined = files.join(bad, ATTACHMENT, "left")
    is_bad = F.col("why").isNotNull()
    change = {"PROC_STTS_CD": F.lit("FAIL"), "FAIL_STEP_CD": F.lit("LOAD"), "FAIL_KND_CD": F.lit(None), "FAIL_MSG_CTNT": F.col("why"), "SCAN_YN": F.lit("N")}
    limit = {n: TEXT_LIMITS[d] for n, d, _ in columns("OS_ATCH_FILE_DTL") if d in TEXT_LIMITS}
    cols = []
    for c in files.columns:
        new = change.get(c, F.left(F.col(c), F.lit(limit[c])) if c in limit else F.col(c))
        cols.append(F.when(is_bad, new).otherwise(F.col(c)).alias(c))
    for c in change:
        if c not in files.columns:
            cols.append(F.when(is_bad, change[c]).cast("string").alias(c))
    return joined.select(*cols), values.join(bad.select(*ATTACHMENT), ATTACHMENT, "left_anti")


def known_items(items: DataFrame, labels: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, labels) where items of codes that the dictionary lacks (of codes(NOTI_ITEM_CD)) have become labels of that name.

    A label that the attachment's disposition has already stays as it is.
    """
    odd = items.join(codes.select("NOTI_ITEM_CD"), "NOTI_ITEM_CD", "left_anti")
    slot = [*ATTACHMENT, "DSPS_SN", "ITEM_LBL_NM"]
    moved = odd.groupBy(*ATTACHMENT, "DSPS_SN", F.col("NOTI_ITEM_CD").alias("ITEM_LBL_NM")).agg(F.min_by("ITEM_VAL_CTNT", "RPT_SN").alias("ITEM_VAL_CTNT"))
    fresh = moved.join(sorted_side(labels.select(*slot)), slot, "left_anti")
    return items.join(codes.select("NOTI_ITEM_CD"), "NOTI_ITEM_CD", "left_semi"), labels.unionByName(fresh, allowMissingColumns=True)


#: By what the rows of each table are replaced: an attachment's by the attachment, with all its children.
REPLACED_BY = {t: ATTACHMENT if t in (*CHILDREN, "OS_ATCH_FILE_DTL") else keys(t) for t in TABLES}


def open_store(spark: SparkSession, root: str, buckets: int = 64) -> Store:
    return Store(spark, root, REPLACED_BY, buckets)


def _side(df: DataFrame, table: str) -> DataFrame:
    """df, keys of table's rows, as a side of a join."""
    return sorted_side(df) if table in GROWING else df


def stamped(df: DataFrame, table: str) -> DataFrame:
    """df with all of table's columns in order, typed, and the time."""
    now = F.current_timestamp()
    spec = columns(table)
    cols = {n: (F.col(n) if n in df.columns else F.lit(None)).cast(SQL_TYPES.get(d, "STRING")) for n, d, _ in spec}
    cols |= {c: now for c in ("FRST_REG_DTM", "LAST_CHG_DTM") if c in cols}
    return df.select(*[v.alias(n) for n, v in cols.items()])


def merged(old: DataFrame | None, new: DataFrame, table: str) -> DataFrame:
    """The rows of new by key, with what they leave null, and the time of the first registration, as old has it."""
    rows = stamped(new, table)
    if old is None:
        return rows
    rest = [c for c in rows.columns if c not in keys(table)]
    was = _side(old.select(*keys(table), *[F.col(c).alias(f"_{c}") for c in rest]), table)
    # the time of the first registration is the old row's, all else what is new
    pick = lambda c: F.coalesce(*((f"_{c}", c) if c == "FRST_REG_DTM" else (c, f"_{c}"))).alias(c)
    return rows.join(was, keys(table), "left").select(*keys(table), *map(pick, rest)).select(*rows.columns)


def load(store: Store, came: dict[str, DataFrame], posts: DataFrame | None = None, agencies: DataFrame | None = None) -> int:
    """Loads came (rows by table, as jobs.load_rows gives them) as one version; its number.

    Attachments that came replace theirs with all children, other attachments of their posts stay; posts that are not known get
    a row; posts(NOTI_SN, ..) and agencies(INSTT_SN, ..) are merged, nulls leaving what was. Types and items come from the
    dictionaries. A key that comes twice, or a type, post or agency that is named but is not there, ends the load before anything is
    changed.
    """
    spark, old = store.spark, store.tables()
    files = staged(came["OS_ATCH_FILE_DTL"], "files")
    given = posts if posts is not None else spark.createDataFrame([], schema("OS_NOTI_BAS"))
    named = files.select("NOTI_SN").distinct().join(sorted_side(given.select("NOTI_SN")), "NOTI_SN", "left_anti")
    unknown = named if "OS_NOTI_BAS" not in old else named.join(sorted_side(old["OS_NOTI_BAS"].select("NOTI_SN")), "NOTI_SN", "left_anti")
    changes = {
        "OS_NOTI_KND_TC": merged(old.get("OS_NOTI_KND_TC"), type_dim(spark).select(F.col("type_cd").alias("NOTI_KND_CD"), F.col("type_nm").alias("NOTI_KND_NM"), F.col("family").alias("HRNK_NOTI_KND_NM")), "OS_NOTI_KND_TC"),
        "OS_NOTI_ITEM_TC": merged(old.get("OS_NOTI_ITEM_TC"), item_dim(spark).select(F.col("item_cd").alias("NOTI_ITEM_CD"), F.col("item_nm").alias("NOTI_ITEM_NM"), F.col("series").alias("ITEM_SRS_NM"), F.col("value_type").alias("ITEM_VAL_TY_CD"), F.col("core_yn").alias("CORE_ITEM_YN")), "OS_NOTI_ITEM_TC"),
        "OS_NOTI_BAS": merged(old.get("OS_NOTI_BAS"), given.unionByName(unknown, allowMissingColumns=True), "OS_NOTI_BAS"),
    }
    if agencies is not None:
        changes["OS_INSTT_BAS"] = merged(old.get("OS_INSTT_BAS"), agencies, "OS_INSTT_BAS")
    items, labels = known_items(came["OS_NOTI_ITEM_VAL_DTL"], came["OS_NOTI_LBL_VAL_DTL"], changes["OS_NOTI_ITEM_TC"])
    rows = {"OS_ATCH_FILE_DTL": files, "OS_ATCH_IMG_DTL": came["OS_ATCH_IMG_DTL"], "OS_NOTI_ITEM_VAL_DTL": items, "OS_NOTI_LBL_VAL_DTL": labels}
    changes = {n: staged(df, n) for n, df in (changes | {n: stamped(df, n) for n, df in rows.items()}).items()}
    for name, df in changes.items():
        if not repeated_keys(df.select(*keys(name)), keys(name)).isEmpty():
            raise ValueError(f"{name} has a key twice")
    for child, parent, by, _ in REFERENCES:
        if child in changes:
            there = [x.select(*by) for x in (old.get(parent), changes.get(parent)) if x is not None]
            lost = changes[child] if not there else orphans(changes[child], _side(there[0] if len(there) == 1 else there[0].union(there[1]), parent), by)
            if not lost.dropna(subset=by).isEmpty():
                raise ValueError(f"{child} names a row of {parent} that is not there")
    slots = files.select(*ATTACHMENT)
    return store.commit({n: (df, slots if n in CHILDREN else None) for n, df in changes.items()})


def load_stats(files: DataFrame, values: DataFrame) -> DataFrame:
    """One row: n_ok (without the skipped), n_failed, n_skipped, n_values."""
    rows = files.select(F.col("PROC_STTS_CD").alias("what")).unionByName(values.select(F.lit("VALUE").alias("what")))
    names = {"OK": "n_ok", "FAIL": "n_failed", "SKIP": "n_skipped", "VALUE": "n_values"}
    return rows.agg(*[F.count_if(F.col("what") == k).alias(v) for k, v in names.items()])


def first_agencies(files: DataFrame) -> DataFrame:
    """Agencies that files name, once each by number: the first file's word counts. files(load_order, INSTT_SN, INSTT_NM, INSTT_KND_CD)."""
    return files.where("INSTT_SN IS NOT NULL").groupBy("INSTT_SN").agg(F.min_by("INSTT_NM", "load_order").alias("INSTT_NM"), F.min_by("INSTT_KND_CD", "load_order").alias("INSTT_KND_CD"))
