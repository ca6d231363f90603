"""Surveys of files: what was scanned, what failed and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of failure in the order in which they are listed, and the steps' codes.
FAIL_KINDS = (
    "HWP3_LEGACY NOT_COMPOUND_FILE PASSWORD_PROTECTED DRM_PROTECTED DISTRIBUTION_UNSUPPORTED DISTRIBUTION_TRUNCATED ENCRYPTED NOT_ZIP ZIP_CORRUPT"
    " XML_PARSE DOCUMENT_PARSE PDF_LOAD EMPTY_FILE FILE_ACCESS UNSUPPORTED_EXT OUT_OF_MEMORY IO OTHER"
).split()
STEPS = {"DTCT": "detect", "EXTC": "extract", "SAVE": "save", "LOAD": "load"}
#: Names of errors that a chain of causes is followed to at most.
MAX_CAUSES = 8


def fail_order(kind: Column | str) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in FAIL_KINDS]), F.col(kind) if isinstance(kind, str) else kind)


def step_of(code: Column | str) -> Column:
    """The step that a code names, whatever its case and blanks; null for others."""
    c = F.upper(F.trim(F.col(code) if isinstance(code, str) else code))
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in STEPS.items() for x in kv]), c)


def classify_failure(size: Column, fmt: Column, ext: Column, protection: Column, error: Column, message: Column) -> Column:
    """The kind of a failure, by the first rule that holds.

    size in bytes, fmt as sniffed (null for none), ext as named; protection: PASSWORD, DRM, DISTRIBUTION, TRUNCATED (a
    distribution copy whose end is lost) or null; error: the innermost error's class; message: its text.
    """
    e, m = F.lower(F.coalesce(error, F.lit(""))), F.lower(F.coalesce(message, F.lit("")))
    is_zip, is_xml = e.rlike("zip"), e.rlike("xml|sax|expat|parseerror")
    by_format = (
        F.when(fmt == "hwp", "DOCUMENT_PARSE")
        .when(fmt == "hwp3", "HWP3_LEGACY")
        .when(fmt == "hwpx", F.when(is_zip, "ZIP_CORRUPT").when(is_xml, "XML_PARSE").otherwise("DOCUMENT_PARSE"))
        .when(fmt == "pdf", "PDF_LOAD")
        .when(fmt.isNull() & (ext == "hwp"), "NOT_COMPOUND_FILE")
        .when(fmt.isNull() & (ext == "hwpx"), "NOT_ZIP")
        .when(fmt.isNull() & (ext == "pdf"), "PDF_LOAD")
    )
    by_protection = F.when(protection == "PASSWORD", "PASSWORD_PROTECTED").when(protection == "DRM", "DRM_PROTECTED").when(protection == "TRUNCATED", "DISTRIBUTION_TRUNCATED").when(protection == "DISTRIBUTION", "DISTRIBUTION_UNSUPPORTED")
    by_text = F.when(e.contains("invalidpassword"), "PASSWORD_PROTECTED").when(m.rlike("encrypt|password|암호"), "ENCRYPTED")
    by_error = F.when(is_xml | F.coalesce(message, F.lit("")).contains("XML"), "XML_PARSE").when(is_zip, "ZIP_CORRUPT").when(e.rlike("ioerror|ioexception|oserror|eof"), "IO").otherwise("OTHER")
    early = (
        F.when(e.rlike("outofmemory|memoryerror|stackoverflow|recursionerror"), "OUT_OF_MEMORY")
        .when(e.rlike("nosuchfile|filenotfound|accessdenied|permissionerror"), "FILE_ACCESS")
        .when(size == 0, "EMPTY_FILE")
        .when(e.rlike("valueerror|illegalargument") & m.contains("지원하지 않는 확장자"), "UNSUPPORTED_EXT")
    )
    return F.coalesce(early, by_protection, by_text, by_format, by_error)


def describe_error(error: BaseException | None) -> str:
    """An error and its causes in one line, each text once, cycles and long chains cut."""
    parts, seen = [], set()
    while error is not None and id(error) not in seen and len(seen) < MAX_CAUSES:
        seen.add(id(error))
        text = f"{type(error).__name__}: {error}" if str(error) else type(error).__name__
        if not any(str(error) and str(error) in p for p in parts):
            parts.append(text)
        error = error.__cause__ or error.__context__
    return " <- ".join(parts)


def root_cause(error: BaseException) -> BaseException:
    seen = set()
    while (below := error.__cause__ or error.__context__) is not None and id(below) not in seen and len(seen) < MAX_CAUSES:
        seen.add(id(error))
        error = below
    return error


def survey(found: DataFrame) -> DataFrame:
    """survey(path, ext, status, kind, error) of found(path, ext, text_chars, n_images, kind, error): a file without text but with images is a scan."""
    status = F.when(F.col("error").isNotNull(), "FAILED").when((F.col("text_chars") < 1) & (F.col("n_images") >= 1), "SCANNED").otherwise("NATIVE")
    return found.select("path", "ext", status.alias("status"), F.when(F.col("error").isNotNull(), F.col("kind")).alias("kind"), "error")


def survey_totals(files: DataFrame) -> DataFrame:
    """One row: n, n_scanned, n_native, n_failed and scanned_ratio of those that succeeded, to 3 places; 0 for none."""
    count = lambda s: F.count_if(F.col("status") == s)
    ok = count("SCANNED") + count("NATIVE")
    ratio = F.round(F.coalesce(F.try_divide(count("SCANNED").cast("double"), ok), F.lit(0.0)), 3)
    return files.agg(F.count(F.lit(1)).alias("n"), count("SCANNED").alias("n_scanned"), count("NATIVE").alias("n_native"), count("FAILED").alias("n_failed"), ratio.alias("scanned_ratio"))


def survey_by_ext(files: DataFrame) -> DataFrame:
    count = lambda s: F.count_if(F.col("status") == s)
    return files.groupBy("ext").agg(count("SCANNED").alias("n_scanned"), count("NATIVE").alias("n_native"), count("FAILED").alias("n_failed")).orderBy("ext")


def failure_samples(files: DataFrame, n: int = 3) -> DataFrame:
    """Failures by kind, the most frequent first, of equals in the kinds' order, with the first n paths.

    A group keeps n paths only, before and after the shuffle, so a kind of any size is no burden.
    """
    from pyspark.sql.window import Window

    bad = files.where("status = 'FAILED'")
    counts = bad.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("path"))
    paths = bad.withColumn("nth", nth).where(F.col("nth") <= n).groupBy("kind").agg(F.array_sort(F.collect_list("path")).alias("samples"))
    return counts.join(paths, "kind").orderBy(F.desc("n"), fail_order("kind"), "kind")


def scanned_files(files: DataFrame) -> DataFrame:
    return files.where("status = 'SCANNED'")


def failed_files(files: DataFrame) -> DataFrame:
    return files.where("status = 'FAILED'")
