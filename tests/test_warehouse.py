"""Loads that run again, incremental loads, failure kinds, dictionaries."""

import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keys, survey, views, warehouse
from tidemark.plans import dictionaries
from tidemark.plans.dictionaries import NoticeType
from tidemark.streaming import ingest


def test_dictionaries(spark):
    dictionaries.checked(spark)
    assert len(dictionaries.items()) == 45 and len(dictionaries.types()) == 56
    with pytest.raises(ValueError, match="belongs"):
        dictionaries.check_items([("A", ("x",), ""), ("B", ("x",), "")])
    with pytest.raises(ValueError, match="no synonyms"):
        dictionaries.check_items([("A", (), "")])
    with pytest.raises(ValueError, match="priority"):
        dictionaries.check_types([NoticeType("A", "a", "f", 1, (("x",),)), NoticeType("B", "b", "f", 1, (("y",),))])


def test_a_load_twice_is_a_load_once(spark):
    files = spark.createDataFrame([(1, 1, "old"), (1, 2, "sibling")], "NOTI_SN int, ATCH_SN int, v string")
    child = files.select("NOTI_SN", "ATCH_SN", F.lit(1).alias("x"))
    old = {"OS_ATCH_FILE_DTL": files} | {n: child for n in warehouse.CHILDREN}
    new = spark.createDataFrame([(1, 1, "new")], "NOTI_SN int, ATCH_SN int, v string")
    came = {"OS_ATCH_FILE_DTL": new, "OS_ATCH_IMG_DTL": new.select("NOTI_SN", "ATCH_SN", F.lit(2).alias("x"))}
    once = warehouse.replace_attachments(old, came)
    twice = warehouse.replace_attachments(once, came)
    rows = lambda t: {n: sorted(map(tuple, df.collect())) for n, df in t.items()}
    assert rows(once) == rows(twice)
    assert rows(once)["OS_ATCH_FILE_DTL"] == [(1, 1, "new"), (1, 2, "sibling")] and rows(once)["OS_ATCH_IMG_DTL"] == [(1, 1, 2), (1, 2, 1)] and rows(once)["OS_NOTI_ITEM_VAL_DTL"] == [(1, 2, 1)]


def test_merge_keeps_what_was_there(spark):
    batch = spark.createDataFrame([(1, "a", None, 1), (1, None, "b", 2), (2, "c", None, 1)], "k int, x string, y string, o int")
    assert sorted(map(tuple, warehouse.fold_batch(batch, ["k"], "o").collect())) == [(1, "a", "b"), (2, "c", None)]


def test_violations_become_failures(spark):
    files = spark.createDataFrame([(1, 1, "a.hwp", "OK", "N", "x" * 51), (2, 1, "b.hwp", "OK", "N", "제1호")], "NOTI_SN int, ATCH_SN int, ATCH_FILE_NM string, PROC_STTS_CD string, SCAN_YN string, NOTI_NO string")
    values = spark.createDataFrame([(1, 1, 1, "LOC", 1, "v"), (2, 1, 1, "LOC", 1, "v")], "NOTI_SN int, ATCH_SN int, DSPS_SN int, NOTI_ITEM_CD string, RPT_SN int, ITEM_VAL_CTNT string")
    good, kept = warehouse.route_violations(files, values)
    rows = {r.NOTI_SN: r for r in good.collect()}
    assert (rows[1].PROC_STTS_CD, rows[1].FAIL_STEP_CD) == ("FAIL", "LOAD") and "NOTI_NO" in rows[1].FAIL_MSG_CTNT and rows[2].PROC_STTS_CD == "OK"
    assert [r.NOTI_SN for r in kept.collect()] == [2]


def test_failure_kinds(spark):
    cases = [
        (0, "hwp", "hwp", None, "OSError", "x", "EMPTY_FILE"), (9, "hwp", "hwp", "DRM", "OSError", "x", "DRM_PROTECTED"), (9, "hwp", "hwp", "TRUNCATED", "OSError", "x", "DISTRIBUTION_TRUNCATED"), (9, "pdf", "pdf", None, "ValueError", "password needed", "ENCRYPTED"),
        (9, "hwp", "hwp", None, "ValueError", "x", "DOCUMENT_PARSE"), (9, "hwp3", "hwp", None, "Damaged", "x", "HWP3_LEGACY"), (9, "hwpx", "hwpx", None, "BadZipFile", "x", "ZIP_CORRUPT"), (9, "hwpx", "hwpx", None, "ParseError", "x", "XML_PARSE"), (9, None, "hwp", None, "ValueError", "x", "NOT_COMPOUND_FILE"),
        (9, None, "hwpx", None, "ValueError", "x", "NOT_ZIP"), (9, "pdf", "hwp", None, "ValueError", "x", "PDF_LOAD"), (9, "hml", "hml", None, "ParseError", "x", "XML_PARSE"), (9, None, "doc", None, "ValueError", "지원하지 않는 확장자: doc", "UNSUPPORTED_EXT"), (9, "hml", "hml", None, "MemoryError", "x", "OUT_OF_MEMORY"), (9, "hml", "hml", None, "KeyError", "x", "OTHER"), (9, "hml", "hml", None, "PermissionError", "x", "FILE_ACCESS"),
    ]
    df = spark.createDataFrame(cases, "size int, fmt string, ext string, p string, e string, m string, want string")
    got = df.select("want", survey.classify_failure(*[F.col(c) for c in ("size", "fmt", "ext", "p", "e", "m")]).alias("got"))
    assert [tuple(r) for r in got.where("want <> got OR got IS NULL").collect()] == []


def test_error_text():
    try:
        try:
            raise OSError("deep")
        except OSError as e:
            raise ValueError("outer") from e
    except ValueError as e:
        assert survey.describe_error(e) == "ValueError: outer <- OSError: deep" and isinstance(survey.root_cause(e), OSError)


def test_sql_over_the_warehouse(spark):
    views.range_function(spark)
    got = spark.sql("SELECT FC_OS_ISO_DATERANGE('[2024-01-01,2024-02-01]') AS a, FC_OS_ISO_DATERANGE('[2024-02-30,2024-03-01]') AS b, FC_OS_ISO_DATERANGE('x') AS c").first()
    assert str(got.a.start_dt) == "2024-01-01" and got.b is None and got.c is None


def test_file_keys(spark):
    names = ["12_3_제목.hwp", "12_제목.hwp", "12_20240101_제목.hwp", "제목.hwp", "12.hwp", "1234567890_x.hwp"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", keys.file_key("n").alias("k")).select("n", "k.*")
    got = {r.n: (r.noti_sn, r.atch_sn, r.crawled) for r in df.collect()}
    assert got[names[0]] == (12, 3, True) and got[names[1]] == (12, 1, True) and got[names[2]] == (12, 1, True)
    assert all(got[n][0] < 0 and not got[n][2] for n in names[3:])


def test_incremental_load(spark, tmp_path):
    folder, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")
    folder.mkdir()
    load = ingest.replace_by_key(table, ["path"])

    def run():
        stream = ingest.new_files(spark, str(folder)).select("path", "length")
        q = ingest.available_now(stream, load, state)
        q.awaitTermination(120)

    (folder / "a").write_bytes(b"1")
    run()
    time.sleep(1)
    (folder / "b").write_bytes(b"22")
    run()
    run()
    assert sorted(r.length for r in ingest.current(spark, table).collect()) == [1, 2]
    batch = spark.createDataFrame([("file:/x", 5)], "path string, length long")
    load(batch, 7)
    load(batch, 7)
    assert ingest.current(spark, table).where("path = 'file:/x'").count() == 1


def test_failures_report_has_a_row_for_each_failure(spark):
    from tidemark.operators import sinks

    bad = spark.range(5000).selectExpr("concat('f', id) AS file_name", "'extract' AS stage", "'OTHER' AS kind", "'m' AS message")
    got = sinks.failures_report(bad, 7000)
    assert [tuple(r) for r in got.where("file_name IS NULL").collect()] == [(7000, 5000, None, None, None, None)]
    assert got.where("file_name IS NOT NULL AND total IS NULL AND failed IS NULL").select("file_name").distinct().count() == 5000
    assert [tuple(r)[:2] for r in sinks.failures_report(bad.limit(0), 3).collect()] == [(3, 0)]
