"""Raw documents to records and warehouse rows, all cases in one plan."""

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.operators import warehouse
from tidemark.sources.document import RAW_SCHEMA, Cell, Document
from tidemark.sources.read import READ_SCHEMA


def raw(name, *items):
    doc = Document()
    for x in items:
        doc.paragraph(x) if isinstance(x, str) else doc.table([Cell(r, c, 1, 1, t) for r, row in enumerate(x) for c, t in enumerate(row)])
    empty = {"n_rows": None, "n_cols": None, "caption": None, "cells": None, "grid": None}
    content = [empty | {"text": None} | c for c in doc.content]
    return {"atch_file_nm": name, "atch_file_path": f"/in/{name}", "file_extn_nm": "hwp", "actl_file_extn_nm": "hwp", "scan_yn": False, "content": content, "images": [], "extc_engn_nm": "x"}


CASES = [
    raw("1_1_notice.hwp", "군산지방해양수산청 고시 제2026-47호", "공유수면 점용ㆍ사용 허가 고시", "2026. 6. 17.", "1. 허가번호 : 제2026-26호(2026. 6. 11.)", "2. 점용ㆍ사용 장소 : 군산시 앞", "3. 기간 : 2026. 6. 11. ~ 2027. 6. 10.", "4. 담당자 : 홍길동", "군산지방해양수산청장"),
    raw("2_bad_period.hwp", "기간 : ’25."),
    raw("3_empty.hwp"),
    raw("4_blank_cell.hwp", [["위치", "", "", "특이"], ["목적", "양식장", "", ""]]),
    raw("5_blocks.hwp", "고시 제1호", "허가 사항", "1. 위치 : 가", "2. 목적 : 나", "1. 위치 : 다", "2. 목적 : 라", "1. 위치 : 마", "2. 목적 : 바"),
    raw("6_restart.hwp", "1. 위치 : 가", "1. 목적 : 나"),
    raw("7_list.hwp", "부산청 고시 제9호", [["성명", "주소", "면적"], ["갑", "부산광역시 강서구 녹산로 1", "10"], ["을", "부산광역시 강서구 녹산로 2", "20"]]),
    raw("8_inverted.hwp", "기간 : 2027. 1. 1. ~ 2026. 1. 1."),
    raw("9_long.hwp", "가" * 6000),
]


@pytest.fixture(scope="module")
def mapped(spark):
    out = jobs.map_documents(spark.createDataFrame(CASES, RAW_SCHEMA + ", extc_engn_nm string"))
    return {"files": {r.ATCH_FILE_NM[0]: r for r in out.files.collect()}, "rows": [(r.doc[4], r.dsps_sn, r.target, r.name, r.value) for r in out.rows.collect()], "values": [(r.doc[4], r.record, r.key, r.value) for r in out.values.collect()], "df": out}


def test_a_whole_notice(mapped):
    f = mapped["files"]["1"]
    assert (f.NOTI_SN, f.ATCH_SN, f.NOTI_KND_CD, f.NOTI_NO, f.NOTI_DT, f.NOTI_TTL) == (1, 1, "OCU_PRM", "고시 제2026-47호", "2026-06-17", "공유수면 점용ㆍ사용 허가 고시")
    rows = {r[3]: r[4] for r in mapped["rows"] if r[0] == "1"}
    assert rows == {"APV_NO": "제2026-26호", "APV_DT": "2026-06-11", "LOC": "군산시 앞", "WORK_PRD": "[2026-06-11,2027-06-10]", "담당자": "홍길동"}
    assert ("1", 0, "NOTI_PSN", "군산지방해양수산청장") in mapped["values"]


def test_periods(mapped):
    assert [r for r in mapped["rows"] if r[0] == "2"] == [("2", 1, "label", "WORK_PRD", "’25.")]
    assert not [r for r in mapped["rows"] if r[0] == "8"]


def test_tables(mapped):
    assert {r[3]: r[4] for r in mapped["rows"] if r[0] == "4"} == {"PRPS": "양식장"}
    rows = sorted(r[1:] for r in mapped["rows"] if r[0] == "7")
    assert rows == sorted([(i + 1, "item", k, v) for i, vs in enumerate((("갑", "부산광역시 강서구 녹산로 1", "10"), ("을", "부산광역시 강서구 녹산로 2", "20"))) for k, v in zip(("APLC_NM", "APLC_ADDR", "AREA"), vs)])
    assert ("7", 1, "NOTI_NO", "고시 제9호") in mapped["values"]  # rows inherit what the document says of itself


def test_blocks(mapped):
    assert sorted((r[1], r[3], r[4]) for r in mapped["rows"] if r[0] == "5") == sorted([(1, "LOC", "가"), (1, "PRPS", "나"), (2, "LOC", "다"), (2, "PRPS", "라"), (3, "LOC", "마"), (3, "PRPS", "바")])
    assert {r[1] for r in mapped["rows"] if r[0] == "6"} == {1}


def test_policy_and_empty(mapped):
    assert mapped["files"]["9"].EXCL_RSN_CTNT == "본문 6,000자 (임계 5,000자 초과)" and mapped["files"]["3"].EXCL_RSN_CTNT is None and len(mapped["files"]) == len(CASES)


def test_load(spark, mapped):
    failures = spark.createDataFrame([(8, 1, "8_inverted.hwp", "/in/8", "extract", "OTHER", "null")], "NOTI_SN int, ATCH_SN int, file_name string, file_path string, stage string, kind string, message string")
    images = spark.createDataFrame([(1, 1, 0, "a", None), (1, 1, 1, "b", "/b"), (9, 1, 0, "c", "/c")], "NOTI_SN int, ATCH_SN int, pos int, name string, path string")
    rows = jobs.load_rows(mapped["df"], images, warehouse.failure_rows(failures))
    files = {r.NOTI_SN: r for r in rows["OS_ATCH_FILE_DTL"].select("NOTI_SN", "PROC_STTS_CD", "FAIL_STEP_CD", "FAIL_MSG_CTNT", F.col("NOTI_DT").cast("string").alias("d")).collect()}
    assert files[1].PROC_STTS_CD == "OK" and files[1].d == "2026-06-17" and files[9].PROC_STTS_CD == "SKIP"
    assert (files[8].PROC_STTS_CD, files[8].FAIL_STEP_CD, files[8].FAIL_MSG_CTNT) == ("FAIL", "EXTC", None)
    assert [(r.NOTI_SN, r.IMG_SN, r.IMG_CPTN_CTNT) for r in rows["OS_ATCH_IMG_DTL"].orderBy("NOTI_SN").collect()] == [(1, 1, "b"), (9, 1, "c")]
    assert rows["OS_NOTI_ITEM_VAL_DTL"].where("NOTI_SN = 1").count() == 4 and rows["OS_NOTI_LBL_VAL_DTL"].where("NOTI_SN = 1").count() == 1


def test_schemas_fit():
    assert READ_SCHEMA.startswith(RAW_SCHEMA)


def test_documents_of_queries_are_parsed_once(spark, sf, monkeypatch):
    from tidemark.plans import document_queries

    real, plans = jobs.map_documents, []
    monkeypatch.setattr(jobs, "map_documents", lambda raw, *a: plans.append(raw._jdf.queryExecution().toString()) or real(raw, *a))
    assert document_queries.notices_mapped(spark, sf).count() == 7 * spark.read.parquet(f"{sf}/customer.parquet").count()
    assert len(plans) == 1 and "MapInArrow" not in plans[0]  # every branch of the mapping read the documents anew
