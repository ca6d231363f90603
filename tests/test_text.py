"""Scalar functions, value by value."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as T


def values(spark, f, inputs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], "i int, x string")
    return [r[0] for r in df.select("i", f("x").alias("y")).orderBy("i").select("y").collect()]


def test_dates(spark):
    pairs = {"2026. 6. 5.": "2026-06-05", "2024-01-05": "2024-01-05", "2024년 1월 5일": "2024-01-05", "’25. 2. 25.": "2025-02-25", "’25.": None, "2024. 13. 1.": None, "2026-02-31": "2026-02-31", "2024/1/5 외": "2024-01-05", "": None}
    assert values(spark, T.date_iso, list(pairs)) == list(pairs.values())
    assert values(spark, T.date_iso, [None]) == [None]


def test_the_first_notation_decides(spark):
    assert values(spark, T.date_iso, ["2024년 13월 1일 (2024-01-05)"]) == [None]


def test_ranges(spark):
    got = values(spark, T.range_halves, ["2024. 1. 1. ~ 2024. 2. 1.", "2024. 1. 1.부터 2024. 2. 1.까지", "2024. 1. 1.", "~ 2024", None, "a-b"])
    assert [tuple(x) if x else None for x in got] == [("2024. 1. 1.", "2024. 2. 1."), ("2024. 1. 1.", "2024. 2. 1."), None, None, None, None]
    got = values(spark, T.literal_range, ["[2024-01-01,2024-02-01]", "[2024-02-30,2024-03-01]", "2024", None])
    assert [str(x["start_dt"]) if x else None for x in got] == ["2024-01-01", None, None, None]


def test_labels(spark):
    pairs = {"1. 점용ㆍ사용 장소 :": "점용·사용장소", "□ ○ 면적": "면적", "5 목적": "목적", "가. 주  소": "주소", "① 성명": "성명", "점용.사용 기간": "점용·사용기간", "2026. 6.": "2026.6.", "Name：": "name", "": ""}
    assert values(spark, T.normalise_label, list(pairs)) == list(pairs.values())
    assert values(spark, T.normalise_label, [None]) == [""]
    assert values(spark, lambda c: T.normalise_label(c, compose=True), ["면적"]) == ["면적"]


def test_brackets(spark):
    assert values(spark, T.outer_part, ["성명(상호)", "(상호)", "성명"]) == ["성명", None, None]
    assert values(spark, T.inner_part, ["성명(상호(주))", "성명)("]) == ["상호(주)", None]


@pytest.mark.parametrize("label,value,kept", [("특이사항", "값", True), ("가" * 21, "값", False), ("제1항", "값", False), ("성명(", "값", False), ("특이", "--", False), ("", "값", False), ("특이", None, False)])
def test_unknown_labels(spark, label, value, kept):
    df = spark.createDataFrame([(label, value)], "l string, v string")
    assert df.select(T.keeps_unknown_label("l", "v")).first()[0] is kept


def test_notice_numbers(spark):
    got = values(spark, T.notice_number, ["군산지방해양수산청 고시 제2026-47호", "공 고   제  56 호", "인천청 고시 제2008- 호", "본문 중의 고시 제1호 참조", None])
    assert [tuple(x) if x else None for x in got] == [("군산지방해양수산청", "고시 제2026-47호"), (None, "공고 제56호"), ("인천청", "고시 제2008-호"), None, None]


def test_other_forms(spark):
    assert values(spark, T.unspaced, ["고 시 문", "공유 수면", "가 나  다 라", " x ", None]) == ["고시문", "공유 수면", "가나 다라", "x", None]
    assert values(spark, T.is_signer, ["부산지방해양수산청장", "강서구청장 (직인생략", "담당자", None]) == [True, False, False, False]
    assert values(spark, T.is_caption, ["<표 1> 위치", "그림 2", "Fig. 3", "표지", "본문", None]) == [True, True, True, True, False, False]
    assert values(spark, T.address, ["부산광역시 강서구 녹산로 12-3 일대", "서울 종로구 세종로 1", "없음", None]) == ["부산광역시 강서구 녹산로 12-3", "서울 종로구 세종로 1", None, None]
    got = values(spark, T.approval_parts, ["제2026-26호(2026. 6. 11.)", "제1호(갑)", "(2026. 1. 1.)"])
    assert [tuple(x) for x in got] == [("제2026-26호", "2026. 6. 11."), ("제1호(갑)", None), ("(2026. 1. 1.)", None)]
    assert values(spark, T.flat_value, [" a\n　b  "]) == ["a b"]
    assert values(spark, T.solid_chars, ["a b\n가　나", " ", "😀", None]) == [4, 1, 2, 0]


def test_policy(spark):
    df = spark.createDataFrame([(236,), (5000,), (8355,)], "n int")
    assert [r[0] for r in df.select(T.skip_reason("n")).collect()] == [None, None, "본문 8,355자 (임계 5,000자 초과)"]
    assert df.select(T.skip_reason("n", 0)).distinct().first()[0] is None


def test_markup(spark):
    assert values(spark, T.html_escape, ['<a href="x">&\r\n', None]) == ["&lt;a href=&quot;x&quot;&gt;&amp;<br>", ""]
    assert values(spark, T.markdown_cell, ["a|b\nc", "", None, "x" * 80]) == ["a\\|b c", "—", "—", "x" * 59 + "…"]


def test_yes_no(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert [r[0] for r in df.select(T.yes_no("b")).collect()] == ["Y", "N", "N"]
    assert df.select(T.is_yes(F.lit("Y"))).first()[0] is True


def test_title_is_normalised_once(spark):
    from tidemark.operators.classify import classify_title

    plan = spark.createDataFrame([("공유수면 점용ㆍ사용 허가",)], "title string").select(classify_title("title"))._jdf.queryExecution().toString().lower()
    assert "contains(" in plan and "contains(regexp_replace" not in plan  # once for each word of each rule


def test_values_behind_colons_are_the_patterns(spark):
    """What stands behind the first colon is the pattern's second group, in odd line ends too; a pair is made once."""
    from tidemark.operators import lines

    texts = ["1. 위치 : 부산", "가. 면적： 3 : 4", "목적:", "a:\u3000 b ", "a : b\u2028", "a:b\u0085", "a:\u2028b", "a:b\rc", "\u3000a\u00a0:\u00a0b", "①값:\tx\ty", "a:b\r"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").where(T.is_label_line("text"))
    got = df.select("text", T.trim_control(T.behind_colon("text")).alias("a"), T.trim_control(F.regexp_extract("text", T.LABEL_LINE, 2)).alias("b")).collect()
    assert len(got) >= 8 and [r.a for r in got] == [r.b for r in got]
    assert spark.createDataFrame([("\x01 a\u2028\x00",), (" \u3000 ",)], "t string").select(T.trim_control("t")).collect() == [("a\u2028",), ("\u3000",)]
    pairs = lines.label_pairs(df.select(F.lit(1).alias("doc"), F.col("i").alias("line_no"), "text"))
    assert pairs._jdf.queryExecution().optimizedPlan().toString().count("^\\s*(?:[-–—·o○]\\s*)?(?:\\d{1,2}\\s*[.)]|[가-힣]\\s*[.)]|[①-⑳㉮-㉻])?\\s*([^:：]{1,40}?)\\s*[:：]\\s*(.*)$, 1") == 1


def test_looks_before_patterns_change_nothing(spark):
    """Dates, signers and numbers as the patterns alone have them, in odd line ends too."""
    texts = ["2024 .\t1 . 5", "12024년1월5일생", "’25-2/5", "'99 . 1.1 ", "1. 위치 : 1-URGENT", "3.4", "\n2024\n.1.1", "부산 시장", "군산청장 (인)", "장", "완도 군수\u0085", "서울지사\r\n", "군 수", "도지사x y", "1장 시장", "고시 제1호", "호", "군산 고 시 제 2 - 호 ", "제3호", "문: 제4호", "", " ", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    date = F.coalesce(*[T.group("x", p, 0) for p in (T.DATE_KOREAN, T.DATE_NUMERIC, T.DATE_SHORT)])
    signer = F.coalesce(T.signer_name("x").rlike(T.SIGNER), F.lit(False)) & F.col("x").isNotNull()
    number = T.trim_control("x").rlike(T.NOTICE_LINE)
    got = df.select("x", date.isNotNull().alias("date"), F.coalesce(F.col("x").rlike(T.DATE_MARK), F.lit(False)).alias("mark"), signer.alias("signer"), T.is_signer("x").alias("is_signer"), F.coalesce(number, F.lit(False)).alias("number"), T.notice_number("x").isNotNull().alias("is_number")).collect()
    assert all(r.mark or not r.date for r in got) and sum(r.date for r in got) == 5
    assert [r.signer for r in got] == [r.is_signer for r in got] and sum(r.signer for r in got) == 3
    assert [r.number for r in got] == [r.is_number for r in got] and sum(r.number for r in got) == 2
    head = df.select(T.notice_number("x", F.lit("고시문")).alias("n"), (T.trim_control("x").rlike(T.NOTICE_LINE) | (~T.is_label_line("x") & T.trim_control("x").rlike(T.BARE_SERIAL))).alias("any")).collect()
    assert [r.n is not None for r in head] == [bool(r.any) for r in head]
    dates = spark.createDataFrame([(t,) for t in ["2024. 1. 1.", "2024\n", "2024 ", "’24~", "", "a1", None]], "x string")
    pure = dates.select((F.regexp_replace("x", r"[\d\s.년월일:～~’'-]", "") == "").alias("a"), F.col("x").rlike(r"^[\d\s.년월일:～~’'-]*\z").alias("b")).collect()
    assert [r.a for r in pure] == [r.b for r in pure]


def test_document_meta_of_many_documents_and_long_lines(spark):
    """What grows with the documents is not broadcast, and a long line without a signer's letters is not searched for one."""
    import time

    from tidemark.operators import lines

    body = spark.createDataFrame([("d", 0, "군산청 고시 제1호"), ("d", 1, "제목"), ("d", 2, "2024. 1. 5."), ("d", 3, "군산청장"), ("d", 4, "a" * 100000 + " 가")], "doc string, line_no int, text string")
    none = spark.range(2).select(F.col("id").cast("string").alias("doc"), F.col("id").cast("string").alias("title"))
    meta = lines.document_meta(body, none.select("doc"), none)
    assert "Broadcast" not in meta._jdf.queryExecution().executedPlan().toString()
    began = time.time()
    assert [tuple(r) for r in meta.collect()] == [("d", "군산청", "고시 제1호", "2024. 1. 5.", "군산청장", "제목")]
    assert time.time() - began < 10
