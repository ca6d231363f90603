"""Loads into a warehouse that is there, images, and the verbs from the command line."""

import json

import numpy as np
import pytest

from tests.test_sources import hwp, record
from tidemark import jobs
from tidemark.operators import warehouse
from tidemark.operators.store import Store
from tidemark.sources import document, images
from tidemark.sources import read as R


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_store_replaces_keys_and_keeps_the_rest(spark, tmp_path):
    store = Store(spark, str(tmp_path / "t"), {"a": ["k"], "b": ["k"]}, buckets=4)
    make = lambda data: spark.createDataFrame(data, "k int, v string")
    assert store.tables() == {}
    store.commit({"a": (make([(i, "old") for i in range(20)]), None), "b": (make([(1, "x"), (1, "y"), (2, "z")]), None)})
    before = store.tables()["a"]
    store.commit({"a": (make([(3, "new"), (99, "new")]), make([(4, "")]).select("k")), "b": (make([]), make([(1, "")]).select("k"))})
    now = store.tables()
    assert rows(now["a"], "k", "v") == sorted([(i, "old") for i in range(20) if i not in (3, 4)] + [(3, "new"), (99, "new")])
    assert rows(now["b"], "k", "v") == [(2, "z")] and before.count() == 20  # who reads the version before still can
    store.commit({"a": (make([(3, "new"), (99, "new")]), None)})
    assert rows(store.tables()["a"], "k", "v") == rows(now["a"], "k", "v") and len(store._numbers()) == 2
    with pytest.raises(RuntimeError):
        store._publish(store._numbers()[-1], {})


def test_a_load_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "t"), {"a": ["k"]}, buckets=2)
    make = lambda v: spark.createDataFrame([(1, v)], "k int, v string")
    store.commit({"a": (make("first"), None)})
    monkeypatch.setattr(Store, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        store.commit({"a": (make("second"), None)})
    assert rows(store.tables()["a"], "v") == [("first",)]


def picture(i):
    rgb = np.full((60, 80, 3), 255, np.uint8)
    rgb[12:48, 10 : 60 + i] = 0
    return images.encode_png(rgb)


def test_pipeline_twice(spark, tmp_path):
    first, second, out = tmp_path / "one", tmp_path / "two", tmp_path / "out"
    for folder in (first, second, first / "sub"):
        folder.mkdir()
    hml = lambda *ps: ('<?xml version="1.0"?><HWPML><BODY><SECTION>' + "".join(f"<P><TEXT><CHAR>{p}</CHAR></TEXT></P>" for p in ps) + "</SECTION></BODY></HWPML>").encode()
    (first / "1_1_a.hml").write_bytes(hml("군산지방해양수산청 고시 제2026-47호", "공유수면 점용ㆍ사용 허가 고시", "1. 위치 : 군산", "2. 특이 : 없음"))
    (first / "1_2_b.HWP").write_bytes(hwp(picture=picture(1)))
    (first / "sub" / "2_1_a.hml").write_bytes(b"")
    (second / "1_1_a.hml").write_bytes(hml("부산지방해양수산청 고시 제2026-48호", "1. 위치 : 부산", "2. 목적 : 양식"))
    (second / "3_1_c.hml").write_bytes(hml("1. 위치 : 여수"))
    assert jobs.main(["pipeline", str(first), str(out)]) == 1
    store = warehouse.open_store(spark, f"{out}/warehouse")
    t = store.tables()
    assert rows(t["OS_ATCH_FILE_DTL"], "NOTI_SN", "ATCH_SN", "PROC_STTS_CD", "FAIL_KND_CD") == [(1, 1, "OK", None), (1, 2, "OK", None), (2, 1, "FAIL", "EMPTY_FILE")]
    assert rows(t["OS_NOTI_ITEM_VAL_DTL"], "NOTI_SN", "ATCH_SN", "NOTI_ITEM_CD", "ITEM_VAL_CTNT") == [(1, 1, "LOC", "군산")]
    (image,) = t["OS_ATCH_IMG_DTL"].collect()
    assert (image.NOTI_SN, image.ATCH_SN, image.IMG_SN, image.IMG_CPTN_CTNT) == (1, 2, 1, "1_2_b_img0.png") and open(image.IMG_FILE_PATH, "rb").read() == picture(1)
    assert jobs.main(["load", str(second), str(out)]) == 0
    again = store.tables()
    assert rows(again["OS_ATCH_FILE_DTL"], "NOTI_SN", "ATCH_SN", "NOTI_NO") == [(1, 1, "고시 제2026-48호"), (1, 2, None), (2, 1, None), (3, 1, None)]
    assert rows(again["OS_NOTI_ITEM_VAL_DTL"], "NOTI_SN", "ATCH_SN", "NOTI_ITEM_CD", "ITEM_VAL_CTNT") == [(1, 1, "LOC", "부산"), (1, 1, "PRPS", "양식"), (3, 1, "LOC", "여수")]
    assert again["OS_NOTI_LBL_VAL_DTL"].where("ATCH_SN = 1").isEmpty() and again["OS_ATCH_IMG_DTL"].count() == 1 and rows(again["OS_NOTI_BAS"], "NOTI_SN") == [(1,), (2,), (3,)]
    assert {f.name for f in again["OS_ATCH_FILE_DTL"].schema} == {c[0] for c in warehouse.columns("OS_ATCH_FILE_DTL")}
    # the same run again changes nothing but times
    jobs.main(["load", str(second), str(out)])
    same = store.tables()
    for name in again:
        cols = [c for c in same[name].columns if not c.endswith("_DTM")]
        assert rows(same[name], *cols) == rows(again[name], *cols)


def test_verbs_over_raw_json(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "5_1_x.hwp").write_bytes(hwp())
    assert jobs.main(["extract", str(source), str(out)]) == 0
    assert jobs.main(["tables", f"{out}/json", f"{out}/t", "--raw"]) == 0 and jobs.main(["render", f"{out}/json", f"{out}/r", "--raw"]) == 0
    assert "머리" in spark.read.parquet(f"{out}/r/html").first().html
    assert jobs.main(["map", f"{out}/json", f"{out}/m", "--raw", "--threshold", "1"]) == 0
    assert spark.read.parquet(f"{out}/m/files").first().EXCL_RSN_CTNT is not None
    assert jobs.main(["detect", str(source), f"{out}/d"]) == 0 and spark.read.parquet(f"{out}/d/survey").first().status == "NATIVE"
    assert jobs.main(["dict", f"{out}/m", f"{out}/docs", "--review"]) == 0
    for name, word in (("items", "LOC"), ("types", "OCU_PRM"), ("standard", "OS_ATCH_FILE_DTL"), ("extras", "미매핑"), ("notice_types", "제목 없음 1")):
        assert word in "\n".join(r[0] for r in spark.read.text(f"{out}/docs/{name}").collect())
    failures = [json.loads(x) for x in spark.read.text(f"{out}/m/failures").toPandas()["value"]]
    assert failures == [{"total": 1, "failed": 0}]
    assert jobs.main(["extract", str(source), f"{out}/e", "--engine", "hml-dom"]) == 1


def test_loads_that_may_not_be(spark, tmp_path):
    store = warehouse.open_store(spark, str(tmp_path / "w"), 2)
    files = spark.createDataFrame([(1, 1, "a", "OK", "N", "OCU_PRM")], "NOTI_SN int, ATCH_SN int, ATCH_FILE_NM string, PROC_STTS_CD string, SCAN_YN string, NOTI_KND_CD string")
    none = {n: spark.createDataFrame([], warehouse.schema(n)) for n in warehouse.CHILDREN}
    values = spark.createDataFrame([(1, 1, 1, "OLD_CODE", 1, "v"), (1, 1, 1, "LOC", 1, "w")], "NOTI_SN int, ATCH_SN int, DSPS_SN int, NOTI_ITEM_CD string, RPT_SN int, ITEM_VAL_CTNT string")
    warehouse.load(store, {"OS_ATCH_FILE_DTL": files} | none | {"OS_NOTI_ITEM_VAL_DTL": values}, agencies=spark.createDataFrame([(7, "a", "LOCL")], "INSTT_SN int, INSTT_NM string, INSTT_KND_CD string"), posts=spark.createDataFrame([(1, 7, "t")], "NOTI_SN int, INSTT_SN int, BBS_TTL string"))
    t = store.tables()
    assert rows(t["OS_NOTI_LBL_VAL_DTL"], "ITEM_LBL_NM", "ITEM_VAL_CTNT") == [("OLD_CODE", "v")] and rows(t["OS_NOTI_ITEM_VAL_DTL"], "NOTI_ITEM_CD") == [("LOC",)]
    with pytest.raises(ValueError, match="OS_NOTI_KND_TC"):
        warehouse.load(store, {"OS_ATCH_FILE_DTL": files.replace("OCU_PRM", "NO_SUCH")} | none)
    with pytest.raises(ValueError, match="twice"):
        warehouse.load(store, {"OS_ATCH_FILE_DTL": files.union(files)} | none)
    with pytest.raises(ValueError, match="OS_INSTT_BAS"):
        warehouse.load(store, {"OS_ATCH_FILE_DTL": files} | none, posts=spark.createDataFrame([(1, 8)], "NOTI_SN int, INSTT_SN int"))
    warehouse.load(store, {"OS_ATCH_FILE_DTL": files} | none, posts=spark.createDataFrame([(1, None, "n")], "NOTI_SN int, BBS_TTL string, TEL_NO string"))
    assert rows(store.tables()["OS_NOTI_BAS"], "NOTI_SN", "INSTT_SN", "BBS_TTL", "TEL_NO") == [(1, 7, "t", "n")] and store.tables()["OS_NOTI_ITEM_VAL_DTL"].isEmpty()


def test_scan_detectors():
    doc = document.Document()
    doc.image("png", b"x")
    assert all(document.is_scan(k, doc) for k in ("hwp", "hwp3", "hwpx", "hml")) and not document.is_scan("pdf", doc)
    doc.first_page = (0, 1)
    doc.paragraph("later text")
    assert document.is_scan("pdf", doc) and not document.is_scan("hwp", doc)
    with pytest.raises(ValueError):
        document.is_scan("doc", doc)
    captioned = document.Document()
    captioned.image("png", b"x", "그림 1")
    assert not document.is_scan("hwpx", captioned)
    before = dict(document.DETECTORS)
    document.detects("hml")(lambda d: True)
    assert document.is_scan("hml", document.Document())
    document.DETECTORS.update(before)
    assert R.read_one("/x/a.hml", b"<?xml version='1.0'?><HWPML/>", "hml", "hml")["scan_yn"] is False and record(66, 0, b"")


def test_characters_of_hwp3():
    from tidemark.sources.hwp3 import decode_char as d

    got = {c: d(c) for c in (0x41, 0x88BA, 0x4000, 0x4000 + 4887, 0x4000 + 4888, 0x7FFF, 0x3013, 0x301C, 0x301D, 0x3059, 0x305F, 0x3060, 0x2F00, 0x2F06, 0x2F09, 0x81, 0x84, 0x309B, 0x309D, 0x37C0, 0x37C5, 0x1F01, 0x1F61, 0x3401, 0x3500, 0x34C0, 0x3400 + 9 * 0x60 + 1, 0x2020)}
    assert [got[c] for c in (0x41, 0x4000, 0x4000 + 4887, 0x3013, 0x301C, 0x301D, 0x2F00, 0x2F06, 0x81, 0x84, 0x309B, 0x309D, 0x37C0, 0x37C5, 0x1F01, 0x1F61)] == ["A", "伽", "詰", "+", "-", "|", "□", "■", '"', "'", "｢", "｣", "한", "터", "ぁ", "ァ"]
    assert all(got[c] == "□" for c in (0x4000 + 4888, 0x7FFF, 0x2F09, 0x34C0, 0x2020))
    assert got[0x3401] == bytes((0xA1, 0xA1)).decode("euc_kr") and got[0x3400 + 9 * 0x60 + 1] == bytes((0xAC, 0xA1)).decode("euc_kr")


def test_jdbc_there_and_back(spark):
    """Spark's own embedded database stands in for a server."""
    from tidemark.operators import sinks

    url, driver = "jdbc:derby:memory:tidemark;create=true", "org.apache.derby.jdbc.EmbeddedDriver"
    df = spark.range(1000).selectExpr("cast(id AS int) AS NOTI_SN", "concat('n', id) AS BBS_TTL").repartition(9)
    sinks.write_jdbc(df, url, "POSTS", driver=driver)
    back = sinks.read_jdbc(spark, url, "POSTS", "NOTI_SN", 4, driver=driver)
    assert back.rdd.getNumPartitions() == 4 and rows(back, "NOTI_SN", "BBS_TTL") == sorted((i, f"n{i}") for i in range(1000))
    sinks.write_jdbc(df.limit(0), url, "NOTHING", driver=driver)
    assert sinks.read_jdbc(spark, url, "NOTHING", "NOTI_SN", driver=driver).count() == 0


def test_tables_are_made_once(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS notices LOCATION '{tmp_path}/notices'")
    for _ in range(2):
        warehouse.create_tables(spark, "notices")
    assert {r.tableName for r in spark.sql("SHOW TABLES IN notices").collect()} == {t.lower() for t in warehouse.TABLES}
    got = {r.col_name: r.data_type for r in spark.sql("DESCRIBE notices.OS_ATCH_FILE_DTL").collect()}
    assert got["NOTI_SN"] == "int" and got["NOTI_DT"] == "date" and list(got) == [c[0] for c in warehouse.columns("OS_ATCH_FILE_DTL")]
    spark.sql("DROP DATABASE notices CASCADE")


def test_settings(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# a comment\nexport OCR_COMMAND='from env file'\n")
    (tmp_path / "application.properties").write_text("ocr.command=from properties\nload.max-body-chars = 7\n")
    files = (str(tmp_path / ".env"), str(tmp_path / "application.properties"))
    assert jobs.setting("ocr.command", "x", files) == "from env file" and jobs.setting("load.max-body-chars", "x", files) == "7" and jobs.setting("none.such", "x", files) == "x"
    monkeypatch.setenv("OCR_COMMAND", "from the environment")
    assert jobs.setting("ocr.command", "x", files) == "from the environment"


def test_reserved_and_long_names(spark):
    from tidemark.operators import governance

    words = spark.createDataFrame([("NM", "name", "D_NM"), ("ORDER", "order", "D_NM")], "word string, meaning string, domain string")
    names = spark.createDataFrame([("ORDER", "D_NM"), ("_".join(["NM"] * 11), "D_NM"), ("NM", "D_NM")], "name string, domain string")
    got = {r.name[:5]: r.violations for r in governance.name_violations(names, words).collect()}
    assert got == {"ORDER": ["reserved"], "NM_NM": ["longer than 30"], "NM": []}


def test_a_load_broadcasts_dimensions_only(spark, sf):
    """Keys that grow with the load meet sorted, though their files are below Spark's threshold."""
    from tidemark.plans.document_queries import load_twice

    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    assert load_twice(spark, sf).count() == 2 * spark.read.parquet(f"{sf}/customer.parquet").count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs, sizes = store.executionsList(), []
    for i in range(before, runs.size()):
        one = runs.apply(i).executionId()
        nodes, told = store.planGraph(one).allNodes(), store.executionMetrics(one)
        for n in (nodes.apply(k) for k in range(nodes.size())):
            if n.name() == "BroadcastExchange":
                ids = [m.accumulatorId() for m in (n.metrics().apply(j) for j in range(n.metrics().size())) if m.name() == "number of output rows"]
                sizes += [int(told.apply(x).replace(",", "")) for x in ids if told.contains(x)]
    assert sizes and max(sizes) < 100  # types and items; a post of the smallest tables is one of 150
