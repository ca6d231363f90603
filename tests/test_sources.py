"""Readers on documents that are made here, byte by byte, and what bytes say."""

import io
import json
import struct
import sys
import zipfile
import zlib

import numpy as np
import pytest

from tidemark.sources import hwp3, hwp5, images, make, pdf, xml_documents
from tidemark.sources import read as R
from tidemark.sources.compound import BrokenContainer, CompoundFile
from tidemark.sources.document import reader_for


def compound(streams: dict[str, bytes]) -> bytes:
    """A compound file with sectors of 512 bytes; every stream is long enough to lie in them."""
    names = ["Root Entry"]
    folders = sorted({n.split("/")[0] for n in streams if "/" in n})
    entries = [["Root Entry", 5, b"", None]] + [[f, 1, b"", f] for f in folders] + [[n.rpartition("/")[2], 2, d.ljust(4096, b"\0") if len(d) < 4096 else d, n] for n, d in streams.items()]
    del names
    body, fat = b"", []

    def put(data):
        nonlocal body
        n = -(-len(data) // 512)
        start = len(fat)
        fat.extend([start + i + 1 for i in range(n - 1)] + [0xFFFFFFFE])
        body += data.ljust(n * 512, b"\0")
        return start

    placed = [(put(e[2]), len(e[2])) if e[1] == 2 else (0xFFFFFFFE, 0) for e in entries]
    at = {e[3]: i for i, e in enumerate(entries) if e[3]}

    def chain(ids):
        return {a: b for a, b in zip(ids, ids[1:] + [0xFFFFFFFF])}

    top = [i for i, e in enumerate(entries) if e[3] and "/" not in e[3]]
    right = chain(top)
    child = {0: top[0]}
    for f in folders:
        inner = [at[n] for n in streams if n.startswith(f + "/")]
        right |= chain(inner)
        child[at[f]] = inner[0]
    rows = b""
    for i, (e, (start, size)) in enumerate(zip(entries, placed)):
        name = e[0].encode("utf-16-le") + b"\0\0"
        rows += name.ljust(64, b"\0") + struct.pack("<HBBIII", len(name), e[1], 1, 0xFFFFFFFF, right.get(i, 0xFFFFFFFF), child.get(i, 0xFFFFFFFF)) + b"\0" * 36 + struct.pack("<IQ", start, size)
    directory = put(rows)
    table = len(fat)
    fat.append(0xFFFFFFFD)
    fat += [0xFFFFFFFF] * (128 - len(fat))
    assert len(fat) == 128
    head = bytes.fromhex("D0CF11E0A1B11AE1") + b"\0" * 16 + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + b"\0" * 6 + struct.pack("<IIIIIIIII", 0, 1, directory, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0) + struct.pack("<I", table) + b"\xff" * 432
    return head + body + struct.pack("<128I", *fat)


def record(tag, level, body):
    return struct.pack("<I", tag | level << 10 | len(body) << 20) + body


def para(text, level=0):
    return record(66, level, b"\0" * 22) + record(67, level + 1, (text + "\r").encode("utf-16-le"))


def hwp(flags=1, picture=b""):
    cells = b"".join(record(72, 2, struct.pack("<IIHHHH", 1, 0, c, r, cs, 1)) + para(t, 2) for r, c, cs, t in ((0, 0, 2, "머리"), (1, 0, 1, "가"), (1, 1, 1, "나")))
    table = record(66, 0, b"\0" * 22) + record(71, 1, b" lbt" + b"\0" * 8) + record(77, 2, struct.pack("<IHH", 0, 2, 2)) + cells
    image = record(66, 0, b"\0" * 22) + record(71, 1, b" osg") + record(76, 2, b"\0" * 8) + record(85, 3, b"\0" * 71 + struct.pack("<H", 10))
    pack = lambda d: zlib.compress(d)[2:-4] if flags & 1 else d
    return compound({"FileHeader": b"HWP Document File".ljust(32, b"\0") + struct.pack("<II", 0x05000300, flags), "BodyText/Section0": pack(para("첫 문단") + table + image + para("끝")), "BinData/BIN000A.png": pack(picture or b"\x89PNG\r\n\x1a\nx")})


def test_compound_and_hwp5():
    data = hwp()
    assert CompoundFile(data).names() == ["BinData/BIN000A.png", "BodyText/Section0", "FileHeader"]
    doc = hwp5.read(data)
    assert [c["type"] for c in doc.content] == ["paragraph", "table", "paragraph"] and doc.content[0]["text"] == "첫 문단"
    assert doc.content[1]["grid"] == [["머리", "머리"], ["가", "나"]] and doc.content[1]["cells"][0]["col_span"] == 2
    assert [i[0] for i in doc.images] == ["png"]  # stream 10 is named in hexadecimal
    for flags, lock in ((3, "PASSWORD"), (17, "DRM"), (5, "DISTRIBUTION"), (1, None)):
        assert R.protection_of("hwp", hwp(flags)) == lock
    with pytest.raises(hwp5.Locked):
        hwp5.read(hwp(3))
    with pytest.raises(BrokenContainer):
        CompoundFile(data[:2000])


def hwp3_bytes(packed=True):
    shape = b"\0" * 31
    word = lambda t: b"".join(struct.pack("<H", ord(c) if ord(c) < 128 else struct.unpack(">H", c.encode("johab"))[0]) for c in t)
    p = lambda body, n: struct.pack("<BHHBBIB", 1, n, 0, 0, 0, 0, 0) + shape + body
    end = struct.pack("<BHHBBIB", 1, 0, 0, 0, 0, 0, 0) + shape
    text = lambda t: p(word(t) + struct.pack("<H", 13), len(t) + 1)
    boxes = [(0, 0, 20, 5), (0, 5, 10, 5), (10, 5, 10, 5)]
    table = struct.pack("<H", 10) + b"\0" * 4 + struct.pack("<H", 10) + b"\0" * 78 + struct.pack("<HHH", 0, 3, 0) + b"".join(struct.pack("<HHHHHH", 0, 0, *b) + b"\0" * 15 for b in boxes) + b"".join(text(t) + end for t in ("머리", "가", "나")) + end
    body = struct.pack("<H", 0) * 7 + struct.pack("<H", 0) + text("처음 abc") + p(table + struct.pack("<H", 13), 5) + text("끝") + end + struct.pack("<II", 1, 36) + b"a.bmp".ljust(16, b"\0") + b"bmp".ljust(16, b"\0") + b"data" + struct.pack("<II", 0, 0)
    info = bytearray(128)
    info[124] = packed
    return b"HWP Document File V3.00 \x1a\1\2\3\4\5"[:30].ljust(30, b"\0") + bytes(info) + b"\0" * 1008 + (zlib.compress(body)[2:-4] if packed else body)


@pytest.mark.parametrize("packed", [True, False])
def test_hwp3(packed):
    doc = hwp3.read(hwp3_bytes(packed))
    assert [c.get("text") for c in doc.content if c["type"] == "paragraph"] == ["처음 abc", "끝"]
    assert next(c for c in doc.content if c["type"] == "table")["grid"] == [["머리", "머리"], ["가", "나"]]
    assert [(e, d) for e, d, _ in doc.images] == [("bmp", b"data")]
    locked = bytearray(hwp3_bytes(packed))
    locked[30 + 96] = 1
    with pytest.raises(hwp3.Damaged):
        hwp3.read(bytes(locked))


def hwpx(manifest=None):
    out = io.BytesIO()
    p = lambda t: f"<hp:p><hp:run><hp:t>{t}</hp:t></hp:run></hp:p>"
    tc = lambda r, c, cs, t: f'<hp:tc><hp:subList>{p(t)}</hp:subList><hp:cellAddr colAddr="{c}" rowAddr="{r}"/><hp:cellSpan colSpan="{cs}" rowSpan="1"/></hp:tc>'
    tbl = f'<hp:p><hp:run><hp:tbl rowCnt="2" colCnt="2"><hp:caption><hp:subList>{p("표 1")}</hp:subList></hp:caption><hp:tr>{tc(0, 0, 2, "머리")}</hp:tr><hp:tr>{tc(1, 0, 1, "가")}{tc(1, 1, 1, "나")}</hp:tr></hp:tbl><hp:pic><hp:img binaryItemIDRef="i1"/></hp:pic></hp:run></hp:p>'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("Contents/section0.xml", f'<hs:sec xmlns:hs="s" xmlns:hp="p">{p("첫<hp:tab/>줄")}{tbl}</hs:sec>')
        z.writestr("Contents/content.hpf", '<opf:package xmlns:opf="o"><opf:manifest><opf:item id="i1" href="BinData/a.PNG"/></opf:manifest></opf:package>')
        z.writestr("BinData/a.PNG", b"image")
        if manifest:
            z.writestr("META-INF/manifest.xml", manifest)
    # the href is looked up as it is written
    return out.getvalue()


def test_hwpx():
    doc = xml_documents.read_hwpx(hwpx())
    assert doc.content[0]["text"] == "첫\t줄" and doc.content[1]["grid"] == [["머리", "머리"], ["가", "나"]] and doc.content[1]["caption"] == "표 1"
    assert [(e, d) for e, d, _ in doc.images] == [("png", b"image")]
    locked = '<m:manifest xmlns:m="m"><m:file-entry m:full-path="Contents/section0.xml"><m:encryption-data/></m:file-entry></m:manifest>'
    with pytest.raises(hwp5.Locked):
        xml_documents.read_hwpx(hwpx(locked))


def test_hml():
    data = """<?xml version="1.0"?><HWPML><HEAD><BINITEM BinData="1" Format="jpg"/></HEAD><BODY><SECTION><P><TEXT><CHAR>첫 줄</CHAR></TEXT></P>
    <P><TEXT><TABLE RowCount="1" ColCount="2"><ROW><CELL RowAddr="0" ColAddr="0"><P><TEXT><CHAR>가</CHAR></TEXT></P></CELL><CELL RowAddr="0" ColAddr="1"><P><TEXT><CHAR>나</CHAR></TEXT></P></CELL></ROW></TABLE><PICTURE><IMAGE BinItem="1"/></PICTURE></TEXT></P></SECTION></BODY>
    <TAIL><BINDATA Id="1" Encoding="Base64">aGVsbG8=</BINDATA></TAIL></HWPML>""".encode()
    doc = xml_documents.read_hml(data)
    assert doc.content[0]["text"] == "첫 줄" and doc.content[1]["grid"] == [["가", "나"]] and doc.images[0][:2] == ("jpg", b"hello")
    with pytest.raises(xml_documents.ET.ParseError):
        xml_documents.read_hml(b'<?xml version="1.0"?><!DOCTYPE x [<!ENTITY a "b">]><HWPML/>')


def pdf_bytes(content: bytes, extra: str = "", trailer: str = ""):
    packed = zlib.compress(content)
    return (
        b"%PDF-1.4\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj\n2 0 obj <</Type/Pages/Kids[3 0 R]/Count 1/MediaBox[0 0 600 800]>> endobj\n"
        + f"3 0 obj <</Type/Page/Parent 2 0 R/Contents 4 0 R/Resources<</Font<</F1 5 0 R>>{extra}>>>> endobj\n4 0 obj <</Length {len(packed)}/Filter/FlateDecode>> stream\n".encode()
        + packed
        + f"\nendstream endobj\n5 0 obj <</Type/Font/Subtype/Type1/BaseFont/Helvetica>> endobj\ntrailer <</Root 1 0 R{trailer}>>".encode()
    )


def test_pdf():
    rules = " ".join(f"{x} 500 m {x} 600 l S" for x in (100, 200, 300)) + " " + " ".join(f"100 {y} m 300 {y} l S" for y in (500, 550, 600))
    show = lambda x, y, t: f"BT /F1 10 Tf {x} {y} Td ({t}) Tj ET"
    content = " ".join([show(100, 700, "First line"), show(100, 685, "\\(goes on\\)"), rules, show(110, 570, "a"), show(210, 570, "b"), show(110, 520, "c"), show(210, 520, "d"), show(100, 400, "Last")])
    doc = pdf.read(pdf_bytes(content.encode()))
    assert [c.get("text") or c["grid"] for c in doc.content] == ["First line (goes on)", [["a", "b"], ["c", "d"]], "Last"]
    with pytest.raises(hwp5.Locked):
        pdf.read(pdf_bytes(b"", trailer="/Encrypt 9 0 R"))
    with pytest.raises(ValueError):
        pdf.read(b"no such thing")


def test_pdf_with_merged_cells_and_two_tables():
    show = lambda x, y, t: f"BT /F1 10 Tf {x} {y} Td ({t}) Tj ET"
    line = lambda x0, y0, x1, y1: f"{x0} {y0} m {x1} {y1} l S"
    # above: a head over two columns, and a cell over two rows on the left; below: a plain table
    first = [line(100, y, 400, y) for y in (700, 650, 550)] + [line(200, 600, 400, 600), line(200, 550, 200, 650)] + [line(x, 550, x, 700) for x in (100, 300, 400)]
    second = [line(100, y, 300, y) for y in (450, 400, 350)] + [line(x, 350, x, 450) for x in (100, 200, 300)]
    words = [show(150, 670, "head"), show(310, 670, "top"), show(110, 600, "left"), *(show(x, y, t) for x, y, t in ((210, 620, "e"), (310, 620, "f"), (210, 570, "g"), (310, 570, "h")))]
    words += [show(100, 500, "Between"), *(show(x, y, t) for x, y, t in ((110, 420, "a"), (210, 420, "b"), (110, 370, "c"), (210, 370, "d")))]
    doc = pdf.read(pdf_bytes(" ".join(first + second + words).encode()))
    assert [c.get("text") or c["grid"] for c in doc.content] == [[["head", "head", "top"], ["left", "e", "f"], ["left", "g", "h"]], "Between", [["a", "b"], ["c", "d"]]]
    assert [(c["row"], c["col"], c["row_span"], c["col_span"]) for c in doc.content[0]["cells"]] == [(0, 0, 1, 2), (0, 2, 1, 1), (1, 0, 2, 1), (1, 1, 1, 1), (1, 2, 1, 1), (2, 1, 1, 1), (2, 2, 1, 1)]
    assert doc.first_page[0] > 0


def test_images():
    white = np.full((60, 80, 3), 255, np.uint8)
    drawn = white.copy()
    drawn[12:48, 10:70] = 0
    speck = np.full((400, 400, 3), 255, np.uint8)
    speck[5:12, 5:12] = 0
    stamp = white[:60, :60].copy()
    stamp[15:45, 15:45] = (200, 20, 20)
    assert [images.accept(images.encode_png(x)) for x in (drawn, white, speck, stamp, drawn[:10, :10])] == [True, False, False, False, False]
    assert (images.decode_png(images.encode_png(drawn)) == drawn).all() and images.accept(b"unknown") and images.accept(None)
    m = images.measure(drawn)
    assert abs(m.ink - 0.45) < 1e-9 and abs(m.spread - 0.75) < 1e-9 and m.red == 0
    bmp = b"BM" + struct.pack("<IHHIIiiHHI", 54 + 4 * 80 * 60, 0, 0, 54, 40, 80, 60, 1, 32, 0) + b"\0" * 20 + np.dstack([drawn[::-1, :, ::-1], np.zeros((60, 80), np.uint8)]).astype(np.uint8).tobytes()
    assert (images.decode_bmp(bmp) == drawn).all()


def test_read_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "12_1_a.HWP").write_bytes(hwp())
    (tmp_path / "13_b.pdf").write_bytes(hwpx())
    (tmp_path / "14_c.hwp").write_bytes(b"")
    (tmp_path / "15_d.hwp").write_bytes(hwp(3))
    (tmp_path / "16_e.txt").write_bytes(b"text")
    from tidemark import jobs
    from tidemark.sources.sniff import scan_files, tagged

    files = scan_files(spark, str(tmp_path))
    assert files.count() == 4 and tagged(files).where("mislabelled").count() == 1
    raw = {r.atch_file_nm: r for r in R.read_documents(files).collect()}
    assert raw["12_1_a.HWP"].error is None and len(raw["12_1_a.HWP"].content) == 3 and raw["13_b.pdf"].actl_file_extn_nm == "hwpx"
    assert raw["15_d.hwp"].protection == "PASSWORD"
    survey = {r.path.rpartition("/")[2]: (r.status, r.kind) for r in jobs.detect(files).collect()}
    assert survey == {"12_1_a.HWP": ("NATIVE", None), "13_b.pdf": ("NATIVE", None), "14_c.hwp": ("FAILED", "EMPTY_FILE"), "15_d.hwp": ("FAILED", "PASSWORD_PROTECTED")}
    assert R.image_table(files).count() == 2


def test_ocr(tmp_path):
    script = tmp_path / "ocr.py"
    script.write_text("import json,sys\nout=sys.argv[sys.argv.index('--output')+1]\njson.dump({'blocks':[{'label':'text','content':'읽은 글'},{'label':'table','content':'<table><tr><td>a</td></tr></table>'},{'label':'seal','content':'x'}]},open(out,'w'))")
    doc = R.run_ocr([sys.executable, str(script)], b"%PDF", "pdf")
    assert [c["type"] for c in doc.content] == ["paragraph", "table"]
    script.write_text("import sys\nprint('why')\nsys.exit(3)")
    with pytest.raises(RuntimeError, match="why"):
        R.run_ocr([sys.executable, str(script)], b"", "pdf")
    script.write_text("import time\ntime.sleep(60)")
    import subprocess

    with pytest.raises(subprocess.TimeoutExpired):
        R.run_ocr([sys.executable, str(script)], b"", "pdf", seconds=1)


def test_registry():
    with pytest.raises(ValueError):
        reader_for("doc")
    assert reader_for("", "content-streams") is pdf.read


def test_json(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"atch_file_nm": "a", "unknown": 1}))
    (tmp_path / "b.json").write_text("{broken")
    good, bad = R.read_json(spark, str(tmp_path))
    assert good.count() == 1 and bad.count() == 1


def test_small_rows_are_read_in_many_tasks(spark):
    rows = spark.range(0, 700, 1, 1).selectExpr("concat(id, '.hml') AS path", "array(if(id = 300, repeat('x', 1200000), 'text')) AS texts", "CAST(NULL AS array<array<string>>) AS cells", "CAST(NULL AS binary) AS picture")
    files = make.documents(rows, "hml")
    assert files.rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism  # one task read them all
    for raw in (R.read_documents(files), R.read_documents(files.coalesce(1))):  # some in a batch, the large one ends its own
        assert raw.where("error IS NULL").select("atch_file_path").distinct().count() == raw.count() == 700


def test_pdf_tokens():
    text = b"%c(\n<</Na#20me/>>[(a(b)\\)c\\12)( x)<41 4>-.5 3. 12]Tj )<zz%(end\nR (open"
    assert [t for t, _ in pdf.tokens(text)] == ["<<", "Na me", "", ">>", "[", b"a(b))c\n", b" x", b"A@", -0.5, 3.0, 12, "]", "Tj", "zz", "R", b"open"]


def test_broken_files_are_read_in_many_tasks(spark, sf, monkeypatch):
    from tidemark import jobs
    from tidemark.plans import document_queries

    real, parts = jobs.extract, []
    monkeypatch.setattr(jobs, "extract", lambda files: parts.append(files.rdd.getNumPartitions()) or real(files))
    assert document_queries.broken_files(spark, sf).count() == spark.read.parquet(f"{sf}/part.parquet").count()
    assert parts[0] >= 4 * spark.sparkContext.defaultParallelism


def test_elements_are_found_by_local_names():
    """Tags lose their namespaces once, not at each look for them; what is found is the same in any prefix."""
    root = xml_documents.parse_xml(b'<a:sec xmlns:a="x" xmlns="y"><a:p><run/></a:p></a:sec>')
    assert [e.tag for e in root.iter()] == ["sec", "p", "run"]
    data = make.hml(["one"], [["k", "v"]], b"").replace(b"<HWPML>", b'<HWPML xmlns="urn:h">')
    got = reader_for("hml")(data)
    assert [c.get("text") or c["grid"] for c in got.content] == ["one", [["k", "v"]]]
