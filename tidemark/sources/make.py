"""Small documents of every format that the readers know, written out of texts: what round trips read back.

A document is paragraphs, then a table (rows of texts, if any), then a picture (PNG bytes, if any).
"""

from __future__ import annotations

import base64
import io
import struct
import zipfile
import zlib
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.plans.staging import spread

Rows = list[list[str]]


def hml(texts: list[str], rows: Rows, picture: bytes) -> bytes:
    p = lambda inside: f"<P><TEXT>{inside}</TEXT></P>"
    char = lambda t: f"<CHAR>{escape(t)}</CHAR>"
    body = "".join(p(char(t)) for t in texts)
    if rows:
        cells = "".join("<ROW>" + "".join(f'<CELL RowAddr="{r}" ColAddr="{c}">{p(char(t))}</CELL>' for c, t in enumerate(row)) + "</ROW>" for r, row in enumerate(rows))
        body += p(f'<TABLE RowCount="{len(rows)}" ColCount="{len(rows[0])}">{cells}</TABLE>')
    head, tail = "", ""
    if picture:
        head, tail = '<BINITEM BinData="1" Format="png"/>', f'<TAIL><BINDATA Id="1" Encoding="Base64">{base64.b64encode(picture).decode()}</BINDATA></TAIL>'
        body += p('<PICTURE><IMAGE BinItem="1"/></PICTURE>')
    return f'<?xml version="1.0"?><HWPML><HEAD>{head}</HEAD><BODY><SECTION>{body}</SECTION></BODY>{tail}</HWPML>'.encode()


def hwpx(texts: list[str], rows: Rows, picture: bytes) -> bytes:
    p = lambda inside: f"<hp:p><hp:run>{inside}</hp:run></hp:p>"
    t = lambda x: f"<hp:t>{escape(x)}</hp:t>"
    cell = lambda r, c, x: f'<hp:tc><hp:subList>{p(t(x))}</hp:subList><hp:cellAddr colAddr="{c}" rowAddr="{r}"/><hp:cellSpan colSpan="1" rowSpan="1"/></hp:tc>'
    body = "".join(p(t(x)) for x in texts)
    if rows:
        body += p(f'<hp:tbl rowCnt="{len(rows)}" colCnt="{len(rows[0])}">' + "".join("<hp:tr>" + "".join(cell(r, c, x) for c, x in enumerate(row)) + "</hp:tr>" for r, row in enumerate(rows)) + "</hp:tbl>")
    if picture:
        body += p('<hp:pic><hp:img binaryItemIDRef="i1"/></hp:pic>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("Contents/section0.xml", f'<hs:sec xmlns:hs="s" xmlns:hp="p">{body}</hs:sec>')
        if picture:
            z.writestr("Contents/content.hpf", '<opf:package xmlns:opf="o"><opf:manifest><opf:item id="i1" href="BinData/a.png"/></opf:manifest></opf:package>')
            z.writestr("BinData/a.png", picture)
    return out.getvalue()


def compound(streams: dict[str, bytes]) -> bytes:
    """A compound file of 512-byte sectors: a directory of one level of folders, every stream padded into full sectors."""
    end, free, table_sector = 0xFFFFFFFE, 0xFFFFFFFF, 0xFFFFFFFD
    folders = sorted({n.split("/")[0] for n in streams if "/" in n})
    names = [*folders, *streams]
    body, chain = bytearray(), []

    def put(data: bytes) -> int:
        first, n = len(chain), -(-len(data) // 512)
        chain.extend([*range(first + 1, first + n), end])
        body.extend(data.ljust(512 * n, b"\0"))
        return first

    at = {name: i + 1 for i, name in enumerate(names)}
    levels = {"": [n for n in names if "/" not in n]} | {f: [n for n in streams if n.startswith(f + "/")] for f in folders}
    after = {n: at[m] for level in levels.values() for n, m in zip(level, level[1:])}

    def entry(name: str, kind: int, right: int, child: int, start: int, size: int) -> bytes:
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBBIII", len(raw), kind, 1, free, right, child) + bytes(36) + struct.pack("<IQ", start, size)

    directory = entry("Root Entry", 5, free, at[levels[""][0]], end, 0)
    for name in names:
        if name in folders:
            directory += entry(name, 1, after.get(name, free), at[levels[name][0]], end, 0)
        else:
            data = streams[name].ljust(4096, b"\0")
            directory += entry(name.rpartition("/")[2], 2, after.get(name, free), free, put(data), len(data))
    first = put(directory)
    chain.append(table_sector)
    if len(chain) > 128:
        raise ValueError("one sector of the table holds no more than 127 sectors")
    head = bytes.fromhex("D0CF11E0A1B11AE1") + bytes(16) + struct.pack("<HHHHH", 0x3E, 3, 0xFFFE, 9, 6) + bytes(6)
    head += struct.pack("<10I", 0, 1, first, 0, 4096, end, 0, end, 0, len(chain) - 1) + b"\xff" * 432
    return head + bytes(body) + struct.pack(f"<{len(chain)}I", *chain).ljust(512, b"\xff")


def hwp5(texts: list[str], rows: Rows, picture: bytes) -> bytes:
    record = lambda tag, level, body: struct.pack("<I", tag | level << 10 | len(body) << 20) + body
    para = lambda t, level: record(66, level, bytes(22)) + record(67, level + 1, (t + "\r").encode("utf-16-le"))
    body = b"".join(para(t, 0) for t in texts)
    if rows:
        cells = b"".join(record(72, 2, struct.pack("<IIHHHH", 1, 0, c, r, 1, 1)) + para(t, 2) for r, row in enumerate(rows) for c, t in enumerate(row))
        body += record(66, 0, bytes(22)) + record(71, 1, b" lbt" + bytes(8)) + record(77, 2, struct.pack("<IHH", 0, len(rows), len(rows[0]))) + cells
    if picture:
        body += record(66, 0, bytes(22)) + record(71, 1, b" osg") + record(76, 2, bytes(8)) + record(85, 3, bytes(71) + struct.pack("<H", 1))
    streams = {"FileHeader": b"HWP Document File".ljust(32, b"\0") + struct.pack("<II", 0x05000300, 1), "BodyText/Section0": zlib.compress(body)[2:-4]}
    return compound(streams | ({"BinData/BIN0001.png": picture} if picture else {}))


def hwp3(texts: list[str], rows: Rows, picture: bytes) -> bytes:
    shape = bytes(31)
    code = lambda c: ord(c) if ord(c) < 128 else int.from_bytes(c.encode("johab"), "big")
    para = lambda body, n: struct.pack("<BHHBBIB", 1, n, 0, 0, 0, 0, 0) + shape + body
    end = struct.pack("<BHHBBIB", 1, 0, 0, 0, 0, 0, 0) + shape
    text = lambda t: para(struct.pack(f"<{len(t) + 1}H", *map(code, t), 13), len(t) + 1)
    body = bytes(16) + b"".join(map(text, texts))
    if rows:
        boxes = [(c * 10, r * 5, 10, 5) for r, row in enumerate(rows) for c in range(len(row))]
        cells = b"".join(struct.pack("<6H", 0, 0, *b) + bytes(15) for b in boxes) + b"".join(text(t) + end for row in rows for t in row) + end
        body += para(struct.pack("<H", 10) + bytes(4) + struct.pack("<H", 10) + bytes(78) + struct.pack("<HHH", 0, len(boxes), 0) + cells + struct.pack("<H", 13), 5)
    body += end
    if picture:
        body += struct.pack("<II", 1, 32 + len(picture)) + b"a.png".ljust(16, b"\0") + b"png".ljust(16, b"\0") + picture
    return b"HWP Document File V3.00 \x1a\1\2\3\4\5".ljust(30, b"\0") + bytes(124) + b"\1" + bytes(3 + 1008) + zlib.compress(body + bytes(8))[2:-4]


def pdf(texts: list[str], rows: Rows, picture: bytes) -> bytes:
    """Texts of ASCII, one below another; the table ruled; a picture as raw pixels 80 wide and 60 high is not supported here."""
    quoted = lambda t: t.replace("\\", "\\\\").replace("(", "\\(").replace(")", "\\)")
    show = lambda x, y, t: f"BT /F1 10 Tf {x} {y} Td ({quoted(t)}) Tj ET"
    parts, top = [show(100, 760 - 20 * i, t) for i, t in enumerate(texts)], 740 - 20 * len(texts)
    if rows:
        xs, ys = [100 + 200 * c for c in range(len(rows[0]) + 1)], [top - 40 * r for r in range(len(rows) + 1)]
        parts += [f"{x} {ys[-1]} m {x} {ys[0]} l S" for x in xs] + [f"{xs[0]} {y} m {xs[-1]} {y} l S" for y in ys]
        parts += [show(xs[c] + 10, ys[r] - 25, t) for r, row in enumerate(rows) for c, t in enumerate(row)]
    packed = zlib.compress(" ".join(parts).encode("latin-1"))
    return (
        b"%PDF-1.4\n1 0 obj <</Type/Catalog/Pages 2 0 R>> endobj\n2 0 obj <</Type/Pages/Kids[3 0 R]/Count 1/MediaBox[0 0 800 800]>> endobj\n"
        b"3 0 obj <</Type/Page/Parent 2 0 R/Contents 4 0 R/Resources<</Font<</F1 5 0 R>>>>>> endobj\n"
        + f"4 0 obj <</Length {len(packed)}/Filter/FlateDecode>> stream\n".encode()
        + packed
        + b"\nendstream endobj\n5 0 obj <</Type/Font/Subtype/Type1/BaseFont/Helvetica>> endobj\ntrailer <</Root 1 0 R>>"
    )


MAKERS = {"hml": hml, "hwpx": hwpx, "hwp": hwp5, "hwp3": hwp3, "pdf": pdf}


def documents(rows: DataFrame, fmt: str) -> DataFrame:
    """files(path, content) of rows(path, texts, cells, picture): a document of the format for each."""
    make = MAKERS[fmt]

    def run(batches):
        for b in batches:
            out = [make(r["texts"] or [], r["cells"] or [], r["picture"] or b"") for r in b.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], ["path", "content"])

    return spread(rows.select("path", "texts", "cells", "picture"), "path").mapInArrow(run, "path string, content binary")
