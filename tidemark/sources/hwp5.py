"""Documents of HWP 5.0: records in the (mostly compressed) streams of a compound file."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from tidemark.sources.compound import CompoundFile
from tidemark.sources.document import Cell, Document, register

# Tags of records, bits of the header, and control characters that take eight places.
PARA_HEADER, PARA_TEXT, CTRL_HEADER, LIST_HEADER, SHAPE, TABLE, PICTURE = 66, 67, 71, 72, 76, 77, 85
COMPRESSED, PASSWORD, DISTRIBUTION, DRM, CERTIFIED, CERTIFIED_DRM = 0, 1, 2, 4, 8, 10
WIDE = {1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23}


class Locked(OSError):
    """A document that cannot be read without what locks it."""


def protection(header: bytes) -> str | None:
    bits = struct.unpack_from("<I", header, 36)[0] if len(header) >= 40 else 0
    has = lambda i: bits >> i & 1
    return "DRM" if has(DRM) or has(CERTIFIED) or has(CERTIFIED_DRM) else "PASSWORD" if has(PASSWORD) else "DISTRIBUTION" if has(DISTRIBUTION) else None


def inflate(data: bytes) -> bytes:
    return zlib.decompressobj(-15).decompress(data)


def records(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(tag, level, body) of a stream."""
    at = 0
    while at + 4 <= len(data):
        head = struct.unpack_from("<I", data, at)[0]
        at += 4
        size = head >> 20
        if size == 0xFFF:
            size = struct.unpack_from("<I", data, at)[0]
            at += 4
        yield head & 0x3FF, head >> 10 & 0x3FF, data[at : at + size]
        at += size


def plain_text(body: bytes) -> str:
    codes, out, i = struct.unpack(f"<{len(body) // 2}H", body[: len(body) // 2 * 2]), [], 0
    while i < len(codes):
        c = codes[i]
        if c >= 32:
            out.append(c)
        elif c in (9, 10, 24, 30, 31):
            out.append({9: 9, 10: 10, 24: 45}.get(c, 32))
        i += 8 if c in WIDE else 1
    return struct.pack(f"<{len(out)}H", *out).decode("utf-16-le", "replace")


class _Node:
    def __init__(self, tag: int, level: int, body: bytes) -> None:
        self.tag, self.level, self.body, self.below = tag, level, body, []


def forest(data: bytes) -> list[_Node]:
    """Records under those of a lower level before them."""
    top: list[_Node] = []
    stack: list[_Node] = []
    for tag, level, body in records(data):
        node = _Node(tag, level, body)
        while stack and stack[-1].level >= level:
            stack.pop()
        (stack[-1].below if stack else top).append(node)
        stack.append(node)
    return top


def _paragraphs(nodes: list[_Node]) -> list[str]:
    found = ("".join(plain_text(t.body) for t in n.below if t.tag == PARA_TEXT).strip() for n in nodes if n.tag == PARA_HEADER)
    return [t for t in found if t]


def _table(control: _Node) -> tuple[list[Cell], int, int, str | None] | None:
    body = next((n for n in control.below if n.tag == TABLE), None)
    if body is None or len(body.body) < 8:
        return None
    n_rows, n_cols = struct.unpack_from("<HH", body.body, 4)
    cells, caption, seen, now = [], [], False, None
    for n in control.below:  # lists and their paragraphs stand side by side
        if n.tag == TABLE:
            seen = True
        elif n.tag == LIST_HEADER:
            now = None
            if seen and len(n.body) >= 16:
                col, row, cs, rs = struct.unpack_from("<HHHH", n.body, 8)
                now = Cell(row, col, max(1, rs), max(1, cs), "\n".join(_paragraphs(n.below)))
                cells.append(now)
            else:
                caption += _paragraphs(n.below)
        elif n.tag == PARA_HEADER:
            texts = _paragraphs([n])
            if now is not None:
                now.text = "\n".join(filter(None, [now.text, *texts]))
            else:
                caption += texts
    return cells, n_rows, n_cols, "\n".join(caption) or None


def _pictures(node: _Node, caption: str | None = None) -> Iterator[tuple[int, str | None]]:
    """(number of the image's stream, caption) of the pictures below a control."""
    for n in node.below:
        if n.tag == LIST_HEADER and node.tag == CTRL_HEADER:
            caption = "\n".join(_paragraphs(n.below) or _paragraphs(node.below)) or caption
    for n in node.below:
        if n.tag == PICTURE and len(n.body) >= 73:
            yield struct.unpack_from("<H", n.body, 71)[0], caption
        yield from _pictures(n, caption)


@register("hwp", "compound-records")
def read(data: bytes) -> Document:
    container, out = CompoundFile(data), Document()
    header = container.read("FileHeader")
    lock = protection(header)
    if lock in ("PASSWORD", "DRM"):
        raise Locked(f"{lock}: the document is locked")
    packed = struct.unpack_from("<I", header, 36)[0] & 1
    unpack = inflate if packed else bytes
    captions: dict[int, str | None] = {}
    order: list[int] = []
    names = [n for n in container.names() if n.startswith("BodyText/Section")]
    for name in sorted(names, key=lambda n: int(n.rpartition("Section")[2] or 0)):
        for para in forest(unpack(container.read(name))):
            if para.tag != PARA_HEADER:
                continue
            out.paragraph("".join(plain_text(t.body) for t in para.below if t.tag == PARA_TEXT))
            for control in para.below:
                if control.tag != CTRL_HEADER:
                    continue
                kind = control.body[:4][::-1]
                if kind == b"tbl " and (table := _table(control)):
                    out.table(*table)
                for number, caption in _pictures(control):
                    order.append(number)
                    captions[number] = caption or captions.get(number)
    streams = {}
    for n in container.names():
        if n.startswith("BinData/BIN"):
            stem, _, ext = n[len("BinData/BIN") :].partition(".")
            streams[int(stem, 16)] = (ext.lower(), n)  # a stream's number is hexadecimal
    for number in dict.fromkeys([*order, *sorted(streams)]):
        if number in streams:
            ext, name = streams[number]
            raw = container.read(name)
            try:
                raw = inflate(raw) if packed else raw
            except zlib.error:
                pass  # an image may be stored as it is
            out.image(ext, raw, captions.get(number))
    return out
