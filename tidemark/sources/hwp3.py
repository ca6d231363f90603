"""Documents of HWP 3.0: one stream of paragraphs with binary controls inside.

A layout is a row of the tables below; the reader walks the stream by them.
"""

from __future__ import annotations

import struct
import zlib

from tidemark.sources.document import Cell, Document, register

# Fixed values of the format: where blocks lie, how long they are, how many characters and bytes a control takes.
SIGNATURE, INFO_AT, INFO, SUMMARY = b"HWP Document File", 30, 128, 1008
ENCRYPTED_AT, PACKED_AT, BLOCK_AT = 96, 124, 126
FONT, LANGUAGES, STYLE, CHAR_SHAPE, PARA_SHAPE, LINE = 40, 7, 20 + 31 + 187, 31, 187, 14
PLACES = [1, 4, 4, 4, 4, 4, 4, 42, 48, 4, 4, 4, 4, 1, 4, 4, 4, 4, 4, 4, 4, 4, 12, 5, 3, 3, 123, 4, 32, 4, 2, 2]
FIXED = {7: 82, 8: 94, 9: 6, 14: 90, 18: 6, 19: 6, 20: 6, 21: 6, 22: 22, 23: 8, 24: 4, 25: 4, 26: 244, 28: 62, 30: 2, 31: 2}
BLOCKS = {0, 1, 2, 3, 4, 12, 27, 29}
LISTS = {15: 14, 16: 16, 17: 20}
MAX_CELLS, MAX_DEPTH = 4096, 32
UNKNOWN = "□"


class Damaged(OSError):
    """A stream that ends or turns where it must not."""


# Fixed values of the format: where each kind of character begins, and the standard's rows (KS X 1001) that they stand for.
HANJA_AT, HANJA, HANJA_ROW = 0x4000, 4888, 0xCA
RULES_AT, RULES = 0x3013, "+++++++++-|"
BULLETS_AT, BULLETS = 0x2F00, (0xA1E0, 0xA1DB, 0xA1DE, 0xA1E2, 0xA1E4, 0xA2B7, 0xA2B9)
SIGNS_AT, SIGNS_END, SIGNS_ROW, ROW = 0x3400, 0x37C0, 0xA1, 0x60
KANA_PAGE, KANA_ROW = 0x1F, 0xAA
SINGLE = {0x81: '"', 0x82: '"', 0x83: "'", 0x84: "'", 0x309B: "｢", 0x309D: "｣"} | {SIGNS_END + i: c for i, c in enumerate("한글과컴퓨터")}


def _pair(row: int, cell: int, charset: str = "euc_kr") -> str:
    """The character at a row and a cell of a charset, a box where there is none."""
    try:
        found = bytes((row, cell)).decode(charset)
    except (UnicodeDecodeError, ValueError):
        return UNKNOWN
    return found if len(found) == 1 else UNKNOWN


def decode_char(code: int) -> str:
    """A character of the document, by the range that its code is in."""
    page, low = code >> 8, code & 0xFF
    if code < 128:
        return chr(code)
    if code >= 0x8000:
        return _pair(page, low, "johab")
    if code >= HANJA_AT:
        row, cell = divmod(code - HANJA_AT, 94)
        return _pair(HANJA_ROW + row, 0xA1 + cell) if code - HANJA_AT < HANJA else UNKNOWN
    if code in SINGLE:
        return SINGLE[code]
    if RULES_AT <= code < RULES_AT + 7 * len(RULES):
        return RULES[(code - RULES_AT) % len(RULES)]
    if page == BULLETS_AT >> 8 and low < 16 * len(BULLETS) and code % 16 < 9:
        return _pair(*divmod(BULLETS[low // 16] + (code % 16 >= 6), 256))
    if page == KANA_PAGE:
        return _pair(KANA_ROW + (low >= ROW), 0xA0 + low - ROW * (low >= ROW)) if low < 2 * ROW else UNKNOWN
    if SIGNS_AT <= code < SIGNS_END and low < 0xC0:
        row, cell = divmod(code - SIGNS_AT, ROW)
        return _pair(SIGNS_ROW + row + 2 * (SIGNS_ROW + row == KANA_ROW), 0xA0 + cell)
    return UNKNOWN


class _Stream:
    def __init__(self, data: bytes) -> None:
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise Damaged(f"{n} bytes are missing at {self.at}")
        self.at += n
        return self.data[self.at - n : self.at]

    def u8(self) -> int:
        return self.take(1)[0]

    def u16(self) -> int:
        return struct.unpack("<H", self.take(2))[0]

    def u32(self) -> int:
        return struct.unpack("<I", self.take(4))[0]

    def left(self) -> int:
        return len(self.data) - self.at


def _texts(items: list) -> list[str]:
    return [t for i in items for t in ([i] if isinstance(i, str) else [c.text for c in i]) if t]


def _table(boxes: list[tuple[int, int, int, int]], texts: list[str]) -> list[Cell]:
    """Cells by the places of their edges among all edges."""
    xs = {v: i for i, v in enumerate(sorted({v for x, _, w, _ in boxes for v in (x, x + w)}))}
    ys = {v: i for i, v in enumerate(sorted({v for _, y, _, h in boxes for v in (y, y + h)}))}
    return [Cell(ys[y], xs[x], max(1, ys[y + h] - ys[y]), max(1, xs[x + w] - xs[x]), t) for (x, y, w, h), t in zip(boxes, texts)]


def _paragraphs(s: _Stream, depth: int = 0) -> list:
    """Texts and tables (lists of cells) of a list of paragraphs, up to the empty one that ends it."""
    if depth > MAX_DEPTH:
        raise Damaged("lists are nested too deep")
    out: list = []
    while s.left() >= 12 + CHAR_SHAPE:
        same_shape, chars, lines, shaped = s.u8(), s.u16(), s.u16(), s.u8()
        s.take(6 + CHAR_SHAPE)
        if not chars:
            return out
        s.take(0 if same_shape else PARA_SHAPE)
        s.take(lines * LINE)
        for _ in range(chars if shaped else 0):
            if s.u8() == 0:
                s.take(CHAR_SHAPE)
        text, used = [], 0
        while used < chars:
            code = s.u16()
            if code == 13:
                break
            if code > 31:
                text.append(decode_char(code))
                used += 1
                continue
            if flat := "".join(text).strip():
                out.append(flat)
            text = []
            out += _control(s, code, depth)
            used += PLACES[code]
        if flat := "".join(text).strip():
            out.append(flat)
    s.at = len(s.data)
    return out


def _control(s: _Stream, code: int, depth: int) -> list:
    if code in FIXED:
        s.take(FIXED[code])
    elif code in BLOCKS:
        size = s.u32()
        s.take(2 + size)
    elif code == 5:
        s.take(36)
        sizes = [s.u32() for _ in range(4)]
        s.take(sum(sizes))
    elif code == 6:
        s.take(40)
    elif code in LISTS:  # what stands in hidden notes, headers and footnotes is not the body's
        s.take(LISTS[code])
        _paragraphs(s, depth + 1)
    elif code == 10:
        s.take(4 + 2 + 8 + 60 + 10)
        kind, n = s.u16(), s.u16()
        s.take(2)
        if not 0 < n <= MAX_CELLS:
            raise Damaged(f"{n} cells make no sense")
        boxes = []
        for _ in range(n):
            boxes.append(struct.unpack_from("<HHHH", s.take(27), 4))
        texts = [" ".join(_texts(_paragraphs(s, depth + 1))) for _ in range(n)]
        caption = _paragraphs(s, depth + 1)
        return [_table(boxes, texts) if kind == 0 else t for t in ([None] if kind == 0 else filter(None, texts))] + caption
    elif code == 11:
        s.take(6)
        more = s.u32()
        s.take(4 + 60 + 6 + 1 + 8 + 265 + more)
        return _paragraphs(s, depth + 1)
    else:
        raise Damaged(f"control {code} is unknown at {s.at - 2}")
    return []


@register("hwp3", "paragraph-stream")
def read(data: bytes) -> Document:
    if not data.startswith(SIGNATURE):
        raise Damaged("the signature is another")
    info = data[INFO_AT : INFO_AT + INFO]
    if len(info) < INFO:
        raise Damaged("the document's block is cut off")
    if struct.unpack_from("<H", info, ENCRYPTED_AT)[0]:
        raise Damaged("the document has a password")
    start = INFO_AT + INFO + SUMMARY + struct.unpack_from("<H", info, BLOCK_AT)[0]
    body = data[start:]
    if info[PACKED_AT]:
        body = zlib.decompressobj(-15).decompress(body)
    s, out = _Stream(body), Document()
    for _ in range(LANGUAGES):
        s.take(s.u16() * FONT)
    s.take(s.u16() * STYLE)
    for item in _paragraphs(s):
        out.paragraph(item) if isinstance(item, str) else out.table(item)
    while s.left() >= 8:
        tag, size = s.u32(), s.u32()
        if not tag or size > s.left():
            break
        block = s.take(size)
        if tag == 1 and size > 32:
            out.image(block[16:32].split(b"\0")[0].decode("ascii", "replace").strip().lower(), block[32:])
    return out
