"""Documents in XML: HWPX (a zip of sections) and HML (one file). Entities and DTDs are refused."""

from __future__ import annotations

import base64
import io
import zipfile
import zlib
from xml.etree import ElementTree as ET

from tidemark.sources.document import Cell, Document, register
from tidemark.sources.hwp5 import Locked


def _attr(e: ET.Element, *names: str) -> str | None:
    for k, v in e.items():
        if k.rpartition("}")[2] in names:
            return v
    return None


def _int(e: ET.Element | None, *names: str, default: int = 0) -> int:
    text = _attr(e, *names) if e is not None else None
    return int(text) if text and text.strip().lstrip("-").isdigit() else default


def parse_xml(data: bytes) -> ET.Element:
    """The root; tags are without their namespaces, so that elements are found by name inside the parser's own code."""
    if b"<!DOCTYPE" in data[:4096] or b"<!ENTITY" in data[:4096]:
        raise ET.ParseError("XML with a DTD is refused")
    root = ET.fromstring(data)
    for e in root.iter():
        if e.tag[0] == "{":
            e.tag = e.tag.rpartition("}")[2]
    return root


# ---- HWPX

#: What stands inside a text for a character.
MARKS = {"tab": "\t", "lineBreak": "\n", "fwSpace": " ", "nbSpace": " "}


def _text(t: ET.Element) -> str:
    parts = [t.text or ""]
    for c in t:
        parts += [MARKS.get(c.tag, ""), c.tail or ""]
    return "".join(parts)


def _para_text(p: ET.Element) -> str:
    return "".join(_text(t) for run in p.findall("run") for t in run.findall("t"))


def _list_text(e: ET.Element | None) -> str:
    lists = e.findall("subList") if e is not None else []
    return "\n".join(t for s in lists for p in s.findall("p") if (t := _para_text(p).strip()))


def manifest_protection(manifest: str | None) -> tuple[str, list[str]] | None:
    """("PASSWORD", the locked entries) of a manifest that names encrypted entries."""
    if not manifest or "encryption-data" not in manifest:
        return None
    entries = list(parse_xml(manifest.encode()).iter("file-entry"))
    locked = [_attr(e, "full-path") or "" for e in entries if next(e.iter("encryption-data"), None) is not None]
    return ("PASSWORD", locked) if locked else None


@register("hwpx", "zip-sections")
def read_hwpx(data: bytes) -> Document:
    archive, out = zipfile.ZipFile(io.BytesIO(data)), Document()
    names = set(archive.namelist())
    lock = manifest_protection(archive.read("META-INF/manifest.xml").decode("utf-8", "replace") if "META-INF/manifest.xml" in names else None)
    if lock:
        raise Locked(f"{lock[0]}: {', '.join(lock[1][:6])}")
    files: dict[str, tuple[str, str]] = {}
    if "Contents/content.hpf" in names:
        for item in parse_xml(archive.read("Contents/content.hpf")).iter("item"):
            href = _attr(item, "href") or ""
            files[_attr(item, "id") or ""] = (next((n for n in (href, f"Contents/{href}") if n in names), ""), href or _attr(item, "media-type") or "")
    sections = sorted((n for n in names if n.startswith("Contents/section") and n.endswith(".xml")), key=lambda n: int("".join(filter(str.isdigit, n)) or 0))

    def picture(pic: ET.Element) -> None:
        ref = next(pic.iter("img"), None)
        name, hint = files.get(_attr(ref, "binaryItemIDRef") or "", ("", "")) if ref is not None else ("", "")
        if name:
            out.image(hint.rpartition(".")[2].lower(), archive.read(name), _list_text(pic.find("caption")) or None)

    for name in sections:
        for p in parse_xml(archive.read(name)).findall("p"):
            out.paragraph(_para_text(p))
            for item in (i for run in p.findall("run") for i in run):
                if item.tag == "tbl":
                    cells = []
                    for tc in (tc for tr in item.findall("tr") for tc in tr.findall("tc")):
                        at, span = tc.find("cellAddr"), tc.find("cellSpan")
                        cells.append(Cell(_int(at, "rowAddr"), _int(at, "colAddr"), _int(span, "rowSpan", default=1), _int(span, "colSpan", default=1), _list_text(tc)))
                    out.table(cells, _int(item, "rowCnt"), _int(item, "colCnt"), _list_text(item.find("caption")) or None)
                    inner = [q for tc in item.iter("tc") for s in tc.findall("subList") for c in s.findall("p") for run in c.findall("run") for q in run.findall("pic")]
                    for q in inner:
                        picture(q)
                elif item.tag == "pic":
                    picture(item)
    return out


# ---- HML


def _chars(e: ET.Element, skip: tuple[str, ...] = ("TABLE", "PICTURE")) -> str:
    parts = []
    for c in e:
        name = c.tag
        if name in skip:
            continue
        if name == "CHAR":
            parts.append("".join(c.itertext()))
        elif name in ("TAB", "LINEBREAK", "NBSPACE", "FWSPACE"):
            parts.append({"TAB": "\t", "LINEBREAK": "\n"}.get(name, " "))
        else:
            parts.append(_chars(c, skip))
    return "".join(parts)


def _unpack(data: bytes) -> bytes:
    for wbits in (15, -15):
        try:
            return zlib.decompressobj(wbits).decompress(data)
        except zlib.error:
            continue
    return data


@register("hml", "single-xml")
def read_hml(data: bytes) -> Document:
    root, out = parse_xml(data), Document()
    binaries = {_attr(e, "Id"): e for e in root.iter("BINDATA")}
    formats = {_attr(e, "BinData"): (_attr(e, "Format") or "").lower() for e in root.iter("BINITEM")}
    body = root.find("BODY")
    for section in body.findall("SECTION") if body is not None else []:
        for p in section.findall("P"):
            out.paragraph(_chars(p))
            tables = list(p.iter("TABLE"))
            nested = {id(t) for outer in tables for t in outer.iter("TABLE") if t is not outer}
            for t in (t for t in tables if id(t) not in nested):
                cells = [
                    Cell(_int(c, "RowAddr"), _int(c, "ColAddr"), _int(c, "RowSpan", default=1), _int(c, "ColSpan", default=1), "\n".join(x for q in c.iter("P") if (x := _chars(q).strip())))
                    for row in t.findall("ROW")
                    for c in row.findall("CELL")
                ]
                caption = next(t.iter("CAPTION"), None)
                out.table(cells, _int(t, "RowCount"), _int(t, "ColCount"), _chars(caption).strip() if caption is not None else None)
            for image in p.iter("IMAGE"):
                found = binaries.get(_attr(image, "BinItem"))
                if found is not None:
                    raw = base64.b64decode("".join((found.text or "").split()))
                    out.image(formats.get(_attr(image, "BinItem"), ""), _unpack(raw) if (_attr(found, "Compress") or "").lower() == "true" else raw)
    return out
