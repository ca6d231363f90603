"""The shape that every reader gives: ordered paragraphs and tables, and images. And the readers' registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

#: The rows of raw documents. pos is an item's place, so that no plan relies on the order of an array.
RAW_SCHEMA = (
    "atch_file_nm string, atch_file_path string, file_extn_nm string, actl_file_extn_nm string, scan_yn boolean,"
    " content array<struct<pos:int,type:string,text:string,n_rows:int,n_cols:int,caption:string,"
    "cells:array<struct<row:int,col:int,row_span:int,col_span:int,text:string>>,grid:array<array<string>>>>,"
    " images array<struct<name:string,path:string,size:bigint,caption:string,ocr_text:string>>"
)


@dataclass
class Cell:
    row: int
    col: int
    row_span: int = 1
    col_span: int = 1
    text: str = ""


@dataclass
class Document:
    content: list[dict] = field(default_factory=list)
    images: list[tuple[str, bytes, str | None]] = field(default_factory=list)  # (extension, bytes, caption)
    first_page: tuple[int, int] | None = None  # its characters and images, where a format has pages

    def paragraph(self, text: str | None) -> None:
        if text and text.strip():
            self.content.append({"pos": len(self.content), "type": "paragraph", "text": text.strip()})

    def table(self, cells: list[Cell], n_rows: int = 0, n_cols: int = 0, caption: str | None = None) -> None:
        """A table from its cells; a merged cell's text stands in every coordinate that it covers."""
        n_rows = max([n_rows, *(c.row + 1 for c in cells)], default=0)
        n_cols = max([n_cols, *(c.col + 1 for c in cells)], default=0)
        grid = [[""] * n_cols for _ in range(n_rows)]
        for c in cells:
            for r in range(c.row, min(c.row + max(1, c.row_span), n_rows)):
                for k in range(c.col, min(c.col + max(1, c.col_span), n_cols)):
                    grid[r][k] = c.text
        self.content.append({"pos": len(self.content), "type": "table", "n_rows": n_rows, "n_cols": n_cols, "caption": caption or None, "cells": [vars(c) for c in cells], "grid": grid})

    def image(self, ext: str, data: bytes, caption: str | None = None) -> None:
        self.images.append((ext, data, caption or None))

    @property
    def text_chars(self) -> int:
        """Characters of the body that are not white space."""
        texts = [c.get("text") or "" for c in self.content] + [x["text"] for c in self.content for x in c.get("cells") or ()]
        return sum(len("".join(t.split())) for t in texts)


Reader = Callable[[bytes], Document]
READERS: dict[str, Reader] = {}
ENGINES: dict[str, str] = {}


def register(key: str, engine: str) -> Callable[[Reader], Reader]:
    """Makes a reader the one for a format; the last that registers wins."""

    def put(reader: Reader) -> Reader:
        READERS[key], ENGINES[key] = reader, engine
        return reader

    return put


def reader_for(key: str, engine: str | None = None) -> Reader:
    """The reader of a format, or of an engine that is asked for by name."""
    if engine:
        key = next((k for k, e in ENGINES.items() if e == engine), "")
        if not key:
            raise ValueError(f"no engine is called {engine}")
    if key not in READERS:
        raise ValueError(f"지원하지 않는 확장자: {key}")
    return READERS[key]


Detector = Callable[[Document], bool]
DETECTORS: dict[str, Detector] = {}
#: A document with fewer characters has no text.
MIN_TEXT = 1


def detects(*keys: str) -> Callable[[Detector], Detector]:
    """Makes a detector of scans the one for some formats; the last that registers wins."""

    def put(detector: Detector) -> Detector:
        DETECTORS.update(dict.fromkeys(keys, detector))
        return detector

    return put


def is_scan(key: str, doc: Document) -> bool:
    """Whether a document is a picture of one, by its format's detector; a format without one is an error."""
    if key not in DETECTORS:
        raise ValueError(f"지원하지 않는 확장자: {key}")
    return DETECTORS[key](doc)


@detects("hwp", "hwp3", "hwpx", "hml")
def images_only(doc: Document) -> bool:
    """No text in the body, its tables and captions, but an image. Headers and footers are no part of the body."""
    captions = sum(len("".join((c or "").split())) for _, _, c in doc.images)
    return doc.text_chars + captions < MIN_TEXT and bool(doc.images)


@detects("pdf")
def image_first(doc: Document) -> bool:
    """The first page speaks for all: annexes of pictures make no scan of a document, nor later text none of one."""
    chars, images = doc.first_page or (0, 0)
    return chars < MIN_TEXT and images > 0


def sieve(images: list[tuple[str, bytes, str | None]]) -> Iterator[tuple[str, bytes, str | None]]:
    from tidemark.sources.images import accept

    return (i for i in images if accept(i[1]))
