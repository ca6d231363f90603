"""Documents out of files: detection and extraction in one pass over the bytes, an error a row of its own."""

from __future__ import annotations

import hashlib
import json
import os
import subprocess
import tempfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.sources import hwp3, hwp5, pdf, xml_documents  # noqa: F401  they register themselves
from tidemark.sources.document import ENGINES, RAW_SCHEMA, Document, is_scan, reader_for, sieve
from tidemark.sources.sniff import document_format, extension, routing_key

READ_SCHEMA = RAW_SCHEMA + ", extc_engn_nm string, text_chars bigint, n_images int, protection string, error string, message string, sniffed string"
#: Seconds that an OCR run may take.
OCR_SECONDS = 3600
#: Documents, and characters of them, that leave a worker together.
BATCH_ROWS, BATCH_CHARS = 256, 1 << 20


def protection_of(key: str, data: bytes) -> str | None:
    """What locks a document, whatever state the rest of it is in."""
    try:
        if key == "hwp":
            from tidemark.sources.compound import CompoundFile

            return hwp5.protection(CompoundFile(data).read("FileHeader"))
        if key == "hwpx":
            import io
            import zipfile

            archive = zipfile.ZipFile(io.BytesIO(data))
            found = xml_documents.manifest_protection(archive.read("META-INF/manifest.xml").decode("utf-8", "replace"))
            return found[0] if found else None
    except Exception:  # a container that cannot be opened locks nothing
        return None
    return None


def run_ocr(command: list[str], data: bytes, ext: str, seconds: int = OCR_SECONDS) -> Document:
    """A scan through an outer program: command + --source-file, --file-type, --output; it writes {"blocks": [..]}."""
    with tempfile.TemporaryDirectory() as folder:
        source, target = Path(folder, f"scan.{ext}"), Path(folder, "out.json")
        source.write_bytes(data)
        process = subprocess.Popen([*command, "--source-file", str(source), "--file-type", ext, "--output", str(target)], stdout=subprocess.PIPE, stderr=subprocess.STDOUT, start_new_session=True)
        try:
            log, _ = process.communicate(timeout=seconds)
        except subprocess.TimeoutExpired:
            import signal

            os.killpg(process.pid, signal.SIGKILL)  # with all that it started
            process.communicate()
            raise
        if process.returncode:
            raise RuntimeError(f"OCR ended with {process.returncode}: {log.decode('utf-8', 'replace')[-2000:]}")
        return blocks_document(json.loads(target.read_text("utf-8")).get("blocks", []))


def blocks_document(blocks: list[dict]) -> Document:
    """A document of OCR's blocks: tables by their HTML or Markdown, pictures left out, all else paragraphs without marks."""
    from tidemark.operators.render import parse_html_tables
    from tidemark.sources.document import Cell

    out = Document()
    for b in blocks:
        label, text = (b.get("label") or "").lower(), b.get("content") or ""
        if label == "table":
            cells = [Cell(r, c, 1, 1, t) for k, r, c, t in parse_html_tables(text) if k == 0]
            if not cells:
                rows = [x.strip().strip("|").split("|") for x in text.splitlines() if x.strip().startswith("|") and not set(x.strip()) <= set("|-: ")]
                cells = [Cell(r, c, 1, 1, v.strip()) for r, row in enumerate(rows) for c, v in enumerate(row)]
            if cells:
                out.table(cells)
        elif label not in ("image", "chart", "seal"):
            out.paragraph(text)
    return out


def saver(folder: str) -> Callable[[str, str, bytes], str]:
    """A function (document's path, name, bytes) -> path that puts files below a folder, each document's in one of its own.

    Names of documents that are equal in two folders do not meet; a task that runs again writes the same files.
    """
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{os.path.abspath(folder)}")

    def save(document: str, name: str, data: bytes) -> str:
        own = f"{root}/{hashlib.sha256(document.encode()).hexdigest()[:16]}"
        store.create_dir(own)
        with store.open_output_stream(f"{own}/{name}") as out:
            out.write(data)
        return f"{own}/{name}"

    return save


def read_one(path: str, data: bytes, key: str, ext: str, engine: str | None = None, ocr: Callable[[bytes, str], Document] | None = None, save: Callable[[str, str, bytes], str] | None = None) -> dict:
    """A row of READ_SCHEMA for a file. An engine that is asked for reads as it is told: nothing is taken for a scan."""
    row = {"atch_file_nm": path.rpartition("/")[2], "atch_file_path": path, "file_extn_nm": ext, "actl_file_extn_nm": key, "scan_yn": False, "content": [], "images": [], "extc_engn_nm": engine or ENGINES.get(key), "text_chars": 0, "n_images": 0, "protection": None, "error": None, "message": None, "sniffed": None}
    try:
        if not data:
            raise OSError("the file is empty")
        doc = reader_for(key, engine)(data)
        scanned = not engine and is_scan(key, doc)
        row |= {"text_chars": doc.text_chars, "n_images": len(doc.images), "scan_yn": scanned}
        if scanned and ocr:
            doc, row["extc_engn_nm"] = ocr(data, key), "ocr"
        stem = row["atch_file_nm"].rpartition(".")[0] or row["atch_file_nm"]
        row["content"] = doc.content
        for i, (e, raw, c) in enumerate(sieve(doc.images)):
            name = f"{stem}_img{i}.{e}"
            row["images"].append({"name": name, "path": save(path, name, raw) if save else None, "size": len(raw), "caption": c, "ocr_text": None})
    except Exception as e:  # a bad file is a row, never the end of a job
        from tidemark.operators.survey import describe_error, root_cause

        row |= {"error": type(root_cause(e)).__name__, "message": describe_error(e), "protection": protection_of(key, data)}
    return row


def read_documents(files: DataFrame, engine: str | None = None, ocr_command: list[str] | None = None, image_folder: str | None = None) -> DataFrame:
    """READ_SCHEMA rows of files(path, content): each parsed once, for its text, its tables, its images and its state.

    With a folder, images that pass the sieve are put there, and their rows have the paths.
    """
    schema = to_arrow_schema(_parse_datatype_string(READ_SCHEMA))
    ocr = (lambda data, ext: run_ocr(ocr_command, data, ext)) if ocr_command else None

    def run(batches):
        save = saver(image_folder) if image_folder else None
        rows, chars = [], 0
        for b in batches:
            for path, data, key, ext, fmt in zip(*b.columns):
                rows.append(read_one(path.as_py(), data.as_py() or b"", key.as_py() or "", ext.as_py() or "", engine, ocr, save) | {"sniffed": fmt.as_py()})
                chars += rows[-1]["text_chars"]
                if len(rows) >= BATCH_ROWS or chars >= BATCH_CHARS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, chars = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    keyed = files.select("path", "content", routing_key("content", "path").alias("key"), extension("path").alias("ext"), document_format("content").alias("fmt"))
    return keyed.mapInArrow(run, READ_SCHEMA)


def image_rows(raw: DataFrame) -> DataFrame:
    """(doc, pos, name, path, caption) of raw documents' images, in order."""
    each = raw.select(F.col("atch_file_path").alias("doc"), F.posexplode("images").alias("pos", "i"))
    return each.select("doc", "pos", "i.name", "i.path", "i.caption")


def image_table(files: DataFrame) -> DataFrame:
    """(path, img_no, ext, data) of the images that pass the sieve, in order; bytes leave the kernel only here."""

    def run(batches):
        for b in batches:
            for path, data, key in zip(*b.columns):
                try:
                    found = list(sieve(reader_for(key.as_py() or "")(data.as_py() or b"").images))
                except Exception:  # told by read_documents
                    continue
                yield pa.RecordBatch.from_pydict({"path": [path.as_py()] * len(found), "img_no": list(range(len(found))), "ext": [f[0] for f in found], "data": [f[1] for f in found]}, schema=pa.schema([("path", pa.string()), ("img_no", pa.int32()), ("ext", pa.string()), ("data", pa.binary())]))

    keyed = files.select("path", "content", routing_key("content", "path").alias("key"))
    return keyed.mapInArrow(run, "path string, img_no int, ext string, data binary")


def paragraphs(raw: DataFrame) -> DataFrame:
    """(doc, pos, text) of raw documents."""
    each = raw.select(F.col("atch_file_path").alias("doc"), F.explode("content").alias("c"))
    return each.where("c.type = 'paragraph'").select("doc", "c.pos", "c.text")


def table_cells(raw: DataFrame) -> DataFrame:
    """cells(doc, tbl, row, col, text) of raw documents' grids; tables are numbered from 0 as they stand."""
    from pyspark.sql.window import Window

    tables = _tables(raw)
    rows = tables.select("doc", "tbl", F.posexplode("grid").alias("row", "cells"))
    return rows.select("doc", "tbl", "row", F.posexplode("cells").alias("col", "text"))


def table_spans(raw: DataFrame) -> DataFrame:
    """spans(doc, tbl, row, col, row_span, col_span) of raw documents' cells."""
    return _tables(raw).select("doc", "tbl", F.explode("cells").alias("c")).select("doc", "tbl", "c.row", "c.col", "c.row_span", "c.col_span")


def _tables(raw: DataFrame) -> DataFrame:
    tables = F.filter("content", lambda c: c["type"] == "table")
    return raw.select(F.col("atch_file_path").alias("doc"), F.posexplode(tables).alias("tbl", "t")).select("doc", "tbl", "t.*")


def captions(raw: DataFrame) -> DataFrame:
    """(doc, text) of tables' and images' captions."""
    from_tables = _tables(raw).select("doc", F.col("caption").alias("text"))
    from_images = raw.select(F.col("atch_file_path").alias("doc"), F.explode("images").alias("i")).select("doc", F.col("i.caption").alias("text"))
    return from_tables.unionByName(from_images).where("text IS NOT NULL")


def read_json(spark, path: str, schema: str = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(rows, bad files) of JSON documents: unknown fields are ignored, a file that is no JSON is told and skipped."""
    text = spark.read.option("wholetext", True).text(path).select("value", F.input_file_name().alias("path"))
    parsed = F.from_json("value", schema + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    got = text.select("path", parsed.alias("j")).select("path", "j.*")
    return got.where("_bad IS NULL").drop("_bad", "path"), got.where("_bad IS NOT NULL").select("path")
