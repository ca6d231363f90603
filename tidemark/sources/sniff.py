"""What bytes say a file is: formats, protection and image types, as Catalyst expressions over binary columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Signatures in hex, and names.
CFB, HWP3, ZIP, PDF = "D0CF11E0A1B11AE1", b"HWP Document File".hex(), "504B0304", b"%PDF".hex()
EXTENSIONS = ("hwp", "hwpx", "hml", "pdf")
IMAGE_HINTS = "jpg jpeg png bmp gif tif tiff webp wmf emf svg ico pcx ole".split()
HEAD = 512


def _starts(c: Column, hex_: str) -> Column:
    return F.startswith(c, F.unhex(F.lit(hex_)))


def document_format(content: Column | str) -> Column:
    """hwp, hwp3, hwpx, pdf or hml by the first bytes; null for none."""
    head = F.substring(F.col(content) if isinstance(content, str) else content, 1, HEAD)
    text = F.decode(head, "ISO-8859-1")
    return F.when(_starts(head, CFB), "hwp").when(_starts(head, HWP3), "hwp3").when(_starts(head, ZIP), "hwpx").when(_starts(head, PDF), "pdf").when(text.contains("<?xml") & text.contains("HWPML"), "hml")


def extension(path: Column | str) -> Column:
    """The extension of a name in lower case, empty without one."""
    return F.lower(F.regexp_extract(path if isinstance(path, Column) else F.col(path), r"\.([^./\\]+)$", 1))


def routing_key(content: Column | str, path: Column | str) -> Column:
    """What the bytes say, else what the name says."""
    return F.coalesce(document_format(content), extension(path))


def tagged(files: DataFrame) -> DataFrame:
    """files(path, content) with file_extn_nm (by name), actl_file_extn_nm (by content) and mislabelled."""
    out = files.withColumn("file_extn_nm", extension("path")).withColumn("actl_file_extn_nm", document_format("content"))
    return out.withColumn("mislabelled", F.coalesce(F.col("file_extn_nm") != F.col("actl_file_extn_nm"), F.lit(False)))


def _any_case(ext: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in ext)


def scan_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, modificationTime, length, content) of the documents below a folder, whatever their names' case.

    Other files are never opened, and plans that do not ask for content never read it. Spark's source passes over empty
    files, which a survey must tell of: they are what its listing has and its rows lack.
    """
    names = "*.{" + ",".join(map(_any_case, EXTENSIONS)) + "}"
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(path)
    listed = files.inputFiles()
    plain = lambda c: F.regexp_replace(F.expr(f"url_decode(replace({c}, '+', '%2B'))"), "^file:/+", "file:/")
    every = spark.createDataFrame([(p,) for p in listed], "p string").select("p", plain("p").alias("k"))
    there = files.select(F.regexp_replace("path", "^file:/+", "file:/").alias("k"))
    empty = every.join(there, "k", "left_anti").select(F.col("k").alias("path"), F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), F.lit(b"").alias("content"))
    return files.unionByName(empty)


def in_order(files: DataFrame) -> DataFrame:
    """files by path, as a listing shows them; a sort over all, for what people read."""
    return files.orderBy("path")


def _byte(c: Column, i: int) -> Column:
    """An unsigned byte at a place from 0; null past the end."""
    return F.conv(F.nullif(F.hex(F.substring(c, i + 1, 1)), F.lit("")), 16, 10).try_cast("int")


def image_type(content: Column | str, hint: Column | str | None = None) -> Column:
    """An image's extension by its bytes, else by a known hint (a name or a media type), else bin."""
    c = F.col(content) if isinstance(content, str) else content
    head = F.substring(c, 1, 256)
    at = lambda i, hex_: F.hex(F.substring(head, i + 1, len(hex_) // 2)) == hex_
    low = F.lower(F.decode(head, "ISO-8859-1"))
    size = sum((_byte(head, 2 + i).cast("long") * (1 << (8 * i)) for i in range(1, 4)), _byte(head, 2).cast("long"))
    found = (
        F.when(at(0, "FFD8"), "jpg")
        .when(at(0, "89504E470D0A1A0A"), "png")
        .when(at(0, "47494638"), "gif")
        .when(at(0, "424D") & (size > 0), "bmp")
        .when(at(0, "49492A00") | at(0, "4D4D002A"), "tif")
        .when(at(0, "52494646") & at(8, "57454250"), "webp")
        .when(at(0, "D7CDC69A") | at(0, "01000900"), "wmf")
        .when(at(0, "01000000") & at(40, "20454D46"), "emf")
        .when(at(0, "00000100"), "ico")
        .when(at(0, CFB), "ole")
        .when(low.contains("<svg") | (low.startswith("<?xml") & low.contains("svg")), "svg")
    )
    if hint is None:
        return F.coalesce(found, F.lit("bin"))
    text = F.lower(F.trim(F.col(hint) if isinstance(hint, str) else hint))
    word = F.trim(F.regexp_extract(text, r"([^./]*?)(?:;.*)?$", 1))
    word = F.when(word.isin("x-emf", "x-wmf"), F.substring(word, 3, 3)).when(word == "svg+xml", "svg").otherwise(word)
    return F.coalesce(found, F.when(word.isin(*IMAGE_HINTS), word), F.lit("bin"))


def magic(content: Column | str) -> Column:
    """The first eight bytes in hex, for messages."""
    c = F.col(content) if isinstance(content, str) else content
    return F.when(F.coalesce(F.length(c), F.lit(0)) == 0, "(비어 있음)").otherwise(F.hex(F.substring(c, 1, 8)))


def header_protection(header: Column | str) -> Column:
    """DRM, PASSWORD or DISTRIBUTION by the properties of an hwp FileHeader stream; null for none or too short a stream."""
    c = F.col(header) if isinstance(header, str) else header
    low, high = _byte(c, 36), _byte(c, 37)
    bit = lambda b, i: F.coalesce(b.bitwiseAND(F.lit(1 << i)) != 0, F.lit(False))
    drm = bit(low, 4) | bit(high, 0) | bit(high, 2)
    return F.when(F.length(c) < 40, None).when(drm, "DRM").when(bit(low, 1), "PASSWORD").when(bit(low, 2), "DISTRIBUTION")
