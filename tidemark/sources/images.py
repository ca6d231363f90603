"""Images: decoding what the standard library can, measuring ink, and sieving what is no content.

No image library is needed: PNG and BMP are decoded here; others count as undecodable, and those are kept.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

# Fixed values of the measure and of the sieve.
TOLERANCE, RED_LEAST, RED_LEAD, SCAN_PIXELS = 40, 90, 45, 40_000_000
LEAST_PIXELS, LEAST_MM, SPARSE_INK, SPARSE_SPREAD = 24, 3.0, 0.01, 0.25
STAMP_MM, STAMP_PIXELS, STAMP_ASPECT, STAMP_INK, STAMP_RED = 45.0, 600, (0.6, 1.7), (0.005, 0.6), 0.55


@dataclass(frozen=True)
class Measured:
    ink: float
    spread: float
    red: float
    width: int
    height: int


def _unfilter(raw: np.ndarray, height: int, stride: int, bpp: int) -> np.ndarray:
    rows, before = np.zeros((height, stride), np.uint8), np.zeros(stride, np.uint8)
    for y in range(height):
        kind, line = raw[y, 0], raw[y, 1:].copy()
        if kind == 1:
            line = line.reshape(-1, bpp).cumsum(0, dtype=np.uint8).reshape(-1) if stride % bpp == 0 else line
        elif kind == 2:
            line = line + before
        elif kind in (3, 4):
            left = np.zeros(bpp, np.int16)
            for x in range(0, stride, bpp):
                up = before[x : x + bpp].astype(np.int16)
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    corner = before[x - bpp : x].astype(np.int16) if x else np.zeros(bpp, np.int16)
                    p = left + up - corner
                    a, b, c = np.abs(p - left), np.abs(p - up), np.abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
                left = (line[x : x + bpp].astype(np.int16) + guess) & 0xFF
                line[x : x + bpp] = left.astype(np.uint8)
        rows[y] = before = line
    return rows


def decode_png(data: bytes) -> np.ndarray | None:
    """RGB over white of an 8-bit PNG that is not interlaced; null for others."""
    at, body, palette, clear = 8, b"", None, b""
    width = height = depth = kind = lace = 0
    while at + 8 <= len(data):
        size, tag = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if tag == b"IHDR":
            width, height, depth, kind, _, _, lace = struct.unpack(">IIBBBBB", part)
        elif tag == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif tag == b"tRNS":
            clear = part
        elif tag == b"IDAT":
            body += part
        at += 12 + size
    bands = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(kind)
    if depth != 8 or lace or not bands or not width or not height:
        return None
    raw = np.frombuffer(zlib.decompress(body), np.uint8)[: height * (width * bands + 1)].reshape(height, -1)
    pixels = _unfilter(raw, height, width * bands, bands).reshape(height, width, bands)
    if kind == 3:
        if palette is None:
            return None
        alpha = np.full(len(palette), 255, np.uint8)
        alpha[: len(clear)] = np.frombuffer(clear, np.uint8)[: len(palette)]
        index = np.minimum(pixels[..., 0], len(palette) - 1)
        return over_white(palette[index], alpha[index])
    if kind in (0, 4):
        rgb = np.repeat(pixels[..., :1], 3, axis=2)
    else:
        rgb = pixels[..., :3]
    return over_white(rgb, pixels[..., -1]) if kind in (4, 6) else rgb


def over_white(rgb: np.ndarray, alpha: np.ndarray) -> np.ndarray:
    a = alpha[..., None].astype(np.uint16)
    return (rgb.astype(np.uint16) * a // 255 + (255 - a)).astype(np.uint8)


def decode_bmp(data: bytes) -> np.ndarray | None:
    """RGB of an uncompressed BMP with 24 or 32 bits."""
    if len(data) < 54:
        return None
    start, _, width, height, _, bits, packed = struct.unpack_from("<IIiiHHI", data, 10)
    if bits not in (24, 32) or packed or width <= 0 or not height:
        return None
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(height), start).reshape(abs(height), stride)
    rgb = rows[:, : width * bits // 8].reshape(abs(height), width, bits // 8)[..., 2::-1]
    return rgb[::-1] if height > 0 else rgb


def decode(data: bytes | None) -> np.ndarray | None:
    try:
        if data and data[:8] == b"\x89PNG\r\n\x1a\n":
            return decode_png(data)
        if data and data[:2] == b"BM":
            return decode_bmp(data)
    except (ValueError, IndexError, struct.error, zlib.error):
        pass
    return None


def encode_png(rgb: np.ndarray) -> bytes:
    chunk = lambda tag, body: struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))
    height, width = rgb.shape[:2]
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rgb.reshape(height, -1)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def measure(rgb: np.ndarray) -> Measured:
    """The part that is ink (unlike the most frequent colour), how far it spreads, and the red part of it."""
    height, width = rgb.shape[:2]
    step = 1
    while (width // step) * (height // step) > SCAN_PIXELS:
        step += 1
    seen = rgb[::step, ::step].astype(np.int16)
    q = seen >> 4
    codes = (q[..., 0] << 8) | (q[..., 1] << 4) | q[..., 2]
    ground = int(np.bincount(codes.ravel(), minlength=4096).argmax())
    back = np.array([(ground >> 8) & 15, (ground >> 4) & 15, ground & 15]) * 17
    ink = np.abs(seen - back).max(2) > TOLERANCE
    n = int(ink.sum())
    if not n:
        return Measured(0.0, 0.0, 0.0, width, height)
    ys, xs = np.nonzero(ink)
    spread = max((np.ptp(xs) + 1) * step / width, (np.ptp(ys) + 1) * step / height)
    red = ink & (seen[..., 0] >= RED_LEAST) & (seen[..., 0] - seen[..., 1:].max(2) >= RED_LEAD)
    return Measured(n / ink.size, min(1.0, float(spread)), int(red.sum()) / n, width, height)


def is_stamp(m: Measured, mm: tuple[float, float] | None = None) -> bool:
    size = max(mm) <= STAMP_MM if mm else max(m.width, m.height) <= STAMP_PIXELS
    aspect = (mm[0] / mm[1] if mm else m.width / m.height) if m.height else 0
    return size and STAMP_ASPECT[0] <= aspect <= STAMP_ASPECT[1] and STAMP_INK[0] <= m.ink <= STAMP_INK[1] and m.red >= STAMP_RED


def keep(m: Measured, mm: tuple[float, float] | None = None) -> bool:
    """Whether an image is content: not tiny, empty, nearly empty in one place, or a stamp."""
    tiny = max(m.width, m.height) < LEAST_PIXELS or (mm is not None and max(mm) < LEAST_MM)
    return not (tiny or m.ink == 0 or (m.ink < SPARSE_INK and m.spread < SPARSE_SPREAD) or is_stamp(m, mm))


def accept(data: bytes | None, mm: tuple[float, float] | None = None) -> bool:
    rgb = decode(data)
    return rgb is None or keep(measure(rgb), mm)
