"""Size and orientation of pictures from their first bytes, for formats that the JVM decodes and for those it does not."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD_BYTES = 1 << 18  # sizes and orientation stand in front of the pixels
HEADER = T.StructType([T.StructField(n, T.IntegerType()) for n in ("width", "height", "orientation")])

# ---- fixed values of the file formats
ORIENTATION_TAG = 0x0112
FRAME_MARKERS = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
ALONE_MARKERS = {0x01, *range(0xD0, 0xD9)}


def _orientation(tiff: bytes) -> int:
    """The orientation tag of a TIFF structure, 1 if it has none."""
    order = {b"II": "<", b"MM": ">"}.get(tiff[:2])
    if order is None or len(tiff) < 8:
        return 1
    at = struct.unpack(order + "I", tiff[4:8])[0]
    if at + 2 > len(tiff):
        return 1
    for k in range(struct.unpack(order + "H", tiff[at:at + 2])[0]):
        entry = tiff[at + 2 + 12 * k:at + 14 + 12 * k]
        if len(entry) == 12 and struct.unpack(order + "H", entry[:2])[0] == ORIENTATION_TAG:
            value = struct.unpack(order + "H", entry[8:10])[0]
            return value if 1 <= value <= 8 else 1
    return 1


def _jpeg(data: bytes) -> tuple[int, int, int] | None:
    turned, at = 1, 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        marker = data[at + 1]
        if marker == 0xFF or marker in ALONE_MARKERS:
            at += 1 if marker == 0xFF else 2
            continue
        length = int.from_bytes(data[at + 2:at + 4], "big")
        body = data[at + 4:at + 2 + length]
        if marker == 0xE1 and body[:6] == b"Exif\0\0":
            turned = _orientation(body[6:])
        if marker in FRAME_MARKERS:
            return (int.from_bytes(body[3:5], "big"), int.from_bytes(body[1:3], "big"), turned) if len(body) >= 5 else None
        if marker == 0xDA:
            return None
        at += 2 + length
    return None


def _riff(data: bytes) -> tuple[int, int, int] | None:
    """WebP: a canvas, a lossless or a lossy picture; the orientation comes with the EXIF chunk if that lies in reach."""
    size, turned, at = None, 1, 12
    while at + 8 <= len(data):
        kind, length, body = data[at:at + 4], int.from_bytes(data[at + 4:at + 8], "little"), data[at + 8:at + 8 + 1024]
        if kind == b"VP8X" and len(body) >= 10:
            size = int.from_bytes(body[4:7], "little") + 1, int.from_bytes(body[7:10], "little") + 1
        elif kind == b"VP8L" and size is None and len(body) >= 5 and body[0] == 0x2F:
            bits = int.from_bytes(body[1:5], "little")
            size = (bits & 0x3FFF) + 1, (bits >> 14 & 0x3FFF) + 1
        elif kind == b"VP8 " and size is None and len(body) >= 10 and body[3:6] == b"\x9d\x01\x2a":
            size = int.from_bytes(body[6:8], "little") & 0x3FFF, int.from_bytes(body[8:10], "little") & 0x3FFF
        elif kind == b"EXIF":
            turned = _orientation(body.removeprefix(b"Exif\0\0"))
        at += 8 + length + length % 2
    return (*size, turned) if size else None


def _boxed(data: bytes) -> tuple[int, int, int] | None:
    """AVIF: the size property, and the rotation in quarter turns against the clock."""
    at = data.find(b"ispe")
    if at < 0 or at + 16 > len(data):
        return None
    turn = data.find(b"irot")
    quarter = data[turn + 4] & 3 if 0 <= turn < len(data) - 4 else 0
    return (*struct.unpack(">II", data[at + 8:at + 16]), {0: 1, 1: 8, 2: 3, 3: 6}[quarter])


def header(data: bytes | None) -> tuple[int, int, int] | None:
    """(width, height, orientation) as stored, or None for what is no known picture."""
    data = bytes(data or b"")
    found = None
    if data[:2] == b"\xff\xd8":
        found = _jpeg(data)
    elif data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        found = (*struct.unpack(">II", data[16:24]), 1)
    elif data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        found = _riff(data)
    elif data[4:8] == b"ftyp":
        found = _boxed(data)
    elif data[:3] == b"GIF" and len(data) >= 10:
        found = (*struct.unpack("<HH", data[6:10]), 1)
    elif data[:2] == b"BM" and len(data) >= 26:
        width, height = struct.unpack("<ii", data[18:26])
        found = width, abs(height), 1
    return found if found and min(found[:2]) > 0 else None


@F.pandas_udf(HEADER)
def headers(heads: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The header of each picture, over its first ``HEAD_BYTES`` bytes."""
    for part in heads:
        yield pd.DataFrame([header(d) or (None, None, None) for d in part], columns=HEADER.names).astype("Int32")
