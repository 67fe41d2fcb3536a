"""Pixels of uncompressed bitmaps and of PNG pictures that stand as bytes in a table."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.functions.pixels import SLICE

#: the part of Spark's image struct that ``pixels`` reads: BGR bytes, rows from the top
IMAGE = T.StructType([
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("nChannels", T.IntegerType()), T.StructField("data", T.BinaryType()),
])
PNG_CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}  # by colour type, at eight bits


def _bmp(data: bytes) -> np.ndarray | None:
    start, size = struct.unpack("<I", data[10:14])[0], struct.unpack("<ii", data[18:26])
    bits, packing = struct.unpack("<HI", data[28:34])
    width, height = size[0], abs(size[1])
    if bits not in (24, 32) or packing not in (0, 3) or width <= 0 or height <= 0:
        return None
    line = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, height * line, start).reshape(height, line)[:, :width * bits // 8]
    bgr = rows.reshape(height, width, bits // 8)[:, :, :3]
    return bgr if size[1] < 0 else bgr[::-1]


def _png(data: bytes) -> np.ndarray | None:
    width, height, bits, colour, _, _, interlaced = struct.unpack(">IIBBBBB", data[16:29])
    if bits != 8 or colour not in PNG_CHANNELS or interlaced:
        return None
    packed, at = b"", 8
    while at + 8 <= len(data):
        length, kind = struct.unpack(">I4s", data[at:at + 8])
        packed += data[at + 8:at + 8 + length] if kind == b"IDAT" else b""
        at += 12 + length
    n = PNG_CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(height, 1 + width * n)
    out, above = np.zeros((height, width * n), np.uint8), np.zeros(width * n, np.uint8)
    for y in range(height):
        out[y] = above = _unfiltered(int(raw[y, 0]), raw[y, 1:], above, n)
    picture = out.reshape(height, width, n)
    return picture[:, :, :1] if n < 3 else picture[:, :, 2::-1]


def _unfiltered(kind: int, row: np.ndarray, above: np.ndarray, n: int) -> np.ndarray:
    """One row of a PNG: what was stored is the difference to a guess from its neighbours."""
    if kind == 0:
        return row.copy()
    if kind == 2:
        return row + above
    if kind == 1:
        return np.cumsum(row.reshape(-1, n), axis=0, dtype=np.uint8).ravel()
    out = row.astype(int)
    up = above.astype(int)
    for k in range(len(out)):
        left, corner = (out[k - n], up[k - n]) if k >= n else (0, 0)
        if kind == 3:
            guess = (left + up[k]) // 2
        else:
            near = left + up[k] - corner
            guess = min((abs(near - left), 0, left), (abs(near - up[k]), 1, up[k]), (abs(near - corner), 2, corner))[2]
        out[k] = (out[k] + guess) & 255
    return out.astype(np.uint8)


def decode(data: bytes | None) -> tuple[int, int, int, bytes] | None:
    """(height, width, channels, BGR bytes) or None for what is damaged or of another format."""
    data = bytes(data or b"")
    try:
        picture = _bmp(data) if data[:2] == b"BM" else _png(data) if data[:8] == b"\x89PNG\r\n\x1a\n" else None
    except (struct.error, ValueError, zlib.error):
        return None
    return None if picture is None else (*picture.shape, np.ascontiguousarray(picture).tobytes())


@F.pandas_udf(IMAGE)
def image(content: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """The pixels of a byte column, in the form of Spark's image reader; null fields where they cannot be read."""
    for part in content:
        for at in range(0, len(part), SLICE):
            frame = pd.DataFrame([decode(d) or (None,) * 4 for d in part.iloc[at:at + SLICE]], columns=IMAGE.names)
            yield frame.astype({c: "Int32" for c in IMAGE.names[:3]})
