"""Pixel statistics of decoded images, and the rules on them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom import vocabulary as V

FEATURES = T.StructType([
    T.StructField("white", T.DoubleType()), T.StructField("dark", T.DoubleType()),
    T.StructField("red_std", T.DoubleType()), T.StructField("ahash", T.StringType()),
    T.StructField("vector", T.ArrayType(T.FloatType())),
])
#: pictures handled at once: Spark's batches have up to 10,000 rows, and a thumbnail has 3,072 numbers
SLICE = 256


@lru_cache(16)
def _weights(old: int, new: int) -> np.ndarray:
    """Rows of area weights that average ``old`` pixels down (or spread them up) to ``new``."""
    edges = np.linspace(0, old, new + 1)
    left, right = edges[:-1, None], edges[1:, None]
    pixel = np.arange(old)[None, :]
    cover = np.clip(np.minimum(right, pixel + 1) - np.maximum(left, pixel), 0, None)
    return cover / cover.sum(axis=1, keepdims=True)


def shrink(pixels: np.ndarray, size: int) -> np.ndarray:
    """Box-mean resize of an (h, w, c) picture to (size, size, c)."""
    rows, cols = _weights(pixels.shape[0], size), _weights(pixels.shape[1], size)
    return np.einsum("ih,hwc,jw->ijc", rows, pixels.astype("float64"), cols, optimize=True)


def measure(data: bytes, width: int, height: int, channels: int) -> tuple | None:
    """(white share, dark share, stdev of red, average hash, thumbnail) of BGR bytes."""
    if not data or width <= 0 or height <= 0:
        return None
    bgr = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    rgb = np.repeat(bgr, 3, axis=2) if channels == 1 else bgr[:, :, 2::-1]
    thumb = np.round(shrink(rgb, 32))
    white, dark = (thumb > 225).all(axis=2).mean(), (thumb < 15).all(axis=2).mean()
    grey = np.round(shrink((rgb * [0.299, 0.587, 0.114]).sum(axis=2, keepdims=True), 8)).ravel()
    bits = "".join("1" if g else "0" for g in grey >= grey.mean())
    return float(white), float(dark), float(thumb[:, :, 0].std(ddof=1)), f"{int(bits, 2):016x}", thumb


def describe(data: bytes, width: int, height: int, channels: int) -> tuple | None:
    """(white share, dark share, stdev of red, average hash, unit vector) of BGR bytes."""
    found = measure(data, width, height, channels)
    if found is None:
        return None
    flat = found[4].transpose(2, 0, 1).ravel() / 255.0
    flat = flat / max(np.linalg.norm(flat), 1e-12)
    return *found[:4], flat.astype("float32")


def _by_slices(frames: Iterator[pd.DataFrame], how, names: list[str]) -> Iterator[pd.DataFrame]:
    """What ``how`` gives for each picture, in frames of up to ``SLICE`` rows."""
    empty = (None,) * len(names)
    for frame in frames:
        for at in range(0, len(frame), SLICE):
            rows = [how(r.data, r.width, r.height, r.nChannels) or empty for r in frame.iloc[at:at + SLICE].itertuples()]
            yield pd.DataFrame([r[:len(names)] for r in rows], columns=names)


@F.pandas_udf(FEATURES)
def features(image: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All pixel statistics in one pass over Spark's ``image`` struct (bytes, height, width, channels)."""
    yield from _by_slices(image, describe, FEATURES.names)


@F.pandas_udf(T.StructType(FEATURES.fields[:4]))
def statistics(image: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``features`` without the vector, for those who do not compare pictures: no thumbnail leaves the task's Python."""
    yield from _by_slices(image, measure, FEATURES.names[:4])


def upright(grid: np.ndarray, orientation: int) -> np.ndarray:
    """A picture (rows first) turned as its orientation tag says."""
    turn = {2: lambda g: g[:, ::-1], 3: lambda g: g[::-1, ::-1], 4: lambda g: g[::-1], 5: lambda g: g.swapaxes(0, 1),
            6: lambda g: np.rot90(g, -1), 7: lambda g: g[::-1, ::-1].swapaxes(0, 1), 8: lambda g: np.rot90(g)}
    return turn.get(orientation, lambda g: g)(grid)


@F.pandas_udf(T.StructType(FEATURES.fields[3:]))
def turned(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """Hash and thumbnail of the upright picture: both are grids of means, so turning moves their cells."""
    for part in parts:
        for at in range(0, len(part[0]), SLICE):
            out = []
            for bits, flat, how in zip(*(c.iloc[at:at + SLICE] for c in part)):
                if bits is not None and how and how > 1:
                    grid = upright(np.array(list(f"{int(bits, 16):064b}")).reshape(8, 8), int(how))
                    bits = f"{int("".join(grid.ravel()), 2):016x}"
                    flat = np.concatenate([upright(c, int(how)).ravel() for c in np.asarray(flat).reshape(3, 32, 32)])
                out.append((bits, flat))
            yield pd.DataFrame(out, columns=["ahash", "vector"])


def signature(image: Column) -> Column:
    """SHA-1 of the size and the pixels, equal for re-encodings of one picture."""
    size = F.concat(image["width"].cast("string"), F.lit("x"), image["height"].cast("string"))
    return F.sha1(F.concat(size.cast("binary"), image["data"]))


def verdict(min_bytes: int = V.MIN_BYTES, short_side: int = V.MIN_SHORT_SIDE, white: float = V.MAX_WHITE_SHARE,
            dark: float = V.MAX_DARK_SHARE, red_std: float = V.MIN_RED_STDEV) -> Column:
    """"ok" or the first rule an image breaks, over file_size, width, height, white, dark, red_std."""
    return (
        F.when(F.col("file_size") < min_bytes, "few_bytes")
        .when(F.col("width").isNull() | (F.col("width") <= 0) | F.col("white").isNull(), "unreadable")
        .when(F.least("width", "height") < short_side, "small_side")
        .when(F.col("white") > white, "white").when(F.col("dark") > dark, "dark")
        .when(F.col("red_std") < red_std, "flat").otherwise("ok")
    )
