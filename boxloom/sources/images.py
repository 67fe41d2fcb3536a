"""Image folders as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import pixels
from boxloom.functions import text as X
from boxloom.functions.headers import HEAD_BYTES, headers
from boxloom.sources.labels import _decoded, relative


def list_images(spark: SparkSession, root: str, suffixes: list[str] | None = None, recursive: bool = True) -> DataFrame:
    """(path, file_size, modified) of image files under ``root``; contents are not read.

    The suffix test ignores case, which a path glob would not.
    """
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(base)
    path = relative(F.col("path"), base).alias("path")
    return files.select(path, F.col("length").alias("file_size"), F.col("modificationTime").alias("modified")).where(
        X.suffix(F.col("path")).isin(suffixes or V.SCAN_SUFFIXES))


def class_folder_images(spark: SparkSession, root: str, names: list[str], suffixes: list[str] | None = None) -> DataFrame:
    """Images directly inside the folders of known classes, with ``label``."""
    parts = F.split("path", "/")
    return list_images(spark, root, suffixes).where((F.size(parts) == 2) & parts[0].isin(names)).withColumn("label", parts[0])


def split_tree_samples(spark: SparkSession, root: str, group: str, suffixes: list[str] | None = None) -> DataFrame:
    """(path, split, label, class_index) of a group's split/class/file tree."""
    parts = F.split("path", "/")
    found = list_images(spark, root, suffixes or V.DEDUPE_SUFFIXES).where(F.size(parts) == 3).select(
        "path", parts[0].alias("split"), parts[1].alias("label"))
    known = V.groups(spark).where(F.col("group") == group).select("label", "class_index")
    return found.where(F.col("split").isin("train", "val", "test")).join(F.broadcast(known), "label")


def decoded(spark: SparkSession, root: str) -> DataFrame:
    """(path, file_size, sha1, width, height, orientation, signature, white, dark, red_std, ahash, vector).

    Bytes and pixels are read once each and dropped in the same stage: neither crosses a shuffle. Size, hash and
    thumbnail are those of the upright picture, as its orientation tag says. A picture that the JVM cannot decode
    has the size that its header names (webp, avif) and no pixel facts; one without a readable header has width -1.
    """
    base = root.rstrip("/")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(base).select(
        relative(F.col("path"), base).alias("path"), F.col("length").alias("file_size"), F.sha1("content").alias("sha1"),
        headers(F.substring("content", 1, HEAD_BYTES)).alias("_h"))
    shown = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(base)
    image = F.col("image")
    pixel = shown.select(
        relative(_decoded(image["origin"]), base).alias("path"), image["width"].alias("_w"), image["height"].alias("_t"),
        F.when(image["width"] > 0, pixels.signature(image)).alias("signature"), pixels.features(image).alias("_f"),
    ).select("path", "_w", "_t", "signature", "_f.*")
    both = raw.where(X.suffix(F.col("path")).isin(V.DEDUPE_SUFFIXES)).join(pixel, "path", "left")
    wide, high = (F.when(F.col(c) > 0, F.col(c)).otherwise(F.coalesce(F.col(f"_h.{h}"), F.lit(-1))) for c, h in (("_w", "width"), ("_t", "height")))
    turn = F.coalesce(F.col("_h.orientation"), F.lit(1))
    names = ["white", "dark", "red_std"]
    return both.select(
        "path", "file_size", "sha1", F.when(turn >= 5, high).otherwise(wide).alias("width"), F.when(turn >= 5, wide).otherwise(high).alias("height"),
        turn.alias("orientation"), "signature", *names, pixels.turned("ahash", "vector", turn).alias("_u"),
    ).select("path", "file_size", "sha1", "width", "height", "orientation", "signature", *names, "_u.ahash", "_u.vector")


def quarantine(images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable, skipped with ``reason``); a failed decode has no positive size."""
    bad: Column = F.coalesce(F.least("width", "height") <= 0, F.lit(True))
    return images.where(~bad), images.where(bad).withColumn("reason", F.lit("cannot be decoded"))
