"""Counters over classes, flags, splits and label files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import text as X


def zero_filled(dimension: DataFrame, counts: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """All rows of a small dimension with their counts, zero when absent."""
    joined = dimension.join(counts, keys, "left")
    return joined.withColumns({v: F.coalesce(v, F.lit(0)) for v in values})


def class_counts(routed: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, label, source, kept, review) images per expected class."""
    counts = routed.groupBy("label").agg(
        F.count(F.lit(1)).alias("source"), F.count_if(F.col("routed") == "kept").alias("kept"),
        F.count_if(F.col("routed") == "review").alias("review"))
    return zero_filled(classes, counts, ["label"], ["source", "kept", "review"])


def label_presence(boxes: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, label, images, instances) per detected class.

    Counts per (label, image) first, so a class that holds most boxes is combined before it meets in one task.
    """
    per_image = boxes.groupBy("label", "image_id").agg(F.count(F.lit(1)).alias("n"))
    counts = per_image.groupBy("label").agg(F.count(F.lit(1)).alias("images"), F.sum("n").alias("instances"))
    return zero_filled(classes, counts, ["label"], ["images", "instances"])


def flag_counts(flagged: DataFrame) -> DataFrame:
    return flagged.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """(section, key, n) for each column in one scan."""
    entries = F.array(*[F.struct(F.lit(c).alias("section"), F.col(c).cast("string").alias("key")) for c in columns])
    return df.select(F.inline(entries)).groupBy("section", "key").agg(F.count(F.lit(1)).alias("n"))


def coverage(images: DataFrame, classes: DataFrame, target: int = V.TARGET_PER_CLASS) -> DataFrame:
    """(class_id, label, images, status, bar, short) against the target; short is under 70 %."""
    counts = images.groupBy("label").agg(F.count(F.lit(1)).alias("images"))
    n = F.col("images")
    filled = F.floor(F.least(n, F.lit(target)) * 30 / target).cast("int")
    return zero_filled(classes, counts, ["label"], ["images"]).withColumns({
        "status": F.when(n >= target, "OK").when(n >= target * 0.6, "..").otherwise("!!"),
        "bar": F.rpad(F.repeat(F.lit("#"), filled), 30, "-"),
        "short": n < target * 0.7,
    })


def label_match_stats(matched: DataFrame, missing: DataFrame, parsed: DataFrame, images: DataFrame) -> DataFrame:
    """One row of totals over label files; ``parsed`` holds the lines of matched files with ``valid``."""
    per_file = parsed.groupBy("path").agg(F.count_if(F.col("valid")).alias("_v"), F.count_if(~F.col("valid")).alias("_i"))
    files = matched.select("path").join(per_file, "path", "left").agg(
        F.count(F.lit(1)).alias("matched_images"),
        F.count_if(F.coalesce("_v", F.lit(0)) == 0).alias("empty_label_files"),
        F.coalesce(F.sum("_i"), F.lit(0)).alias("invalid_label_lines"))
    lost = missing.agg(F.count(F.lit(1)).alias("n")).scalar()
    stems = images.select(X.stem(F.col("path")).alias("s")).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    return files.select(
        stems.alias("total_images"), (F.col("matched_images") + lost).alias("total_label_files"),
        "matched_images", "empty_label_files", lost.alias("missing_images"), "invalid_label_lines")


def reasons_by_group(samples: DataFrame, group: str, reason: Column) -> DataFrame:
    """(group, reason, n)."""
    return samples.groupBy(group, reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))
