"""Flags of images: quality, duplicates, review routing and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocabulary as V


def per_image(boxes: DataFrame) -> DataFrame:
    """What the flags need of an image's boxes, combined map-side: the label set has at most one entry per class."""
    return boxes.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("box_count"), F.collect_set("label").alias("labels"),
        F.min("score").alias("low_score"),
        F.max((F.col("source") == "expected_fallback").cast("int")).alias("has_fallback"),
    )


def _described(images: DataFrame, boxes: DataFrame) -> DataFrame:
    joined = images.join(per_image(boxes), "image_id", "left")
    return joined.withColumns({
        "box_count": F.coalesce("box_count", F.lit(0)),
        "labels": F.coalesce("labels", F.array().cast("array<string>")),
    })


def _set(*named: tuple[str, Column]) -> Column:
    return F.sort_array(F.array_compact(F.array(*[F.when(test, name) for name, test in named])))


def quality_flags(images: DataFrame, boxes: DataFrame, short_side: int = V.MIN_SHORT_SIDE,
                  low: float = V.LOW_SCORE, busy: int = V.BUSY_BOXES) -> DataFrame:
    """Images (image_id, expected_class, width, height) with box_count, labels and sorted ``flags``."""
    empty = F.col("box_count") == 0
    found = F.array_contains("labels", F.col("expected_class"))
    return _described(images, boxes).withColumn("flags", _set(
        ("small_image", F.least("width", "height") < short_side),
        ("empty_detection", empty),
        ("expected_missing", empty | ~found),
        ("fallback_used", ~empty & found & (F.col("has_fallback") == 1)),
        ("cross_class_only", ~empty & ~found),
        ("low_confidence", ~empty & (F.col("low_score") < low)),
        ("busy_scene", F.col("box_count") >= busy),
    )).drop("low_score", "has_fallback")


def review_flags(images: DataFrame, boxes: DataFrame, low: float = V.LOW_SCORE, busy: int = V.BUSY_BOXES) -> DataFrame:
    """The review workspace's flags: every image is reviewed, the rest says why it may be hard."""
    empty = F.col("box_count") == 0
    found = F.array_contains("labels", F.col("expected_class"))
    return _described(images, boxes).withColumn("flags", _set(
        ("manual_review_all", F.lit(True)),
        ("empty_detection", empty),
        ("source_class_missing", empty | ~found),
        ("cross_class_only", ~empty & ~found),
        ("low_confidence", ~empty & (F.col("low_score") < low)),
        ("busy_scene", F.col("box_count") >= busy),
    )).drop("low_score", "has_fallback")


def duplicate_flags(images: DataFrame) -> DataFrame:
    """Add ``dup_flags`` to (sha1, label, ...): exact_duplicate, and cross_class_duplicate when classes differ.

    A group spans classes when its smallest and largest class differ, so no
    distinct count is needed. Only groups with more than one row are joined back.
    """
    groups = images.groupBy("sha1").agg(
        F.count(F.lit(1)).alias("_n"), F.min("label").alias("_lo"), F.max("label").alias("_hi")
    ).where(F.col("_n") > 1).select("sha1", (F.col("_lo") != F.col("_hi")).alias("_cross"))
    return images.join(groups, "sha1", "left").withColumn("dup_flags", _set(
        ("exact_duplicate", F.col("_cross").isNotNull()),
        ("cross_class_duplicate", F.coalesce("_cross", F.lit(False))),
    )).drop("_cross")


def review_required(flags: Column) -> Column:
    return F.arrays_overlap(flags, F.array(*[F.lit(f) for f in V.CRITICAL_FLAGS]))


def route(images: DataFrame, policy: str = "exclude") -> DataFrame:
    """Add ``review_required`` and ``routed``: "review" for critical images under the exclude policy, else "kept"."""
    if policy not in ("exclude", "include"):
        raise ValueError(f"unknown review policy: {policy}")
    needed = review_required(F.col("flags"))
    to_review = needed & F.lit(policy == "exclude")
    return images.withColumns({
        "review_required": needed, "routed": F.when(to_review, "review").otherwise("kept"),
    })


QUEUE_MODES = ["all", "unreviewed_all", "high_risk", "duplicate_boxes", "pending_risk"]


def known_flags(manifest: DataFrame, local: DataFrame) -> DataFrame:
    """(image_id, flags): union of manifest flags and flags found on the boxes."""
    none = F.array().cast("array<string>")
    return manifest.select("image_id", F.col("flags").alias("_m")).join(
        local.select("image_id", F.col("flags").alias("_l")), "image_id", "full_outer"
    ).select("image_id", F.sort_array(F.array_union(F.coalesce("_m", none), F.coalesce("_l", none))).alias("flags"))


def review_queue(images: DataFrame, flags: DataFrame, reviewed: DataFrame) -> DataFrame:
    """(mode, image_id) for every queue mode an image belongs to, in one pass."""
    seen = reviewed.select("image_id").distinct().withColumn("_seen", F.lit(True))
    none = F.array().cast("array<string>")
    joined = images.select("image_id").join(flags, "image_id", "left").join(seen, "image_id", "left").withColumns({
        "flags": F.coalesce("flags", none), "_open": F.col("_seen").isNull(),
    })
    risky = F.col("_open") & (F.size("flags") > 0)
    tests = {
        "all": F.lit(True), "unreviewed_all": F.col("_open"), "high_risk": risky,
        "duplicate_boxes": F.col("_open") & F.array_contains("flags", "same_class_overlap"),
        "pending_risk": risky,
    }
    modes = F.array_compact(F.array(*[F.when(tests[m], m) for m in QUEUE_MODES]))
    return joined.select(F.explode(modes).alias("mode"), "image_id")
