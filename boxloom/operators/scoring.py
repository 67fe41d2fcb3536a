"""Running a caller's detector over images, and what follows from its output."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom import vocabulary as V
from boxloom.functions import boxes as B
from boxloom.operators import detections as D

BOXES = T.StructType([
    T.StructField("image_id", T.LongType()), T.StructField("pos", T.LongType()),
    T.StructField("raw_label", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("x1", T.DoubleType()), T.StructField("y1", T.DoubleType()),
    T.StructField("x2", T.DoubleType()), T.StructField("y2", T.DoubleType()),
])

# A scorer takes a batch of image rows (with their prompt) and returns BOXES rows.
Scorer = Callable[[pd.DataFrame], pd.DataFrame]


def next_fit(pixels: Iterable[int], max_images: int, max_pixels: int) -> list[int]:
    """Batch number of each image: a new batch starts when the next image would break a limit.

    ``max_pixels`` of 0 means no pixel limit; an image above the limit forms its own batch.
    """
    out, batch, count, total = [], 0, 0, 0
    for size in pixels:
        full = count >= max_images or (max_pixels > 0 and count > 0 and total + size > max_pixels)
        if full:
            batch, count, total = batch + 1, 0, 0
        out.append(batch)
        count, total = count + 1, total + size
    return out


def score_images(
    images: DataFrame, load: Callable[[], Scorer], max_images: int = 8, max_pixels: int = 1_600_000
) -> DataFrame:
    """Apply a scorer to (image_id, width, height, prompt, ...) in batches within both limits.

    ``load`` runs once per task and returns the scorer, so a model is read once per task.
    Batches form inside an Arrow batch: memory is bounded by the Arrow batch size. Rows are
    spread by image first (ids and sizes only, no pixels), since a model outweighs a shuffle.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = load()
        for frame in frames:
            if frame.empty:
                continue
            batch = next_fit(frame["width"].astype("int64") * frame["height"], max_images, max_pixels)
            for _, part in frame.groupby(pd.Series(batch, index=frame.index), sort=True):
                yield scorer(part)[[f.name for f in BOXES]]

    return images.repartition("image_id").mapInPandas(run, BOXES)


def missing_expected(images: DataFrame, boxes: DataFrame, floor: float | None = None) -> DataFrame:
    """Images without a box of their expected class; with ``floor`` also those whose best one is below it."""
    found = boxes if floor is None else boxes.where(F.col("score") >= floor)
    found = found.select("image_id", F.col("label").alias("expected_class")).distinct()
    return images.join(found, ["image_id", "expected_class"], "left_anti")


def missing_classes(images: DataFrame, boxes: DataFrame, names: list[str]) -> DataFrame:
    """(image_id, label) for every class of ``names`` not found in the image.

    Each image gathers the set of its labels (at most ``len(names)``) and emits
    the difference, so no product of images and classes is shuffled.
    """
    known = F.array(*[F.lit(n) for n in names])
    found = boxes.where(F.col("label").isin(names)).groupBy("image_id").agg(F.collect_set("label").alias("_found"))
    none = F.array().cast("array<string>")
    return images.select("image_id").join(found, "image_id", "left").select(
        "image_id", F.explode(F.array_except(known, F.coalesce("_found", none))).alias("label")
    )


def cascade(images: DataFrame, first: DataFrame, second: DataFrame, iou: float = V.NMS_IOU) -> DataFrame:
    """First-pass boxes plus, for images that missed their expected class, second-pass boxes of that class."""
    missed = missing_expected(images, first).select("image_id", "expected_class")
    extra = D.forced(second.join(missed, "image_id"), F.col("expected_class")).drop("expected_class")
    return D.suppress(first.unionByName(extra), iou)


def two_pass(
    images: DataFrame, load: Callable[[], Scorer], full_prompt: str = V.FULL_PROMPT, iou: float = V.NMS_IOU,
    thresholds: tuple[float, float] = (V.FULL_THRESHOLD, V.FALLBACK_THRESHOLD), **limits,
) -> DataFrame:
    """Score all images with the joint prompt, rescore the misses with the prompt of their class.

    The first pass is written to the shared folder: the model must not run twice for it.
    """
    from boxloom.cluster import cut

    raw = score_images(images.withColumn("prompt", F.lit(full_prompt)), load, **limits)
    first = cut(D.mapped(D.above(raw, thresholds[0])).drop("raw_label"))
    prompt = F.element_at(F.create_map(*[F.lit(x) for kv in V.FALLBACK_PROMPTS.items() for x in kv]),
                          F.col("expected_class"))
    missed = missing_expected(images, first).withColumn("prompt", prompt)
    # second-pass positions follow the first pass's, so ties fall to the first pass
    second = D.above(score_images(missed, load, **limits), thresholds[1]).drop("raw_label")
    second = second.withColumn("pos", F.col("pos") + (1 << 40))
    second = D.forced(second.join(missed.select("image_id", "expected_class"), "image_id"), F.col("expected_class"))
    return D.suppress(first.unionByName(second.drop("expected_class")), iou)


def route_masks(df: DataFrame, min_area: int = V.MIN_MASK_AREA) -> DataFrame:
    """Boxes whose mask (``mask_area`` in pixels, null when none) is too small fall back to the box polygon."""
    small = F.coalesce(F.col("mask_area") < min_area, F.lit(True))
    box = B.polygon(B.corner_columns(), F.col("width"), F.col("height"))
    return df.withColumns({
        "route": F.when(small, "box_fallback").otherwise("sam_mask"),
        "points": F.when(small, box),
    })
