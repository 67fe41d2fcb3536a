"""Per-image statistics, noise and rarity rules, train lists, manifests and the merged training set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import text as X
from boxloom.operators import splits
from boxloom.operators.stats import zero_filled


def image_stats(images: DataFrame, boxes: DataFrame, large: float = 0.5) -> DataFrame:
    """(image_id, box_count, class_ids, distinct_class_count, large_box_count); zeros without boxes."""
    found = boxes.groupBy("image_id").agg(
        F.count(F.lit(1)).alias("box_count"), F.sort_array(F.collect_set("class_id")).alias("class_ids"),
        F.count_if(F.col("w") * F.col("h") >= large).alias("large_box_count"),
    )
    joined = images.select("image_id").join(found, "image_id", "left").select(
        "image_id", F.coalesce("box_count", F.lit(0)).alias("box_count"),
        F.coalesce("class_ids", F.array().cast("array<int>")).alias("class_ids"),
        F.coalesce("large_box_count", F.lit(0)).alias("large_box_count"),
    )
    return joined.withColumn("distinct_class_count", F.size("class_ids").cast("long"))


def _ceiled(column: str) -> Column:
    return F.ceil(F.coalesce(column, F.lit(0.0)))


def thresholds(stats: DataFrame) -> DataFrame:
    """One row: (box_count_gt, distinct_classes_gt, large_boxes_gt).

    The quantiles are exact and interpolated; they run over histograms of the three
    counts, not over the images.
    """
    kinds = ["box_count", "distinct_class_count", "large_box_count"]
    histogram = (
        stats.select(F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("value")) for k in kinds])))
        .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    q = {k: F.expr(f"percentile(case when kind = '{k}' then value end, {0.99 if k.startswith('large') else 0.95}, n)")
         for k in kinds}
    row = histogram.agg(*[v.alias(k) for k, v in q.items()])
    return row.select(
        _ceiled("box_count").alias("box_count_gt"), _ceiled("distinct_class_count").alias("distinct_classes_gt"),
        F.greatest(F.lit(2), _ceiled("large_box_count")).cast("long").alias("large_boxes_gt"),
    )


def with_noise(stats: DataFrame, limits: DataFrame) -> DataFrame:
    """Add ``noise_reasons`` (e.g. box_count_gt_7) and ``noisy``."""
    pairs = (("box_count", "box_count_gt"), ("distinct_class_count", "distinct_classes_gt"), ("large_box_count", "large_boxes_gt"))
    limit = {name: limits.select(name).scalar() for _, name in pairs}
    reasons = F.array_compact(F.array(*[
        F.when(F.col(c) > limit[n], F.concat(F.lit(f"{n}_"), limit[n].cast("string"))) for c, n in pairs]))
    return stats.withColumn("noise_reasons", reasons).withColumn("noisy", F.size("noise_reasons") > 0)


def removal_reasons(noisy: DataFrame) -> DataFrame:
    """(reason, n); an image may count under several."""
    return noisy.select(F.explode("noise_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def presence(stats: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, label, images): images per class, zero for absent ones."""
    counts = stats.select(F.explode("class_ids").alias("class_id")).groupBy("class_id").agg(F.count(F.lit(1)).alias("images"))
    return zero_filled(classes, counts, ["class_id"], ["images"])


def rarity(counts: DataFrame) -> DataFrame:
    """Add ``tier`` to class presence: severe up to the 25 % quantile, moderate up to 40 %, else common; quantiles ride along."""
    row = counts.agg(*[F.percentile("images", q).alias(n) for n, q in (("q25", 0.25), ("q40", 0.40), ("median", 0.50))])
    q = {n: row.select(n).scalar() for n in row.columns}
    out = counts.withColumns({n: F.coalesce(v, F.lit(0.0)) for n, v in q.items()})
    return out.withColumn("tier", F.when(F.col("images") <= F.col("q25"), "severe")
                          .when(F.col("images") <= F.col("q40"), "moderate").otherwise("common"))


def repeat_factors(stats: DataFrame, tiers: DataFrame) -> DataFrame:
    """Add ``repeat_factor``: 3 with a severe class, 2 with a moderate one, else 1."""
    def ids(tier: str) -> Column:
        return tiers.where(F.col("tier") == tier).agg(F.collect_list("class_id")).scalar()

    return stats.withColumn("repeat_factor", F.when(F.arrays_overlap("class_ids", ids("severe")), 3)
                            .when(F.arrays_overlap("class_ids", ids("moderate")), 2).otherwise(1))


def train_list(factored: DataFrame) -> DataFrame:
    """One row per line of the list: an image appears ``repeat_factor`` times, numbered by ``copy``."""
    return factored.select("image_id", F.explode(F.sequence(F.lit(1), F.col("repeat_factor"))).alias("copy"))


def repeat_histogram(factored: DataFrame) -> DataFrame:
    """(repeat_factor, images)."""
    return factored.groupBy("repeat_factor").agg(F.count(F.lit(1)).alias("images"))


def presence_by_noise(judged: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, label, clean, removed): images per class that stay in and leave the train list; zeros for absent classes."""
    counts = judged.select(F.explode("class_ids").alias("class_id"), "noisy").groupBy("class_id").agg(
        F.count_if(~F.col("noisy")).alias("clean"), F.count_if("noisy").alias("removed"))
    return zero_filled(classes, counts, ["class_id"], ["clean", "removed"])


def effective_presence(factored: DataFrame, classes: DataFrame) -> DataFrame:
    """(class_id, label, images, lines): presence before and after repetition."""
    counts = factored.select(F.explode("class_ids").alias("class_id"), "repeat_factor").groupBy("class_id").agg(
        F.count(F.lit(1)).alias("images"), F.sum("repeat_factor").alias("lines"))
    return zero_filled(classes, counts, ["class_id"], ["images", "lines"])


# ---- the merged training set -----------------------------------------------

def training_status(images: DataFrame, folds: DataFrame, seed: int = 42) -> DataFrame:
    """(image_id, path, source_folder, status, source_box_count, export_box_count).

    Splits are planned over all images; images with a conflict then leave their split for
    ``review_conflicts``. ``images`` carries image_id, path and perhaps source_folder (else the
    first folder of the path); ``folds`` are the ``detections.image_folds`` of the boxes.
    """
    if "source_folder" not in images.columns:
        images = images.withColumn("source_folder", X.top_folder(F.col("path")))
    planned = splits.plan(images, "source_folder", "path", seed)
    known = folds.groupBy("image_id").agg(
        F.sum("boxes").alias("_all"), F.sum(F.size("merged")).alias("_kept"), F.sum("clash_pairs").alias("_clashes"))
    return planned.join(known, "image_id", "left").select(
        "image_id", "path", "source_folder",
        F.when(F.col("_clashes") > 0, "review_conflicts").otherwise(F.col("split")).alias("status"),
        F.coalesce("_all", F.lit(0)).alias("source_box_count"), F.coalesce("_kept", F.lit(0)).alias("export_box_count"),
    )


def conflict_status(images: DataFrame, folds: DataFrame) -> DataFrame:
    """(image_id, status): ``review_conflicts`` as in ``training_status``, else ``exported``; no split is planned for it."""
    clashing = folds.where(F.col("clash_pairs") > 0).select("image_id", F.lit(True).alias("_clash")).distinct()
    return images.select("image_id").join(clashing, "image_id", "left").select(
        "image_id", F.when(F.col("_clash"), "review_conflicts").otherwise("exported").alias("status"))


def training_summary(status: DataFrame, folds: DataFrame) -> DataFrame:
    """(section, key, value) of the merged set: totals, splits, folders under review, dropped boxes, classes kept.

    ``status`` and ``folds`` are read twice each; written tables serve best.
    """
    review = F.col("status") == "review_conflicts"
    zero, one = F.lit(0), F.lit(1)
    per_image = status.select(F.inline(F.array_compact(F.array(
        _entry("total", F.lit("images"), one),
        _entry("total", F.lit("review_conflict_images"), F.when(review, one).otherwise(zero)),
        _entry("total", F.lit("missing_label_count"), F.when(F.col("source_box_count") == 0, one).otherwise(zero)),
        _entry("total", F.lit("merged_box_drop_count"), F.col("source_box_count") - F.col("export_box_count")),
        F.when(review, _entry("review_folder", F.col("source_folder"), one)),
        F.when(~review, _entry("split", F.col("status"), one)),
    ))))
    exported = status.where(~review).select("image_id")
    classes = folds.select("image_id", "merged.target_class").join(exported, "image_id", "left_semi").select(
        F.lit("target_instances").alias("section"), F.explode("target_class").alias("key"), one.cast("long").alias("value"))
    pairs = folds.select(F.lit("total").alias("section"), F.lit("review_conflict_pairs").alias("key"), F.coalesce("clash_pairs", zero).alias("value"))
    # the totals are there even if there is nothing to count
    totals = ["images", "review_conflict_images", "review_conflict_pairs", "merged_box_drop_count", "missing_label_count"]
    empty = status.sparkSession.createDataFrame([("total", t, 0) for t in totals], "section string, key string, value long")
    return per_image.unionByName(classes).unionByName(pairs).unionByName(empty).groupBy("section", "key").agg(F.sum("value").alias("value"))


def _entry(section: str, key: Column, value: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), key.alias("key"), value.cast("long").alias("value"))


def source_target_presence(status: DataFrame, folds: DataFrame) -> DataFrame:
    """(pair, images): exported images per source->target class, counted once per image."""
    exported = status.where(F.col("status") != "review_conflicts").select("image_id")
    pairs = folds.select("image_id", F.explode("mappings").alias("m")).select("image_id", F.concat_ws("->", "m.source_class", "m.target_class").alias("pair"))
    return pairs.join(exported, "image_id", "left_semi").groupBy("pair").agg(F.count(F.lit(1)).alias("images"))


# ---- manifests -------------------------------------------------------------

def split_manifest(images: DataFrame) -> DataFrame:
    """Nine columns per image from (path, label, split or null, flags, labels, box_count, sha1, ahash)."""
    from boxloom.operators.flags import review_required

    at = F.transform("labels", lambda n: F.struct(V.position(V.COLLECTION_CLASSES, n).alias("i"), n.alias("n")))
    return images.select(
        F.col("path").alias("source_image"), F.col("label").alias("expected_class"),
        F.coalesce("split", F.lit("review")).alias("split"),
        review_required(F.col("flags")).cast("int").alias("review_required"),
        F.array_join(F.sort_array("flags"), ";").alias("flags"),
        F.array_join(F.transform(F.array_sort(at), lambda s: s["n"]), ";").alias("detected_labels"),
        "box_count", "sha1", "ahash",
    )


def review_manifest(images: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The review workspace's rows: ten columns, pred_<class> as 0/1 and an empty human_check_<class> per class."""
    names = names or V.REVIEW_CLASSES
    base = X.export_stem(F.col("label"), F.col("path"), F.col("sha1"))
    return images.select(
        F.concat(F.col("label"), F.lit("/"), base, F.lit("."), X.suffix(F.col("path"))).alias("export_image"),
        F.concat(F.col("label"), F.lit("/"), base, F.lit(".txt")).alias("export_label"),
        F.col("path").alias("source_image"), F.col("label").alias("source_class"), "width", "height", "box_count",
        F.array_join(F.sort_array("labels"), ";").alias("detected_labels"),
        F.array_join(F.sort_array("flags"), ";").alias("flags"), "sha1",
        *[F.array_contains("labels", n).cast("int").alias(f"pred_{n}") for n in names],
        *[F.lit("").alias(f"human_check_{n}") for n in names],
    )


def split_cache(images: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cached, pending): an entry counts only when stem, sha1 and class all agree."""
    keys = ["export_stem", "sha1", "source_class"]
    known = cache.select(*keys).distinct()
    return images.join(known, keys, "left_semi"), images.join(known, keys, "left_anti")
