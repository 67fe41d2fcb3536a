"""Exact duplicates: decisions, survivors, renumbering and the manifest that follows them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.functions import text as X
from boxloom.operators.ranking import GROUP_BOUND, first_per_key, rank, running_before


def quality(df: DataFrame) -> Column:
    """What makes one copy better than another: pixels, width, bytes, path."""
    return F.struct(
        (F.col("width").cast("long") * F.col("height")).alias("pixels"), "width", "file_size", "path"
    )


def exact_decisions(images: DataFrame, signature: str = "sha1", bound: int = GROUP_BOUND) -> DataFrame:
    """One row per removed image: (remove_image, keep_image, final_keep, reason, score).

    Copies are met in path order; each step keeps the better of the best so far and
    the new one. ``keep_image`` is the keeper at that step and may lose later;
    ``final_keep`` is the one that stays.
    """
    best = images.groupBy(signature).agg(F.max(quality(images)).alias("_final"), F.count(F.lit(1)).alias("_n"))
    copies = images.join(best.where(F.col("_n") > 1).select(signature, "_final"), signature)
    copies = copies.select(signature, "path", quality(images).alias("_q"), "_final")
    steps = running_before(copies, [signature], ["path"], {"_best": ("max", F.col("_q"))}, bound)
    return steps.where(F.col("_best").isNotNull()).select(
        F.least("_best", "_q")["path"].alias("remove_image"),
        F.greatest("_best", "_q")["path"].alias("keep_image"),
        F.col("_final.path").alias("final_keep"),
        F.lit("exact_duplicate").alias("reason"), F.lit(1.0).alias("score"),
    )


def exact_survivors(images: DataFrame, signature: str = "sha1") -> DataFrame:
    """The best copy of each image; no window needed."""
    rest = [c for c in images.columns if c != signature]
    return (
        images.groupBy(signature).agg(F.max(F.struct(quality(images).alias("_q"), *rest)).alias("_b"))
        .select(signature, *[F.col(f"_b.{c}") for c in rest])
    )


def one_per_removed(decisions: DataFrame) -> DataFrame:
    """The decision with the highest score per removed image, the earliest (``pos``) on ties."""
    return first_per_key(decisions, ["remove_image"], [-F.col("score"), F.col("pos")])


def without(images: DataFrame, decisions: DataFrame, path: str = "path") -> DataFrame:
    """Images not removed by any decision."""
    return images.join(decisions.select(F.col("remove_image").alias(path)), path, "left_anti")


def attach_mirrors(images: DataFrame, labels: DataFrame, extras: DataFrame) -> DataFrame:
    """Add ``label_path`` (or null) and sorted ``extra_paths`` of the same folder and stem.

    All three sides hold paths relative to their own root.
    """
    def keyed(df: DataFrame, path: str) -> DataFrame:
        return df.withColumns({"_dir": X.parent(F.col(path)), "_stem": X.stem(F.col(path))})

    label_side = keyed(labels.select(F.col("path").alias("label_path")), "label_path")
    extra_side = keyed(extras.select(F.col("path").alias("_e")), "_e").groupBy("_dir", "_stem").agg(
        F.sort_array(F.collect_list("_e")).alias("extra_paths"))
    return (
        keyed(images, "path").join(label_side, ["_dir", "_stem"], "left").join(extra_side, ["_dir", "_stem"], "left")
        .withColumn("extra_paths", F.coalesce("extra_paths", F.array().cast("array<string>"))).drop("_dir", "_stem")
    )


def renumber(images: DataFrame, start: int = 1, padding: int = 6, prefix: str = "folder",
             bound: int = GROUP_BOUND) -> DataFrame:
    """Add ``new_path``: the files of a folder in path order become <prefix>_000001.<suffix> and so on.

    ``prefix`` is "folder" for the folder's name or "parent" for its parent's. Numbers
    wider than the padding are not cut.
    """
    df = images.withColumn("_dir", X.parent(F.col("path")))
    number = (F.col("_r") + (start - 1)).cast("string")
    name = X.file_name(F.col("_dir")) if prefix == "folder" else X.file_name(X.parent(F.col("_dir")))
    padded = F.when(F.length(number) >= padding, number).otherwise(F.lpad(number, padding, "0"))
    return rank(df, ["_dir"], ["path"], "_r", bound).withColumn("new_path", F.concat(
        F.when(F.col("_dir") != "", F.concat("_dir", F.lit("/"))).otherwise(""),
        name, F.lit("_"), padded, F.lit("."), X.suffix(F.col("path")),
    )).drop("_dir", "_r")


def rename_plan(renumbered: DataFrame) -> DataFrame:
    """(old_path, new_path) of files whose name changes."""
    return renumbered.where(F.col("path") != F.col("new_path")).select(F.col("path").alias("old_path"), "new_path")


def update_manifest(manifest: DataFrame, removed: DataFrame, renames: DataFrame) -> DataFrame:
    """Drop rows of removed images and rewrite the paths of renamed ones.

    Manifest rows carry export_image and export_label, relative to their roots.
    """
    kept = manifest.join(removed.select(F.col("remove_image").alias("export_image")), "export_image", "left_anti")
    moved = renames.select(F.col("old_path").alias("export_image"), F.col("new_path").alias("_new"))
    joined = kept.join(moved, "export_image", "left")
    return joined.withColumns({
        "export_label": F.when(F.col("_new").isNotNull(), X.with_suffix(F.col("_new"), ".txt")).otherwise(F.col("export_label")),
        "export_image": F.coalesce("_new", "export_image"),
    }).drop("_new")


def report(removed: DataFrame, renames: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(key, value): removed in total, exact, near; renamed; unreadable."""
    counts = removed.agg(
        F.count(F.lit(1)).alias("removed_total"),
        F.count_if(F.startswith("reason", F.lit("exact_duplicate"))).alias("removed_exact_duplicates"),
        F.count_if(F.startswith("reason", F.lit("near_duplicate"))).alias("removed_near_duplicates"),
    )
    names = counts.columns
    tidy = counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names])))
    for name, frame in (("renamed_files", renames), ("unreadable_images", unreadable)):
        tidy = tidy.unionByName(frame.agg(F.count(F.lit(1)).alias("value")).withColumn("key", F.lit(name)))
    return tidy
