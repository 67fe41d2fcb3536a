"""What memory and time must not grow with: sizes of frames, and of the parts of a plan."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from boxloom.functions import bitmaps, pixels
from boxloom.functions import text as X
from boxloom.operators import manifests, ranking


def test_pixel_facts_leave_python_in_small_frames(spark):
    """A batch of Spark has up to 10,000 rows: its thumbnails must not stand in one frame."""
    r = np.random.default_rng(1)
    n = pixels.SLICE * 2 + 7
    frame = pd.DataFrame({"height": 8, "width": 8, "nChannels": 3, "data": [r.bytes(192) for _ in range(n)]})
    frame.loc[3, "data"] = b""
    full, lean = list(pixels.features.func(iter([frame]))), list(pixels.statistics.func(iter([frame])))
    for parts in (full, lean, list(bitmaps.image.func(iter([pd.Series([b"BM"] * n)])))):
        assert [len(p) for p in parts] == [pixels.SLICE, pixels.SLICE, 7]
    pd.testing.assert_frame_equal(pd.concat(full).drop(columns="vector"), pd.concat(lean))
    assert pd.concat(full)["ahash"].isna().sum() == 1
    vectors = [np.arange(3072, dtype="float32")] * n
    turned = pixels.turned.func(iter([(pd.Series(["0f" * 8] * n), pd.Series(vectors), pd.Series([3] * n))]))
    assert [len(p) for p in turned] == [pixels.SLICE, pixels.SLICE, 7]
    # rows and facts still belong together when frames are cut in Python
    table = spark.createDataFrame(pd.DataFrame({"id": range(n), "image": frame.to_dict("records")}),
                                  "id int, image struct<height:int,width:int,nChannels:int,data:binary>").coalesce(1)
    got = {x.id: x.h for x in table.select("id", pixels.statistics(F.col("image"))["ahash"].alias("h")).collect()}
    assert got == dict(enumerate(h if isinstance(h, str) else None for h in pd.concat(lean)["ahash"]))


def test_label_text_is_normalised_once(spark):
    """Each alias looks into one normalised text; the regular expression must not run once per alias."""
    label = X.canonical_label(F.col("t"))
    df = spark.createDataFrame([("A  BED-side!",), ("nothing",), (None,), ("",)], "t string")
    plan = df.select(label.alias("l"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert [r.l for r in df.select(label.alias("l")).collect()] == ["bed", None, None, None]


def test_crowded_keys_are_looked_for_in_crowded_images_only(spark):
    """Classes are counted within crowded images alone; with none, no class is even read."""
    rows = [(1, "a")] * 3 + [(1, "b")] * 2 + [(2, "a")] * 5 + [(3, n) for n in "abcde"] + [(4, "a")]
    df = spark.createDataFrame(rows, "image_id int, label string")
    keys = ["image_id", "label"]
    for counted in (None, df.unionAll(df)):
        cold, hot = ranking.split_hot(df, keys, 3, ["image_id"], counted)
        assert {tuple(r) for r in hot.collect()} == {(2, "a")} and hot.count() == 5 and cold.count() == 11
    unread = df.withColumn("label", F.raise_error(F.lit("label read")).cast("string"))
    assert ranking.split_hot(unread, keys, 5, ["image_id"])[1] is None


def test_presence_needs_no_split(spark):
    """Images with a conflict are left out as by the whole status, though no split is planned."""
    images = spark.createDataFrame([(n, f"f{n % 2}/{n}.jpg", f"f{n % 2}") for n in range(6)], "image_id long, path string, source_folder string")
    m = "array<struct<source_class:string,target_class:string>>"
    folds = spark.createDataFrame([(0, 1, 0, [("a", "x")]), (1, 2, 1, [("a", "x"), ("b", "y")]), (2, None, 0, None), (2, None, 3, None), (2, 9, None, [("b", "y")]),
                                   (3, 1, None, [("a", "x"), ("b", "y")]), (9, 1, 0, [("a", "x")])],
                                  f"image_id long, boxes long, clash_pairs long, mappings {m}").withColumn("merged", F.array(F.lit(1)))
    brief, full = manifests.conflict_status(images, folds), manifests.training_status(images, folds)
    assert {r.image_id for r in brief.where("status = 'review_conflicts'").collect()} == {1, 2} and brief.count() == 6
    want = {"a->x": 2, "b->y": 1}
    for status in (brief, full):
        assert {r.pair: r.images for r in manifests.source_target_presence(status, folds).collect()} == want
