"""Hand-derived results at ties, limits and odd inputs."""

import pytest
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import boxes as B
from boxloom.functions import text as X
from boxloom.operators import crawl, dedupe, detections as D, flags, manifests, review, scoring, splits
from boxloom.sources import labels as L


def one(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def det(spark, rows):
    return spark.createDataFrame(rows, "image_id long, pos long, label string, score double, source string, x1 double, y1 double, x2 double, y2 double")


# ---- splits ----------------------------------------------------------------

@pytest.mark.parametrize("rule,n,want", [
    (splits.proportional, 1, (1, 0, 0)), (splits.proportional, 2, (1, 1, 0)), (splits.proportional, 3, (1, 1, 1)),
    (splits.proportional, 4, (2, 1, 1)), (splits.proportional, 9, (7, 1, 1)), (splits.proportional, 10, (8, 1, 1)),
    (splits.proportional, 11, (8, 1, 2)), (splits.proportional, 100, (80, 10, 10)),
    (splits.cut_points, 1, (1, 0, 0)), (splits.cut_points, 2, (1, 1, 0)), (splits.cut_points, 3, (2, 1, 0)), (splits.cut_points, 10, (8, 1, 1)),
])
def test_split_counts(spark, rule, n, want):
    rows = spark.range(1, n + 1).select(rule(F.col("id"), F.lit(n)).alias("s")).groupBy("s").count().collect()
    got = {r.s: r["count"] for r in rows}
    assert tuple(got.get(s, 0) for s in splits.SPLITS) == want


def test_empty_splits_borrow(spark):
    def used(names):
        df = spark.createDataFrame([(s,) for s in names], "split string")
        return sorted(one(splits.fill_empty_splits(df), "split", "used_as"))

    assert used(["train", "val", "test"]) == [("test", "test"), ("train", "train"), ("val", "val")]
    assert used(["train"]) == [("train", "test"), ("train", "train"), ("train", "val")]
    assert used(["train", "val"]) == [("train", "train"), ("val", "test"), ("val", "val")]
    assert used(["train", "test"]) == [("test", "test"), ("train", "train"), ("train", "val")]


def test_group_split_small_classes(spark):
    """Ten singletons of one class go 8/1/1, two singletons both go to train."""
    rows = [(f"a{i}", "bed", i) for i in range(10)] + [("b0", "sofa", 1), ("b1", "sofa", 2)]
    df = spark.createDataFrame(rows, "sha1 string, label string, n int")
    got = splits.group_split(df, V.position(V.COLLECTION_CLASSES, F.col("label"))).groupBy("label", "split").count().collect()
    assert sorted(map(tuple, got)) == [("bed", "test", 1), ("bed", "train", 8), ("bed", "val", 1), ("sofa", "train", 2)]


# ---- suppression and merging -----------------------------------------------

def test_suppress_ties_and_threshold(spark):
    rows = [
        (1, 0, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0), (1, 1, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0),  # tie: earlier stays
        (2, 0, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0), (2, 1, "bed", 0.8, "s", 0.0, 0.0, 10.0, 5.0),  # IoU exactly 0.5: goes
        (3, 0, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0), (3, 1, "bed", 0.8, "s", 0.0, 0.0, 10.0, 4.9),  # below: stays
        (4, 0, "bed", 0.9, "s", 5.0, 5.0, 5.0, 9.0), (4, 1, "bed", 0.8, "s", 5.0, 5.0, 5.0, 9.0),  # no area: both stay
        (5, 0, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0), (5, 1, "sofa", 0.8, "s", 0.0, 0.0, 10.0, 10.0),  # classes apart
        # a suppressed box suppresses nothing
        (6, 0, "bed", 0.9, "s", 0.0, 0.0, 10.0, 10.0), (6, 1, "bed", 0.8, "s", 0.0, 3.0, 10.0, 13.0), (6, 2, "bed", 0.7, "s", 0.0, 6.0, 10.0, 16.0),
    ]
    got = sorted(one(D.suppress(det(spark, rows)), "image_id", "pos"))
    assert got == [(1, 0), (2, 0), (3, 0), (3, 1), (4, 0), (4, 1), (5, 0), (5, 1), (6, 0), (6, 2)]


def test_merge_chain_ties_and_conflict(spark):
    schema = "image_id int, line_no int, source_class string, target_class string, xc double, yc double, w double, h double"
    rows = [
        (1, 0, "a", "t", 0.50, 0.5, 0.5, 0.5), (1, 1, "a", "t", 0.55, 0.5, 0.5, 0.5), (1, 2, "b", "t", 0.60, 0.5, 0.5, 0.5),  # chain
        (2, 3, "a", "t", 0.5, 0.5, 0.5, 0.5), (2, 7, "b", "t", 0.5, 0.5, 0.5, 0.5),  # equal areas: earliest line
        (3, 0, "a", "t", 0.5, 0.5, 0.5, 0.5), (3, 1, "c", "u", 0.5, 0.5, 0.5, 0.5),  # conflict, no merge
        (4, 0, "a", "t", 0.5, 0.5, 0.4, 0.5), (4, 5, "a", "t", 0.5, 0.5, 0.45, 0.5),  # larger stays
    ]
    df = spark.createDataFrame(rows, schema)
    for bound in (4096, 0):
        got = sorted(one(D.merge_overlaps(df, 0.8, bound), "image_id", "line_no", "merged_from"))
        assert got == [(1, 0, 3), (2, 3, 2), (3, 0, 1), (3, 1, 1), (4, 5, 2)]
    pairs = one(D.conflicts(df), "image_id", "box_a_index", "box_a_target_class", "box_b_index", "box_b_target_class", "overlap_ratio")
    assert pairs == [(3, 0, "t", 1, "u", 1.0)]
    assert one(D.conflict_images(df), "image_id") == [(3,)]


# ---- flags -----------------------------------------------------------------

def test_quality_flags_at_limits(spark):
    images = spark.createDataFrame(
        [(1, "bed", 512, 600), (2, "bed", 511, 600), (3, "bed", 600, 600), (4, "bed", 600, 600), (5, "bed", 600, 600)],
        "image_id long, expected_class string, width int, height int")
    rows = [(1, 0, "bed", 0.35, "full_prompt"), (2, 0, "bed", 0.34, "expected_fallback"), (3, 0, "sofa", 0.9, "expected_fallback")]
    rows += [(4, k, "bed", 0.9, "full_prompt") for k in range(8)]
    boxes = spark.createDataFrame(rows, "image_id long, pos long, label string, score double, source string")
    got = dict(one(flags.quality_flags(images, boxes), "image_id", F.array_join("flags", ";")))
    assert got == {
        1: "", 2: "fallback_used;low_confidence;small_image", 3: "cross_class_only;expected_missing", 4: "busy_scene",
        5: "empty_detection;expected_missing"}
    review = dict(one(flags.review_flags(images, boxes), "image_id", F.array_join("flags", ";")))
    assert review[5] == "empty_detection;manual_review_all;source_class_missing" and review[1] == "manual_review_all"


def test_routing_policies(spark):
    df = spark.createDataFrame([(["small_image"],), (["expected_missing"],)], "flags array<string>")
    assert one(flags.route(df), "review_required", "routed") == [(False, "kept"), (True, "review")]
    assert one(flags.route(df, "include"), "review_required", "routed") == [(False, "kept"), (True, "kept")]
    with pytest.raises(ValueError):
        flags.route(df, "maybe")


def test_queue_modes(spark):
    images = spark.createDataFrame([(k,) for k in (1, 2, 3, 4)], "image_id int")
    known = spark.createDataFrame([(1, ["x"]), (2, ["same_class_overlap"]), (3, ["x"])], "image_id int, flags array<string>")
    reviewed = spark.createDataFrame([(3,)], "image_id int")
    got = {}
    for mode, image in one(flags.review_queue(images, known, reviewed), "mode", "image_id"):
        got.setdefault(mode, []).append(image)
    assert {m: sorted(v) for m, v in got.items()} == {
        "all": [1, 2, 3, 4], "unreviewed_all": [1, 2, 4], "high_risk": [1, 2], "duplicate_boxes": [2], "pending_risk": [1, 2]}


# ---- text ------------------------------------------------------------------

@pytest.mark.parametrize("raw,want", [
    ("Bedroom door", "room_door"), ("bedside table", "bed"), ("", None), ("???", None), ("orange lamp", "stove"),
    ("Floor-to-ceiling   WINDOW!", "floor_window"), ("a small window", "normal_window"), ("Fenêtre", None), ("kitchen table", "dining_table"),
])
def test_canonical_label(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "t string")
    assert one(df, X.canonical_label(F.col("t"))) == [(want,)]


def test_classes_missing_from_the_priority_come_last(spark):
    df = spark.createDataFrame([("red bed lamp",)], "t string")
    aliases = {"lamp": ["lamp"], "bed": ["bed"]}
    assert one(df, X.canonical_label(F.col("t"), aliases, ["bed"])) == [("bed",)]


def test_paths(spark):
    rows = [("a/b/c.tar.JPG",), ("top.png",), ("x/.hidden",), ("d.e/noext",)]
    p = F.col("p")
    got = one(spark.createDataFrame(rows, "p string"), X.suffix(p), X.stem(p), X.leaf_folder(p), X.top_folder(p), X.parent(p), X.with_suffix(p, ".txt"))
    assert got[0] == ("jpg", "c.tar", "b", "a", "a/b", "a/b/c.tar.txt")
    assert got[1] == ("png", "top", "_root", "_root", "", "top.txt")
    assert got[3][:4] == ("", "noext", "d.e", "d.e") and got[3][5] == "d.e/noext.txt"


def test_labels_dir(spark):
    df = spark.createDataFrame([("r/images/train",), ("r/Images",), ("r/pics",)], "p string")
    assert one(df, X.labels_dir(F.col("p"))) == [("r/labels/train",), ("r/labels",), ("r/pics_labels",)]


# ---- labels ----------------------------------------------------------------

def test_label_lines(spark):
    text = "0 0.5 0.5 0.1 0.1\r\n\r\n2.0\t0.5 0.5 0.1 0.1\n1 2 3 4\n1 0.5 0.5 0.1 0.1 9\n99 0.5 0.5 0.1 0.1\n1 -0.5 1.5 0.1 2\n1 0.5 0.5 nope 0.1\n -1 0 0 0 0 "
    files = spark.createDataFrame([("a.txt", text), ("empty.txt", "")], "path string, text string")
    boxes, rejects = L.parse_strict(files, V.class_map(spark))
    assert sorted(one(boxes, "line_no", "class_id", "xc", "yc")) == [(0, 0, 0.5, 0.5), (2, 2, 0.5, 0.5), (6, 1, -0.5, 1.5)]
    assert sorted(one(rejects, "line_no", "reason")) == [(5, "unknown_class"), (7, "unreadable_number"), (8, "unknown_class")]
    tolerant = L.parse_tolerant(files)
    got = sorted(one(tolerant, "line_no", "valid", F.coalesce("class_id", F.lit(-9)), F.coalesce("xc", F.lit(-9.0)), F.coalesce("h", F.lit(-9.0))))
    assert got == [(0, True, 0, 0.5, 0.1), (2, True, 2, 0.5, 0.1), (3, False, -9, -9.0, -9.0), (4, False, -9, -9.0, -9.0),
                   (5, True, 99, 0.5, 0.1), (6, True, 1, 0.0, 1.0), (7, False, -9, -9.0, -9.0), (8, True, -1, 0.0, 0.0)]


def test_read_label_files_keeps_empty_ones(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a b.txt").write_text("0 0.5 0.5 0.1 0.1\n1 0.5 0.5 0.1 0.1\n")
    (tmp_path / "d" / "empty.txt").write_text("")
    (tmp_path / "x.jpg").write_text("no")
    got = sorted(one(L.read_label_files(spark, str(tmp_path)), "path", "text"))
    assert got == [("d/a b.txt", "0 0.5 0.5 0.1 0.1\n1 0.5 0.5 0.1 0.1\n"), ("d/empty.txt", "")]


def test_class_dictionary(spark):
    lines = ["nc: 2", "names:", "  0: bed", "  2: 'water feature'", "path: x", "# 3: no"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    found = L.class_dictionary(df)
    assert sorted(one(found, "class_id", "label")) == [(0, "bed"), (2, "water feature")]
    assert sorted(one(L.fill_class_gaps(found), "class_id", "label")) == [(0, "bed"), (1, "class_1"), (2, "water feature")]
    nothing = df.where("value = 'names:'")
    assert one(L.class_dictionary(nothing), "label") == []
    assert sorted(one(L.class_dictionary(nothing, ["x", "y"]), "class_id", "label")) == [(0, "x"), (1, "y")]


# ---- statistics ------------------------------------------------------------

def test_thresholds_and_noise(spark):
    images = spark.createDataFrame([(k,) for k in range(21)], "image_id long")
    boxes = spark.createDataFrame([(20, k % 3, 0.8, 0.8) for k in range(6)] + [(k, 0, 0.1, 0.1) for k in range(1, 20)],
                                  "image_id long, class_id int, w double, h double")
    stats = manifests.image_stats(images, boxes)
    assert one(stats.where("image_id = 0"), "box_count", F.size("class_ids"), "large_box_count") == [(0, 0, 0)]
    limits = manifests.thresholds(stats)
    assert one(limits, "*") == [(1, 1, 5)]  # 99 % of the way is index 19.8: 4.8, rounded up
    noisy = manifests.with_noise(stats, limits).where("noisy")
    assert one(noisy, "image_id", F.array_join("noise_reasons", ";")) == [(20, "box_count_gt_1;distinct_classes_gt_1;large_boxes_gt_5")]
    assert one(manifests.thresholds(stats.limit(0)), "*") == [(0, 0, 2)]


def test_rarity_with_absent_classes(spark):
    counts = spark.createDataFrame([(0, "a", 0), (1, "b", 0), (2, "c", 5), (3, "d", 9)], "class_id int, label string, images long")
    tiers = manifests.rarity(counts)
    assert dict(one(tiers, "label", "tier")) == {"a": "severe", "b": "severe", "c": "common", "d": "common"}
    stats = spark.createDataFrame([(1, [0, 2]), (2, [2]), (3, [])], "image_id int, class_ids array<int>")
    assert sorted(one(manifests.repeat_factors(stats, tiers), "image_id", "repeat_factor")) == [(1, 3), (2, 1), (3, 1)]


# ---- dedupe ----------------------------------------------------------------

def test_exact_duplicates_with_rising_quality(spark):
    rows = [("a.jpg", 10, 10, 5, "s"), ("b.jpg", 20, 20, 5, "s"), ("c.jpg", 30, 30, 5, "s"), ("d.jpg", 5, 5, 5, "s"), ("e.jpg", 1, 1, 1, "t")]
    df = spark.createDataFrame(rows, "path string, width int, height int, file_size long, sha1 string")
    got = sorted(one(dedupe.exact_decisions(df), "remove_image", "keep_image", "final_keep"))
    assert got == [("a.jpg", "b.jpg", "c.jpg"), ("b.jpg", "c.jpg", "c.jpg"), ("d.jpg", "c.jpg", "c.jpg")]
    assert sorted(one(dedupe.exact_survivors(df), "path")) == [("c.jpg",), ("e.jpg",)]


def test_renumber_widths(spark):
    df = spark.createDataFrame([("x/b.JPG",), ("x/a.png",), ("y/z/q.jpg",)], "path string")
    got = dict(one(dedupe.renumber(df, start=0, padding=3), "path", "new_path"))
    assert got == {"x/a.png": "x/x_000.png", "x/b.JPG": "x/x_001.jpg", "y/z/q.jpg": "y/z/z_000.jpg"}
    assert dict(one(dedupe.renumber(df, start=999, padding=3), "path", "new_path"))["x/b.JPG"] == "x/x_1000.jpg"
    assert dict(one(dedupe.renumber(df, prefix="parent"), "path", "new_path"))["y/z/q.jpg"] == "y/z/y_000001.jpg"


def test_mirrors(spark):
    def paths(*p):
        return spark.createDataFrame([(x,) for x in p], "path string")

    got = sorted(one(dedupe.attach_mirrors(paths("a/1.jpg", "a/2.jpg"), paths("a/1.txt"), paths("a/1.png", "a/1.json", "b/1.png")),
                     "path", "label_path", F.array_join("extra_paths", "|")))
    assert got == [("a/1.jpg", "a/1.txt", "a/1.json|a/1.png"), ("a/2.jpg", None, "")]


# ---- review loop -----------------------------------------------------------

def test_actions_at_thresholds(spark):
    rows = [("plant", "0.820000", "0.180000", "1"), ("plant", "0.819999", "0.5", "1"), ("plant", "0.58", "0.08", "1"), ("table", "0.85", "0.3", "1"),
            ("nobody", "0.80", "0.16", "1"), ("door", "0.99", "0.9", "0"), ("door", "oops", "", "1")]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows], "group string, confidence string, margin string, error string, true_label string, pred_label string")
    got = [r.suggested_action for r in review.suggest_actions(df).collect()]
    assert got == ["relabel_candidate", "general_review", "ambiguous_candidate", "general_review", "relabel_candidate", "general_review", "ambiguous_candidate"]


def test_top_two_of_one_class(spark):
    df = spark.createDataFrame([([0.9], ["a"]), ([0.25, 0.75], ["a", "b"])], "probs array<double>, names array<string>")
    assert one(review.top_two(df), "pred_label", "confidence", "margin") == [("a", 0.9, 0.9), ("b", 0.75, 0.5)]


def test_relabel_chains(spark):
    samples = [("g", "train/x/1.png"), ("g", "train/y/1.png"), ("g", "train/x/2.png"), ("g", "train/y/2.png"), ("g", "train/x/3.png")]

    def moved(rows):
        s = spark.createDataFrame(samples, "group string, path string")
        c = spark.createDataFrame(rows, "group string, path string, pred_label string, order long")
        return dict(one(review.apply_relabels(s, c), "order", "moved"))

    # x -> y waits for y -> z only in the right order
    assert moved([("g", "train/y/1.png", "z", 1), ("g", "train/x/1.png", "y", 2)]) == {1: True, 2: True}
    assert moved([("g", "train/x/2.png", "y", 1), ("g", "train/y/2.png", "z", 2)]) == {1: False, 2: True}
    assert moved([("g", "train/q/3.png", "y", 1), ("g", "x/3.png", "y", 2), ("g", "train/x/3.png", "x", 3)]) == {1: False, 2: False, 3: False}


def test_confusion_fills_the_square(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "true_label string, pred_label string")
    matrix = review.confusion(df, ["a", "b", "c"])
    assert matrix.count() == 9
    assert sorted(one(review.per_class_accuracy(matrix), "*")) == [("a", 2, 1, 0.5), ("b", 0, 0, 0.0), ("c", 0, 0, 0.0)]


# ---- geometry --------------------------------------------------------------

def test_inference_size_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1000, 5), (1000, 7), (1000, 1), (300, 200)], "w int, h int")
    w, h = B.inference_size(F.col("w"), F.col("h"), 500)
    assert one(df, w, h) == [(500, 2), (500, 4), (500, 1), (300, 200)]
    assert one(df.limit(1), *B.inference_size(F.col("w"), F.col("h"), 0)) == [(1000, 5)]


def test_next_fit():
    assert scoring.next_fit([4, 4, 4, 9, 20, 1], 3, 10) == [0, 0, 1, 2, 3, 4]
    assert scoring.next_fit([1, 1, 1, 1], 2, 0) == [0, 0, 1, 1]


def test_polygon_text(spark):
    df = spark.createDataFrame([(-5.0, 0.0, 50.0, 120.0)], "x1 double, y1 double, x2 double, y2 double")
    points = B.polygon(B.corner_columns(), F.lit(100), F.lit(100))
    assert one(df, B.polygon_text(F.lit(3), points)) == [("3 0.000000 0.000000 0.500000 0.000000 0.500000 1.000000 0.000000 1.000000",)]


# ---- crawl -----------------------------------------------------------------

def test_media_urls(spark):
    html = ('"murl": "http://a/x.jpg" "murl":"http://a/x.jpg" murl&quot;:&quot;https://b/y.png?z=1&quot; murl&quot;:&quot;https://b/page.html&quot; '
            'mediaurl=https%3a%2f%2fc%2fa+b%20c.webp&q "murl":"http://a/q.gif"')
    df = spark.createDataFrame([(html,)], "h string")
    assert one(df, crawl.media_urls(F.col("h")))[0][0] == ["http://a/x.jpg", "https://b/y.png?z=1", "https://c/a+b c.webp"]


def test_flickr_falls_back_only_before_the_first_url(spark):
    listed = '"photos":{"page":1,"photo":[{"farm":5,"server":"1","id":"0","secret":"s"},{"farm":0,"server":"1","id":"2","secret":"s"}]}'
    inline = 'src="//live.staticflickr.com/1/2_ab_m.jpg"'
    rows = [("q", 0, "x"), ("q", 1, inline), ("q", 2, inline), ("q", 3, listed), ("r", 0, listed + inline)]
    df = spark.createDataFrame(rows, "query string, page_no int, html string")
    for bound in (4096, 0):
        got = {(r.query, r.page_no): r.urls for r in crawl.flickr_pages(df, bound=bound).collect()}
        assert got == {("q", 0): [], ("q", 1): ["https://live.staticflickr.com/1/2_ab_b.jpg"], ("q", 2): [],
                       ("q", 3): ["https://farm5.staticflickr.com/1/0_s_b.jpg"], ("r", 0): ["https://farm5.staticflickr.com/1/0_s_b.jpg"]}


def test_pages_taken(spark):
    rows = [("a", 0, 25, 10), ("a", 1, 19, 1), ("a", 2, 30, 5), ("b", 0, 40, 30), ("b", 1, 40, 30), ("b", 2, 40, 1), ("c", 0, 0, 0)]
    df = spark.createDataFrame(rows, "query string, page_no int, found long, kept long")
    assert sorted(one(crawl.pages_taken(df, 50, None, 20), "query", "page_no")) == [("a", 0), ("a", 1), ("b", 0), ("b", 1), ("c", 0)]
    assert sorted(one(crawl.pages_taken(df, 50, 1, 0), "query", "page_no")) == [("a", 0), ("b", 0), ("c", 0)]


def test_source_targets(spark):
    rows = [("q", "dezeen", 0, k, f"u{k}") for k in range(60)] + [("q", "bing", 0, 0, "u5"), ("q", "other", 0, 0, "zz")]
    df = spark.createDataFrame(rows, "query string, source string, page_no int, pos int, url string")
    got = crawl.union_sources(df)
    assert got.count() == 40 and one(got.where("url = 'u5'"), "source") == [("bing",)]


def test_character_references_decode_once(spark):
    import html

    from boxloom.operators.crawl import unescape

    texts = ["plain", "a&amp;b", "&amp;lt;", "&#x2F;&#47;", "caf&eacute;", "&#128512;&#x1F600;", "&nope; & &", "&#0;&#xD800;", "&#38;lt;", ""]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)] + [(99, None)], "n int, t string")
    got = {r.n: r.u for r in df.select("n", unescape(F.col("t")).alias("u")).collect()}
    assert got.pop(99) is None
    assert [got[n] for n in range(len(texts))] == [html.unescape(t) for t in texts]


def test_class_dictionary_readers(spark):
    from boxloom.sources import descriptors as N

    def read(fn, text, *more):
        rows = [("f", k, v) for k, v in enumerate(text.split("\n"))]
        return [(r.class_id, r.label) for r in fn(spark.createDataFrame(rows, "file string, line_no int, value string"), *more).orderBy("class_id").collect()]

    both = "nc: 2\n5: early\nnames:\n  # note\n\n  0: 'bed'\n  2: \"water: feature\"\nnames:\n1: flat\nval: x\n  4: late"
    assert read(N.tolerant, both) == [(0, "bed"), (1, "flat"), (2, "water: feature")]
    assert read(N.scoped, both, ["x"]) == [(0, "bed"), (1, "water: feature")]
    assert read(N.strict, both) == [(0, "'bed'"), (1, "flat"), (2, '"water: feature"'), (4, "late"), (5, "early")]
    listed = "names:\n- bed\n  - 'sofa'\n  odd\nend\n- late"
    assert read(N.tolerant, listed) == [(0, "bed"), (1, "sofa")] and read(N.scoped, listed, ["x", "y"]) == [(0, "x"), (1, "y")]
    assert read(N.tolerant, "names:\n  3: a\n  - b\n  3: c") == [(0, "class_0"), (1, "class_1"), (2, "class_2"), (3, "c")]
    assert read(N.tolerant, "0: bed") == [] and read(N.scoped, "names:\n  0: \n", ["x"]) == [(0, "x")]
    with pytest.raises(Exception, match="no class names in f"):
        read(N.strict, listed)


def test_label_listing_on_executors(spark, tmp_path, monkeypatch):
    """Folders at any depth, names with blanks and other letters, empty and hidden files; no file name reaches the driver."""
    import os

    from boxloom.sources import listing

    want = {}
    for k in range(2000):
        path = f"{['', 'a/', 'a/b c/', 'ü/'][k % 4]}{k} +%41é.txt"
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        want[path] = "" if k % 3 == 0 else f"{k} 0.5 0.5 0.1 0.1\n"
        (tmp_path / path).write_text(want[path])
    for path in ("a/_x.txt", ".y.txt", "a/z.TXT", "a/img.jpg", "_dir/w.txt"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("1")
    (tmp_path / "a/bad.txt").write_bytes(b"\xff1")
    want["a/bad.txt"] = "�1"
    reader = listing.LabelReader({"path": str(tmp_path), "shares": "3"})
    seen = []
    real = os.scandir
    monkeypatch.setattr(os, "scandir", lambda p: seen.append(str(p)) or real(p))
    parts = reader.partitions()
    assert seen == [str(tmp_path)] and {p.folder for p in parts} == {"", "a", "ü"} and len(parts) == 9
    monkeypatch.undo()
    got = L.read_label_files(spark, str(tmp_path), shares=3)
    assert {r.path: r.text for r in got.collect()} == want and got.count() == len(want)
    assert L.read_label_files(spark, f"file://{tmp_path}").count() == len(want)
