"""Boxes within an image: close pairs, suppression, merging, conflicts, selection.

Where boxes are gathered into arrays the rows are repartitioned first: gathering reduces
nothing, so a map-side pass would only build the arrays twice and ship them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import cut
from boxloom.functions import boxes as B
from boxloom.operators import crowded, graphs
from boxloom.operators.ranking import split_hot

CORNERS = ["x1", "y1", "x2", "y2"]
PAIR_BOUND = 256


def with_corners(df: DataFrame) -> DataFrame:
    """Add x1..y2 to boxes in centre form."""
    names = dict(zip(CORNERS, B.to_corners(*(F.col(c) for c in ("xc", "yc", "w", "h")))))
    return df.withColumns(names)


# ---- close pairs -----------------------------------------------------------

def close_pairs(df: DataFrame, keys: list[str], threshold: float, order: str, bound: int = PAIR_BOUND) -> DataFrame:
    """Pairs of boxes of one key with IoU >= ``threshold``, as structs ``a``, ``b`` and ``iou``.

    ``order`` decides which of the two is ``a``. Keys with at most ``bound`` boxes meet in a
    plain equi-join with the test in its condition; larger ones meet in grid cells.
    """
    cold, hot = split_hot(df, keys, bound)
    names = df.columns
    corners = [tuple(F.col(f"_{p}_{c}") for c in CORNERS) for p in "ab"]

    def renamed(prefix: str) -> DataFrame:
        return cold.select(*keys, *[F.col(n).alias(f"_{prefix}_{n}") for n in names])

    plain = (
        renamed("a").join(renamed("b"), keys).where(F.col(f"_a_{order}") < F.col(f"_b_{order}"))
        .withColumn("iou", B.iou(*corners)).where(F.col("iou") >= threshold)
    )
    found = plain if hot is None else plain.unionByName(_grid_pairs(hot, keys, threshold, order).select(*plain.columns))
    return found.select(*keys, *[F.struct(*[F.col(f"_{p}_{n}").alias(n) for n in names]).alias(p) for p in "ab"], "iou")


def _grid_pairs(df: DataFrame, keys: list[str], threshold: float, order: str) -> DataFrame:
    """The same pairs for crowded keys.

    An IoU of t bounds the ratio of the sides by t and the distance of the centres by
    (1 - t) of the larger side, so every pair meets in a cell of a size-dependent grid: the
    join is an equi-join on (keys, level, cell), the boxes of a crowded image spread over
    its cells, and pairs that are far apart are never formed. ``a`` goes to its own cell, ``b``
    to all cells a partner can be in, so each pair is found once.
    """
    names = df.columns
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    solid = df.where((w > 0) & (h > 0))

    def level(side: Column) -> Column:
        return F.floor(F.log2(side)).cast("int")

    def cell(centre: Column, at: Column) -> Column:
        return F.floor(centre / F.pow(F.lit(2.0), at + 1))

    def side(prefix: str) -> list[Column]:
        return [F.col(n).alias(f"_{prefix}_{n}") for n in names]

    def spots(centre: Column, length: Column) -> Column:
        return F.flatten(F.transform(B.partner_levels(length, threshold), lambda at: F.transform(
            B.partner_cells(centre, length, at, threshold), lambda c: F.struct(at.alias("at"), c.alias("c")))))

    left = solid.select(
        *keys, level(w).alias("_lw"), level(h).alias("_lh"),
        cell(cx, level(w)).alias("_cx"), cell(cy, level(h)).alias("_cy"), *side("a"),
    )
    right = (
        solid.withColumn("_x", F.explode(spots(cx, w))).withColumn("_y", F.explode(spots(cy, h)))
        .select(*keys, F.col("_x.at").alias("_lw"), F.col("_y.at").alias("_lh"),
                F.col("_x.c").alias("_cx"), F.col("_y.c").alias("_cy"), *side("b"))
    )
    corners = [tuple(F.col(f"_{p}_{c}") for c in CORNERS) for p in "ab"]
    return (
        left.join(right, [*keys, "_lw", "_lh", "_cx", "_cy"])
        .where(F.col(f"_a_{order}") < F.col(f"_b_{order}"))
        .withColumn("iou", B.iou(*corners)).where(F.col("iou") >= threshold)
    )


# ---- suppression -----------------------------------------------------------

def suppress(df: DataFrame, threshold: float = V.NMS_IOU, bound: int = PAIR_BOUND, counted: DataFrame | None = None) -> DataFrame:
    """Class-wise greedy suppression over (image_id, label, score, pos, x1, y1, x2, y2).

    By score from high to low (ties by ``pos``) a box stays when its IoU with
    every kept box of its image and label is below ``threshold``. Other columns
    ride along. ``counted`` may name a cheaper frame that has at least these boxes: crowded images are looked for in it.

    Images of up to ``bound`` boxes are folded whole, so the result stays dealt by image. In larger ones each label is
    folded for itself, and labels of more boxes than that take the way without pairs.
    """
    large = (df if counted is None else counted).groupBy("image_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bound).drop("_n")
    if not large.head(1):
        return _suppress_folded(df, ["image_id"], threshold)
    large = cut(large)
    out = _suppress_folded(df.join(large, "image_id", "left_anti"), ["image_id"], threshold)
    keys = ["image_id", "label"]
    cold, hot = split_hot(df.join(large, "image_id", "left_semi"), keys, bound)
    out = out.unionByName(_suppress_folded(cold, keys, threshold))
    return out if hot is None else out.unionByName(_suppress_hot(hot, keys, threshold))


def _suppress_folded(df: DataFrame, keys: list[str], threshold: float) -> DataFrame:
    """The rule within an array of all boxes of a key."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct((-F.col("score")).alias("_neg"), F.col("pos").alias("_pos"), *rest)

    def corners(s: Column) -> B.Corners:
        return tuple(s[c] for c in CORNERS)

    def blocks(k: Column, box: Column) -> Column:
        near = B.iou(corners(k), corners(box)) >= threshold
        return k["label"].eqNullSafe(box["label"]) & near if "label" in rest else near

    def step(kept: Column, box: Column) -> Column:
        return F.when(F.exists(kept, lambda k: blocks(k, box)), kept).otherwise(F.concat(kept, F.array(box)))

    # boxes of labels that are all different do not block each other
    labels = F.size(F.array_distinct("_raw.label")) if "label" in rest else F.lit(1)
    folded = F.when(F.col("_alone"), F.col("_all")).otherwise(F.aggregate("_all", F.slice("_all", 1, 0), step))
    return (
        df.repartition(*keys).groupBy(*keys).agg(F.collect_list(row).alias("_raw"))
        .withColumn("_alone", labels == F.size("_raw"))
        .withColumn("_all", F.when(F.col("_alone"), F.col("_raw")).otherwise(F.sort_array("_raw")))
        .select(*keys, F.inline(folded)).select(*df.columns)
    )


def _suppress_hot(df: DataFrame, keys: list[str], threshold: float, fold_boxes: int = crowded.FOLD_BOXES) -> DataFrame:
    """The same rule for crowded keys: equal boxes collapse, the rest is selected without forming pairs."""
    rest = [c for c in df.columns if c not in keys]
    flat = (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1"))
    best = F.min(F.struct((-F.col("score")).alias("_neg"), F.col("pos").alias("_pos"), *rest))
    firsts = cut(
        df.where(~flat).groupBy(*keys, *CORNERS).agg(best.alias("_b"))
        .select(*keys, *[F.col(f"_b.{c}") for c in rest])
        .withColumn("_node", F.struct((-F.col("score")).alias("neg"), "pos", *CORNERS)).withColumn("_mid", F.monotonically_increasing_id())
    )
    gone = crowded.dropped(firsts, keys, "_node", threshold, fold_boxes)
    return firsts.join(gone, "_mid", "left_anti").select(*df.columns).unionByName(df.where(flat))


# ---- merging ---------------------------------------------------------------

def merge_overlaps(df: DataFrame, threshold: float = V.MERGE_IOU, bound: int = PAIR_BOUND) -> DataFrame:
    """One box per connected component of same-target boxes with IoU >= ``threshold``.

    Over (image_id, line_no, target_class, xc, yc, w, h and more). The box that stays is
    the largest of its component, the earliest line on ties; it gets ``merged_from``,
    the number of boxes it stands for.
    """
    keys = ["image_id", "target_class"]
    df = with_corners(df)
    cold, hot = split_hot(df, keys, bound, ["image_id"])
    rest = [c for c in df.columns if c not in keys]
    row = F.struct((F.col("w") * F.col("h")).alias("_area"), (-F.col("line_no")).alias("_back"), *rest)

    def corners(s: Column) -> B.Corners:
        return tuple(s[c] for c in CORNERS)

    def step(found: Column, box: Column) -> Column:
        def touches(group: Column) -> Column:
            return F.exists(group, lambda o: B.iou(corners(o), corners(box)) >= threshold)

        apart = F.filter(found, lambda g: ~touches(g))
        joined = F.flatten(F.filter(found, touches))
        return F.concat(apart, F.array(F.concat(joined, F.array(box))))

    folded = F.when(
        F.size("_all") == 1, F.array(F.col("_all"))
    ).otherwise(F.aggregate("_all", F.slice(F.array(F.col("_all")), 1, 0), step))
    out = (
        cold.repartition(*keys).groupBy(*keys).agg(F.collect_list(row).alias("_all"))
        .withColumn("_group", F.explode(folded))
        .select(*keys, F.array_max("_group").alias("_best"), F.size("_group").cast("long").alias("merged_from"))
        .select(*keys, *[F.col(f"_best.{c}") for c in rest], "merged_from")
    )
    return out if hot is None else out.unionByName(_merge_hot(hot, keys, rest, threshold))


def _merge_hot(df: DataFrame, keys: list[str], rest: list[str], threshold: float, fold_boxes: int = crowded.FOLD_BOXES) -> DataFrame:
    """The same for crowded keys: equal boxes collapse, the rest is flooded by a task or, beyond ``fold_boxes``, by joins."""
    flat = (F.col("x2") <= F.col("x1")) | (F.col("y2") <= F.col("y1"))
    best = F.max(F.struct((F.col("w") * F.col("h")).alias("_area"), (-F.col("line_no")).alias("_back"), *rest))
    firsts = cut(
        df.where(~flat).groupBy(*keys, *CORNERS)
        .agg(best.alias("_b"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_node", F.struct(F.col("_b.line_no").alias("line_no"), *CORNERS)).withColumn("_mid", F.monotonically_increasing_id())
    )
    fits, over = split_hot(firsts.select(*keys, "_node", "_mid", *CORNERS), keys, fold_boxes)
    roots = crowded.roots(fits, keys, "_node", threshold)
    if over is not None:
        pairs = close_pairs(over, keys, threshold, "_node")
        linked = graphs.components(pairs.select(F.col("a._mid").alias("a"), F.col("b._mid").alias("b")))
        roots = roots.unionByName(linked.select(F.col("node").alias("_mid"), "root"))
    merged = (
        firsts.join(roots, "_mid", "left").withColumn("root", F.coalesce("root", "_mid"))
        .groupBy(*keys, "root").agg(F.max("_b").alias("_best"), F.sum("_n").alias("merged_from"))
        .select(*keys, *[F.col(f"_best.{c}") for c in rest], "merged_from")
    )
    single = df.where(flat).select(*keys, *rest, F.lit(1).cast("long").alias("merged_from"))
    return merged.unionByName(single)


def overlaps(df: DataFrame, threshold: float = V.MERGE_IOU) -> DataFrame:
    """All box pairs of an image with IoU >= ``threshold``, in line order."""
    return close_pairs(with_corners(df), ["image_id"], threshold, "line_no")


def conflicts(df: DataFrame, threshold: float = V.MERGE_IOU) -> DataFrame:
    """Pairs that overlap but merge into different classes."""
    pairs = overlaps(df, threshold).where(F.col("a.target_class") != F.col("b.target_class"))
    side = [
        F.col(f"{s}.{c}").alias(f"box_{s}_{n}")
        for s in ("a", "b")
        for c, n in (("line_no", "index"), ("source_class", "source_class"), ("target_class", "target_class"))
    ]
    return pairs.select("image_id", *side, F.bround("iou", 6).alias("overlap_ratio"))


def conflict_rows(pairs: DataFrame, images: DataFrame) -> DataFrame:
    """``conflicts`` as rows of a review table: ``image`` (its path) and ``source_folder`` ahead of the two boxes."""
    named = images.select("image_id", F.col("path").alias("image"), "source_folder")
    return named.join(pairs, "image_id").select("image", "source_folder", *[c for c in pairs.columns if c != "image_id"])


def conflict_images(df: DataFrame, threshold: float = V.MERGE_IOU, bound: int = PAIR_BOUND) -> DataFrame:
    """Images with at least one conflict.

    Only whether a pair exists matters, so no pair is formed for images of up to ``bound``
    boxes; in larger ones equal boxes of one class collapse before they meet.
    """
    cold, hot = split_hot(df, ["image_id"], bound)

    def corners(s: Column) -> B.Corners:
        return tuple(s[c] for c in CORNERS)

    clash = F.exists("_all", lambda a: F.exists(
        "_all", lambda b: (a["target_class"] < b["target_class"]) & (B.iou(corners(a), corners(b)) >= threshold)))
    found = (
        with_corners(cold).repartition("image_id").groupBy("image_id")
        .agg(F.collect_list(F.struct("target_class", *CORNERS)).alias("_all"))
        .where(F.size("_all") > 1).where(clash).select("image_id")
    )
    if hot is None:
        return found
    firsts = cut(
        with_corners(hot).groupBy("image_id", "target_class", *CORNERS).agg(F.min("line_no").alias("line_no"))
        .withColumn("_node", F.struct("line_no", "target_class"))
    )
    pairs = _grid_pairs(firsts, ["image_id"], threshold, "_node")
    clashing = pairs.where(F.col("_a_target_class") != F.col("_b_target_class")).select("image_id").distinct()
    return found.unionByName(clashing)


def image_folds(df: DataFrame, threshold: float = V.MERGE_IOU, bound: int = PAIR_BOUND, fold_boxes: int = crowded.FOLD_BOXES) -> DataFrame:
    """(image_id, boxes, merged, clash_pairs, mappings): all that the merged training set needs, from one shuffle of the boxes.

    Over (image_id, line_no, source_class, target_class, xc, yc, w, h and more). ``merged`` is an array of what
    ``merge_overlaps`` gives, ``clash_pairs`` the number of pairs that ``conflicts`` would list, ``mappings`` the distinct
    source and target classes. An image of up to ``bound`` boxes has one row. A larger one has several, to be summed: one
    for each merged box and each mapping, and one with its pairs, which are counted without being formed as rows.
    """
    df = with_corners(df)
    cold, hot = split_hot(df, ["image_id"], bound)
    rest = [c for c in df.columns if c != "image_id"]
    row = F.struct((F.col("w") * F.col("h")).alias("_area"), (-F.col("line_no")).alias("_back"), *rest)
    boxes = F.col("_all")

    def near(a: Column, b: Column) -> Column:
        return B.iou(tuple(a[c] for c in CORNERS), tuple(b[c] for c in CORNERS)) >= threshold

    def step(found: Column, box: Column) -> Column:
        def touches(group: Column) -> Column:
            return F.exists(group, lambda o: (o["target_class"] == box["target_class"]) & near(o, box))

        return F.concat(F.filter(found, lambda g: ~touches(g)), F.array(F.concat(F.flatten(F.filter(found, touches)), F.array(box))))

    def one(group: Column) -> Column:
        best = F.array_max(group)
        return F.struct(*[best[c].alias(c) for c in rest], F.size(group).cast("long").alias("merged_from"))

    groups = F.when(F.size(boxes) == 1, F.array(boxes)).otherwise(F.aggregate(boxes, F.slice(F.array(boxes), 1, 0), step))
    clashing = F.aggregate(boxes, F.lit(0).cast("long"), lambda s, a: s + F.size(F.filter(
        boxes, lambda b: (a["_back"] > b["_back"]) & (a["target_class"] != b["target_class"]) & near(a, b))))
    out = (
        cold.repartition("image_id").groupBy("image_id").agg(F.collect_list(row).alias("_all"))
        .select(
            "image_id", F.size(boxes).cast("long").alias("boxes"), F.transform(groups, one).alias("merged"),
            F.when(F.size(boxes) == 1, F.lit(0).cast("long")).otherwise(clashing).alias("clash_pairs"),
            F.array_distinct(F.transform(boxes, lambda b: F.struct(b["source_class"].alias("source_class"), b["target_class"].alias("target_class")))).alias("mappings"))
    )
    return out if hot is None else out.unionByName(_hot_folds(hot, out, threshold, fold_boxes))


def _hot_folds(df: DataFrame, like: DataFrame, threshold: float, fold_boxes: int) -> DataFrame:
    def rows(frame: DataFrame, **given: Column) -> DataFrame:
        return frame.select("image_id", *[(given[c] if c in given else F.lit(None).cast(like.schema[c].dataType)).alias(c) for c in like.columns[1:]])

    keys = ["image_id", "target_class"]
    merged = _merge_hot(df, keys, [c for c in df.columns if c not in keys], threshold, fold_boxes)
    fields = [f.name for f in like.schema["merged"].dataType.elementType.fields]
    solid = df.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
    firsts = cut(solid.groupBy(*keys, *CORNERS).agg(F.count(F.lit(1)).alias("_n")).withColumn("_mid", F.monotonically_increasing_id()))
    fits, over = split_hot(firsts, ["image_id"], fold_boxes)
    pairs = crowded.clash_counts(fits, ["image_id"], "_mid", "target_class", "_n", threshold)
    counted = firsts.select("_mid", "image_id").join(pairs, "_mid")
    if over is not None:
        met = _grid_pairs(over, ["image_id"], threshold, "_mid").where(F.col("_a_target_class") != F.col("_b_target_class"))
        counted = counted.unionByName(met.select(F.col("_a__mid").alias("_mid"), "image_id", (F.col("_a__n") * F.col("_b__n")).alias("pairs")))
    mappings = df.select("image_id", "source_class", "target_class").distinct()
    return (
        rows(merged, boxes=F.col("merged_from"), merged=F.array(F.struct(*fields)))
        .unionByName(rows(counted, clash_pairs=F.col("pairs")))
        .unionByName(rows(mappings, mappings=F.array(F.struct("source_class", "target_class"))))
    )


def same_class_overlaps(df: DataFrame, bound: int = PAIR_BOUND) -> DataFrame:
    """Images with a suspicious pair of one class.

    Up to ``bound`` boxes of a class are compared inside an array without forming rows. Beyond
    that equal boxes collapse first (two copies of a box with an area are a suspicious pair)
    and the rest meets in columns of a size-dependent grid.
    """
    keys = ["image_id", "class_id"]
    df = with_corners(df).select(*keys, "line_no", *CORNERS)
    cold, hot = split_hot(df, keys, bound, ["image_id"])

    def corners(s: Column) -> B.Corners:
        return tuple(s[c] for c in CORNERS)

    any_pair = F.exists("_all", lambda a: F.exists(
        "_all", lambda b: (a < b) & B.suspicious_same_class(corners(a), corners(b))))
    found = (
        cold.repartition(*keys).groupBy(*keys).agg(F.collect_list(F.struct("line_no", *CORNERS)).alias("_all"))
        .where(F.size("_all") > 1).where(any_pair).select("image_id")
    )
    if hot is not None:
        solid = hot.where((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")))
        firsts = cut(solid.groupBy(*keys, *CORNERS).agg(F.count(F.lit(1)).alias("_n")))
        found = found.union(firsts.where(F.col("_n") > 1).select("image_id")).union(_same_class_hot(firsts.drop("_n"), keys))
    return found.distinct()


def _same_class_hot(df: DataFrame, keys: list[str]) -> DataFrame:
    """Boxes meet in x-columns as wide as the wider of the two."""
    width, centre = F.col("x2") - F.col("x1"), (F.col("x1") + F.col("x2")) / 2
    level = F.floor(F.log2(width)).cast("int")
    top = df.agg(F.max(level)).scalar()
    size = F.pow(F.lit(2.0), level + 1)
    wide = df.select(
        *keys, level.alias("_l"), F.struct(*CORNERS).alias("a"),
        F.explode(F.sequence(F.floor(centre / size) - 1, F.floor(centre / size) + 1)).alias("_c"),
    )
    narrow = (
        df.withColumn("_l", F.explode(F.sequence(level, top)))
        .select(*keys, "_l", F.floor(centre / F.pow(F.lit(2.0), F.col("_l") + 1)).alias("_c"),
                F.struct(*CORNERS).alias("b"))
    )
    return (
        wide.join(narrow, [*keys, "_l", "_c"])
        .where((F.col("a") != F.col("b"))
               & B.suspicious_same_class(B.corner_columns("a"), B.corner_columns("b")))
        .select("image_id")
    )


# ---- selection -------------------------------------------------------------

def in_area_range(df: DataFrame, low: float = V.AREA_RANGE[0], high: float = V.AREA_RANGE[1]) -> DataFrame:
    """Boxes covering an allowed share of their picture (needs width and height)."""
    return df.where(B.area_in_range(B.corner_columns(), F.col("width"), F.col("height"), low, high))


def top_instances(df: DataFrame, k: int = V.TOP_INSTANCES, iou: float = V.NMS_IOU, counted: DataFrame | None = None) -> DataFrame:
    """Area filter, suppression (see there for ``counted``), then the k best boxes of each image with their rank.

    The bound on the rank lets Spark cut each image to k rows before the shuffle.
    """
    kept = suppress(in_area_range(df), iou, counted=counted)
    order = W.partitionBy("image_id").orderBy(F.desc("score"), V.position(V.COLLECTION_CLASSES, F.col("label")), "pos")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def best_detection(df: DataFrame, iou: float = V.NMS_IOU) -> DataFrame:
    """The best box of each image after the area filter.

    The best-scored box is never suppressed, so no suppression is needed.
    """
    rest = [c for c in df.columns if c != "image_id"]
    row = F.struct((-F.col("score")).alias("_neg"),
                   V.position(V.COLLECTION_CLASSES, F.col("label")).alias("_idx"), F.col("pos").alias("_pos"), *rest)
    return (
        in_area_range(df).groupBy("image_id").agg(F.min(row).alias("_b"))
        .select("image_id", *[F.col(f"_b.{c}") for c in rest])
    )


def above(df: DataFrame, threshold: float) -> DataFrame:
    """Boxes with a score above the threshold."""
    return df.where(F.col("score") > threshold)


def mapped(df: DataFrame, raw: str = "raw_label") -> DataFrame:
    """Joint-prompt boxes whose text maps to a class; the others are dropped."""
    from boxloom.functions.text import canonical_label

    return (
        df.withColumn("label", canonical_label(F.col(raw))).where(F.col("label").isNotNull())
        .withColumn("source", F.lit("full_prompt"))
    )


def forced(df: DataFrame, label: Column, source: str = "expected_fallback") -> DataFrame:
    """Boxes of a single-class prompt: all take that class."""
    return df.withColumn("label", label).withColumn("source", F.lit(source))
