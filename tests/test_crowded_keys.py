"""Keys too large for one task take another way; forcing it must not change any result."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.functions import boxes as B
from boxloom.operators import dedupe, detections as D, graphs, neardup, ranking, splits
from boxloom.plans.inputs import Inputs
from boxloom.sources import labels as L

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, FOLDER)


def same(a, b, *columns):
    left = sorted(map(tuple, a.select(*columns).collect()))
    right = sorted(map(tuple, b.select(*columns).collect()))
    assert left == right
    return left


def crowded(inputs):
    """All boxes of the table in three images, one holding most of them."""
    return inputs.mapped_boxes().withColumn("image_id", F.when(F.col("image_id") % 5 < 3, 0).otherwise(F.col("image_id") % 2 + 1)).where(
        F.col("line_no") % 10 == 0)


def test_close_pairs(inputs):
    boxes = D.with_corners(crowded(inputs))
    for threshold in (0.5, 0.98):
        plain = D.close_pairs(boxes, ["image_id"], threshold, "line_no", bound=10**6)
        grid = D.close_pairs(boxes, ["image_id"], threshold, "line_no", bound=0)
        rows = same(plain, grid, "image_id", "a.line_no", "b.line_no", "iou")
        assert len(rows) > 100 and len(rows) == len(set(rows))


def test_grid_pairs_of_odd_sizes(spark):
    rng = random.Random(3)
    rows = [(1, i, *(rng.choice([0.0, rng.uniform(-3, 3), 0.25]) for _ in range(2)),
             *(2 ** rng.uniform(-6, 2) * rng.choice([1, 1, 0]) for _ in range(2))) for i in range(300)]
    rows += [(1, 300 + i, x + 1e-3, y, w * 1.01, h) for i, (_, _, x, y, w, h) in enumerate(rows)]
    boxes = D.with_corners(spark.createDataFrame(rows, "image_id int, line_no int, xc double, yc double, w double, h double"))
    for threshold in (0.3, 0.7, 0.98):
        plain = D.close_pairs(boxes, ["image_id"], threshold, "line_no", bound=10**6)
        assert same(plain, D.close_pairs(boxes, ["image_id"], threshold, "line_no", bound=0), "a.line_no", "b.line_no")


def test_suppress(inputs):
    boxes = crowded(inputs).select("image_id", F.lit("x").alias("label"), "score", F.col("line_no").alias("pos"),
                                   F.lit("s").alias("source"), *[v.alias(n) for n, v in zip(D.CORNERS, B.to_corners(*map(F.col, ("xc", "yc", "w", "h"))))])
    assert same(D.suppress(boxes), D.suppress(boxes, bound=1), *boxes.columns)


def test_suppress_folds_images_whole(spark, inputs):
    boxes = crowded(inputs).select("image_id", F.when(F.col("line_no") % 7 > 0, (F.col("line_no") % 7).cast("string")).alias("label"), "score", F.col("line_no").alias("pos"),
                                   *[v.alias(n) for n, v in zip(D.CORNERS, B.to_corners(*map(F.col, ("xc", "yc", "w", "h"))))])
    want = same(D.suppress(boxes, bound=10**6), D.suppress(boxes, bound=20), *boxes.columns[:1], *boxes.columns[2:])
    kept = []
    for b in sorted(boxes.collect(), key=lambda b: (-b["score"], b["pos"])):
        def iou(k):
            w, h = min(k["x2"], b["x2"]) - max(k["x1"], b["x1"]), min(k["y2"], b["y2"]) - max(k["y1"], b["y1"])
            union = sum((x["x2"] - x["x1"]) * (x["y2"] - x["y1"]) for x in (k, b)) - w * h
            return w * h / union if w > 0 and h > 0 else 0
        if all(k["image_id"] != b["image_id"] or k["label"] != b["label"] or iou(k) < V.NMS_IOU for k in kept):
            kept.append(b)
    assert sorted((b["image_id"], *b[2:]) for b in kept) == want and len(want) < boxes.count()
    # dealt by image once: counting what is left of each image needs no further shuffle
    plan = D.suppress(boxes, bound=10**6).groupBy("image_id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_merge(inputs):
    boxes = crowded(inputs)
    columns = ["image_id", "target_class", "line_no", "merged_from"]
    rows = same(D.merge_overlaps(boxes, 0.6), D.merge_overlaps(boxes, 0.6, bound=1), *columns)
    assert any(r[3] > 2 for r in rows)


def test_conflict_images(inputs):
    boxes = inputs.mapped_boxes()
    assert same(D.conflict_images(boxes), D.conflict_images(boxes, bound=1), "image_id")


def test_same_class(inputs):
    boxes = inputs.boxes()
    assert same(D.same_class_overlaps(boxes), D.same_class_overlaps(boxes, bound=1), "image_id")


def test_exact_decisions(inputs):
    images = inputs.images().withColumn("sha1", F.when(F.col("image_id") % 3 == 0, "copy").otherwise(F.col("sha1")))
    columns = ["remove_image", "keep_image", "final_keep"]
    assert len(same(dedupe.exact_decisions(images), dedupe.exact_decisions(images, bound=1), *columns)) > 60


def test_rank_and_renumber(inputs):
    images = inputs.images()
    same(dedupe.renumber(images), dedupe.renumber(images, bound=1), "path", "new_path")
    a = ranking.rank(images, ["folder"], ["path"], "r")
    same(a, ranking.rank(images, ["folder"], ["path"], "r", bound=0), "path", "r")


def test_running_values(spark):
    rows = [(k, i, (i * 7919) % 101) for k in range(3) for i in range(60)]
    df = spark.createDataFrame(rows, "k int, i int, v long")
    spec = {"hi": ("max", F.col("v")), "lo": ("min", F.col("v")), "total": ("sum", F.col("v"))}
    same(ranking.running_before(df, ["k"], ["i"], spec), ranking.running_before(df, ["k"], ["i"], spec, bound=1),
         "k", "i", F.coalesce("hi", F.lit(-1)), F.coalesce("lo", F.lit(-1)), F.coalesce("total", F.lit(-1)))


def test_hash_rank_numbers_each_key_once(inputs):
    images = inputs.images().withColumn("token", splits.shuffle_token(1, F.col("path")))
    rows = ranking.hash_rank(images, ["folder"], "token", "r").collect()
    by = {}
    for r in rows:
        by.setdefault(r["folder"], []).append((r["token"], r["r"]))
        assert r["r_of"] == sum(q["folder"] == r["folder"] for q in rows)
    for pairs in by.values():
        assert [r for _, r in sorted(pairs)] == list(range(1, len(pairs) + 1))


def test_label_text_parts_make_the_file(inputs):
    lines = crowded(inputs).select("image_id", "target_id", "line_no", L.box_line(F.col("target_id")).alias("line")).withColumn("k", F.col("line"))
    whole = {r.image_id: r.label_text for r in L.label_text(lines, ["target_id", "line_no", "k"], bound=10**6).collect()}
    parts = {}
    for r in L.label_text(lines, ["target_id", "line_no", "k"], bound=7).orderBy("image_id", "part").collect():
        parts[r.image_id] = parts.get(r.image_id, "") + r.label_text
    assert parts == whole


def test_components(spark):
    rng = random.Random(5)
    for n, m in ((40, 30), (60, 80), (30, 0)):
        pairs = [tuple(rng.sample(range(n), 2)) for _ in range(m)] + [(i + 100, i + 101) for i in range(40)]
        parent = {v: v for p in pairs for v in p}

        def find(v):
            while parent[v] != v:
                v = parent[v]
            return v

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
        got = {r.node: r.root for r in graphs.components(spark.createDataFrame(pairs, "a int, b int")).collect()}
        assert got == {v: find(v) for v in parent}


# ---- near duplicates -------------------------------------------------------

def walk(rows, sims, threshold):
    """Brute force over one folder: rows [(id, quality)] in order, sims[i][j]."""
    gone = {}
    for i, (base, q) in enumerate(rows):
        if base in gone:
            continue
        group = [(q, base)] + [(rows[j][1], rows[j][0]) for j in range(i + 1, len(rows)) if rows[j][0] not in gone and sims[i][j] >= threshold]
        keep = max(group)[1]
        gone.update({m: keep for _, m in group if m != keep})
    return sorted(gone.items())


@pytest.mark.parametrize("seed,local_edges", [(1, 10**6), (1, 0), (2, 0), (3, 10**6), (4, 0)])
def test_near_decisions_with_many_copies(spark, seed, local_edges):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 16))
    vectors = [centres[rng.integers(4)] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.3]) for _ in range(90)]
    vectors += [vectors[0]] * 25 + [vectors[7]] * 9 + [vectors[9]] * 3
    vectors = [v / np.linalg.norm(v) for v in vectors]
    order = rng.permutation(len(vectors))
    rows = [(f"f{k % 2}", int(n), [float(x) for x in vectors[k]], (int(rng.integers(5)), int(n))) for n, k in enumerate(order)]
    df = spark.createDataFrame(rows, "folder string, vec_id long, vector array<double>, quality struct<p:int,v:long>")
    got = sorted((r.folder, r.remove_id, r.keep_id) for r in neardup.near_decisions(
        df, 0.97, masks=(0, 4, 8), block_rows=5, local_edges=local_edges).collect())
    want = []
    for folder in ("f0", "f1"):
        part = [r for r in rows if r[0] == folder]
        m = np.array([r[2] for r in part])
        for a, b in walk([(r[1], r[3]) for r in part], m @ m.T, 0.97):
            want.append((folder, a, b))
    assert got == sorted(want) and len(got) > 30


def test_dense_near_copies_vanish_without_pairs(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    m = np.concatenate([centre + rng.normal(size=(150, 16)) * 0.01, rng.normal(size=(60, 16)), np.zeros((3, 16))])
    m = m[rng.permutation(len(m))]
    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    rows = [("f", n, [float(x) for x in v], (int(rng.integers(5)), n)) for n, v in enumerate(m)]
    df = spark.createDataFrame(rows, "folder string, vec_id long, vector array<double>, quality struct<p:int,v:long>")
    pairs = []
    real = neardup.similar_pairs
    monkeypatch.setattr(neardup, "similar_pairs", lambda *a: pairs.append(real(*a).cache()) or pairs[-1])
    got = sorted((r.remove_id, r.keep_id) for r in neardup.near_decisions(df, 0.97, masks=(0, 4, 8), block_rows=20).collect())
    assert got == walk([(r[1], r[3]) for r in rows], m @ m.T, 0.97) and len(got) == 149
    assert pairs[0].count() < 200  # of 11 175


def test_near_pairs_lose_nothing(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    base = rng.normal(size=(60, 32))
    m = np.concatenate([base, base + rng.normal(size=base.shape) * 0.06, base + rng.normal(size=base.shape) * 0.1])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    df = spark.createDataFrame([("f", i, [float(x) for x in v]) for i, v in enumerate(m)], "folder string, rep long, vector array<double>")
    for threshold, block in ((0.995, 2048), (0.99, 3), (0.9, 16)):
        got = sorted((r.a, r.b) for r in neardup.similar_pairs(df, threshold, block).collect())
        sims = m @ m.T
        assert got == [(i, j) for i, j in itertools.combinations(range(len(m)), 2) if sims[i, j] >= threshold]


# ---- group split -----------------------------------------------------------

def test_fill_run_equals_one_by_one():
    rng = random.Random(11)
    for _ in range(400):
        sizes = sorted(((rng.choice([1, 2, 3, 7, 50]), rng.randrange(1, 400)) for _ in range(rng.randrange(1, 5))), reverse=True)
        total = sum(s * n for s, n in sizes)
        shares = rng.choice([(0.8, 0.1, 1.0 - 0.8 - 0.1), (0.6, 0.2, 1.0 - 0.6 - 0.2), (1 / 3, 1 / 3, 1.0 - 1 / 3 - 1 / 3)])
        targets = tuple(total * s for s in shares)
        slow, want = [0, 0, 0], []
        for s, n in sizes:
            for _ in range(n):
                k = max(range(3), key=lambda k: (targets[k] - slow[k], -slow[k], -k))
                slow[k] += s
                want.append(k)
        fast, got = [0, 0, 0], []
        for s, n in sizes:
            for count, cycle in splits.fill_run(targets, fast, s, n):
                got += [cycle[j % len(cycle)] for j in range(count)]
        assert got == want and fast == slow


def test_fill_run_is_short_for_huge_runs():
    total = 10**9
    runs = splits.fill_run((total * 0.8, total * 0.1, total * (1.0 - 0.8 - 0.1)), [0, 0, 0], 1, total)
    assert len(runs) < 60 and sum(c for c, _ in runs) == total


def test_group_split_shares_copies(inputs):
    images = inputs.images()
    rows = splits.group_split(images, V.position(V.COLLECTION_CLASSES, F.col("label"))).groupBy("sha1").agg(
        F.countDistinct("split").alias("n")).where("n > 1").count()
    assert rows == 0


# ---- the index of near vectors ----------------------------------------------

def _wide(rng, kind, n):
    import numpy as np

    if kind == "noise":
        m = rng.random((n, 3072))
    else:  # smooth pictures of 32 x 32 x 3
        y, x = np.mgrid[0:32, 0:32] / 32
        m = np.zeros((n, 32, 32, 3))
        for one in m:
            for c in range(3):
                for _ in range(6):
                    f, g = rng.integers(0, 4, 2)
                    one[:, :, c] += rng.normal() / (1 + f + g) * np.cos(2 * np.pi * (f * x + g * y) + rng.uniform(0, 6))
            one -= one.min()
        m = m.reshape(n, -1)
    copies = m[: n // 10] * (1 + rng.normal(size=(n // 10, 3072)) * 0.05)
    m = np.concatenate([m, np.abs(copies)])
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def test_index_forms_few_pairs_of_given_vectors(spark):
    from boxloom.plans.image_queries import _vectors

    df = _vectors(Inputs(spark, "/root/testdata/sf0.01")).select(F.lit("f").alias("folder"), F.col("vec_id").alias("rep"), "vector").cache()
    formed, left = neardup.pairs_formed(df)
    n, true = df.count(), neardup.similar_pairs(df).count()
    assert formed <= 0.05 * n * n and true > 900 and left <= 4 * true


@pytest.mark.parametrize("kind", ["noise", "pictures"])
def test_index_on_wide_vectors(spark, kind):
    """None lost; the arithmetic of finding candidates is at most a twentieth of comparing all pairs in full."""
    import numpy as np

    from boxloom.operators import vectorindex

    m = _wide(np.random.default_rng(1), kind, 500)
    df = spark.createDataFrame([("f", i, [float(x) for x in v]) for i, v in enumerate(m)], "folder string, rep long, vector array<double>").repartition(4).cache()
    sims = m @ m.T
    true = {(i, j) for i, j in zip(*np.nonzero(sims >= 0.995)) if i < j}
    assert len(true) >= 40 and {(r.a, r.b) for r in neardup.similar_pairs(df).collect()} == true
    formed, left = neardup.pairs_formed(df)
    index = vectorindex.fit(df, "rep", neardup._reach(0.995))
    assert formed * index.axes.shape[1] / 3072 + left <= 0.05 * len(m) ** 2


def test_small_groups_are_settled_in_tasks(spark, monkeypatch):
    """10,000 groups of three: no rounds, three written tables."""
    def quality(n):
        return 7 * n % 5

    rows = [("f", 3 * g + i, quality(3 * g + i), 3 * g + i + 1, quality(3 * g + i + 1)) for g in range(10_000) for i in (0, 1)]
    edges = spark.createDataFrame(rows, "folder string, a long, qa int, b long, qb int")
    written = []
    real = neardup.cut
    monkeypatch.setattr(neardup, "cut", lambda df: written.append(1) or real(df))
    got = {r.remove_id: r.keep_id for r in neardup._resolve(edges, 1000).collect()}
    assert len(written) <= 4
    want = {}
    for n in range(30_000):  # the first gathers the second, and the second, if it is the better one, the third
        if n % 3 < 2 and n not in want:
            keep = max((quality(m), m) for m in (n, n + 1))[1]
            want[2 * n + 1 - keep] = keep
    assert got == want


def test_components_beyond_one_task(spark, monkeypatch):
    """The rounds of joins name the same components as the task."""
    rng = random.Random(3)
    rows = [(f"f{k % 2}", min(p), max(p)) for k in range(300) for p in [rng.sample(range(200), 2)]]
    edges = spark.createDataFrame(rows, "folder string, a long, b long").repartition(5)
    local = sorted(map(tuple, neardup._labels(edges, 10**6).select("folder", "n", "root").collect()))
    assert local == sorted(map(tuple, neardup._labels(edges, 0).select("folder", "n", "root").collect())) and len(local) > 200


# ---- crowded images -----------------------------------------------------------

def _boxes(rng, n, kind):
    import numpy as np

    if kind == "jitter":  # one object found over and over
        at = np.array([100.0, 100, 300, 260]) + rng.normal(size=(n, 4)) * 1.5
    elif kind == "chain":  # each overlaps the next only
        at = np.array([[i * 10.0, 0, i * 10.0 + 50, 40] for i in range(n)])
    else:
        low, size = rng.uniform(0, 2000, (n, 2)), np.exp(rng.normal(3, 1, (n, 2)))
        at = np.concatenate([low, low + size], axis=1)
    return at


def _all_iou(at):
    import numpy as np

    area = (at[:, 2] - at[:, 0]) * (at[:, 3] - at[:, 1])
    wide = np.maximum(0, np.minimum(at[:, None, 2], at[None, :, 2]) - np.maximum(at[:, None, 0], at[None, :, 0]))
    high = np.maximum(0, np.minimum(at[:, None, 3], at[None, :, 3]) - np.maximum(at[:, None, 1], at[None, :, 1]))
    return wide * high / (area[:, None] + area[None, :] - wide * high)


@pytest.mark.parametrize("kind", ["jitter", "chain", "spread"])
@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.67, 0.98])
def test_fold_of_a_crowded_image(kind, threshold):
    import numpy as np

    from boxloom.operators import crowded as C

    at = _boxes(np.random.default_rng(2), 700, kind)
    near = _all_iou(at) >= threshold
    gone = np.zeros(len(at), bool)
    for i in range(len(at)):
        if not gone[i]:
            gone[i + 1:] |= near[i, i + 1:]
    assert (C.select(at, threshold)[0] == gone).all()
    root = np.arange(len(at))
    while (new := np.array([root[near[i]].min() for i in range(len(at))])).tolist() != root.tolist():
        root = new
    assert (C.flood(at, threshold)[0] == root).all()


def test_near_linear_pairs_and_long_chains():
    import numpy as np

    from boxloom.operators import crowded as C

    rng = np.random.default_rng(4)
    for n in (5_000, 20_000):
        at = _boxes(rng, n, "jitter")
        assert C.select(at, 0.5)[1] < 4 * n and C.flood(at, 0.5)[1] < 4 * n
        far = _boxes(rng, n, "spread")
        assert C.select(far, 0.5)[1] < 40 * n
    chain = _boxes(rng, 1_001, "chain")
    assert set(C.flood(chain, 0.6)[0]) == {0} and C.select(chain, 0.6)[0].sum() == 500


@pytest.mark.parametrize("kind", ["jitter", "chain", "spread"])
def test_rounds_of_leaders(spark, kind):
    """Keys beyond a fold: rounds on all executors come to the same selection, dense clusters in one round."""
    import numpy as np

    from boxloom.operators import crowded as C

    at = _boxes(np.random.default_rng(5), 300, kind)
    df = spark.createDataFrame([(1, i, i, *map(float, b)) for i, b in enumerate(at)], "image_id long, pos long, _mid long, x1 double, y1 double, x2 double, y2 double")
    want = {i for i, gone in enumerate(C.select(at, 0.5)[0]) if gone}
    assert {r[0] for r in C.dropped(df, ["image_id"], "pos", 0.5, fold_boxes={"chain": 296}.get(kind, 200)).collect()} == want
    gone, left = C.lead_round(df, ["image_id"], "pos", 0.5)
    assert left.count() < {"jitter": 30, "chain": 299, "spread": 200}[kind] and {r[0] for r in gone.collect()} <= want


def test_image_folds(inputs):
    """One fold an image says what merging, conflicts and mappings say apart, also for crowded images and beyond one task."""
    boxes = crowded(inputs).union(crowded(inputs).withColumn("line_no", F.col("line_no") + 7).withColumn("w", F.lit(0.0)).limit(20))
    merged = sorted(map(tuple, D.merge_overlaps(boxes, 0.6).select("image_id", "target_class", "line_no", "merged_from").collect()))
    pairs = dict(D.conflicts(boxes, 0.6).groupBy("image_id").count().collect())
    mapped = {tuple(r) for r in boxes.select("image_id", "source_class", "target_class").distinct().collect()}
    assert len(merged) > 50 and pairs and len(mapped) > 20
    for bound, fold in ((10**6, 10**6), (1, 10**6), (1, 5)):
        folds = D.image_folds(boxes, 0.6, bound, fold).cache()
        got = folds.select("image_id", F.inline("merged")).select("image_id", "target_class", "line_no", "merged_from").collect()
        assert sorted(map(tuple, got)) == merged
        sums = {r["image_id"]: r for r in folds.groupBy("image_id").agg(F.sum("boxes").alias("n"), F.sum("clash_pairs").alias("p")).collect()}
        assert {k: r["p"] for k, r in sums.items() if r["p"]} == pairs and sum(r["n"] for r in sums.values()) == boxes.count()
        assert {tuple(r) for r in folds.select("image_id", F.inline("mappings")).collect()} == mapped
