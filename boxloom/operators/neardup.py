"""Near duplicates: exact cosine join without comparing whole folders, and its greedy resolution."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import cut
from boxloom.operators import vectorindex
from boxloom.operators.graphs import components

BLOCK_ROWS = 2048
MASKS = (0, 16, 512)  # mean, left against right, top against bottom of a 32x32 picture
LOCAL_EDGES = 200_000  # of one component that a task walks
ONE_TASK = 500_000  # edges of spanning forests that one task joins


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def unit(vector: Column) -> Column:
    """The vector at length one (a zero vector stays zero)."""
    length = F.greatest(F.sqrt(dot(vector, vector)), F.lit(1e-12))
    # as an array the length is computed once per row; inside a lambda it would be once per element
    return F.zip_with(vector, F.array_repeat(length, F.size(vector)), lambda x, n: x / n)


def _projection(vector: Column, mask: int) -> Column:
    """Dot product with the unit vector of signs (-1)^popcount(index & mask)."""
    signed = F.transform(
        vector, lambda x, i: F.when(F.bit_count(i.bitwiseAND(F.lit(mask))) % 2 == 0, x).otherwise(-x)
    )
    return F.aggregate(signed, F.lit(0.0), lambda s, v: s + v) / F.sqrt(F.size(vector))


def distinct_vectors(df: DataFrame) -> DataFrame:
    """One row per (folder, vector): the smallest vec_id as ``rep`` and the number of ``copies``."""
    return df.groupBy("folder", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def projected(reps: DataFrame, masks: tuple[int, ...] = MASKS) -> DataFrame:
    """Add the projections _p0, _p1, ... of unit vectors and write the table once for its several readers."""
    return cut(reps.withColumns({f"_p{k}": _projection(F.col("vector"), m) for k, m in enumerate(masks)}))


def similar_pairs(points: DataFrame, threshold: float = V.NEAR_COSINE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(folder, a, b, sim): all pairs a < b of a folder with cosine >= ``threshold``.

    Over (folder, rep, vector) with unit vectors of one length, which should be a written table (``cut``). Unit vectors with
    cosine t lie within sqrt(2 - 2t) of each other; ``vectorindex`` finds all pairs that near without comparing whole
    folders. Only ids and a few coordinates are shipped to find them; each pair found is verified once on its vectors.
    """
    index = vectorindex.fit(points, "rep", _reach(threshold))
    kind = points.schema["rep"].dataType.simpleString()
    if index is None:
        return points.select("folder", F.col("rep").alias("a"), F.col("rep").alias("b"), F.lit(0.0).alias("sim"))
    near = _met(points, index, block_rows).mapInPandas(
        lambda frames: _candidates(frames, index), f"folder string, a {kind}, b {kind}, formed long")
    near = near.where(F.col("a").isNotNull()).select("folder", "a", "b").distinct()  # a pair may be near in several blocks
    vectors = points.select("folder", "rep", "vector")
    found = near.join(vectors.select("folder", F.col("rep").alias("a"), F.col("vector").alias("_v")), ["folder", "a"]).join(
        vectors.select("folder", F.col("rep").alias("b"), F.col("vector").alias("_w")), ["folder", "b"])
    return found.withColumn("sim", dot(F.col("_v"), F.col("_w"))).where(F.col("sim") >= threshold).select("folder", "a", "b", "sim")


def pairs_formed(points: DataFrame, threshold: float = V.NEAR_COSINE, block_rows: int = BLOCK_ROWS) -> tuple[int, int]:
    """(pairs that the index forms, pairs left to verify) for ``similar_pairs`` on the same rows."""
    index = vectorindex.fit(points, "rep", _reach(threshold))
    kind = points.schema["rep"].dataType.simpleString()
    met = _met(points, index, block_rows).mapInPandas(
        lambda frames: _candidates(frames, index), f"folder string, a {kind}, b {kind}, formed long")
    return met.agg(F.coalesce(F.sum("formed"), F.lit(0)), F.count_distinct("folder", "a", "b")).first()


_CELL = ["folder", "block", "cell", "_a", "_b"]


def _met(points: DataFrame, index: vectorindex.Index, block_rows: int) -> DataFrame:
    """Rows dealt to coarse cells of each block, homes and guests together; crowded cells in pairs of parts."""
    kind = points.schema["rep"].dataType.simpleString()

    def dealt(batches):
        for b in batches:
            width = index.axes.shape[0]
            vectors = b.column("vector").flatten().to_numpy().reshape(-1, width)
            solid = np.flatnonzero(np.einsum("ij,ij->i", vectors, vectors) > 0.5)  # a zero vector is near nothing
            values = index.sketch(vectors[solid])
            for k, ids in enumerate(index.blocks):
                own = np.ascontiguousarray(values[:, ids])
                coarse = (0, min(index.coarse, index.grid))
                home, _ = index.cells(own, *coarse)
                row, cell = index.visits(own, *coarse)
                at = np.r_[np.arange(len(own)), row]
                packed = pa.array([x.tobytes() for x in own], pa.binary())
                take = pa.array(solid[at])
                yield pa.RecordBatch.from_arrays([
                    b.column("folder").take(take), pa.array(np.full(len(at), k, np.int32)), pa.array(np.r_[home, cell]),
                    pa.array(np.arange(len(at)) < len(own)), b.column("rep").take(take), packed.take(pa.array(at))],
                    ["folder", "block", "cell", "is_home", "rep", "at"])

    rows = cut(points.select("folder", "rep", F.col("vector").cast("array<double>").alias("vector")).mapInArrow(
        dealt, f"folder string, block int, cell long, is_home boolean, rep {kind}, at binary"))
    keys = _CELL[:3]
    sizes = rows.groupBy(*keys).agg(F.count_if("is_home").alias("_h"), F.count(F.lit(1)).alias("_n")).select(
        *keys, F.ceil(F.greatest("_h", F.col("_n") - F.col("_h")) / block_rows).alias("_blocks"))
    crowded = sizes.where("_blocks > 1")
    zero = F.lit(0).cast("long")
    if not crowded.head(1):
        met = rows.select(*keys, zero.alias("_a"), zero.alias("_b"), "is_home", "rep", "at")
    else:
        mine, other = F.pmod(F.xxhash64("rep"), "_blocks"), F.explode(F.sequence(zero, F.col("_blocks") - 1))
        met = rows.join(cut(crowded), keys, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1).cast("long"))).withColumn(
            "_mine", mine).withColumn("_other", other).select(
            *keys, F.when(F.col("is_home"), F.col("_mine")).otherwise(F.col("_other")).alias("_a"),
            F.when(F.col("is_home"), F.col("_other")).otherwise(F.col("_mine")).alias("_b"), "is_home", "rep", "at")
    return met.repartition(*_CELL).sortWithinPartitions(*_CELL)


def _candidates(frames: Iterator[pd.DataFrame], index: vectorindex.Index) -> Iterator[pd.DataFrame]:
    """Pairs near on the axes of a block; cells come sorted, at most one is open at a time. ``formed`` rides on the first row of a cell."""
    def met(cell: pd.DataFrame) -> pd.DataFrame | None:
        home = cell["is_home"].to_numpy()
        if home.all() or not home.any():
            return None
        width = len(index.blocks[cell["block"].iloc[0]])
        at = np.frombuffer(b"".join(cell["at"]), np.float32).reshape(-1, width)
        rep = cell["rep"].to_numpy()
        left, right = rep[home], rep[~home]
        x, y, formed = index.close(at[home], at[~home])
        later = left[x] < right[y]
        x, y = x[later], y[later]
        if not formed:
            return None
        counts = np.zeros(len(x) + 1, np.int64)
        counts[0] = formed
        return pd.DataFrame({"folder": cell["folder"].iloc[0], "a": [None, *left[x]], "b": [None, *right[y]], "formed": counts}, dtype=object)

    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        new = (frame[_CELL] != frame[_CELL].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(new)
        out = [m for lo, hi in zip(starts[:-1], starts[1:]) if (m := met(frame.iloc[lo:hi])) is not None]
        if out:
            yield pd.concat(out, ignore_index=True)
        rest = frame.iloc[starts[-1]:]
    if rest is not None and not rest.empty and (last := met(rest)) is not None:
        yield last


def near_decisions(df: DataFrame, threshold: float = V.NEAR_COSINE, masks: tuple[int, ...] = MASKS,
                   block_rows: int = BLOCK_ROWS, local_edges: int = LOCAL_EDGES) -> DataFrame:
    """(folder, remove_id, keep_id, score): greedy resolution of near duplicates per folder.

    Over (folder, vec_id, vector, quality) with unit vectors; ``vec_id`` gives the order and
    ``quality`` must differ between rows. In order, each image still present gathers the
    later present ones at least ``threshold`` similar, the best of all these stays and the
    others go. The score is the similarity of removed and kept.

    Rows with equal vectors collapse to two: the first, and the best (or the runner-up when
    the first is the best). The first image that gathers any of them gathers all, so every
    other copy goes at that moment, along with the worse of the two. Crowded cells are
    thinned before pairs are formed (see ``_thin``).
    """
    place = F.struct(F.col("quality"), F.col("vec_id"))
    df = df.where(dot(F.col("vector"), F.col("vector")) > 0.5)  # a zero vector is similar to nothing
    groups = df.groupBy("folder", "vector").agg(
        F.min(F.struct("vec_id", "quality")).alias("_first"), F.max(place).alias("_best"), F.count(F.lit(1)).alias("_n"))
    groups = projected(groups.withColumn("rep", F.col("_first.vec_id")), masks)
    # runner-up where the first copy is the best one
    led = groups.where((F.col("_n") > 1) & (F.col("rep") == F.col("_best.vec_id"))).select("folder", "vector", "rep")
    second = (
        df.join(led, ["folder", "vector"]).where(F.col("vec_id") != F.col("rep"))
        .groupBy("folder", "rep").agg(F.max(place).alias("_second"))
    )
    groups = groups.join(second, ["folder", "rep"], "left").withColumn(
        "_partner", F.when(F.col("_n") > 1, F.coalesce("_second", "_best")))
    axes = [c for c in groups.columns if c.startswith("_p") and c != "_partner"]
    nodes = cut(groups.select("folder", "vector", *axes, F.inline(F.array_compact(F.array(
        F.struct(F.col("_first.vec_id").alias("rep"), F.col("_first.quality").alias("q")),
        F.when(F.col("_n") > 1, F.struct(F.col("_partner.vec_id").alias("rep"), F.col("_partner.quality").alias("q"))))))))

    nodes, early = _thin(nodes, threshold, block_rows)
    quality = nodes.select("folder", "rep", "q")
    edges = (
        similar_pairs(nodes.select("folder", "rep", "vector"), threshold, block_rows)
        .join(quality.select("folder", F.col("rep").alias("a"), F.col("q").alias("qa")), ["folder", "a"])
        .join(quality.select("folder", F.col("rep").alias("b"), F.col("q").alias("qb")), ["folder", "b"])
        .select("folder", "a", "qa", "b", "qb")
    )
    removed = _resolve(edges, local_edges)
    if early is not None:
        removed = removed.unionByName(early)
    # the other copies go with the worse of their two stand-ins
    first_is_best = F.col("rep") == F.col("_best.vec_id")
    worse = groups.where(F.col("_n") > 2).select(
        "folder", "vector", "rep", F.col("_partner.vec_id").alias("_other"),
        F.when(first_is_best, F.col("_partner.vec_id")).otherwise(F.col("rep")).alias("remove_id"))
    followers = (
        df.select("folder", "vector", "vec_id").join(worse, ["folder", "vector"])
        .where((F.col("vec_id") != F.col("rep")) & (F.col("vec_id") != F.col("_other")))
        .join(removed, ["folder", "remove_id"]).select("folder", F.col("vec_id").alias("remove_id"), "keep_id")
    )
    removed = removed.unionByName(followers)
    gone = df.select("folder", F.col("vec_id").alias("remove_id"), F.col("vector").alias("_v"))
    kept = df.select("folder", F.col("vec_id").alias("keep_id"), F.col("vector").alias("_w"))
    return removed.join(gone, ["folder", "remove_id"]).join(kept, ["folder", "keep_id"]).select(
        "folder", "remove_id", "keep_id", dot(F.col("_v"), F.col("_w")).alias("score"))


def _reach(threshold: float) -> float:
    """Largest distance of two unit vectors at the threshold."""
    return math.sqrt(max(0.0, 2.0 - 2.0 * threshold)) + 1e-9


def _around(df: DataFrame, cells: list[str]) -> DataFrame:
    """Each row in its own cell and in all adjacent ones."""
    for c in cells:
        df = df.withColumn(c, F.explode(F.sequence(F.col(c) - 1, F.col(c) + 1)))
    return df


def _thin(nodes: DataFrame, threshold: float, crowd: int) -> tuple[DataFrame, DataFrame | None]:
    """Settle what can be settled around cells with more than ``crowd`` rows, without forming their pairs.

    Over (folder, rep, q, vector, _p0, ...); returns the rows still open and the removals. Cells
    are 4r wide, so whatever shares a neighbour with a row lies in its own or an adjacent cell.
    The first row of a cell that is also first among the adjacent cells is therefore next in
    order: it gathers its neighbours in one join, the best stays, the others go. A dense group
    of near copies vanishes in one round. Ends when no cell is crowded, or when a
    round removes little: then the rows there are mostly not similar and give few pairs.
    """
    width = 4.0 * _reach(threshold)
    axes = [c for c in nodes.columns if c.startswith("_p")]
    cells = [f"_c{k}" for k in range(len(axes))]
    keys = ["folder", *cells]
    removed = None
    while True:
        placed = nodes.withColumns({c: F.floor(F.col(p) / width) for c, p in zip(cells, axes)})
        leads = placed.groupBy(*keys).agg(F.min("rep").alias("_lead"), F.count(F.lit(1)).alias("_n"))
        if not leads.where(F.col("_n") > crowd).head(1):
            return nodes, removed
        leads = cut(leads)
        near = _around(leads, cells).groupBy(*keys).agg(F.min("_lead").alias("_near"), F.max("_n").alias("_most"))
        first = leads.join(near, keys).where((F.col("_lead") == F.col("_near")) & (F.col("_most") > crowd))
        pivots = cut(placed.join(first.select(*keys, F.col("_lead").alias("rep")), [*keys, "rep"], "left_semi").select(*keys, "rep", "q", "vector"))
        spots = _around(pivots.select(*keys, F.col("rep").alias("a"), F.col("q").alias("qa"), F.col("vector").alias("_v")), cells)
        members = cut(
            placed.join(spots, keys)
            .where((F.col("rep") > F.col("a")) & (dot(F.col("vector"), F.col("_v")) >= threshold))
            .select("folder", "a", "qa", "rep", "q")
        )
        top = members.groupBy("folder", "a", "qa").agg(F.max(F.struct("q", "rep")).alias("_top")).select(
            "folder", "a", F.greatest("_top", F.struct(F.col("qa").alias("q"), F.col("a").alias("rep")))["rep"].alias("keep_id"))
        gone = members.select("folder", "a", F.col("rep").alias("remove_id")).join(top, ["folder", "a"]).select("folder", "remove_id", "keep_id")
        gone = gone.unionByName(top.select("folder", F.col("a").alias("remove_id"), "keep_id")).where(F.col("remove_id") != F.col("keep_id"))
        gone = cut(gone)
        removed = gone if removed is None else removed.unionByName(gone)
        # a gathering row is done: kept or not, no later row can reach it
        done = gone.select("folder", F.col("remove_id").alias("rep")).unionByName(pivots.select("folder", "rep")).distinct()
        nodes = cut(nodes.join(done, ["folder", "rep"], "left_anti"))
        crowded = leads.where(F.col("_n") > crowd).agg(F.sum("_n")).first()[0]
        if gone.count() * 20 < crowded:
            return nodes, removed


def _labels(edges: DataFrame, one_task: int) -> DataFrame:
    """(folder, n, root) for every node of ``edges`` (folder, a, b): the component that it lies in.

    Up to ``one_task`` edges are joined by one task. Of more, each task first reduces its own to a spanning forest; if these
    still have more edges than that, they go through rounds of joins. Either way the roots are the smallest nodes.
    """
    kind = edges.schema["a"].dataType.simpleString()
    forest = edges.select("folder", "a", "b")
    if edges.count() > one_task:
        forest = cut(forest.mapInPandas(_forest, f"folder string, a {kind}, b {kind}"))
    if forest.count() <= one_task:
        return forest.coalesce(1).mapInPandas(_forest, f"folder string, a {kind}, b {kind}").select("folder", F.col("b").alias("n"), F.col("a").alias("root"))
    pairs = forest.where(F.col("a") != F.col("b"))
    roots = components(pairs.select(F.struct("folder", F.col("a").alias("n")).alias("a"), F.struct("folder", F.col("b").alias("n")).alias("b")))
    return roots.select("node.folder", "node.n", F.col("root.n").alias("root"))


def _forest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(folder, a, b) for every node b of a task's edges (folder, a, b), a being the smallest node that it reaches."""
    parent: dict = {}

    def root(n: tuple) -> tuple:
        at = n
        while (up := parent.setdefault(at, at)) != at:
            at = up
        while parent[n] != at:
            parent[n], n = at, parent[n]
        return at

    for frame in frames:
        for folder, a, b in frame.itertuples(index=False, name=None):
            x, y = root((folder, a)), root((folder, b))
            if x != y:
                parent[max(x, y)] = min(x, y)
    if parent:
        nodes = list(parent)
        yield pd.DataFrame({"folder": [n[0] for n in nodes], "a": [root(n)[1] for n in nodes], "b": [n[1] for n in nodes]})


def _resolve(edges: DataFrame, local_edges: int) -> DataFrame:
    """Settle edges (folder, a, qa, b, qb), a before b; returns (folder, remove_id, keep_id).

    What happens in one component of the similarity graph does not touch another. Components of at most ``local_edges``
    edges are dealt to tasks, many to each, and walked in order. Larger ones go through a round (see ``_round``), which
    breaks them up, and so on.
    """
    edges = cut(edges)
    kind = edges.schema["a"].dataType.simpleString()
    removed = None
    while True:
        labels = _labels(edges, ONE_TASK)
        labelled, some = edges.join(labels.select("folder", F.col("n").alias("a"), "root"), ["folder", "a"]), False
        if edges.count() > local_edges:  # else no component can have more
            labelled = cut(labelled)
            large = labelled.groupBy("folder", "root").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > local_edges).drop("_n")
            some = bool(large.head(1))
        small = labelled.join(large, ["folder", "root"], "left_anti") if some else labelled
        walked = small.repartition("folder", "root").sortWithinPartitions("folder", "root").mapInPandas(
            _walk_components, f"folder string, remove_id {kind}, keep_id {kind}")
        removed = walked if removed is None else removed.unionByName(walked)
        if not some:
            return cut(removed)
        gone, edges = _round(cut(labelled.join(large, ["folder", "root"], "left_semi").drop("root")))
        removed = removed.unionByName(gone)


def _round(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(removals, edges left): settles every image that no earlier open image can reach or share a neighbour with.

    Those gather disjoint groups, so they act at once exactly as in order.
    """
    first = edges.groupBy("folder", "b").agg(F.min("a").alias("_lead"))
    reached = first.select("folder", F.col("b").alias("a"))
    contested = edges.join(first, ["folder", "b"]).where(F.col("_lead") < F.col("a")).select("folder", "a")
    open_now = edges.join(reached.union(contested).distinct(), ["folder", "a"], "left_anti")
    best = F.max(F.struct(F.col("qb").alias("q"), F.col("b").alias("id")))
    groups = open_now.groupBy("folder", "a", "qa").agg(best.alias("_top")).select(
        "folder", "a", F.greatest("_top", F.struct(F.col("qa").alias("q"), F.col("a").alias("id")))["id"].alias("keep_id"))
    groups = cut(groups)
    members = edges.join(groups, ["folder", "a"]).select("folder", F.col("b").alias("remove_id"), "keep_id")
    bases = groups.select("folder", F.col("a").alias("remove_id"), "keep_id")
    gone = cut(members.unionByName(bases).where(F.col("remove_id") != F.col("keep_id")))
    names = gone.select("folder", F.col("remove_id").alias("n"))
    return gone, cut(
        edges.join(groups.select("folder", "a"), ["folder", "a"], "left_anti")
        .join(names.withColumnRenamed("n", "a"), ["folder", "a"], "left_anti")
        .join(names.withColumnRenamed("n", "b"), ["folder", "b"], "left_anti")
    )


def _walk_components(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Components come sorted; each is walked when it is complete, at most one is open at a time."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if frame.empty:
            continue
        new = (frame[["folder", "root"]] != frame[["folder", "root"]].shift()).any(axis=1).to_numpy()
        last = np.flatnonzero(new)[-1]
        if last:
            yield _walk(frame.iloc[:last])
        rest = frame.iloc[last:]
    if rest is not None and not rest.empty:
        yield _walk(rest)


def _walk(edges: pd.DataFrame) -> pd.DataFrame:
    """The rule for whole components, in order: components do not touch, so they may be walked together."""
    def quality(q: object) -> tuple:
        return tuple(q.values()) if isinstance(q, dict) else tuple(q) if hasattr(q, "__iter__") and not isinstance(q, str) else (q,)

    later: dict = {}
    rank: dict = {}
    for folder, a, qa, b, qb in edges[["folder", "a", "qa", "b", "qb"]].itertuples(index=False, name=None):
        later.setdefault((folder, a), []).append((folder, b))
        rank[folder, a], rank[folder, b] = (quality(qa), a), (quality(qb), b)
    gone: dict = {}
    for base in sorted(later):
        if base in gone:
            continue
        group = [base, *(b for b in later[base] if b not in gone)]
        keep = max(group, key=rank.__getitem__)
        gone.update({m: keep for m in group if m != keep})
    return pd.DataFrame({"folder": [f for f, _ in gone], "remove_id": [n for _, n in gone], "keep_id": [k for _, k in gone.values()]})
