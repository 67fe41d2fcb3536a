"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one representative per group.

Equal vectors collapse to one node first. Centroids are fitted on a bounded sample; every node has its home in the cell
of its nearest centroid and visits each cell whose centroid is nearly as near (``MARGIN``), so a pair that a border parts
still meets. Pairs within a cell are compared in blocks of bounded size, as matrix products in double precision.

A cell's core are the nodes so near its centroid that all of them must be linked to each other (half the angle of the
threshold). Cores are counted, never compared with themselves, and nothing beyond one and a half times that angle is
compared with them: a hot group of near copies costs no square of its size.

What leaves a block is a count for each node and a spanning forest of its links, not the links.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut, spread
from boxloom.llm.catalog import query, table
from boxloom.operators.graphs import components

COSINE = 0.9
#: a node also visits the cells whose centroid's cosine is at most this much less than its best one
MARGIN = 0.12
#: bounds of what the centroids are fitted on, and of the centroids that each task gets (32 MB as doubles)
SAMPLE_ROWS, SAMPLE_VALUES, CENTROID_VALUES = 16_384, 4_000_000, 4_000_000
ROUNDS = 8
SCORES = 2_000_000  # cosines to centroids that are in memory at once
BLOCK_ROWS = 1024

PARTIAL = "node string, links long, root string"


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one, in double precision; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _matrix(column: pa.Array, kind: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each length of vector in a column of packed vectors."""
    packed = column.to_pylist()
    sizes = np.array([len(p) for p in packed], int)
    out = []
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        out.append((at, _unit(np.frombuffer(b"".join(packed[i] for i in at), kind).astype(float).reshape(len(at), -1))))
    return out


def _pack(vectors: DataFrame, kind: str) -> DataFrame:
    """(vec_id, node, packed): a digest and the bytes of each vector; null for those that link with nothing."""
    id_type = vectors.schema["vec_id"].dataType.simpleString()

    def packed(batches):
        for b in batches:
            nodes, bodies = [], []
            at, flat = b.column(1).offsets.to_numpy(), b.column(1).values.to_numpy(zero_copy_only=False).astype(kind)  # nulls turn to NaN
            for lo, hi in zip(at[:-1], at[1:]):
                x = flat[lo:hi]
                body = (x + x.dtype.type(0)).tobytes() if np.isfinite(x).all() and x.any() else None  # -0 is 0
                nodes.append(body and hashlib.blake2b(body, digest_size=16).hexdigest())
                bodies.append(body)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(nodes, pa.string()), pa.array(bodies, pa.binary())], ["vec_id", "node", "packed"])

    return spread(vectors).mapInArrow(packed, f"vec_id {id_type}, node string, packed binary")


def fit(sample: np.ndarray, cells: int, threshold: float = COSINE, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means over the unit vectors ``sample``; seeds are taken in order, none within ``threshold`` of another.

    So a group of near copies, however large its share of the sample, seeds one cell and not most of them.
    """
    free = np.ones(len(sample), bool)
    seeds: list[int] = []
    for i in range(len(sample)):
        if free[i] and len(seeds) < cells:
            seeds.append(i)
            free &= sample @ sample[i] < threshold
        if len(seeds) == cells:
            break
    centroids = sample[seeds].copy()
    for _ in range(rounds):
        home = np.concatenate([(sample[i:i + 1024] @ centroids.T).argmax(axis=1) for i in range(0, len(sample), 1024)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        length = np.sqrt(np.einsum("ij,ij->i", sums, sums))
        centroids = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centroids)
    return centroids


def _centroids(reps: DataFrame, nodes: int, threshold: float, kind: str) -> dict[int, np.ndarray]:
    """Centroids for each length of vector in the sample: about the square root of the number of vectors."""
    share = max(1, math.ceil(nodes / SAMPLE_ROWS))
    drawn = reps.where(F.pmod(F.xxhash64("node"), F.lit(share)) == 0).select("node", "packed").limit(2 * SAMPLE_ROWS)
    widest = reps.agg(F.max(F.octet_length("packed"))).first()[0] // np.dtype(kind).itemsize
    rows = sorted(drawn.limit(max(1, SAMPLE_VALUES // widest)).collect())[:SAMPLE_ROWS]
    out = {}
    if rows:
        for _, units in _matrix(pa.array([bytes(r["packed"]) for r in rows], pa.binary()), kind):
            cells = min(math.ceil(math.sqrt(nodes)), max(1, CENTROID_VALUES // units.shape[1]))
            out[units.shape[1]] = fit(units, cells, threshold)
    return out


class _Cells:
    """Which cells a node belongs to. Cells of vectors of one length are numbered on from those of shorter ones."""

    def __init__(self, centroids: dict[int, np.ndarray], threshold: float, margin: float, kind: str):
        self.centroids, self.margin, self.kind = centroids, margin, kind
        self.first, at = {}, 0
        for size in sorted(centroids):
            self.first[size], at = at, at + len(centroids[size])
        self.rest = at  # lengths that the sample has not: one cell each, without a centroid
        angle = math.acos(threshold)
        self.core, self.near = math.cos(angle / 2 - 1e-6), math.cos(min(math.pi, angle * 1.5 + 1e-6))

    def places(self, packed: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, cosine to its centroid, whether it is the row's home), a row's cells in order."""
        out = []
        for at, units in _matrix(packed, self.kind):
            size = units.shape[1]
            if size not in self.centroids:
                out.append((at, np.full(len(at), self.rest + size), np.full(len(at), -1.0), np.ones(len(at), bool)))
                continue
            step = max(1, SCORES // len(self.centroids[size]))
            for i in range(0, len(at), step):
                scores = units[i:i + step] @ self.centroids[size].T
                home = scores.argmax(axis=1)
                row, cell = np.nonzero(scores >= scores.max(axis=1, keepdims=True) - self.margin)
                out.append((at[i + row], cell + self.first[size], scores[row, cell], home[row] == cell))
        return tuple(np.concatenate(c) for c in zip(*out))

    def kinds(self, cosine: np.ndarray, home: np.ndarray) -> np.ndarray:
        """0 core, 1 may be linked to a core, 2 the rest."""
        return np.where(home & (cosine >= self.core), 0, np.where(cosine >= self.near, 1, 2))


def _census(reps: DataFrame, cells: _Cells) -> dict[int, list]:
    """For each cell: rows of each kind, weight of the core, smallest node of the core. At most one row a cell."""
    def counted(batches):
        for b in batches:
            if not b.num_rows:
                continue
            row, cell, cosine, home = cells.places(b.column("packed"))
            kind = cells.kinds(cosine, home)
            copies, nodes = b.column("copies").to_numpy(), np.array(b.column("node").to_pylist(), object)
            there, at = np.unique(cell, return_inverse=True)
            n = [np.bincount(at, kind == k, len(there)).astype(int) for k in range(3)]
            weight = np.zeros(len(there), np.int64)
            np.add.at(weight, at[kind == 0], copies[row[kind == 0]])
            low: list = [None] * len(there)
            for i, node in zip(at[kind == 0], nodes[row[kind == 0]]):
                low[i] = node if low[i] is None else min(low[i], node)
            yield pa.RecordBatch.from_arrays(
                [pa.array(there, pa.int64()), *(pa.array(x, pa.int64()) for x in n), pa.array(weight), pa.array(low, pa.string())],
                ["cell", "n0", "n1", "n2", "weight", "low"])

    found = reps.select("node", "packed", "copies").mapInArrow(
        counted, "cell long, n0 long, n1 long, n2 long, weight long, low string")
    sums = [F.sum(c).alias(c) for c in ("n0", "n1", "n2", "weight")]
    return {r["cell"]: r for r in found.groupBy("cell").agg(*sums, F.min("low").alias("low")).collect()}


def _forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest member of each of 0..n-1 over the links x[i] - y[i]."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label, new)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(t: pa.Table, threshold: float, kind: str) -> pa.RecordBatch | None:
    """Links among the rows of one pair of blocks: counts and a forest."""
    side, home, own = t.column("side").to_numpy(), t.column("home").to_numpy(), t.column("of").to_numpy()
    weight, cell = t.column("copies").to_numpy(), t.column("cell")[0].as_py()
    within = bool((side == 2).all())  # a block with itself
    left, right = (np.arange(len(side)),) * 2 if within else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
    if not len(left) or not len(right) or len(side) < 2:
        return None
    units = np.zeros(0)
    for _, units in _matrix(t.column("packed").combine_chunks(), kind):
        pass  # vectors of one cell have one length
    close = units[left] @ units[right].T >= threshold
    close &= home[left][:, None] | home[right][None, :]
    if within:
        close = np.triu(close, 1)
    x, y = np.nonzero(close)
    x, y = left[x], right[y]
    # a pair of different homes that meets in both is counted in the lower cell
    host, guest = np.where(home[x], x, y), np.where(home[x], y, x)
    parted = own[host] != own[guest]
    twice = np.zeros(len(x), bool)
    lower = np.flatnonzero(parted & (own[guest] < cell))
    if len(lower):
        lists = t.column("visits").combine_chunks()
        flat, off = lists.values.to_numpy(), lists.offsets.to_numpy()
        visits = np.repeat(np.arange(len(side)), np.diff(off)) * (1 << 32) + flat[off[0]:off[-1]]
        twice[lower] = np.isin(host[lower] * (1 << 32) + own[guest[lower]], visits)
    x, y = x[~twice], y[~twice]
    if not len(x):
        return None
    links = np.zeros(len(side), np.int64)
    np.add.at(links, x, weight[y])
    np.add.at(links, y, weight[x])
    root = _forest(len(side), x, y)
    some = np.flatnonzero(links)
    nodes = t.column("node")
    return pa.RecordBatch.from_arrays(
        [nodes.take(some).combine_chunks(), pa.array(links[some]), nodes.take(root[some]).combine_chunks()], ["node", "links", "root"])


def _met(reps: DataFrame, cells: _Cells, census: dict[int, list], threshold: float, block_rows: int) -> DataFrame:
    """(node, links, root) of each pair of blocks that meets; rows sorted, one pair of blocks in memory at a time."""
    def blocks(n: int) -> int:
        return max(1, math.ceil(n / block_rows))

    # per cell: blocks of the shell (kinds 1 and 2), of those that may reach the core, and of the core
    cut_into = {c: (blocks(r["n1"] + r["n2"]), blocks(r["n1"]), blocks(r["n0"]), r["n0"] > 0, r["n1"] > 0) for c, r in census.items()}

    def dealt(batches):
        for b in batches:
            if not b.num_rows:
                continue
            row, cell, cosine, home = cells.places(b.column("packed"))
            kind = cells.kinds(cosine, home)
            order = np.argsort(row, kind="stable")
            row, cell, home, kind = row[order], cell[order], home[order], kind[order]
            of = np.zeros(b.num_rows, np.int64)
            of[row[home]] = cell[home]
            hashes = [int(x[:12], 16) for x in b.column("node").to_pylist()]
            starts = np.searchsorted(row, np.arange(b.num_rows + 1))
            keys, sides, at, homes = [], [], [], []
            for r, c, h, k in zip(row.tolist(), cell.tolist(), home.tolist(), kind.tolist()):
                shell, reach, core, has_core, has_reach = cut_into[c]
                if k:
                    mine = hashes[r] % shell
                    for o in range(shell):
                        keys.append((c, 0, min(mine, o), max(mine, o)))
                        sides.append(2 if mine == o else int(mine > o))
                if k == 1 and has_core:
                    keys += [(c, 1, hashes[r] % reach, o) for o in range(core)]
                    sides += [0] * core
                if k == 0 and has_reach:
                    keys += [(c, 1, o, hashes[r] % core) for o in range(reach)]
                    sides += [1] * reach
                new = len(keys) - len(at)
                at += [r] * new
                homes += [h] * new
            where = np.array(at, np.int64)
            c, what, i, j = (np.array(x, np.int64) for x in zip(*keys)) if keys else (np.zeros(0, np.int64),) * 4
            visits = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(cell, pa.int64()))
            for s in range(0, len(where), 8192):
                part = slice(s, s + 8192)
                take = pa.array(where[part])
                yield pa.RecordBatch.from_arrays([
                    *(pa.array(x[part]) for x in (c, what, i, j)), pa.array(np.array(sides, np.int32)[part]), pa.array(np.array(homes, bool)[part]),
                    pa.array(of[where[part]]), b.column("node").take(take), b.column("copies").take(take), b.column("packed").take(take),
                    visits.take(take)], ["cell", "what", "i", "j", "side", "home", "of", "node", "copies", "packed", "visits"])

    group = ["cell", "what", "i", "j"]

    def compared(batches):
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if kept is None else pa.concat_tables([kept, t])
            if not t.num_rows:
                continue
            keys = np.stack([t.column(g).to_numpy() for g in group])
            starts = np.r_[0, 1 + np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0))]
            for lo, hi in zip(starts[:-1], starts[1:]):
                if (found := _compare(t.slice(lo, hi - lo), threshold, cells.kind)) is not None:
                    yield found
            kept = t.slice(starts[-1]).combine_chunks()  # the last pair of blocks may go on in the next batch
        if kept is not None and (found := _compare(kept, threshold, cells.kind)) is not None:
            yield found

    dealt_rows = reps.select("node", "packed", "copies").mapInArrow(
        dealt, "cell long, what long, i long, j long, side int, home boolean, of long, node string, copies long, packed binary, visits array<long>")
    return dealt_rows.repartition(*group).sortWithinPartitions(*group).mapInArrow(compared, PARTIAL)


def _in_cores(reps: DataFrame, cells: _Cells, census: dict[int, list]) -> DataFrame:
    """(node, links, root) of the nodes in cores: each is linked to all of its core."""
    cores = {c: (r["weight"], r["low"]) for c, r in census.items() if r["n0"] > 1}

    def counted(batches):
        for b in batches:
            if not b.num_rows:
                continue
            row, cell, cosine, home = cells.places(b.column("packed"))
            inside = np.flatnonzero((cells.kinds(cosine, home) == 0) & np.isin(cell, np.array(list(cores), np.int64)))
            copies, take = b.column("copies").to_numpy(), pa.array(row[inside])
            links = [cores[c][0] - int(copies[r]) for r, c in zip(row[inside], cell[inside].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("node").take(take), pa.array(links, pa.int64()), pa.array([cores[c][1] for c in cell[inside].tolist()], pa.string())],
                ["node", "links", "root"])

    return reps.select("node", "packed", "copies").mapInArrow(counted, PARTIAL)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = COSINE,
                    margin: float = MARGIN, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row for each row of ``vectors``; other columns do not matter.

    A link is a cosine of at least ``threshold`` (over 0) in double precision. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing; vectors of different lengths do not link with each other. Each row
    counts as a vector of its own, also with an id that repeats. Rows with a null id count as links of others; they
    get the smallest id that they reach, or null, and are never kept. An empty table gives no rows.

    Links are found if one end visits the home of the other: all of them in practice, a measured share in the README.
    """
    vectors = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    kind = "<f4" if vectors.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"
    rows = cut(_pack(vectors, kind))
    reps = cut(rows.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.first("packed").alias("packed"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low")))
    n = reps.count()
    if n == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    cells = _Cells(_centroids(reps, n, threshold, kind), threshold, margin, kind)
    census = _census(reps, cells)
    met = cut(_met(reps, cells, census, threshold, block_rows).unionByName(_in_cores(reps, cells, census)))
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of = cut(reps.select("node", "copies", "low").join(links, "node", "left").join(roots, "node", "left"))
    # written apart, so that the join below can be split where a component is large
    lows = cut(of.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("low").alias("component")))
    total = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    per_node = of.where(F.col("root").isNotNull()).join(lows.hint("merge"), "root").select("node", total, "component").unionByName(
        of.where(F.col("root").isNull()).select("node", total, F.col("low").alias("component")))
    found = rows.select("vec_id", "node").join(per_node.hint("merge"), "node", "left")
    alone = F.col("node").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component"))
    return found.select("vec_id", F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"),
                        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


@query("op13_embeddings")
def op13_embeddings(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"))
