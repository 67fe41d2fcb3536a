"""A multi-index for an exact join of near vectors: narrow axes per block, fitted on a bounded sample.

Orthonormal axes shorten no distance to more than it was: vectors within r of each other stay within r on any set of axes,
and if the axes are dealt into B blocks, within r / sqrt(B) on one of them at least. So a pair that is found in no block
is no pair. In each block the leading axes form a grid. The first few (coarse) deal the rows to tasks, the others are
joined within the task; what agrees there is tested on all axes of the block. How many axes and blocks pay is reckoned
on rows of the sample that the axes were not fitted on; the choice bears on cost alone, never on the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS, SAMPLE_VALUES = 1024, 4_000_000
AXES, BLOCKS, WIDTHS = (16, 32, 64, 128, 256), (1, 2, 4, 8, 16), (4.0, 3.0, 2.001)
COARSE, GRID = 3, 8
#: copies of a row that may be shipped, and made within a task
MOST_SHIPPED, MOST_LOCAL = 64, 64
SLACK = 1e-6  # coordinates are kept in single precision
CHUNK = 4_000_000


@dataclass
class Index:
    axes: np.ndarray  # vector length x axes
    blocks: list[np.ndarray]  # numbers of the axes, those of the grid first
    reach: float  # largest distance within a block
    coarse: int
    grid: int
    wide: float = 4.0  # width of a cell in reaches, more than 2

    @property
    def width(self) -> float:
        return self.wide * (self.reach + SLACK)

    def sketch(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors @ self.axes).astype(np.float32)

    def cells(self, values: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(own key, own cells) on the grid axes lo..hi-1 of a block's values."""
        at = np.floor(values[:, lo:hi] / self.width).astype(np.int64)
        return _keys(at), at

    def visits(self, values: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of every cell that lies within reach of a row, on the same axes."""
        far = self.reach + SLACK
        low = np.floor((values[:, lo:hi] - far) / self.width).astype(np.int64)
        high = np.floor((values[:, lo:hi] + far) / self.width).astype(np.int64)
        row, at = np.arange(len(values)), low.copy()
        for k in range(hi - lo):  # what lies within reach is narrower than a cell: one cell or two
            two = np.flatnonzero(low[row, k] != high[row, k])
            more = at[two].copy()
            more[:, k] += 1
            row, at = np.r_[row, row[two]], np.concatenate([at, more])
        return row, _keys(at)

    def close(self, home: np.ndarray, guest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(x, y, pairs formed): homes and guests of one coarse cell within reach on a block's axes."""
        limit, xs, ys, formed = (self.reach + 10 * SLACK) ** 2, [], [], 0
        fine = (min(self.coarse, self.grid), self.grid)
        if fine[0] >= fine[1]:  # no grid within the task: all of the cell
            step = max(1, CHUNK // max(1, len(guest)))
            squares = np.einsum("ij,ij->i", guest, guest)
            for i in range(0, len(home), step):
                part = home[i:i + step]
                d = np.einsum("ij,ij->i", part, part)[:, None] + squares[None, :] - 2 * (part @ guest.T)
                x, y = np.nonzero(d <= limit)
                xs.append(i + x)
                ys.append(y)
            formed = len(home) * len(guest)
        else:
            own, _ = self.cells(home, *fine)
            order = np.argsort(own, kind="stable")
            own = own[order]
            row, key = self.visits(guest, *fine)
            first, end = np.searchsorted(own, key, "left"), np.searchsorted(own, key, "right")
            some = np.flatnonzero(end > first)
            row, first, count = row[some], first[some], (end - first)[some]
            formed = int(count.sum())
            starts = np.r_[0, np.cumsum(count)]
            i = 0
            while i < len(row):
                j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK, "right")) - 1)
                n = count[i:j]
                y = np.repeat(row[i:j], n)
                x = order[np.repeat(first[i:j], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                d = home[x] - guest[y]
                keep = np.einsum("ij,ij->i", d, d) <= limit
                xs.append(x[keep])
                ys.append(y[keep])
                i = j
        return (np.concatenate(xs), np.concatenate(ys), formed) if xs else (np.zeros(0, int), np.zeros(0, int), formed)


def _keys(at: np.ndarray) -> np.ndarray:
    """One number for the cells on a few axes; wraps around far away, where it makes no pair that is near."""
    bits = 60 // max(1, at.shape[1])
    key = np.zeros(len(at), np.int64)
    for k in range(at.shape[1]):
        key = key << bits | at[:, k] & ((1 << bits) - 1)
    return key


def principal(sample: np.ndarray, most: int) -> np.ndarray:
    """Orthonormal axes, those along which the sample varies most first."""
    centred = sample - sample.mean(axis=0)
    if sample.shape[1] <= len(sample):
        _, axes = np.linalg.eigh(centred.T @ centred)
        axes = axes[:, ::-1]
    else:
        size, along = np.linalg.eigh(centred @ centred.T)
        some = np.flatnonzero(size > 1e-12)[::-1]
        axes = centred.T @ along[:, some]
    if axes.shape[1] == 0:
        axes = np.eye(sample.shape[1], 1)
    return np.linalg.qr(axes[:, :most])[0]


def plan(sample: np.ndarray, distance: float) -> Index:
    """The index that forms the fewest pairs among held-out rows of the sample, within the bounds on copies of rows."""
    held, fitted = (sample[:256], sample[256:]) if len(sample) >= 512 else (sample, sample)
    axes = principal(fitted, min(max(AXES), sample.shape[1]))
    best, least = None, math.inf
    apart = ~np.eye(len(held), dtype=bool)
    for n in sorted({min(k, axes.shape[1]) for k in AXES}):
        values = (held @ axes[:, :n]).astype(np.float32)
        squares = np.einsum("ij,ij->i", values, values)
        near = squares[:, None] + squares[None, :] - 2 * values @ values.T
        options = [Index(axes[:, :n], [np.arange(n)], distance, 0, 0)]  # no grid: all pairs, tested on all axes at once
        options += [Index(axes[:, :n], [np.arange(k, n, b) for k in range(b)], distance / math.sqrt(b), COARSE, min(GRID, n // b), wide)
                    for b in BLOCKS if b <= n for wide in WIDTHS]
        for one in options:
            share, shipped, local = _costs(one, values, apart)
            cost = min(share, 1.0) + (near[apart] <= distance ** 2).mean() if len(held) > 1 else 0.0
            if shipped <= MOST_SHIPPED and local <= MOST_LOCAL and cost < least - 1e-3:
                best, least = one, cost
    return best


def _costs(one: Index, values: np.ndarray, apart: np.ndarray) -> tuple[float, float, float]:
    """Among the rows of ``values``: share of the pairs formed, copies of a row shipped, copies made within a task."""
    share, shipped, local = 0.0, 0.0, 0.0
    for ids in one.blocks:
        own = values[:, ids[:one.grid]]
        at, low, high = (np.floor((own + d) / one.width) for d in (0, -one.reach - SLACK, one.reach + SLACK))
        meets = apart.copy()
        for k in range(one.grid):
            meets &= (low[None, :, k] <= at[:, None, k]) & (at[:, None, k] <= high[None, :, k])
        copies = high - low + 1
        share += meets.sum() / max(1, apart.sum())
        shipped += 1 + copies[:, :one.coarse].prod(axis=1).mean()
        local = max(local, copies[:, one.coarse:].prod(axis=1).mean())
    return share, shipped, local


def fit(points: DataFrame, order: str, distance: float) -> Index | None:
    """An index over the ``vector`` column (unit vectors of one length); None for an empty table."""
    total = points.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not total[0]:
        return None
    rows = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // max(1, total[1])))
    share = max(1, total[0] // rows)
    drawn = points.where(F.pmod(F.xxhash64(order), F.lit(share)) == 0).select("vector").limit(rows).collect()
    if not drawn:
        drawn = points.select("vector").limit(rows).collect()
    return plan(np.array([r[0] for r in drawn], float), distance)
