"""Greedy selection and components among the boxes of crowded images, without forming their pairs.

A box meets only boxes in the cells of a size-dependent grid that a partner's centre can lie in, and what is settled
leaves its cell. In a dense cluster the first box settles nearly all others, so the work stays near linear.

A key with up to ``FOLD_BOXES`` boxes is folded by one task, many keys to a task. For larger ones ``lead_rounds`` lets all
boxes that lead their neighbourhood act at once, on all executors, until what is left of a key fits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.functions import boxes as B

FOLD_BOXES = 200_000
CORNERS = ["x1", "y1", "x2", "y2"]


class Field:
    """Boxes of one key in cells by level (power of two of each side) and centre; settled ones leave."""

    def __init__(self, corners: np.ndarray, threshold: float):
        self.corners, self.threshold = corners, threshold
        self.open = np.ones(len(corners), bool)
        self.met = 0  # pairs of boxes that were compared
        self.sides = corners[:, 2:] - corners[:, :2]
        self.centres = (corners[:, :2] + corners[:, 2:]) / 2
        self.areas = self.sides[:, 0] * self.sides[:, 1]
        level = np.floor(np.log2(self.sides)).astype(int)
        cell = np.floor(self.centres / np.exp2(level + 1.0)).astype(np.int64)
        keys, member = np.unique(np.column_stack([level, cell]), axis=0, return_inverse=True)
        order = np.argsort(member, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(member[order])) + 1)
        self.cells = {tuple(k): p for k, p in zip(keys.tolist(), parts)}
        self.levels = sorted({(a, b) for a, b, _, _ in self.cells})

    def _spans(self, i: int) -> Iterator[tuple[int, int, range, range]]:
        slack = self.threshold * (1 - 1e-9)
        side, centre = self.sides[i].tolist(), self.centres[i].tolist()
        low = [math.floor(math.log2(s * slack)) for s in side]
        high = [math.floor(math.log2(s / slack)) for s in side]
        for level in self.levels:
            if all(low[k] <= level[k] <= high[k] for k in (0, 1)):
                spans = []
                for k in (0, 1):
                    size = 2.0 ** (level[k] + 1)
                    reach = side[k] * ((1.0 - self.threshold) / self.threshold) + size * 1e-9
                    spans.append(range(math.floor((centre[k] - reach) / size), math.floor((centre[k] + reach) / size) + 1))
                yield *level, *spans

    def settle(self, i: int) -> np.ndarray:
        """The open boxes that overlap box i at the threshold, which are then closed like it."""
        self.open[i] = False
        hits = []
        for lw, lh, across, down in self._spans(i):
            for cx in across:
                for cy in down:
                    if (there := self.cells.get((lw, lh, cx, cy))) is None:
                        continue
                    live = there[self.open[there]]
                    self.met += len(live)
                    hit = live[self._iou(i, live) >= self.threshold] if len(live) else live
                    self.open[hit] = False
                    hits.append(hit)
                    if len(live) - len(hit) < len(there):
                        rest = live[self.open[live]]
                        if len(rest):
                            self.cells[lw, lh, cx, cy] = rest
                        else:
                            del self.cells[lw, lh, cx, cy]
        return np.concatenate(hits) if hits else np.zeros(0, int)

    def near(self, i: int) -> np.ndarray:
        """The boxes after box i that overlap it at the threshold; nothing is closed."""
        found = []
        for lw, lh, across, down in self._spans(i):
            for cx in across:
                for cy in down:
                    if (there := self.cells.get((lw, lh, cx, cy))) is not None:
                        there = there[there > i]
                        self.met += len(there)
                        found.append(there[self._iou(i, there) >= self.threshold])
        return np.concatenate(found) if found else np.zeros(0, int)

    def _iou(self, i: int, others: np.ndarray) -> np.ndarray:
        a, b = self.corners[i], self.corners[others]
        wide = np.maximum(0.0, np.minimum(a[2], b[:, 2]) - np.maximum(a[0], b[:, 0]))
        high = np.maximum(0.0, np.minimum(a[3], b[:, 3]) - np.maximum(a[1], b[:, 1]))
        shared = wide * high
        union = self.areas[i] + self.areas[others] - shared
        return np.where((shared > 0) & (union > 0), shared / np.where(union > 0, union, 1.0), 0.0)


def select(corners: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """(whether each box is dropped, pairs compared): first come, in the order given."""
    field, dropped = Field(corners, threshold), np.zeros(len(corners), bool)
    for i in range(len(corners)):
        if field.open[i]:
            dropped[field.settle(i)] = True
    return dropped, field.met


def flood(corners: np.ndarray, threshold: float) -> tuple[np.ndarray, int]:
    """(number of each box's component, its first box; pairs compared)."""
    field, root = Field(corners, threshold), np.arange(len(corners))
    for i in range(len(corners)):
        todo = [i] if field.open[i] else []
        while todo:
            found = field.settle(todo.pop())
            root[found] = i
            todo += found.tolist()
    return root, field.met


def clashes(corners: np.ndarray, kinds: np.ndarray, weights: np.ndarray, threshold: float) -> int:
    """Pairs of boxes of different kinds that overlap, each box standing for ``weights`` equal ones."""
    field, total = Field(corners, threshold), 0
    for i in range(len(corners)):
        near = field.near(i)
        total += int(weights[i]) * int(weights[near[kinds[near] != kinds[i]]].sum())
    return total


def _folded(df: DataFrame, keys: list[str], order: str, fold: Callable, *more: str) -> DataFrame:
    """Over (keys, order, _mid, corners, more): (_mid, to) rows of ``fold`` (rows of one key in order)."""
    columns = ["_key", "_mid", *CORNERS, *more]
    rows = df.select(F.to_json(F.struct(*keys)).alias("_key"), F.col(order).alias("_order"), "_mid", *[F.col(c).cast("double").alias(c) for c in CORNERS], *more)
    ordered = rows.repartition("_key").sortWithinPartitions("_key", "_order").select(*columns)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            if frame.empty:
                continue
            key = frame["_key"].to_numpy()
            starts = np.r_[0, 1 + np.flatnonzero(key[1:] != key[:-1])]
            for lo, hi in zip(starts[:-1], starts[1:]):
                yield fold(frame.iloc[lo:hi])
            rest = frame.iloc[starts[-1]:]
        if rest is not None and not rest.empty:
            yield fold(rest)

    return ordered.mapInPandas(run, "_mid long, to long")


def dropped(df: DataFrame, keys: list[str], order: str, threshold: float, fold_boxes: int = FOLD_BOXES) -> DataFrame:
    """(_mid) of the boxes that a first-come selection within ``keys`` drops.

    Over a written table with the keys, ``order``, a unique ``_mid`` and corners of boxes with an area.
    """
    def fold(part: pd.DataFrame) -> pd.DataFrame:
        gone = part["_mid"].to_numpy()[select(part[CORNERS].to_numpy(), threshold)[0]]
        return pd.DataFrame({"_mid": gone, "to": gone})

    open_rows, gone = df.select(*keys, order, "_mid", *CORNERS), None
    while True:
        large = open_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > fold_boxes).drop("_n")
        if not large.head(1):
            last = _folded(open_rows, keys, order, fold).select("_mid")
            return last if gone is None else last.unionByName(gone)
        large = cut(large)
        fits, over = open_rows.join(large, keys, "left_anti"), open_rows.join(large, keys, "left_semi")
        more, open_over = lead_round(over, keys, order, threshold)
        gone = more if gone is None else gone.unionByName(more)
        open_rows = cut(fits.unionByName(open_over))


def lead_round(rows: DataFrame, keys: list[str], order: str, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(boxes dropped, rows still open): all boxes act that come first in every cell a partner of theirs can lie in.

    They are kept for certain, and what they overlap is dropped for certain. A box meets one box a cell, its first.
    """
    w, h = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    cx, cy = (F.col("x1") + F.col("x2")) / 2, (F.col("y1") + F.col("y2")) / 2
    cells = ["_lw", "_lh", "_cx", "_cy"]

    def level(side):
        return F.floor(F.log2(side)).cast("int")

    def spots(centre, side):
        return F.flatten(F.transform(B.partner_levels(side, threshold), lambda at: F.transform(
            B.partner_cells(centre, side, at, threshold), lambda c: F.struct(at.alias("at"), c.alias("c")))))

    lead = F.min(F.struct(order, "_mid", *CORNERS)).alias("_lead")
    leads = rows.select(
        *keys, order, "_mid", *CORNERS, level(w).alias("_lw"), level(h).alias("_lh"), F.floor(cx / F.pow(F.lit(2.0), level(w) + 1)).alias("_cx"),
        F.floor(cy / F.pow(F.lit(2.0), level(h) + 1)).alias("_cy")).groupBy(*keys, *cells).agg(lead)
    around = rows.withColumn("_x", F.explode(spots(cx, w))).withColumn("_y", F.explode(spots(cy, h))).select(
        *keys, order, "_mid", *CORNERS, F.col("_x.at").alias("_lw"), F.col("_y.at").alias("_lh"), F.col("_x.c").alias("_cx"), F.col("_y.c").alias("_cy"))
    ratio = B.iou(tuple(F.col(c) for c in CORNERS), tuple(F.col(f"_lead.{c}") for c in CORNERS))
    met = cut(around.join(leads, [*keys, *cells]).select(
        "_mid", F.col("_lead._mid").alias("_by"), (F.col(f"_lead.{order}") < F.col(order)).alias("_later"), (ratio >= threshold).alias("_hit")))
    acting = cut(met.groupBy("_mid").agg(F.max("_later").alias("_later")).where(~F.col("_later")).select("_mid"))
    gone = cut(met.where(F.col("_hit") & (F.col("_mid") != F.col("_by"))).join(acting.withColumnRenamed("_mid", "_by"), "_by", "left_semi").select("_mid").distinct())
    return gone, rows.join(acting.unionByName(gone), "_mid", "left_anti").select(*rows.columns)


def roots(df: DataFrame, keys: list[str], order: str, threshold: float) -> DataFrame:
    """(_mid, root): the first box of each box's component, for keys that one task folds."""
    def fold(part: pd.DataFrame) -> pd.DataFrame:
        mid = part["_mid"].to_numpy()
        return pd.DataFrame({"_mid": mid, "to": mid[flood(part[CORNERS].to_numpy(), threshold)[0]]})

    return _folded(df, keys, order, fold).select("_mid", F.col("to").alias("root"))


def clash_counts(df: DataFrame, keys: list[str], order: str, kind: str, weight: str, threshold: float) -> DataFrame:
    """(_mid, pairs): the clashing pairs of each key that one task folds, at its first box."""
    def fold(part: pd.DataFrame) -> pd.DataFrame:
        pairs = clashes(part[CORNERS].to_numpy(), part[kind].to_numpy(), part[weight].to_numpy(), threshold)
        return pd.DataFrame({"_mid": part["_mid"].iloc[:1], "to": [pairs]})

    return _folded(df, keys, order, fold, kind, weight).select("_mid", F.col("to").alias("pairs"))
