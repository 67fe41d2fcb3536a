"""Train/val/test plans that do not depend on partitioning and leak no duplicates."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.operators.ranking import first_per_key, hash_rank

SPLITS = ("train", "val", "test")


def shuffle_token(seed: int, *what: Column) -> Column:
    """A hash that orders rows in a seeded, repeatable, location-free way."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *what))


def _shares(n: Column, train: float, val: float) -> tuple[Column, Column]:
    first = F.greatest(F.lit(1), F.floor(n * F.lit(train)))
    second = F.greatest(F.lit(1), F.floor(n * F.lit(val)))
    second = F.when(first + second >= n, F.greatest(F.lit(1), n - first)).otherwise(second)
    return first, second


def proportional(rank: Column, n: Column, train: float = 0.8, val: float = 0.1) -> Column:
    """Split of the ``rank``-th of ``n`` rows (1-based); from three rows on no split is empty."""
    first, second = _shares(n, train, val)
    full = first + second >= n
    cut_first = F.when(full & (first > second), first - 1).otherwise(first)
    cut_second = F.when(full & (first <= second), second - 1).otherwise(second)
    return (
        F.when(n <= 2, F.when(rank == 1, "train").otherwise("val"))
        .when(rank <= cut_first, "train").when(rank <= cut_first + cut_second, "val").otherwise("test")
    )


def cut_points(rank: Column, n: Column, train: float = 0.8, val: float = 0.1) -> Column:
    """The variant that may leave test empty (three rows: two train, one val)."""
    first, second = _shares(n, train, val)
    return (
        F.when(n <= 2, F.when(rank == 1, "train").otherwise("val"))
        .when(rank <= first, "train").when(rank <= F.least(n, first + second), "val").otherwise("test")
    )


def plan(df: DataFrame, folder: str, path: str, seed: int = 42, rule=proportional,
         train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Add ``split``: the rows of each folder, in hashed order, by the rule."""
    ranked = hash_rank(df.withColumn("_token", shuffle_token(seed, F.col(path))), [folder], "_token", "_r")
    return ranked.withColumn("split", rule(F.col("_r"), F.col("_r_of"), train, val)).drop("_token", "_r", "_r_of")


def per_class_limit(df: DataFrame, folder: str, path: str, limit: int, seed: int = 42) -> DataFrame:
    """The first ``limit`` rows of each folder in hashed order (all rows for 0)."""
    if limit <= 0:
        return df
    ranked = hash_rank(df.withColumn("_token", shuffle_token(seed, F.col(path))), [folder], "_token", "_r")
    return ranked.where(F.col("_r") <= limit).drop("_token", "_r", "_r_of")


def primary_classes(images: DataFrame, idx: Column) -> DataFrame:
    """(sha1, label, size): most frequent class of each duplicate group, ties to the class scanned first."""
    counts = images.groupBy("sha1", "label").agg(F.count(F.lit(1)).alias("_n"), F.min(idx).alias("_idx"))
    sizes = F.sum("_n").alias("size")
    best = F.max(F.struct(F.col("_n"), (-F.col("_idx")).alias("_back"), "label")).alias("_best")
    return counts.groupBy("sha1").agg(sizes, best).select("sha1", F.col("_best.label").alias("label"), "size")


# ---- groups to splits by largest deficit -----------------------------------

def fill_run(targets: tuple[float, ...], current: list[int], size: int, n: int) -> list[tuple[int, list[int]]]:
    """Place ``n`` groups of one size: each goes to the split furthest below its target.

    Ties go to the smaller split, then to the earlier. Returns (count, cycle) stretches,
    where the k-th group of a stretch goes to ``cycle[k % len(cycle)]``, and moves
    ``current`` forward. All deficits fall by ``size`` per group placed, so the choice is
    first constant, then a fixed cycle over the splits that have drawn level; whole
    stretches are taken at once.
    """
    out: list[tuple[int, list[int]]] = []

    def gap(k: int) -> float:
        return targets[k] - current[k]

    def choose() -> int:
        return max(range(len(targets)), key=lambda k: (gap(k), -current[k], -k))

    def place(cycle: list[int], times: int) -> None:
        nonlocal n
        for k in cycle:
            current[k] += size * times
        n -= len(cycle) * times
        if out and out[-1][1] == cycle:
            out[-1] = (out[-1][0] + len(cycle) * times, cycle)
        else:
            out.append((len(cycle) * times, cycle))

    while n > 0:
        top = choose()
        level = [k for k in range(len(targets)) if gap(top) - gap(k) < size]
        behind = [gap(top) - gap(k) for k in range(len(targets)) if k not in level]
        if len(level) == 1:
            alone = int(min(behind) / size) - 1 if behind else n
            place([top], max(1, min(n, alone)))
            continue
        start = list(current)
        cycle: list[int] = []
        for _ in range(min(n, len(level))):
            k = choose()
            cycle.append(k)
            current[k] += size
        current[:] = start
        rounds = 1
        if sorted(cycle) == sorted(level):
            room = int(min(behind) / size) - 2 if behind else n // len(cycle)
            rounds = max(1, min(n // len(cycle), room))
        place(cycle, rounds)
    return out


def group_split(images: DataFrame, idx: Column, seed: int = 42, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """Add ``split`` to images (sha1, label, ...): all copies of an image share it.

    Per primary class, duplicate groups from large to small (equal sizes in hashed
    order) each go to the split furthest below its target. Only (class, size, count) rows
    reach Python: at most one per distinct group size.
    """
    shares = (train, val, 1.0 - train - val)
    groups = primary_classes(images, idx).withColumn("_token", shuffle_token(seed, F.col("sha1")))
    runs = groups.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))

    def simulate(runs: pd.DataFrame) -> pd.DataFrame:
        total = int((runs["size"] * runs["n"]).sum())
        targets = tuple(total * share for share in shares)
        current = [0, 0, 0]
        rows = []
        for size, n in runs.sort_values("size", ascending=False)[["size", "n"]].itertuples(index=False):
            start = 0
            for count, cycle in fill_run(targets, current, int(size), int(n)):
                rows.append((runs["label"].iloc[0], int(size), start, start + count, [SPLITS[k] for k in cycle]))
                start += count
        return pd.DataFrame(rows, columns=["label", "size", "lo", "hi", "cycle"])

    stretches = runs.groupBy("label").applyInPandas(
        simulate, "label string, size long, lo long, hi long, cycle array<string>"
    ).groupBy("label", "size").agg(F.collect_list(F.struct("lo", "hi", "cycle")).alias("_plan"))
    at = F.col("_r") - 1
    mine = F.filter("_plan", lambda s: (s["lo"] <= at) & (at < s["hi"]))[0]
    chosen = F.element_at(mine["cycle"], ((at - mine["lo"]) % F.size(mine["cycle"]) + 1).cast("int"))
    placed = (
        hash_rank(groups, ["label", "size"], "_token", "_r").join(stretches, ["label", "size"])
        .select("sha1", chosen.alias("split"))
    )
    return images.join(placed, "sha1")


def fill_empty_splits(df: DataFrame) -> DataFrame:
    """Rows with ``used_as``: an empty val borrows the train rows, an empty test the val rows, else train's."""
    present = df.groupBy().agg(F.collect_set("split")).scalar()
    has_val, has_test = F.array_contains(present, "val"), F.array_contains(present, "test")
    split = F.col("split")
    roles = F.array_compact(F.array(
        split,
        F.when((split == "train") & ~has_val, "val"),
        F.when(~has_test & (split == F.when(has_val, "val").otherwise("train")), "test"),
    ))
    return df.withColumn("used_as", F.explode(roles))
