"""Exact ordered numbering that does not put a whole key into one task.

A plain ``row_number() over (partition by key)`` sends every row of a key to one
task. Here a key is cut into ordered blocks, blocks are numbered in parallel and
each is shifted by the number of rows before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.cluster import cut

GROUP_BOUND = 4096
_MID, _BLOCK = "_mid", "_block"


def split_hot(df: DataFrame, keys: list[str], bound: int = GROUP_BOUND, outer: list[str] | None = None,
              counted: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys with at most ``bound`` rows, rows of the larger keys or None).

    Only the keys are counted; the counts are combined map-side. The larger keys
    number at most rows / bound.

    Where most keys differ from row to row, combining holds nearly all rows of a task. ``outer`` names some of the
    keys that have few rows each too, but fewer values: they are counted first, and all keys only within those above
    ``bound``. ``counted`` is a cheaper frame with at least the rows of ``df`` for that first count.
    """
    over = F.col("_n") > bound

    def above(rows: DataFrame, by: list[str]) -> DataFrame:
        return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(over).drop("_n")

    some = df
    if outer is not None and outer != keys:
        large = above(df if counted is None else counted, outer)
        if not large.head(1):
            return df, None
        some = df.join(cut(large), outer, "left_semi")
    hot = above(some, keys)
    if not hot.head(1):
        return df, None
    hot = cut(hot)
    return df.join(hot, keys, "left_anti"), df.join(hot, keys, "left_semi")


def hash_rank(df: DataFrame, keys: list[str], token: str, out: str, digits: int = 3) -> DataFrame:
    """Number rows 1.. within ``keys`` in the order of a hexadecimal hash column.

    The leading digits of the hash are the block: 16**digits even blocks per key.
    Adds ``out`` and ``<out>_of``, the number of rows of the key.
    """
    df = df.withColumn(_BLOCK, F.substring(token, 1, digits))
    ordered = W.partitionBy(*keys).orderBy(_BLOCK)
    whole = W.partitionBy(*keys)
    offsets = (
        df.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(ordered) - F.col("_n"))
        .withColumn(f"{out}_of", F.sum("_n").over(whole))
        .drop("_n")
    )
    inner = W.partitionBy(*keys, _BLOCK).orderBy(token)
    return (
        df.withColumn("_rn", F.row_number().over(inner))
        .join(offsets, [*keys, _BLOCK])
        .withColumn(out, F.col("_before") + F.col("_rn"))
        .drop(_BLOCK, "_rn", "_before")
    )


def in_blocks(df: DataFrame, order: list[str]) -> DataFrame:
    """Rows sorted by ``order`` over the whole cluster, with a row id and the block it lies in.

    The ids grow with the order; they are written out, so they stay the same for
    all later readers.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn(_MID, F.monotonically_increasing_id())
        .withColumn(_BLOCK, F.spark_partition_id())
    )
    return cut(ranged)


def range_rank(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Number rows 1.. within ``keys`` in the order of ``order``, whatever the size of a key."""
    rows = in_blocks(df, [*keys, *order])
    before = W.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = (
        rows.groupBy(*keys, _BLOCK).agg(F.min(_MID).alias("_lo"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    return (
        rows.join(blocks, [*keys, _BLOCK])
        .withColumn(out, F.col("_before") + F.col(_MID) - F.col("_lo") + 1)
        .drop(_BLOCK, _MID, "_lo", "_before")
    )


def rank(df: DataFrame, keys: list[str], order: list[str], out: str, bound: int = GROUP_BOUND) -> DataFrame:
    """row_number within ``keys``; keys above ``bound`` rows are numbered in blocks."""
    cold, hot = split_hot(df, keys, bound)
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    cold = cold.withColumn(out, number)
    return cold if hot is None else cold.unionByName(range_rank(hot, keys, order, out))


def running_before(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[str, Column]],
    bound: int = GROUP_BOUND,
) -> DataFrame:
    """Running aggregates over the earlier rows of the key (null for the first row).

    ``values`` maps an output name to ("max" | "min" | "sum", column).
    """
    fold = {"max": F.max, "min": F.min, "sum": F.sum}
    pair = {"max": F.greatest, "min": F.least, "sum": lambda a, b: a + b}
    df = df.withColumns({f"_v_{n}": c for n, (_, c) in values.items()})
    cold, hot = split_hot(df, keys, bound)
    temporary = [f"_v_{n}" for n in values]
    earlier = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    cold = cold.withColumns({n: fold[k](f"_v_{n}").over(earlier) for n, (k, _) in values.items()}).drop(*temporary)
    if hot is None:
        return cold
    rows = in_blocks(hot, [*keys, *order])
    before = W.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, _BLOCK).agg(*[fold[k](f"_v_{n}").alias(f"_t_{n}") for n, (k, _) in values.items()])
    blocks = blocks.select(*keys, _BLOCK, *[fold[k](f"_t_{n}").over(before).alias(f"_p_{n}") for n, (k, _) in values.items()])
    local = W.partitionBy(*keys, _BLOCK).orderBy(_MID).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns({f"_l_{n}": fold[k](f"_v_{n}").over(local) for n, (k, _) in values.items()})
    rows = rows.join(blocks, [*keys, _BLOCK])
    for n, (k, _) in values.items():
        mine, prior = F.col(f"_l_{n}"), F.col(f"_p_{n}")
        rows = rows.withColumn(n, F.when(mine.isNull(), prior).when(prior.isNull(), mine).otherwise(pair[k](mine, prior)))
    return cold.unionByName(rows.select(*cold.columns))


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], descending: bool = False) -> DataFrame:
    """One whole row per key, the smallest (or largest) by ``order``; combined map-side.

    ``order`` has to single out one row per key.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], *rest)
    best = F.max(row) if descending else F.min(row)
    return df.groupBy(*keys).agg(best.alias("_best")).select(*keys, *[F.col(f"_best.{c}") for c in rest])
