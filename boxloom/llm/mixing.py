"""Mixing sources to target weights under a time-varying curriculum.

Each source's share follows a weight schedule over training time 0..1. Its integral up to a time says what part of the
source's tokens has been asked for by then; inverting that demand at the place where a document begins in its source's
stream gives the document's position in training. A source whose target exceeds its size is streamed again, up to three
times; the last pass ends where the target is met.

The order within a source is that of a hash of the id. Running sums do not gather a source: it is cut into hash blocks,
summed in parallel and shifted by the blocks before. Positions are made comparable over all sources and the result is
sorted by range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table
from boxloom.llm.words import split_words

WEIGHTS = 3  # sources weigh 1, 2, 3, 1, ... in the order of their names
PASSES = 3
BLOCK_BITS = 12
#: a source of weight 1, 2, 3 goes from 1.5 to 0.5, stays at 1, goes from 0.5 to 1.5 times its mean weight
SLOPE = 0.5


def targets(sizes: DataFrame) -> DataFrame:
    """Adds rank, weight, target to (source, source_size): one row for each source, null last.

    The shares are levels of water: a source holds level * weight, or PASSES times its size if that is less. Sources
    are filled in the order of the level at which they stop; there are few of them, so these windows are small.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))).withColumn(
        "weight", F.pmod(F.col("rank") - 1, F.lit(WEIGHTS)) + 1
    ).withColumn("_cap", PASSES * F.col("source_size"))
    up = W.orderBy(F.col("_cap") / F.col("weight"), "rank")
    filled = (
        ranked.withColumn("_rest", F.sum("source_size").over(W.partitionBy()) - F.sum("_cap").over(up) + F.col("_cap"))
        .withColumn("_weights", F.sum("weight").over(up.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("_level", F.col("_rest") / F.col("_weights"))
        .withColumn("_stops", F.col("_cap") <= F.col("_level") * F.col("weight"))
    )
    # the first source that does not stop sets the level of all that follow
    level = F.first(F.when(~F.col("_stops"), F.col("_level")), ignorenulls=True).over(
        up.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return filled.withColumn("_common", level).select(
        "source", "source_size", "rank", "weight",
        F.when(F.col("_stops"), F.col("_cap").cast("double")).otherwise(F.col("_common") * F.col("weight")).alias("target"),
    )


def demand_time(share: Column, slope: Column) -> Column:
    """The time by which a source has been asked for ``share`` of its tokens, if its weight is 1 + slope * (2t - 1)."""
    rest = 1 - slope
    return F.when(share <= 0, F.lit(0.0)).otherwise(2 * share / (rest + F.sqrt(rest * rest + 4 * slope * share)))


def mix(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, copies, positions, position``, one row for each row of ``docs``.

    ``taken``: words the mix takes, repeats counted; ``positions``: the times at which the document's passes begin;
    ``copies``: whole documents, a pass counting if at least half of it is taken. Rows are sorted by ``position``, the
    first time; documents that are not taken come last with none. Null and empty texts have size 0 and are never
    taken; sources of size 0 have target 0. Equal ids are ordered by size and text, so reruns agree.
    """
    text = F.coalesce("text", F.lit(""))
    order = ["_h", "doc_id", "size", "_x"]
    sized = cut(docs.select(
        "doc_id", "source", F.size(split_words(text)).cast("long").alias("size"), F.xxhash64("doc_id").alias("_h"),
        F.xxhash64(text).alias("_x"),
    ).withColumn("_block", F.shiftrightunsigned("_h", 64 - BLOCK_BITS)))
    sources = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    blocks = (
        sized.groupBy("source", "_block").agg(F.sum("size").alias("_sum"))
        .join(sources.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of")))
        .withColumn("_before", F.sum("_sum").over(W.partitionBy("rank").orderBy("_block")) - F.col("_sum"))
        .select("source", "_block", "_before", "rank", "weight", "source_size", "target")
    )
    running = F.sum("size").over(W.partitionBy("source", "_block").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    b = blocks.withColumnsRenamed({"source": "_of", "_block": "_in"})
    placed = (
        sized.withColumn("_within", running - F.col("size"))
        .join(b, F.col("source").eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_in")))
        .withColumn("_start", F.col("_before") + F.col("_within"))
    )
    whole = F.floor("target")
    begins = lambda e: F.col("_start") + e * F.col("source_size")
    passes = range(PASSES)
    taken = sum((F.greatest(F.lit(0), F.least(F.col("size"), whole - begins(e))) for e in passes), F.lit(0).cast("long"))
    copies = sum(((F.col("size") > 0) & (2 * (whole - begins(e)) >= F.col("size"))).cast("int") for e in passes)
    slope = (F.col("weight") - 2) * F.lit(SLOPE)
    times = F.array(*(
        F.when((F.col("size") > 0) & (begins(e) < whole), demand_time(begins(e) / F.col("target"), slope)) for e in passes
    ))
    made = placed.select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), copies.alias("copies"),
        F.filter(times, lambda t: t.isNotNull()).alias("positions"),
    ).withColumn("position", F.get("positions", F.lit(0)))
    return cut(made).orderBy(F.col("position").asc_nulls_last(), "doc_id")


@query("op8_mixing")
def op8_mixing(spark, folder):
    return mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
