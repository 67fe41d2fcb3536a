"""Sharding by minimax contiguous partition: the smallest shard capacity for which a greedy filling needs no more shards.

Equal texts form one atomic group. Groups are ordered by the digest of their text; documents are sorted by range on
(digest, id), so a group of any size is spread over tasks, and running sums are made for each range and shifted by the
ranges before it. A group then is a place on a line where a cut may be made.

The capacity is found by bisection. The greedy check runs over knots, a bounded sample of those places held by the
driver: between knots a cut is only known to lie in an interval, which gives a capacity that surely is enough and one
that surely is not. The stretches in which a cut may lie are then read again at a finer grain, until every one of
them is known exactly. Each round reads at most KNOTS numbers whatever the number of documents, and divides the doubt
by about KNOTS / shards.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table

SHARDS, KNOTS = 24, 8192
#: bytes a document takes besides its text
OVERHEAD = 8


class Knots:
    """Places where a cut may be made, ascending from 0; ``open[i]``: others may lie between knots i - 1 and i."""

    def __init__(self, at: np.ndarray, is_open: np.ndarray):
        self.at, self.open = at, is_open

    def reach(self, start: int, capacity: int, most: bool) -> int:
        """The last place that ``capacity`` reaches: the latest it may be, or the earliest."""
        i = int(np.searchsorted(self.at, start + capacity, "right")) - 1
        return start + capacity if most and i + 1 < len(self.at) and self.open[i + 1] else int(self.at[i])

    def cuts(self, capacity: int, shards: int, most: bool) -> list[int]:
        out, at = [], 0
        for _ in range(shards):
            at = min(self.reach(at, capacity, most), int(self.at[-1]))
            out.append(at)
        return out

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Ends of all shards but the last: within ``capacity``, each as near as can be to an even share of the rest.

        ``latest_start[j]`` is the first knot from which the shards after j still hold the rest. It never lies beyond
        the greedy cut, so a knot between it and the capacity is always left to choose.
        """
        total = int(self.at[-1])
        latest_start = [total]
        for _ in range(shards - 1):
            latest_start.append(int(self.at[np.searchsorted(self.at, max(0, latest_start[-1] - capacity))]))
        latest_start.reverse()
        out, at = [], 0
        for j in range(shards - 1):
            choice = self.at[(self.at >= max(at, latest_start[j])) & (self.at <= at + capacity)]
            at = int(choice[np.abs(choice - (at + (total - at) / (shards - j))).argmin()])
            out.append(at)
        return out

    def least(self, shards: int, most: bool, low: int, high: int) -> int:
        """The least capacity in (low, high] under which the shards suffice; ``high`` does."""
        while high - low > 1:
            mid = (low + high) // 2
            low, high = (low, mid) if self.cuts(mid, shards, most)[-1] >= self.at[-1] else (mid, high)
        return high


def minimax_cuts(ends: DataFrame, total: int, shards: int, knots: int = KNOTS) -> list[int]:
    """Ends of all shards but the last, over the ``end`` column of ``ends`` (distinct, ascending to ``total``).

    Cutting where the greedy check filled up would leave the slack to the last shards, and many of them empty beside a
    group as large as several shards. The cuts keep the least capacity and are chosen evenly below it.
    """
    known = Knots(np.array([0, total]), np.array([False, True]))
    while True:
        enough = known.least(shards, False, 0, total)
        first = known.least(shards, True, 0, total)  # no smaller capacity can do
        low, high = known.cuts(first, shards, False), known.cuts(enough, shards, True)
        doubt = [i for i in range(1, len(known.at)) if known.open[i]
                 and any(a < known.at[i] and known.at[i - 1] <= b for a, b in zip(low, high, strict=True))]
        if not doubt:
            return known.even_cuts(enough, shards)
        # joined where they are closest, so that the condition stays short; each is read at least 4 times finer
        stretches = [[int(known.at[i - 1]), int(known.at[i]), int(known.at[i] - known.at[i - 1])] for i in doubt]
        while len(stretches) > 2 * shards or any(x[1] == y[0] for x, y in zip(stretches, stretches[1:], strict=False)):
            k = min(range(1, len(stretches)), key=lambda k: stretches[k][0] - stretches[k - 1][1])
            a, b, widest = stretches.pop(k)
            stretches[k - 1][1:] = b, max(widest, stretches[k - 1][2])
        share = max(2, knots // len(stretches))
        widths = [max(1, min(-(-(b - a) // share), widest // 4)) for a, b, widest in stretches]
        inside = [(F.col("end") > a) & (F.col("end") <= b) for a, b, _ in stretches]
        bucket = F.coalesce(*(
            F.when(within, F.struct(F.lit(n).alias("n"), F.floor((F.col("end") - 1 - a) / w).alias("k")))
            for n, (within, (a, *_), w) in enumerate(zip(inside, stretches, widths, strict=True))
        ))
        found = (
            ends.where(reduce(or_, inside)).groupBy(bucket.alias("_b"))
            .agg(F.min("end").alias("low"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n")).collect()
        )
        # between the last place of a bucket and the first of the next there is none: large groups leave no doubt
        fresh = {r["low"]: False for r in found} | {r["end"]: r["n"] > 2 for r in found}
        old = {int(at): bool(o) for at, o in zip(known.at, known.open, strict=True)
               if not any(a < at <= b for a, b, _ in stretches)}
        both = dict(sorted({**old, **fresh}.items()))
        known = Knots(np.array(list(both)), np.array(list(both.values())))


def on_a_line(docs: DataFrame) -> tuple[DataFrame, int]:
    """(doc_id, size, text_crc32, _digest, _end, _at), and the sum of all sizes.

    ``_end``: running sum of sizes in the order (digest, doc_id); ``_at``: number of rows before.
    """
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("_digest"),
    )

    def summed(batches):
        part, at, end = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            sizes = pc.add(pc.cumulative_sum(b.column("size")), end)
            places = pa.array(np.arange(at, at + b.num_rows))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), sizes, places],
                names=[*b.schema.names, "_part", "_run", "_place"],
            )
            if b.num_rows:
                at, end = at + b.num_rows, sizes[-1].as_py()

    lined = cut(
        sized.repartitionByRange("_digest", "doc_id").sortWithinPartitions("_digest", "doc_id")
        .mapInArrow(summed, "doc_id long, size long, text_crc32 long, _digest binary, _part int, _run long, _place long")
    )
    parts = sorted(lined.groupBy("_part").agg(F.max("_run"), F.count(F.lit(1))).collect())  # one row for each task
    offsets, end, at = [], 0, 0
    for part, run, n in parts:
        offsets.append((part, end, at))
        end, at = end + run, at + n
    shift = docs.sparkSession.createDataFrame(offsets, "_part int, _bytes long, _rows long")
    return lined.join(F.broadcast(shift), "_part").select(
        "doc_id", "size", "text_crc32", "_digest", (F.col("_run") + F.col("_bytes")).alias("_end"),
        (F.col("_place") + F.col("_rows")).alias("_at"),
    ), end


def shard(docs: DataFrame, shards: int = SHARDS, knots: int = KNOTS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``, one row for each row of ``docs``.

    Law ``bytes``: no contiguous partition of the ordered groups into so many shards has a smaller largest shard.
    Null texts count as empty and are equal to those. Equal rows take neighbouring slots. With fewer groups than
    shards some shards stay empty; no documents give no rows.
    """
    lined, total = on_a_line(docs)
    if total == 0:
        cuts = []
    else:
        ends = cut(lined.groupBy("_digest").agg(F.max("_end").alias("end")).select("end"))
        cuts = minimax_cuts(ends, total, shards, knots)
    number = sum(((F.col("_end") > c).cast("int") for c in cuts), F.lit(0))
    numbered = lined.withColumn("shard", number)
    firsts = {r["shard"]: r["first"] for r in numbered.groupBy("shard").agg(F.min("_at").alias("first")).collect()}
    first = F.coalesce(*(F.when(F.col("shard") == s, F.lit(at).cast("long")) for s, at in firsts.items()), F.lit(0).cast("long"))
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_at") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_sharding")
def op5_sharding(spark, folder):
    return shard(table(spark, folder, "documents").select("doc_id", "text"))
