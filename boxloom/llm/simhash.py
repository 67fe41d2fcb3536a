"""SimHash near-duplicates by pivot distance tables.

Hamming distance obeys the triangle inequality: two fingerprints within 4 bits differ by at most 4 in their distance to
any reference fingerprint, so a pair whose tables differ by more in one coordinate needs no comparison. On 64 bits that
test alone keeps 4 pairs in 7 for each coordinate, too many to start from. The references used to find pairs are
therefore confined to blocks of the bits: of six blocks, a pair within 4 bits has two without any difference, where
the largest allowed coordinate difference is 0. Equal coordinates can be grouped by, which gives 15 groupings that
together miss no pair. Inside a group, pairs are discarded by the largest coordinate difference of the full-width
table, and survivors are verified on the bits.

Equal fingerprints collapse first. A group that is too large for one task is cut into blocks, and every pair of blocks
meets in its own cell. A cell returns a spanning forest of its links, never all its pairs: what is already reached is
not compared again. Components of the forest edges are found in rounds of joins.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table
from boxloom.llm.words import lower_ascii, runs, split_words
from boxloom.operators.graphs import components

WIDTH, RADIUS = 4, 4
#: more blocks than RADIUS + 1 leave two or more without a difference
BLOCKS = 6
BLOCK_PIVOTS, PIVOTS = 12, 24
#: fingerprints of one group that one task compares at most, twice
CELL = 2048
#: groups up to this size are compared by offsets over the whole batch
SMALL = 8


def references(n: int) -> list[int]:
    """``n`` fixed, well spread 64-bit patterns (the splitmix sequence)."""
    out, state = [], 0
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & (2**64 - 1)
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & (2**64 - 1)
        out.append(z ^ (z >> 31))
    return out


def signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def majority(hashes: np.ndarray, lengths: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """One fingerprint for each run of ``lengths`` hashes: bits set in over half of them; none gives zero."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    out = np.zeros(len(lengths), np.uint64)
    first = 0
    while first < len(lengths):  # as many texts at once as fit into a chunk, one text at least
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + chunk, "right")) - 1)
        some = np.flatnonzero(lengths[first:last]) + first
        if some.size == 1:
            i, ones = some[0], np.zeros((1, 64), np.int64)
            for at in range(ends[i], ends[i + 1], chunk):
                ones[0] += _bits(hashes[at : min(at + chunk, ends[i + 1])]).sum(axis=0, dtype=np.int64)
        elif some.size:
            ones = np.add.reduceat(_bits(hashes[ends[first] : ends[last]]), ends[some] - ends[first], axis=0, dtype=np.int64)
        if some.size:
            bits = (2 * ones > lengths[some][:, None]).astype(np.uint8)
            out[some] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
        first = last
    return out


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) for each row: the 64-bit SimHash of the text's four-word shingles. No shuffle."""
    worded = docs.select(F.col("doc_id").cast("long").alias("doc_id"), split_words(lower_ascii(F.col("text"))).alias("_w"))
    whole = F.when(F.size("_w") > 0, F.array(F.xxhash64(F.concat_ws(" ", "_w")))).otherwise(F.array().cast("array<bigint>"))
    hashed = worded.select("doc_id", F.when(
        F.size("_w") >= WIDTH, runs(F.col("_w"), WIDTH, lambda w: F.xxhash64(F.concat_ws(" ", *w)))
    ).otherwise(whole).alias("_h"))

    def made(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                lists = part.column(1)
                hashes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                fp = majority(hashes, np.diff(lists.offsets.to_numpy()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return hashed.mapInArrow(made, "doc_id long, fp long")


def block_masks(blocks: int = BLOCKS) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]


def meeting_keys(fps: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(key, fp, node): for every choice of blocks that a pair may agree in, the coordinates there as one number."""
    pivots = references(blocks * BLOCK_PIVOTS)
    packed = fps
    for i, mask in enumerate(block_masks(blocks)):
        coordinates = [
            F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(p))).bitwiseAND(F.lit(signed(mask)))).cast("long")
            for p in pivots[i * BLOCK_PIVOTS : (i + 1) * BLOCK_PIVOTS]
        ]
        value = coordinates[0]
        for c in coordinates[1:]:
            value = F.shiftleft(value, 4).bitwiseOR(c)
        packed = packed.withColumn(f"_b{i}", value)
    keys = [F.xxhash64(F.lit(n), *(f"_b{i}" for i in chosen))
            for n, chosen in enumerate(combinations(range(blocks), blocks - RADIUS))]
    return packed.select(F.explode_outer(F.array(*keys)).alias("key"), "fp", "node")


def linked(fp: np.ndarray, node: np.ndarray, run: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (a, b) between nodes of equal ``run`` (ascending): all in small runs, a spanning forest in larger ones."""
    a, b = [], []
    tables = np.bitwise_count(fp[:, None] ^ pivots[None, :]).astype(np.int8)
    starts = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    sizes = np.diff(np.r_[starts, len(run)])
    of = np.repeat(sizes, sizes)
    for lag in range(1, min(SMALL, len(run))):
        i = np.flatnonzero((run[lag:] == run[:-lag]) & (of[lag:] <= SMALL))
        i = i[np.abs(tables[i] - tables[i + lag]).max(axis=1) <= RADIUS] if i.size else i
        i = i[np.bitwise_count(fp[i] ^ fp[i + lag]) <= RADIUS]
        a.append(node[i])
        b.append(node[i + lag])
    for s, n in zip(starts[sizes > SMALL], sizes[sizes > SMALL], strict=True):
        left = np.arange(s, s + n)
        while left.size > 1:
            reached, left = [left[0]], left[1:]
            while reached and left.size:
                x = reached.pop()
                near = np.abs(tables[left] - tables[x]).max(axis=1) <= RADIUS
                near[near] = np.bitwise_count(fp[left[near]] ^ fp[x]) <= RADIUS
                if near.any():
                    a.append(np.full(int(near.sum()), node[x]))
                    b.append(node[left[near]])
                    reached.extend(left[near])
                    left = left[~near]
    return (np.concatenate(a), np.concatenate(b)) if a else (node[:0], node[:0])


def links(fps: DataFrame, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """(a, b) nodes whose distinct fingerprints (fp, node) are within RADIUS, enough of them for the components."""
    keyed = cut(meeting_keys(fps, blocks))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    parts = F.ceil(F.col("_n") / cell).cast("int")
    mine = F.pmod(F.xxhash64("fp", "key"), F.col("_parts")).cast("int")
    met = (
        keyed.join(sizes, "key").withColumn("_parts", parts).withColumn("_mine", mine)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(F.xxhash64("key", F.least("_mine", "_other"), F.greatest("_mine", "_other")).alias("cell"), "fp", "node")
        .repartition("cell").sortWithinPartitions("cell")
    )
    pivots = np.array(references(BLOCKS * BLOCK_PIVOTS + PIVOTS)[-PIVOTS:], np.uint64)

    def made(batches):
        kept = None
        for b in batches:
            t = pa.Table.from_batches([b]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([b])])
            run = t.column("cell").to_numpy()
            last = int(np.searchsorted(run, run[-1])) if len(run) else 0  # the last run may go on in the next batch
            yield from found(t.slice(0, last))
            kept = t.slice(last).combine_chunks()
        if kept is not None:
            yield from found(kept)

    def found(t):
        if t.num_rows > 1:
            fp = t.column("fp").to_numpy().view(np.uint64)
            a, b = linked(fp, t.column("node").to_numpy(), t.column("cell").to_numpy(), pivots)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return met.mapInArrow(made, "a long, b long")


def near_duplicates(docs: DataFrame, blocks: int = BLOCKS, cell: int = CELL) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row for each row of ``docs``.

    Texts without words have fingerprint zero and are linked like any other. Rows with a null id get the component of
    their fingerprint, or null if no row with an id has it; they link nothing. Repeated ids count with each of their
    fingerprints.
    """
    marked = cut(fingerprints(docs))
    distinct = cut(marked.where(F.col("doc_id").isNotNull()).groupBy("fp").agg(F.min("doc_id").alias("node")))
    # one node may stand for several fingerprints when ids repeat; that joins them, as the same document holds both
    roots = components(links(distinct, blocks, cell))
    of = distinct.join(roots, "node", "left").select("fp", F.coalesce("root", "node").alias("component_id"))
    return marked.join(of, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op1_simhash")
def op1_simhash(spark, folder):
    return near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
