"""Ranked lexical search: Block-Max MaxScore over an inverted index in shards, whose heaps are merged.

``build`` indexes every document: each scan task writes shards of bounded size, with no shuffle. Within a shard documents
are numbered by length, shortest first, and a term's list is cut into blocks of packed gaps and frequencies. The head
of a block names its largest frequency and smallest length, from which its maximum follows once the collection is known.

``search`` keeps the ten best scores of each item per shard. Lists whose maxima together cannot reach the tenth score
are non-essential: documents come from the others only, and the block maxima of the non-essential lists decide which of them
are looked up at all. Blocks in which nothing is left to look up are never unpacked.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.cluster import cut, spread
from boxloom.llm.catalog import query, table
from boxloom.llm.words import LOWER, UPPER, lower_ascii, split_words

BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOWN = str.maketrans(UPPER, LOWER)
TOP = 10
#: a shard is closed at so many documents or postings
SHARD_DOCS, SHARD_POSTINGS = 65_536, 2_000_000
BLOCK = 128
#: terms of the items that are searched at once; more items go in further batches
BATCH_TERMS = 100_000
FIRST_WINDOW = 512

HEAD = np.dtype([("last", "<u4"), ("top_tf", "<u4"), ("length", "<u4"), ("at", "<u4"), ("gap_bytes", "u1"), ("tf_bytes", "u1")])
#: the row of a shard whose term is empty holds its documents: ids, and lengths in ``data``
INDEX = "shard string, term string, posts long, words long, heads binary, data binary, ids array<{}>"


def _terms(text: str) -> list[str]:
    return TERM.findall(text.lower() if text.isascii() else text.translate(DOWN))


def _binaries(offsets: np.ndarray, body: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])


def _spread_bytes(out: np.ndarray, at: np.ndarray, value: np.ndarray, width: np.ndarray) -> None:
    """Write each value at its place, in as many bytes as its block takes (1, 2 or 4)."""
    for k in range(4):
        wide = width > k
        out[at[wide] + k] = value[wide] >> (8 * k) & 255


class _Shard:
    """The documents of one shard while they are read."""

    def __init__(self):
        self.ids, self.lengths = [], array("q")
        self.vocabulary: defaultdict = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.docs, self.terms, self.tfs = array("i"), array("i"), array("i")

    def add(self, doc_id, text: str) -> None:
        words = _terms(text)
        if not words:
            return
        counts = Counter(words)
        self.docs.extend([len(self.ids)] * len(counts))
        self.terms.extend(map(self.vocabulary.__getitem__, counts))
        self.tfs.extend(counts.values())
        self.ids.append(doc_id)
        self.lengths.append(len(words))

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or len(self.docs) >= SHARD_POSTINGS

    def rows(self, name: str, id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
        lengths = np.frombuffer(self.lengths, np.int64)
        order = np.argsort(lengths, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        lengths = lengths[order]
        ids = pa.array([self.ids[i] for i in order], id_type)
        schema = pa.schema([("shard", pa.string()), ("term", pa.string()), ("posts", pa.int64()), ("words", pa.int64()), ("heads", pa.binary()),
                            ("data", pa.binary()), ("ids", pa.list_(id_type))])
        yield pa.RecordBatch.from_arrays([
            pa.array([name]), pa.array([""]), pa.array([len(order)]), pa.array([int(lengths.sum())]), pa.array([None], pa.binary()),
            pa.array([lengths.astype("<u4").tobytes()]), pa.ListArray.from_arrays(pa.array([0, len(order)], pa.int32()), ids)], schema=schema)

        term, tf = np.frombuffer(self.terms, np.int32).astype(np.int64), np.frombuffer(self.tfs, np.int32)
        key = term << 32 | place[np.frombuffer(self.docs, np.int32)]
        by = np.argsort(key)
        term, ordinal, tf = key[by] >> 32, key[by] & 0xFFFFFFFF, tf[by].astype(np.int64)
        n = len(term)
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        posts = np.diff(np.r_[starts, n])
        within = np.arange(n) - np.repeat(starts, posts)
        heads_at = np.flatnonzero(within % BLOCK == 0)  # first posting of each block
        sizes = np.diff(np.r_[heads_at, n])
        gap = np.where(within == 0, ordinal, ordinal - np.r_[0, ordinal[:-1]])
        width = []
        for values in (gap, tf):
            most = np.maximum.reduceat(values, heads_at)
            width.append(np.where(most < 256, 1, np.where(most < 65536, 2, 4)))
        bytes_of = sizes * (width[0] + width[1])
        ends = np.cumsum(bytes_of)
        at = ends - bytes_of
        body = np.zeros(int(ends[-1]), np.uint8)
        block = np.repeat(np.arange(len(heads_at)), sizes)
        inside = np.arange(n) - heads_at[block]
        _spread_bytes(body, at[block] + inside * width[0][block], gap, width[0][block])
        _spread_bytes(body, at[block] + sizes[block] * width[0][block] + inside * width[1][block], tf, width[1][block])
        first_block = np.searchsorted(heads_at, starts)
        blocks = np.diff(np.r_[first_block, len(heads_at)])
        heads = np.zeros(len(heads_at), HEAD)
        heads["last"], heads["top_tf"] = ordinal[heads_at + sizes - 1], np.maximum.reduceat(tf, heads_at)
        heads["length"] = lengths[ordinal[heads_at]]  # the shortest comes first
        heads["at"] = at - np.repeat(at[first_block], blocks)
        heads["gap_bytes"], heads["tf_bytes"] = width
        names = np.array(list(self.vocabulary), object)[term[starts]]
        total = np.add.reduceat(tf, starts)
        for lo in range(0, len(starts), 8192):
            hi = min(lo + 8192, len(starts))
            cuts = np.r_[first_block[lo:hi], len(heads_at) if hi == len(starts) else first_block[hi]]
            data_at = np.r_[at[first_block[lo:hi]], ends[-1] if hi == len(starts) else at[first_block[hi]]]
            yield pa.RecordBatch.from_arrays([
                pa.array([name] * (hi - lo)), pa.array(names[lo:hi], pa.string()), pa.array(posts[lo:hi]), pa.array(total[lo:hi]),
                _binaries((cuts - cuts[0]) * HEAD.itemsize, heads[cuts[0]:cuts[-1]].view(np.uint8)),
                _binaries(data_at - data_at[0], body[data_at[0]:data_at[-1]]), pa.nulls(hi - lo, pa.list_(id_type))], schema=schema)


def build(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all documents that hold a term, written to the shared folder: a row for each shard and term.

    Each row of ``docs`` is a document of its own, also with a null or repeated id.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def indexed(batches):
        where, shard, made, id_type = TaskContext.get().partitionId(), _Shard(), 0, None
        for b in batches:
            id_type = b.schema.field(0).type
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                shard.add(doc_id, text.as_py() or "")
                if shard.full():
                    yield from shard.rows(f"{where}-{made}", id_type)
                    shard, made = _Shard(), made + 1
        if shard.ids:
            yield from shard.rows(f"{where}-{made}", id_type)

    return cut(spread(docs.select(id_col, text_col)).mapInArrow(indexed, INDEX.format(kind)))


class _List:
    """A term's list in one shard: block maxima, and the blocks that had to be unpacked."""

    def __init__(self, heads: bytes, data: bytes, posts: int, weight: int, lengths: np.ndarray, damping: np.ndarray):
        self.heads, self.data, self.posts, self.weight = np.frombuffer(heads, HEAD), data, posts, weight
        self.lengths, self.damping = lengths, damping
        first = np.searchsorted(lengths, self.heads["length"])  # any document of that length
        self.most = weight * _impact(self.heads["top_tf"].astype(np.int64), damping[first])
        self.last = self.heads["last"].astype(np.int64)
        self.bound = int(self.most.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, weighted impacts) of one block."""
        if b not in self.unpacked:
            head, size = self.heads[b], min(BLOCK, self.posts - b * BLOCK)
            at, gap_bytes = int(head["at"]), int(head["gap_bytes"])
            gaps = np.frombuffer(self.data, f"<u{gap_bytes}", size, at).astype(np.int64)
            tf = np.frombuffer(self.data, f"<u{int(head['tf_bytes'])}", size, at + size * gap_bytes).astype(np.int64)
            docs = np.cumsum(gaps) + (self.last[b - 1] if b else 0)
            self.unpacked[b] = docs, self.weight * _impact(tf, self.damping[docs])
        return self.unpacked[b]

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """All of the list in documents lo..hi-1."""
        first, end = np.searchsorted(self.last, lo), np.searchsorted(self.last, hi)
        parts = [self.block(b) for b in range(first, min(end + 1, len(self.last)))]
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        docs, impacts = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
        a, z = np.searchsorted(docs, (lo, hi))
        return docs[a:z], impacts[a:z]


def _impact(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 8 * damping)


def _best(lists: list[tuple[_List, int]], n_docs: int, rank: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of one item in one shard; ``rank`` orders documents with equal scores."""
    lists = sorted(lists, key=lambda x: x[0].bound * x[1])
    bounds = np.array([x.bound * q for x, q in lists], np.int64)
    upto = np.r_[0, np.cumsum(bounds)]  # upto[i]: what the i weakest lists can give
    docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    lo, width = 0, FIRST_WINDOW
    while lo < n_docs:
        hi = min(lo + width, n_docs)
        weak = int(np.searchsorted(upto, least, side="left")) - 1  # the first so many lists are non-essential
        if weak == len(lists):
            break
        sums = np.zeros(hi - lo, np.int64)
        for x, q in lists[weak:]:
            d, s = x.between(lo, hi)
            sums[d - lo] += q * s
        found = np.flatnonzero(sums)
        found = found[sums[found] + upto[weak] >= least]
        part, at = sums[found], found + lo
        for i in range(weak - 1, -1, -1):
            if not len(at):
                break
            x, q = lists[i]
            block = np.searchsorted(x.last, at)
            inside = block < len(x.last)
            most = np.where(inside, q * x.most[np.minimum(block, len(x.last) - 1)], 0)
            stay = part + most + upto[i] >= least  # the block maximum decides before the block is unpacked
            at, part, block, inside = at[stay], part[stay], block[stay], inside[stay]
            for b in np.unique(block[inside]):
                mine = np.flatnonzero(block == b)
                d, s = x.block(int(b))
                spot = np.minimum(np.searchsorted(d, at[mine]), len(d) - 1)
                same = d[spot] == at[mine]
                part[mine[same]] += q * s[spot[same]]
            stay = part + upto[i] >= least
            at, part = at[stay], part[stay]
        if len(at):
            docs, scores = np.r_[docs, at], np.r_[scores, part]
            keep = np.lexsort((rank[docs], -scores))[:top]
            docs, scores = docs[keep], scores[keep]
            least = max(least, int(scores[-1])) if len(docs) == top else least
        lo, width = hi, width * 2
    return docs, scores


def _search_shard(rows: list[tuple], items: dict[int, list[tuple[str, int]]], weights: dict[str, int], n: int, words: int, top: int):
    """(item number, document id, score) rows of one shard."""
    (_, _, _, lengths, ids), rest = rows[0], rows[1:]
    lengths = np.frombuffer(lengths, "<u4").astype(np.int64)
    there, back = np.unique(lengths, return_inverse=True)
    damping = np.array([25 + 75 * int(x) * n // words for x in there], np.int64)[back]  # in whole numbers of any size
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0, i))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    lists = {term: _List(heads, data, posts, weights[term], lengths, damping) for term, posts, heads, data, _ in rest if weights.get(term)}
    out = []
    for item, terms in items.items():
        mine = [(lists[t], q) for t, q in terms if t in lists]
        if mine:
            docs, scores = _best(mine, len(ids), rank, top)
            out += [(item, ids[d], int(s)) for d, s in zip(docs, scores)]
    return out


def search(index: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text", top: int = TOP,
           batch_terms: int = BATCH_TERMS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of each row of ``items`` with a score above 0.

    Equal scores go by document id, null last. Items go through the index in batches with a bounded number of terms.
    """
    doc_kind = index.schema["ids"].dataType.elementType.simpleString()
    numbered = cut(items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).withColumn("item", F.monotonically_increasing_id()))
    wanted = cut(numbered.select("item", F.explode(split_words(lower_ascii(F.col("text")), BETWEEN)).alias("term"))
                 .groupBy("item", "term").agg(F.count(F.lit(1)).alias("times")))
    n, words = index.where("term = ''").agg(F.coalesce(F.sum("posts"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    found = None
    batches = -(-wanted.count() // batch_terms) if n else 0
    for batch in range(batches):
        part = wanted.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == batch)
        asked: dict[int, list] = defaultdict(list)
        for r in part.collect():
            asked[r["item"]].append((r["term"], r["times"]))
        # the terms of one batch: bounded, so every task can hold them
        terms = F.broadcast(part.select("term").distinct())
        df = index.where("term <> ''").select("term", "posts").join(terms, "term").groupBy("term").agg(F.sum("posts").alias("df"))
        weight = F.floor(1000 * F.log((2 * F.lit(float(n)) + 2) / (2 * F.col("df") + 1))).cast("long")
        weights = {r["term"]: r["w"] for r in df.select("term", weight.alias("w")).collect()}
        lists = index.join(terms, "term", "left_semi").unionByName(index.where("term = ''"))
        one = lists.repartition("shard").sortWithinPartitions("shard", "term").select("shard", "term", "posts", "heads", "data", "ids")
        hits = one.mapInPandas(_searched(dict(asked), weights, n, words, top), f"item long, doc_id {doc_kind}, score long")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = index.select(F.lit(0).cast("long").alias("item"), F.col("ids")[0].alias("doc_id"), F.col("posts").alias("score")).limit(0)
    rank = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = found.withColumn("rank", rank).where(F.col("rank") <= top)  # cut to the best in every task before the heaps meet
    return numbered.select("item", "item_id").join(best, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _searched(items: dict, weights: dict, n: int, words: int, top: int):
    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        open_shard, rows = None, []

        def closed() -> pd.DataFrame:
            return pd.DataFrame(_search_shard(rows, items, weights, n, words, top) if rows else [], columns=["item", "doc_id", "score"], dtype=object)

        for frame in frames:
            for shard, *row in frame.itertuples(index=False, name=None):
                if shard != open_shard:
                    yield closed()
                    open_shard, rows = shard, []
                rows.append(tuple(row))
        yield closed()

    return made


def rank_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the best documents (doc_id, text) for each item (item_id, text).

    A null or empty text has no terms: such documents count nowhere, such items find nothing. Repeated rows are documents
    or items of their own. Without documents or items there are no rows; further columns do not matter.
    """
    return search(build(docs), items, top=top)


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents),
bw AS (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
lens AS (SELECT doc_id, count(*)::BIGINT AS n FROM dw GROUP BY 1),
g AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM lens),
tfs AS (SELECT doc_id, t, count(*)::BIGINT AS tf FROM dw WHERE t IN (SELECT t FROM bw) GROUP BY 1, 2),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT t, count(*)::BIGINT AS df FROM tfs GROUP BY 1), g),
q AS (SELECT item_id, t, count(*)::BIGINT AS q FROM bw GROUP BY 1, 2),
scored AS (
  SELECT item_id, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN tfs USING (t) JOIN lens USING (doc_id), g GROUP BY 1, 2)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""


@query("op12_lexical", ORACLE)
def op12_lexical(spark, folder):
    return rank_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
