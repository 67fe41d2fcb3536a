"""LM scoring with a causal self-attention model over subword ids.

The probability of a word is that of its class in context, from the attention model, times that of the word within its
class, from counts over all training documents. A class is a set of first subword ids, dealt by frequency; the model
reads the first and last subword id of the words before. So what the corpus teaches about words has no bound (the count
table grows with the corpus), while the trained part stays small and every token costs the same.

1. Words are counted over all training documents; each different word is split into subwords once.
2. One pass reads every text into a written table: the subword ids of its words, and the word terms of frequent words
   from a broadcast table. A word is frequent if it makes up more than one token in FREQUENT, so that table has at most
   FREQUENT rows whatever the corpus. The remaining words meet their counts in a join, in which no key can be hot.
3. The model starts as the unigram model over classes and is trained by local passes of Adam over the ids of all training
   documents, in parallel. They are dealt over the rounds by hash; weights are averaged in two steps after each round.
4. One pass over the ids of every document gives the class terms.
"""

from __future__ import annotations

import functools
import itertools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm import attention
from boxloom.llm.catalog import query, table
from boxloom.llm.words import text_of

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
CLASSES, FREQUENT = 32, 100_000
ROUNDS, RATE = 2, 0.004
#: training documents are dealt by hash into so many shares, one for each round, so that each of them teaches once
SHARE = ROUNDS
MERGERS = 32
#: words whose subwords a Python worker remembers; those that come later are encoded each time
REMEMBERED = 400_000
#: how a text is split before byte pairs are merged: a word is one piece here
WHOLE = r"[^\r\n]+|[\r\n]"


class Subwords(dict):
    """First subword id * 65536 + last one, by word in UTF-8. A word is encoded with the space before it when first asked for."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        super().__init__()
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.coder = tiktoken.Encoding(os.path.basename(path), pat_str=WHOLE, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: bytes) -> int:
        ids = self.coder._encode_single_piece(b" " + word)
        code = (ids[0] << 16) + ids[-1]
        if len(self) < REMEMBERED:
            self[word] = code
        return code

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Words that are not remembered are encoded in one call, a line each."""
        out = np.fromiter(map(self.get, words, itertools.repeat(-1)), np.int64, len(words))
        at = np.flatnonzero(out < 0)
        if len(at):
            new = [words[i] for i in at]
            ids = np.array(self.coder.encode_ordinary("\n" + (b" " + b"\n ".join(new)).decode() + "\n"), np.int64)
            ends = np.flatnonzero(ids == ids[0])  # no word holds an end of line
            out[at] = (ids[ends[:-1] + 1] << 16) + ids[ends[1:] - 1]
            self.update(itertools.islice(zip(new, out[at].tolist(), strict=True), max(0, REMEMBERED - len(self))))
        return out


@functools.cache
def subwords(path: str) -> Subwords:
    """One for each Python worker, which outlives its tasks: it is read once, and words stay encoded."""
    return Subwords(path)


def lowered(column: pa.Array) -> pa.Array:
    """A-Z only. Spark's translate(), which other letters call for, looks every character up and takes longer than all else here."""
    return pc.ascii_lower(column.cast(pa.string()))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training rows of (held_out, text), A-Z lower-cased; ends are not words."""

    def made(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                # its blanks are those of split() in texts(); at the ends of a text they leave an empty word
                words = pc.ascii_split_whitespace(lowered(b.column(0).slice(at, 2048))).flatten()
                found = words.filter(pc.not_equal(words, "")).value_counts()
                yield pa.RecordBatch.from_arrays(found.flatten(), ["word", "n"])

    partly = docs.where(~F.col("held_out")).select("text").mapInArrow(made, "word string, n long")
    return partly.groupBy("word").agg(F.sum("n").alias("n"))


def by_first_subword(counts: DataFrame, path: str) -> list:
    """(first subword id, words, tokens) over the vocabulary; at most one row for each id."""

    def made(batches):
        coder = subwords(path)
        for b in batches:
            first = coder.codes(b.column(0).cast(pa.binary()).to_pylist()) >> 16
            yield pa.RecordBatch.from_arrays([pa.array(first), b.column(1)], ["id", "n"])

    return (
        counts.select("word", "n").mapInArrow(made, "id long, n long")
        .groupBy("id").agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("tokens")).orderBy("id").collect()
    )


def classes_of(found: list, classes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class of each subword id, words in a class, tokens in a class); classes have about equal sums of root counts."""
    of, words, tokens = np.zeros(65536, np.int32), np.zeros(classes, np.int64), np.zeros(classes, np.int64)
    of[:] = np.arange(65536) % classes  # ids that no training word begins with
    listed = sorted(found, key=lambda r: (-r["tokens"], r["id"]))
    total, so_far = sum(r["tokens"] ** 0.5 for r in listed), 0.0
    for r in listed:
        k = min(classes - 1, int(classes * so_far / total))
        so_far += r["tokens"] ** 0.5
        of[r["id"]] = k
        words[k] += r["words"]
        tokens[k] += r["tokens"]
    return of, words, tokens


def texts(batch, column: int, size: int = 256):
    """Slices of a batch with the words of their texts, in UTF-8: (slice, all words, number of words of each text)."""
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        # without an argument, split() on bytes takes the six blanks for ends of words and nothing else
        lists = [t.split() for t in part.column(column).cast(pa.binary()).to_pylist()]
        yield part, list(itertools.chain.from_iterable(lists)), np.fromiter(map(len, lists), np.int64, len(lists))


def once_each(words: list[bytes]) -> tuple[list[bytes], np.ndarray, pa.Array]:
    """The different words, the place of each word among them, and the different words as a column."""
    d = pa.array(words, pa.binary()).dictionary_encode()
    # to_pylist() takes ten times as long: it makes a scalar of each
    return d.dictionary.to_numpy(zero_copy_only=False).tolist(), d.indices.to_numpy(), d.dictionary


def encoded(docs: DataFrame, path: str, known: dict[bytes, int], base_of: float, n_docs: int) -> DataFrame:
    """``docs`` of (doc_id, held_out, text) with ids in place of texts, A-Z lower-cased, and the word terms of words in ``known``.

    ``codes`` has first subword id * 65536 + last one of each word, as 32 bits. ``sure`` sums the base terms of known words
    and of the end, ``known`` counts these; ``rare`` has all other words. ``hash`` is the ``row_hash`` of id and lower-cased text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(known)
    log_base, end_log = np.log10(base_of), np.log10((n_docs + 1) / base_of)
    columns = "_row long, doc_id long, held_out boolean, hash long, n_tokens long, known long, sure double, rare array<string>, codes array<int>"

    def made(batches):
        table_of, coder = sent.value, subwords(path)
        for b in batches:
            for part, words, lengths in texts(b.set_column(4, "text", lowered(b.column(4))), 4, 1024):
                seeds, raw = part.column(3).to_numpy().view(np.uint64).tolist(), part.column(4).cast(pa.binary()).to_pylist()
                hashes = np.fromiter(map(xxhash.xxh64_intdigest, raw, seeds), np.uint64, len(raw)).view(np.int64)
                few, at, column = once_each(words)
                n = np.fromiter(map(table_of.get, few, itertools.repeat(0)), np.int64, len(few))
                term = np.where(n > 0, np.log10(n + 1.0) - log_base, 0)
                codes = coder.codes(few).astype(np.uint32).view(np.int32)
                is_rare, of_word = (n == 0)[at], np.repeat(np.arange(len(lengths)), lengths)
                rare = np.bincount(of_word[is_rare], minlength=len(lengths))
                listed = lambda counts, values: pa.ListArray.from_arrays(
                    pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), values)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:3], pa.array(hashes), pa.array(lengths + 1), pa.array(lengths - rare + (n_docs > 0)),
                    pa.array(np.bincount(of_word, term[at], len(lengths)) + end_log),
                    listed(rare, column.take(pa.array(at[is_rare])).cast(pa.string())), listed(lengths, pa.array(codes[at])),
                ], [x.split()[0] for x in columns.split(", ")])

    # xxhash64 of several columns: the hash of each is the seed of the next
    numbered = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "held_out", F.xxhash64("doc_id"), "text")
    return cut(numbered.mapInArrow(made, columns))


def coded(batch, column: int, size: int = 256):
    """Slices of a batch with the codes of their texts: (slice, codes of all words, number of words of each text)."""
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        lists = part.column(column)
        codes = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint32).astype(np.int64)
        yield part, codes, np.diff(lists.offsets.to_numpy()).astype(np.int64)


def taught(learning: DataFrame, r: int, share: int, hashed: str | None = None) -> DataFrame:
    """The rows that teach in round ``r``; over ``share`` rounds they are all rows. ``hashed`` names a column with ``row_hash``."""
    return learning.where(F.pmod(F.col(hashed) if hashed else row_hash(), F.lit(share)) == r % share)


def row_hash():
    # by id and text: a group of equal texts that all fell on one share would outweigh the rest of it
    return F.xxhash64("doc_id", "text")


def trained(docs: DataFrame, start: dict, of: np.ndarray, rounds: int, share: int) -> dict:
    """Weights after so many rounds of local training on a share of the training rows and averaging; none for 0 rounds.

    ``docs`` are those of ``encoded``.
    """
    if 0 < rounds < share:
        raise ValueError(f"{rounds} rounds leave some of {share} shares untaught")
    p, end = start, len(start["bias"]) - 1
    learning = docs.where(~F.col("held_out"))
    for r in range(rounds):
        flat = attention.packed(p)

        def learn(batches, flat=flat):
            own, seen = attention.unpacked(flat, start), 0
            for b in batches:
                for _, codes, lengths in coded(b, 0):
                    attention.train(own, attention.laid_out(codes, lengths, of, end), RATE)
                    seen += len(codes) + len(lengths)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([(attention.packed(own) * np.float64(seen)).tolist()], pa.list_(pa.float64()))],
                    ["seen", "w"],
                )

        def add(batches):
            seen, total = 0, None
            for b in batches:
                for n, w in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    w = w.values.to_numpy(zero_copy_only=False)
                    seen, total = seen + n, w if total is None else total + w
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["seen", "w"]
                )

        picked = taught(learning, r, share, "hash").select("codes")
        sums = cut(picked.mapInArrow(learn, "seen long, w array<double>"))
        merged = sums.repartition(MERGERS, F.col("seen")).sortWithinPartitions("seen").mapInArrow(add, "seen long, w array<double>")
        rows = sorted(merged.collect(), key=lambda x: (x["seen"], x["w"][0]))  # MERGERS at most
        if rows:
            p = attention.unpacked(sum(np.array(x["w"]) for x in rows) / sum(x["seen"] for x in rows), start)
    return p


def score(docs: DataFrame, path: str = TOKENIZER, classes: int = CLASSES, frequent: int = FREQUENT,
          rounds: int = ROUNDS, share: int = SHARE) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``, one row for each row of ``docs``.

    Null and empty texts are one token, the end. A null id is held in (its text is empty). With no training rows all
    counts are 0 and every token has base probability 1. Words never seen have the base share of a word seen never.
    Equal texts have equal scores.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7 == 2).alias("held_out"),
        text_of(F.col("text")).alias("text"),
    )
    counts = cut(word_counts(docs))
    n_docs = docs.where(~F.col("held_out")).count()
    n_words, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_all = n_words + n_docs
    base_of = float(n_all + vocabulary + bool(n_docs) + 1)
    of, words_in, tokens_in = classes_of(by_first_subword(counts, path), classes)
    # counts of a class with the share of a word never seen; the end is a class of its own
    mass = np.r_[tokens_in + words_in + 1, n_docs + 1].astype(float)
    start = attention.fresh(classes + 1, np.log(mass / mass.sum()))
    gain_of = -np.log10(mass / base_of)
    often = counts.where(F.col("n") * frequent > n_all)
    known = {r["word"].encode(): r["n"] for r in often.collect()}  # fewer than ``frequent`` rows
    rows = encoded(docs, path, known, base_of, n_docs)
    weights = attention.packed(trained(rows, start, of, rounds, share))
    columns = "_row long, doc_id long, held_out boolean, n_tokens long, known long, sure double, gain double"

    def made(batches):
        own = attention.unpacked(weights, start)
        for b in batches:
            for part, codes, lengths in coded(b, 6):
                logs, outputs = attention.position_scores(own, attention.laid_out(codes, lengths, of, classes))
                text = np.repeat(np.arange(len(lengths)), lengths + 1)
                gain = np.bincount(text, logs.astype(float) / np.log(10) + gain_of[outputs], len(lengths))
                yield pa.RecordBatch.from_arrays([*part.columns[:6], pa.array(gain)], [x.split()[0] for x in columns.split(", ")])

    scored = rows.select("_row", "doc_id", "held_out", "n_tokens", "known", "sure", "codes").mapInArrow(made, columns)
    seldom = counts.where(F.col("n") * frequent <= n_all)
    found = (
        rows.select("_row", F.explode("rare").alias("word")).join(seldom.hint("shuffle_hash"), "word", "left")
        .groupBy("_row").agg(
            F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(base_of))).alias("_log"), F.count("n").alias("_known"),
        )
    )
    base = F.col("sure") + F.coalesce("_log", F.lit(0.0))
    return scored.join(found, "_row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"),
    )


@query("op10_attention")
def op10_attention(spark, folder):
    return score(table(spark, folder, "documents").select("doc_id", "text"))
