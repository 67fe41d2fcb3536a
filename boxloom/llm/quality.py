"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Every document's words and word pairs are hashed into a fixed number of buckets. The buckets are counted once over
all documents (the raw multinomial) and over documents known to be good (the target). A document's score is the mean
log ratio of its buckets, so its length does not matter. Ratios are whole millionths: sums do not depend on the
order in which they are added, and a document gets the same verdict on every run.

Only the bucket counts leave the scan: their number is a parameter, not a matter of the data, which is why they may
pass through the driver and into the scoring expression. Scoring is a projection without a shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.catalog import query, table
from boxloom.llm.words import BLANKS, columns_apart, split_words, text_of

BUCKETS = 8192
#: most labelled rows the target is fitted on; beyond it a share of them, chosen by the hash of the id
TARGET_ROWS = 200_000
#: added to each bucket's count
PRIOR = 1.0
#: documents below this mean log ratio (millionths of a nat for each n-gram) are rejected
LEAST = -60_000
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


def grams(words: Column, buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    bucket = lambda *w: F.pmod(F.xxhash64(*w), F.lit(buckets)).cast("int")
    pairs = F.transform(words, lambda w, i: bucket(w, F.get(words, i + 1)))
    return F.concat(F.transform(words, lambda w: bucket(w)), F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Adds the number of words that lie in a window of three words found twice or more in the array column.

    Windows are compared by a 64-bit hash. Only texts with a repeated window sort theirs. Each step is a column of its
    own: what a lambda refers to would else be computed again for every element.
    """
    windows, placed, starts = columns_apart(df, "_windows", "_placed", "_starts")
    hashes = F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))
    same = lambda x, k: F.coalesce(F.get(placed, k)["h"] == x["h"], F.lit(False))
    return (
        df.withColumn(windows, F.slice(hashes, 1, F.greatest(F.size(words) - 2, F.lit(0))))
        .withColumn(placed, F.when(
            F.size(F.array_distinct(windows)) < F.size(windows),
            F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ))
        .withColumn(starts, F.sort_array(F.filter(
            F.transform(placed, lambda x, k: F.when(same(x, k - 1) | same(x, k + 1), x["i"])), lambda i: i.isNotNull()
        )))
        # a window covers three words, or as many as are left before the next one begins
        .withColumn(out, F.coalesce(F.aggregate(
            starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
            lambda a, s: F.struct((a["n"] + F.least(F.lit(3), s - a["last"])).alias("n"), s.alias("last")),
            lambda a: a["n"],
        ), F.lit(0).cast("long")))
        .drop(windows, placed, starts)
    )


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, rows: int = TARGET_ROWS) -> DataFrame:
    """(bucket, raw, target): n-grams of all documents, and of those whose id is in ``trusted``.

    The ids are thinned by their hash to about ``rows``, so that the set that is broadcast has a bound. Repeated and
    null ids count once and never.
    """
    ids = trusted.select(F.col("doc_id").cast("long").alias("_id")).where(F.col("_id").isNotNull()).distinct()
    share = min(1.0, rows / max(1, ids.count()))
    ids = ids.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000)).withColumn("_t", F.lit(1))
    worded = docs.select(F.col("doc_id").cast("long").alias("_id"), split_words(F.col("text")).alias("_w"))
    grammed = worded.select("_id", grams(F.col("_w"), buckets).alias("_g"))
    return (
        grammed.join(F.broadcast(ids), "_id", "left")
        # the outer form: a filter inferred from a plain explode would split the text again for each of its words
        .select(F.coalesce("_t", F.lit(0)).alias("_t"), F.explode_outer("_g").alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("_t").alias("target"))
    )


def log_ratios(counts: list[tuple[int, int, int]], buckets: int, prior: float = PRIOR) -> list[int]:
    """Millionths of log(target share / raw share) for each bucket; unseen buckets rest on the prior."""
    raw, target = [0] * buckets, [0] * buckets
    for bucket, n, t in counts:
        raw[bucket], target[bucket] = n, t
    of_raw, of_target = sum(raw) + prior * buckets, sum(target) + prior * buckets
    return [
        round(1e6 * math.log((t + prior) / of_target * of_raw / (n + prior))) for n, t in zip(raw, target, strict=True)
    ]


def assess(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, least: int = LEAST) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, kept.

    ``ratio`` is the mean log ratio in whole millionths (floor; null for a text without words). Columns of ``docs``
    by these names are replaced. Null or empty texts have no words and fail the base rules; without trusted ids no
    document is better than another, all ratios are near 0 and the base rules alone decide.
    """
    text, words, lines, found = columns_apart(docs, "_text", "_words", "_lines", "_found")
    table_of = log_ratios(
        [tuple(r) for r in bucket_counts(docs, trusted, buckets).collect()], buckets
    )  # one row for each bucket at most
    ratios = F.split(F.lit(",".join(map(str, table_of))), ",").cast("array<int>")
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "kept"]
    with_words = docs.drop(*made).withColumn(text, text_of(F.col("text"))).withColumn(words, split_words(F.col(text)))
    symbols = F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))
    total = F.aggregate(grams(F.col(words), buckets), F.lit(0).cast("long"), lambda a, g: a + F.get(ratios, g))
    n = F.col("n_words")
    return (
        with_words
        .withColumn(lines, F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)) != ""))
        .withColumn("n_words", F.size(words).cast("long"))
        .withColumn("word_chars", F.char_length(F.array_join(words, "")).cast("long"))
        .withColumn("n_symbols", F.when(F.rlike(text, F.lit(f"[{SYMBOLS}]")), symbols).otherwise(0).cast("long"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))
        .transform(with_repeated_words, words, "n_repeat_words")
        .withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n))
        .withColumn(found, total)
        .withColumn("ratio", F.when(n > 0, F.floor(F.col(found) / (2 * n - 1))))
        # always true, but not to be moved: a filter on the verdict would be pushed below the steps above and with it
        # all of their expressions, nested into one
        .withColumn("kept", ~F.col("base_failed") & (F.col(found) >= least * (2 * n - 1)) & (F.monotonically_increasing_id() >= 0))
        .drop(text, words, lines, found)
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good and not toxic in any of their rows."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("_q"), F.max("toxic").alias("_t")).where(
        (F.col("_q") == 1) & (F.coalesce("_t", F.lit(0)) == 0)
    ).select("doc_id")


@query("op2_quality")
def op2_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return assess(docs, trusted_ids(table(spark, folder, "labels"))).drop("text")
