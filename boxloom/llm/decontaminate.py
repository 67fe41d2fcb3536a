"""Benchmark decontamination by a prefix-filtered set join.

A benchmark item is cut into windows of 13 words; a document is hit where a window occurs in it, word for word. Each
window is the set of its placed five-word shingles. As all of them must occur, the prefix that any match has to share
is one shingle long: the window's rarest, counted over the whole corpus. Documents meet windows on that shingle only;
a meeting fixes where the window would start, which must lie inside the document (length and positional bounds), and
is verified on the words themselves.

One scan finds the places of benchmark shingles in the corpus and writes them: they give both the rarities and the
meetings. A second scan verifies. Neither shuffles words. Documents are shuffled once, by id, to meet their candidates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table
from boxloom.llm.words import NOT_WORD, columns_apart, lower_ascii, runs, split_words

WINDOW, SHINGLE = 13, 5
#: benchmark shingles are broadcast up to this number of rows (16 bytes each), else shuffled with the corpus' shingles
BROADCAST_ROWS = 1_000_000
#: a document is contaminated if at least one in so many of its words is hit
SHARE = 20


def token_words(text: Column) -> Column:
    return split_words(lower_ascii(text), NOT_WORD)


def benchmark_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_win, _k, _line: the distinct windows, their words and text) and (_win, _item: the items that hold them)."""
    words = cut(benchmark.select(F.col("item_id").cast("string").alias("_item"), token_words(F.col("text")).alias("_w")))
    long = words.where(F.size("_w") >= WINDOW).select(
        "_item", F.explode_outer(runs(F.col("_w"), WINDOW, lambda w: F.concat_ws(" ", *w))).alias("_line")
    )
    short = words.where((F.size("_w") > 0) & (F.size("_w") < WINDOW)).select("_item", F.concat_ws(" ", "_w").alias("_line"))
    held = cut(long.union(short).distinct())
    windows = cut(held.select("_line").distinct().select(
        F.monotonically_increasing_id().alias("_win"), F.size(F.split("_line", " ")).alias("_k"), "_line"
    ))
    return windows, cut(held.join(windows, "_line").select("_win", "_item").where(F.col("_item").isNotNull()))


def shingle_hashes(words: str, width: int) -> Column:
    """64-bit hashes of the column's runs of ``width`` words, in place order."""
    return runs(F.col(words), width, lambda w: F.xxhash64(F.lit(width), *w))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, one row for each row of ``docs``.

    Null and empty texts have no words and are never contaminated. Rows with equal or null ids are each judged on
    their own text. Items without words have no window; items that are equal all count. An empty benchmark hits
    nothing: then items_sha256 is that of the empty list.
    """
    met, held = candidates(docs, benchmark)
    verified = with_hits(docs.select("doc_id", "text"), met)
    return _report(verified.select(F.col("doc_id").alias("_doc"), "_n_words", "_n_hit", "_wins"), held)


#: working columns of ``with_hits``
WORKING = ("_to", "_met", "_w", "_true", "_n_words", "_n_hit", "_wins", "_clean")


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the benchmark does not contaminate, with all their columns, after one shuffle of them.

    Columns may have any names; an empty table stays empty.
    """
    names = docs.columns
    clashing = {c: aside for c, aside in zip(names, columns_apart(docs, *[f"_own{k}" for k in range(len(names))])) if c.lower() in WORKING}
    docs = docs.withColumnsRenamed(clashing)
    verified = with_hits(docs, candidates(docs, benchmark)[0])
    clean = (F.col("_n_hit") == 0) | (SHARE * F.col("_n_hit") < F.col("_n_words"))
    # always true, but a filter on it stays above the steps that count the hits
    kept = verified.withColumn("_clean", clean & (F.monotonically_increasing_id() >= 0))
    return kept.where("_clean").select(*docs.columns).withColumnsRenamed({aside: c for c, aside in clashing.items()})


def candidates(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """(_to, _met: for each document id the places where windows may occur), and the items of the windows.

    None for the first if no item has words.
    """
    windows, held = benchmark_windows(benchmark)
    shingled = windows.withColumn("_bw", F.split("_line", " ")).withColumn("_s", F.least(F.lit(SHINGLE), F.col("_k")))
    widths = [r[0] for r in shingled.select("_s").distinct().collect()]  # five values at most
    tokens = None  # all shingles of all windows, with their places
    for width in widths:
        part = shingled.where(F.col("_s") == width).select(
            "_win", "_k", F.posexplode_outer(shingle_hashes("_bw", width)).alias("_off", "_h")
        )
        tokens = part if tokens is None else tokens.union(part)
    worded = docs.select(F.col("doc_id").alias("_doc"), token_words(F.col("text")).alias("_w"))
    if tokens is None:
        return None, held
    tokens = cut(tokens)
    known = tokens.select("_h").distinct()
    if known.count() <= BROADCAST_ROWS:
        known = F.broadcast(known)
    places = None
    for width in widths:
        part = worded.select(
            "_doc", F.size("_w").alias("_n"), F.posexplode_outer(shingle_hashes("_w", width)).alias("_pos", "_h")
        ).join(known, "_h")
        places = part if places is None else places.union(part)
    places = cut(places)
    frequency = places.groupBy("_h").agg(F.count(F.lit(1)).alias("_f"))
    prefix = (
        tokens.join(frequency, "_h", "left")
        .groupBy("_win", "_k").agg(F.min(F.struct(F.coalesce("_f", F.lit(0)).alias("f"), "_off", "_h")).alias("_p"))
        .where(F.col("_p.f") > 0)  # a window with a shingle that no document has occurs nowhere
        .select("_win", "_k", "_p._off", "_p._h")
    )
    start = F.col("_pos") - F.col("_off")
    met = (
        places.join(prefix, "_h").where((start >= 0) & (start + F.col("_k") <= F.col("_n")))
        .select("_doc", "_win", start.alias("_at")).distinct()
        .join(windows, "_win").groupBy("_doc")
        .agg(F.sort_array(F.collect_list(F.struct("_at", "_k", "_win", "_line"))).alias("_met"))
    )
    return met.withColumnRenamed("_doc", "_to"), held


def with_hits(docs: DataFrame, met: DataFrame | None) -> DataFrame:
    """``docs`` with _n_words, _n_hit and _wins: words that lie in an occurrence, and the windows that occur."""
    if met is None:
        return docs.withColumn("_n_words", F.size(token_words(F.col("text"))).cast("long")).withColumn(
            "_n_hit", F.lit(0).cast("long")).withColumn("_wins", F.array().cast("array<bigint>"))
    own = [c for c in docs.columns if c.lower() not in WORKING]
    there = lambda m: F.concat_ws(" ", F.slice("_w", m["_at"] + 1, m["_k"])) == m["_line"]
    return (
        # candidates grow with the documents: never a broadcast
        docs.select(*own).join(met.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_to")), "left")
        .select(*own, "_met", token_words(F.col("text")).alias("_w"))
        .select(*own, F.size("_w").cast("long").alias("_n_words"),
                F.filter(F.coalesce("_met", F.array().cast(met.schema["_met"].dataType)), there).alias("_true"))
        # the occurrences are in place order: each adds the words that lie beyond those before it
        .select(*own, "_n_words", F.aggregate(
            "_true", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda a, m: F.struct(
                (a["n"] + F.greatest(F.lit(0), m["_at"] + m["_k"] - F.greatest(m["_at"], a["end"]))).alias("n"),
                F.greatest(a["end"], m["_at"] + m["_k"]).alias("end"),
            ), lambda a: a["n"],
        ).alias("_n_hit"), F.array_distinct(F.transform("_true", lambda m: m["_win"])).alias("_wins"))
    )


def _report(verified: DataFrame, held: DataFrame) -> DataFrame:
    rows = cut(verified.withColumn("_row", F.monotonically_increasing_id()))
    items = (
        rows.where(F.size("_wins") > 0).select("_row", F.explode("_wins").alias("_win")).join(held, "_win")
        .groupBy("_row").agg(F.sort_array(F.collect_set("_item")).alias("_items"))
    )
    listed = F.coalesce("_items", F.array().cast("array<string>"))
    return rows.join(items, "_row", "left").select(
        F.col("_doc").alias("doc_id"), F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        ((F.col("_n_hit") > 0) & (SHARE * F.col("_n_hit") >= F.col("_n_words"))).alias("contaminated"),
    )


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS line
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
placed AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS line
  FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
hit AS (SELECT DISTINCT placed.doc_id, win.item_id, placed.i, placed.k FROM placed JOIN win USING (k, line)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS sha
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op4_decontaminate", ORACLE)
def op4_decontaminate(spark, folder):
    return hits(table(spark, folder, "documents").select("doc_id", "text"),
                table(spark, folder, "benchmark").select("item_id", "text"))
