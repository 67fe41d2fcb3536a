"""Quotation linking: reply-ordered conversations without quotes.

Lines that begin with ``>`` are quotes, one level for each mark. What a message quotes at one level, the message that it
answers holds one level less deep. Neighbouring lines of one level are a passage. Passages, their sentences and their
lines are normalised and hashed, so a quote that was wrapped anew still meets its original by its sentences. Each quoted
unit is joined, within a conversation, to the latest earlier message that holds it one level less deep, by a window over
all messages with that hash: a line that everybody writes makes no pairs.

Units of the shallowest level that finds anything decide; of passages, sentences and lines those with the most words found;
of messages that with the most words, the latest of equals. A thread is a message without parent and all that hangs
on it: its root is found by pointer doubling, so that a chain of n replies takes log n rounds. Sorting by (conversation,
root, turn) puts every message after what it answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table

MARKS = r"^((?:[ \t]*>)+)[ \t]?"


def lines_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, row, at, level, line) of all lines with their place; level 0 is a message's own text."""
    rows = messages.select("conv_id", "turn", F.split(F.coalesce("text", F.lit("")), r"\r\n|\r|\n").alias("_lines"), F.monotonically_increasing_id().alias("row"))
    lined = rows.select("conv_id", "turn", "row", F.posexplode_outer("_lines").alias("at", "_raw"))
    marks = F.regexp_extract("_raw", MARKS, 1)
    body = F.lower(F.trim(F.regexp_replace(F.regexp_replace("_raw", MARKS, ""), r"\s+", " ")))
    return lined.select("conv_id", "turn", "row", "at", F.char_length(F.regexp_replace(marks, r"[ \t]", "")).alias("level"), body.alias("line"))


def units_of(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, kind, hash, words, n): lines, sentences and passages, equal ones of a message counted together."""
    at = W.partitionBy("row").orderBy("at")
    new = (F.col("line") == "") | (F.lag("line").over(at) == "") | (F.lag("level").over(at) != F.col("level"))
    lines = lines_of(messages)
    numbered = lines.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int")).withColumn("part", F.sum("_new").over(at)).where("line <> ''")
    passages = numbered.groupBy("conv_id", "turn", "row", "part", "level").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]).alias("_lines"))
    whole = F.array_join("_lines", " ")
    sentences = F.filter(F.transform(F.split(whole, r"(?<=[.!?])\s+"), lambda x: F.trim(x)), lambda x: x != "")
    def kind(number: int, texts) -> Column:
        return F.transform(texts, lambda t: F.struct(F.lit(number).alias("kind"), t.alias("unit")))

    kinds = [kind(0, F.col("_lines")), kind(1, sentences), kind(2, F.array(whole))]
    units = passages.select("conv_id", "turn", "level", F.inline(F.concat(*kinds)))
    return units.groupBy("conv_id", "turn", "level", "kind", F.md5("unit").alias("hash")).agg(
        F.first(F.size(F.split("unit", " "))).alias("words"), F.count(F.lit(1)).alias("n"))


def parents(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn, n_linked): messages whose quotes were found in an earlier message of the conversation."""
    units = cut(units_of(messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull())))
    held = units.select("conv_id", "kind", "hash", F.col("level").alias("depth"), "turn", F.lit(0).alias("n"), F.lit(0).alias("words"))
    quoted = units.where("level > 0").select("conv_id", "kind", "hash", (F.col("level") - 1).alias("depth"), "turn", "n", "words")
    both = held.unionByName(quoted).withColumn("_own", F.when(F.col("n") == 0, F.col("turn")))
    turns = both.groupBy("conv_id", "kind", "hash", "depth", "turn").agg(F.max("_own").alias("_own"), F.sum("n").alias("n"), F.max("words").alias("words"))
    ahead = W.partitionBy("conv_id", "kind", "hash", "depth").orderBy("turn").rowsBetween(W.unboundedPreceding, -1)
    found = turns.withColumn("_from", F.last("_own", ignorenulls=True).over(ahead)).where((F.col("n") > 0) & F.col("_from").isNotNull())
    votes = found.groupBy("conv_id", "turn", "depth", "kind", "_from").agg(F.sum("n").alias("_n"), F.sum(F.col("n") * F.col("words")).alias("_words"))
    best = F.max(F.struct((-F.col("depth")).alias("_shallow"), "_words", (-F.col("kind")).alias("_fine"), "_from", "_n"))
    return votes.groupBy("conv_id", "turn").agg(best.alias("_p")).select(
        "conv_id", "turn", F.col("_p._from").alias("parent_turn"), F.col("_p._n").alias("n_linked"))


def threads(linked: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) of the messages in ``linked``, following parents to the first without one."""
    ahead = cut(linked.select("conv_id", "turn", F.col("parent_turn").alias("root_turn"), F.lit(1).alias("depth")))
    while True:
        to = ahead.select("conv_id", F.col("turn").alias("_at"), F.col("root_turn").alias("_root"), F.col("depth").alias("_more"))
        moved = cut(
            ahead.join(to.withColumnRenamed("conv_id", "_c"), (F.col("conv_id") == F.col("_c")) & (F.col("root_turn") == F.col("_at")), "left")
            .select("conv_id", "turn", F.coalesce("_root", "root_turn").alias("root_turn"),
                    (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_at").isNotNull().alias("_moved"))
        )
        ahead = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return ahead


def reply_ordered(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, role, parent_turn, root_turn, depth, n_quoted, n_linked, text``, one row for each message.

    ``text`` is without its quoted lines and trimmed (null stays null); ``n_quoted`` counts them at all levels,
    ``n_linked`` the quoted lines (or sentences, or passages: what decided) that the parent holds. Without a link parent_turn
    is null, depth 0, root the turn itself. Rows with a null conversation or turn are kept and link to nothing; of rows
    with one (conversation, turn), all lines count together. Sorted by (conv_id, root_turn, turn, role). An empty table
    gives no rows; columns not named do not matter.
    """
    messages = messages.select("conv_id", "turn", "role", "text")
    linked = cut(parents(messages))
    placed = threads(linked).join(linked, ["conv_id", "turn"]).select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "parent_turn", "root_turn", "depth", "n_linked"
    )
    lines = F.split("text", r"\r\n|\r|\n")
    own = F.filter(lines, lambda x: ~F.rlike(x, F.lit(MARKS)))
    return (
        messages.select(
            "conv_id", "turn", "role", F.coalesce(F.size(lines) - F.size(own), F.lit(0)).alias("n_quoted"),
            F.when(F.col("text").isNotNull(), F.trim(F.array_join(own, "\n"), F.lit(" \t\n"))).alias("text"),
        )
        .join(placed, (F.col("conv_id") == F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
        .select(
            "conv_id", "turn", "role", "parent_turn", F.coalesce("root_turn", "turn").alias("root_turn"),
            F.coalesce("depth", F.lit(0)).alias("depth"), F.when(F.col("text").isNull(), 0).otherwise(F.col("n_quoted")).alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"), "text",
        )
        .orderBy(F.col("conv_id").asc_nulls_last(), F.col("root_turn").asc_nulls_last(), "turn", "role")
    )


@query("op3_quotes")
def op3_quotes(spark, folder):
    return reply_ordered(table(spark, folder, "conversations"))
