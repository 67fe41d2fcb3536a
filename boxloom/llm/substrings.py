"""Substring dedup by line and sentence hashing.

Lines are the units; a line of several sentences is also cut at their ends, so that a passage is found again where it
stands inside other lines. Units are normalised (case, white space) and known by a 128-bit digest. Digests are counted
over all documents with their earliest occurrence, combined before the shuffle; every later occurrence is removed.
Offsets are code points of the original text. A unit's earliest occurrence is never removed with a larger unit: the line
it stands in would have to occur earlier still.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table
from boxloom.llm.words import columns_apart

#: sentences within a line that are shorter ("Licensed.", "the end.") are left alone; lines are units whatever their length
MIN_WORDS = 6
SENTENCE_END = re.compile(r"[.!?][^\w\s]*(?=\s)")
UNITS = "row long, doc_id long, start int, end int, line int, n_words int, d1 long, d2 long"


def units_of(text: str, least: int = MIN_WORDS):
    """(start, end, start of its line, words, digest) of all lines that are not blank, and of their sentences of at least
    ``least`` words."""
    at = 0
    for line in text.split("\n"):
        words = line.split()
        if words:
            yield at, at + len(line), at, len(words), _digest(words)
            begin = 0
            for m in SENTENCE_END.finditer(line) if len(words) >= least else ():
                if (made := _sentence(line, begin, m.end(), at, least)) is not None:
                    yield made
                begin = m.end()
            if begin and (made := _sentence(line, begin, len(line), at, least)) is not None:
                yield made
        at += len(line) + 1


def _sentence(line: str, a: int, b: int, at: int, least: int):
    words = line[a:b].split()
    if len(words) < least:
        return None
    inside = a + len(line[a:b]) - len(line[a:b].lstrip())
    return at + inside, at + a + len(line[a:b].rstrip()), at, len(words), _digest(words)


def _digest(words: list[str]) -> bytes:
    return hashlib.md5(" ".join(words).lower().encode()).digest()


def units(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    def made(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out: list[list] = [[] for _ in range(8)]
                for row, doc, text in zip(*(c.to_pylist() for c in b.slice(at, 256).columns), strict=True):
                    for start, end, line, n, digest in units_of(text or "", least):
                        d1, d2 = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
                        for column, value in zip(out, (row, doc, start, end, line, n, d1, d2), strict=True):
                            column.append(value)
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], [x.split()[0] for x in UNITS.split(", ")]
                )

    return docs.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(made, UNITS)


def repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``row, doc_id, start, end, n_words, first_doc_id, first_start``: one row for each unit to remove.

    ``docs`` has a ``row`` number. The earliest occurrence is that of the smallest (doc_id, row, start), null ids last.
    Null and empty texts have no units. Repeated rows count as further documents: all but the first lose their units.
    Of a line that is removed whole, its sentences are not listed again.
    """
    found = cut(units(docs, least))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "start")
    again = cut(
        found.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1)).select("d1", "d2", "first")
    ).hint("merge")  # grows with the documents: never a broadcast
    later = (F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start"))
    # a line of one sentence holds that sentence at the same place: the pair is one occurrence
    gone = cut(found.join(again, ["d1", "d2"]).where(later).select(
        "row", "doc_id", "start", "end", "line", "n_words", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"),
    ).distinct())
    # within a removed line every other unit is a part of it
    longest = gone.groupBy("row", "line").agg(F.max(F.struct(F.col("end") - F.col("start"), "start")).alias("_l"))
    whole = longest.select("row", "line", F.col("_l.start").alias("_from"), (F.col("_l.start") + F.col("_l.col1")).alias("_to"))
    return gone.join(whole.hint("merge"), ["row", "line"]).where(
        (F.col("start") < F.col("_from")) | (F.col("end") > F.col("_to"))
        | ((F.col("start") == F.col("_from")) & (F.col("end") == F.col("_to")))
    ).select("row", "doc_id", "start", "end", "n_words", "first_doc_id", "first_start")


def without_repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleared of repeats and ``removed``: (start, end, first_doc_id, first_start) in the old text.

    Columns of ``docs`` named ``removed`` or ``row`` are replaced, others may have any names; a null text stays null, an
    empty table empty.
    """
    docs = docs.drop("removed", "row")
    (of,) = columns_apart(docs, "_row")
    rows = cut(docs.withColumn("row", F.monotonically_increasing_id()))
    spans = repeats(rows, least).groupBy(F.col("row").alias(of)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "first_doc_id", "first_start"))).alias("removed")
    )
    with_spans = rows.join(spans, F.col("row") == F.col(of), "left").drop("row", of).withColumn(
        "removed", F.coalesce("removed", F.array().cast(spans.schema["removed"].dataType))
    )
    kept = F.aggregate(
        "removed", F.struct(F.lit("").alias("t"), F.lit(0).alias("at")),
        lambda a, s: F.struct(
            F.concat(a["t"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"])).alias("t"), s["end"].alias("at")
        ),
        lambda a: F.concat(a["t"], F.substring(F.col("text"), a["at"] + 1, F.char_length("text"))),
    )
    return with_spans.withColumn("text", F.when(F.size("removed") > 0, kept).otherwise(F.col("text")))


@query("op9_substrings")
def op9_substrings(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    return repeats(docs).drop("row")
