"""Class names from dataset descriptors: lines in order, with the section that they stand in.

Three readers are told apart by what they accept. All take (file, line_no, value) rows of any number of descriptors and
return (file, class_id, label). A descriptor is small; its lines meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SECTION = "names:"
QUOTES = r"^['\"]+|['\"]+$"


def read_descriptors(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of descriptor files; a file is one value first, so that lines keep their order."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", r"\r\n|[\n\r]")).alias("line_no", "value"))


def _stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def _parts(lines: DataFrame) -> DataFrame:
    text = _stripped(F.col("value"))
    return lines.select(
        "file", "line_no", text.alias("s"), F.col("value").rlike(r"^[ \t]").alias("inside"), text.contains(":").alias("colon"),
        _stripped(F.substring_index(text, ":", 1)).alias("left"), _stripped(F.regexp_extract(text, r"(?s)^[^:]*:(.*)$", 1)).alias("right"))


def _section(parts: DataFrame, ends: Column) -> DataFrame:
    """Lines after the first section header and before the first line that ends the section, without blanks, comments and headers."""
    whole = W.partitionBy("file")
    live = (F.col("s") != "") & ~F.col("s").startswith("#")
    begun = parts.where(live).withColumn("_from", F.min(F.when(F.col("s") == SECTION, F.col("line_no"))).over(whole))
    begun = begun.where((F.col("line_no") > F.col("_from")) & (F.col("s") != SECTION))
    return begun.withColumn("_to", F.min(F.when(ends, F.col("line_no"))).over(whole)).where(
        F.col("_to").isNull() | (F.col("line_no") < F.col("_to"))).drop("_from", "_to")


def _last(found: DataFrame) -> DataFrame:
    """A class id that is named twice keeps its later name."""
    return found.groupBy("file", "class_id").agg(F.max_by("label", "line_no").alias("label"))


def tolerant(lines: DataFrame) -> DataFrame:
    """A ``names:`` section of ``id: name`` lines, gaps filled with class_<id>, or else of ``- name`` lines in order.

    A line that is neither and not indented ends the section; the others need not be indented.
    """
    parts = _parts(lines)
    key, name = F.regexp_replace("left", QUOTES, ""), F.regexp_replace("right", QUOTES, "")
    mapped = F.col("colon") & key.rlike(r"^\d+$")
    listed = ~mapped & F.col("s").startswith("- ")
    rows = _section(parts, ~mapped & ~listed & ~F.col("inside"))
    ids = _last(rows.where(mapped).select("file", "line_no", key.cast("int").alias("class_id"), name.alias("label")))
    every = ids.groupBy("file").agg(F.max("class_id").alias("_top")).select("file", F.explode(F.sequence(F.lit(0), "_top")).alias("class_id"))
    filled = every.join(ids, ["file", "class_id"], "left").withColumn(
        "label", F.coalesce("label", F.concat(F.lit("class_"), F.col("class_id").cast("string"))))
    item = F.regexp_replace(_stripped(F.substring("s", 3, 1 << 20)), QUOTES, "")
    order = (F.row_number().over(W.partitionBy("file").orderBy("line_no")) - 1).cast("int")
    items = rows.where(listed).select("file", order.alias("class_id"), item.alias("label"))
    return filled.select("file", "class_id", "label").unionByName(items.join(ids.select("file").distinct(), "file", "left_anti"))


def scoped(lines: DataFrame, default: list[str]) -> DataFrame:
    """A ``names:`` section of indented ``id: name`` lines, numbered in the order of their ids; ``default`` without any.

    The first line that is not indented ends the section. Names without text do not count.
    """
    parts = _parts(lines)
    name = F.regexp_replace("right", QUOTES, "")
    rows = _section(parts, ~F.col("inside")).where(F.col("colon") & F.col("left").rlike(r"^\d+$") & (name != ""))
    ids = _last(rows.select("file", "line_no", F.col("left").cast("int").alias("class_id"), name.alias("label")))
    order = (F.row_number().over(W.partitionBy("file").orderBy("class_id")) - 1).cast("int")
    ranked = ids.select("file", order.alias("class_id"), "label")
    spare = F.inline(F.array(*[F.struct(F.lit(i).alias("class_id"), F.lit(n).alias("label")) for i, n in enumerate(default)]))
    return ranked.unionByName(lines.select("file").distinct().join(ids.select("file").distinct(), "file", "left_anti").select("file", spare))


def strict(lines: DataFrame) -> DataFrame:
    """``id: name`` lines anywhere, names as they stand; a descriptor without any ends the run with its name."""
    parts = _parts(lines)
    mapped = F.col("colon") & F.col("left").rlike(r"^\d+$")
    named = parts.groupBy("file").agg(F.count_if(mapped).alias("_n"))
    ids = _last(parts.where(mapped).select("file", "line_no", F.col("left").cast("int").alias("class_id"), F.col("right").alias("label")))
    known = F.when(F.col("_n") > 0, F.col("file")).otherwise(F.raise_error(F.concat(F.lit("no class names in "), "file")))
    # every descriptor passes through the check, also those that name nothing
    return named.withColumn("file", known).join(ids, "file", "left").select("file", "class_id", "label")
