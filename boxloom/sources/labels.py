"""Label files and class dictionaries: text to boxes."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.functions import boxes as B
from boxloom.functions import text as X
from boxloom.sources import listing

LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
SPACE = r"[\s\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"


def read_label_files(spark: SparkSession, root: str, shares: int = 4) -> DataFrame:
    """(path, text) of every .txt under ``root``, paths relative to it.

    Spark's readers return no row for a zero-byte file, yet an empty label file means "looked at, nothing there". In a
    mounted folder the executors list and read the files themselves; the driver sees first-level folders only. In other
    stores the file index that Spark holds on the driver adds the empty ones back.
    """
    if folder := listing.mounted(spark, root):
        spark.dataSource.register(listing.LabelFolder)
        return spark.read.format(listing.NAME).option("shares", shares).load(folder)
    base = root.rstrip("/")
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(base, wholetext=True)
    full = found.select(relative(_decoded(F.col("_metadata.file_path")), base).alias("path"), F.col("value").alias("text"))
    listed = spark.createDataFrame([(p,) for p in found.inputFiles()], "_path string")
    listed = listed.select(relative(_decoded(F.col("_path")), base).alias("path"))
    return listed.join(full, "path", "left").withColumn("text", F.coalesce("text", F.lit("")))


def _decoded(path: Column) -> Column:
    """A file URL as a plain path; Spark's metadata and file index show URLs."""
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def relative(path: Column, root: str) -> Column:
    """The part of a full path after the root folder; a root without a scheme fits paths of any scheme."""
    base = re.sub(r"^file:/+", "/", root.rstrip("/"))
    plain = F.regexp_replace(path, r"^file:/+", "/")
    if base.startswith("/"):
        plain = F.regexp_replace(plain, r"^[A-Za-z0-9+.-]+://[^/]*", "")
    return F.substring(plain, len(base) + 2, 1 << 20)


def lines(files: DataFrame, text: str = "text") -> DataFrame:
    """One row per line with its number from 0; every line counts, also blank and broken ones."""
    kept = [c for c in files.columns if c != text]
    return files.select(*kept, F.posexplode(F.split(text, LINE_BREAK)).alias("line_no", "line"))


def _boxes(df: DataFrame) -> DataFrame:
    """Lines split into fields: ``five`` (exactly five), ``readable`` (all numbers) and the values or nulls."""
    line = F.regexp_replace("line", f"{SPACE}+", " ")
    f = F.split(F.trim("line"), " ")
    values = dict(zip(("class_id", "xc", "yc", "w", "h"), [F.get(f, k).try_cast("double") for k in range(5)]))
    # a class id may be written as a float
    values["class_id"] = values["class_id"].try_cast("int")
    return df.withColumn("line", line).withColumns({
        "five": F.col("line").rlike(r"^ ?[^ ]+(?: [^ ]+){4} ?$"),
        "readable": F.col("line").rlike(f"^ ?{NUMBER}(?: {NUMBER}){{4}} ?$"),
    } | {k: F.when(F.col("line").rlike(r"^ ?[^ ]+(?: [^ ]+){4} ?$"), v) for k, v in values.items()})


def parsed_strict(files: DataFrame, class_map: DataFrame) -> DataFrame:
    """Lines with exactly five fields; ``reason`` is null for boxes and says why the others are rejected.

    A class id outside ``class_map`` or an unreadable number rejects the line instead of failing the run.
    """
    rows = _boxes(lines(files)).where("five").join(F.broadcast(class_map), "class_id", "left")
    return rows.withColumn(
        "reason", F.when(~F.col("readable"), "unreadable_number").when(F.col("source_class").isNull(), "unknown_class")
    ).drop("five", "readable")


def parse_strict(files: DataFrame, class_map: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(boxes, rejects) of whole label files."""
    rows = parsed_strict(files, class_map)
    return (
        rows.where(F.col("reason").isNull()).drop("line", "reason"),
        rows.where(F.col("reason").isNotNull()).select(*[c for c in files.columns if c != "text"], "line_no", "line", "reason"),
    )


def parse_tolerant(files: DataFrame) -> DataFrame:
    """Non-blank lines with ``valid``; valid ones carry a class id and numbers clamped to [0, 1]."""
    rows = _boxes(lines(files)).where(~F.col("line").isin("", " "))
    numbers = {n: F.when(F.col("readable"), B.clamp(F.col(n))) for n in ("xc", "yc", "w", "h")}
    return rows.withColumns(numbers | {"class_id": F.when(F.col("readable"), F.col("class_id"))}).withColumnRenamed(
        "readable", "valid").drop("five", "line")


def class_dictionary(text: DataFrame, default: list[str] | None = None) -> DataFrame:
    """(class_id, label) from the ``digit: name`` lines of a descriptor, quotes removed.

    ``text`` has one row per line (``value``). Without such lines the default names are
    used; without a default the result is empty.
    """
    found = text.select(
        F.regexp_extract("value", r"^\s*(\d+)\s*:\s*(.+?)\s*$", 1).try_cast("int").alias("class_id"),
        F.regexp_replace(F.regexp_extract("value", r"^\s*(\d+)\s*:\s*(.+?)\s*$", 2), r"^['\"]+|['\"]+$", "").alias("label"),
    ).where(F.col("class_id").isNotNull() & (F.col("label") != ""))
    if default is None:
        return found
    known = F.array(*[F.struct(F.lit(i).alias("class_id"), F.lit(n).alias("label")) for i, n in enumerate(default)])
    count = found.agg(F.count(F.lit(1))).scalar()
    spare = text.sparkSession.range(1).where(count == 0).select(F.inline(known))
    return found.unionByName(spare)


def fill_class_gaps(classes: DataFrame) -> DataFrame:
    """Missing ids below the highest one are named class_<id>."""
    top = classes.agg(F.max("class_id")).scalar()
    every = classes.sparkSession.range(1).select(F.explode(F.sequence(F.lit(0), top)).alias("class_id"))
    return every.join(classes, "class_id", "left").withColumn(
        "label", F.coalesce("label", F.concat(F.lit("class_"), F.col("class_id").cast("string"))))


def label_text(boxes: DataFrame, order: list[str], trailing_newline: bool = True, bound: int = 4096) -> DataFrame:
    """(image_id, part, label_text) from (image_id, line, order columns).

    An image has one part, 0, unless it has more than ``bound`` boxes; then each part
    holds the next ``bound`` lines, and the parts in order are the file.
    """
    from boxloom.operators.ranking import range_rank, split_hot

    end = "\n" if trailing_newline else ""
    cold, hot = split_hot(boxes, ["image_id"], bound)

    def joined(df: DataFrame, keys: list[str]) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct(*order, "line")))
        return df.groupBy(*keys).agg(
            F.concat(F.array_join(F.transform(rows, lambda r: r["line"]), "\n"), F.lit(end)).alias("label_text"))

    out = joined(cold, ["image_id"]).select("image_id", F.lit(0).cast("long").alias("part"), "label_text")
    if hot is None:
        return out
    ranked = range_rank(hot, ["image_id"], order, "_r").withColumn("part", F.floor((F.col("_r") - 1) / bound).cast("long"))
    return out.unionByName(joined(ranked, ["image_id", "part"]))


def box_line(class_id: Column) -> Column:
    """class xc yc w h with six decimals."""
    return F.concat_ws(" ", class_id.cast("string"), *[B.six(F.col(c)) for c in ("xc", "yc", "w", "h")])


def match_images(labels: DataFrame, images: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matched, missing): label files with the image of the same stem, and those without one.

    Of images with equal stems the last path wins.
    """
    index = images.groupBy(X.stem(F.col("path")).alias("_stem")).agg(F.max("path").alias("image_path"))
    keyed = labels.withColumn("_stem", X.stem(F.col("path")))
    return (keyed.join(index, "_stem").drop("_stem"), keyed.join(index, "_stem", "left_anti").drop("_stem"))


def resolve_images(labels: DataFrame, images: DataFrame) -> DataFrame:
    """Label files with ``image_path``: same folder and stem, .jpg before others, then by path; null when missing."""
    choice = F.min(F.struct((X.suffix(F.col("path")) != "jpg").alias("_other"), "path"))
    index = images.groupBy(X.parent(F.col("path")).alias("_dir"), X.stem(F.col("path")).alias("_stem")).agg(
        choice["path"].alias("image_path"))
    keyed = labels.withColumns({"_dir": X.parent(F.col("path")), "_stem": X.stem(F.col("path"))})
    return keyed.join(index, ["_dir", "_stem"], "left").drop("_dir", "_stem")
