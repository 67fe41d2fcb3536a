"""Writing results: manifests, label files, lists, summaries and split-partitioned exports."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.cluster import cut


def write_manifest(df: DataFrame, path: str, order: list[str] | None = None, mode: str = "errorifexists") -> None:
    """CSV with header, range-sorted when an order is given; part files in order make the manifest."""
    (df.orderBy(*order) if order else df).write.mode(mode).option("header", True).csv(path)


def read_manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV manifest with header (a byte-order mark is fine) under a given schema; no inference pass."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_list(df: DataFrame, column: str, path: str, order: list[str] | None = None, mode: str = "errorifexists") -> None:
    """One value per line; repeated values are repeated lines."""
    (df.orderBy(*order) if order else df).select(F.col(column).cast("string")).write.mode(mode).text(path)


def write_summary(tidy: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A tidy (section, key, value) table as one JSON object per section.

    Sections and keys are classes, flags, splits and the like, so the maps stay small.
    """
    entry = F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value"))))
    tidy.groupBy("section").agg(entry.alias("counts")).select(
        F.to_json(F.struct("section", "counts")).alias("value")).write.mode(mode).text(path)


def export_split(df: DataFrame, path: str, batch: str | None = None) -> DataFrame:
    """Write (split, label, path, label_text, ...) rows partitioned by split and label, leaving out what is there already.

    Pictures are referred to by path, not copied. Each call fills a folder of its own, named by ``batch``; a retry under
    the same name replaces its own rows only. Returns the rows that were new.
    """
    spark = df.sparkSession
    batch = batch or uuid.uuid4().hex
    fresh = df
    if _exists(spark, path):
        stored = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("batch", T.StringType())])).parquet(path)
        known = stored.where(F.col("batch") != batch).select("split", "label", "path")
        fresh = df.join(known, ["split", "label", "path"], "left_anti")
    fresh = cut(fresh)  # decided before anything is replaced
    fresh.write.mode("overwrite").partitionBy("split", "label").parquet(os.path.join(path, f"batch={batch}"))
    return fresh


def write_cache(entries: DataFrame, path: str) -> None:
    """Append detection-cache entries (export_stem, sha1, source_class, flags, detections)."""
    entries.write.mode("append").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
