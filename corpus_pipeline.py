"""A corpus pipeline of five of the operators in ``boxloom.llm``: filter, dedupe, decontaminate, mix, shard.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame, which is written as Parquet to the shared
folder and read again as the next stage's ``docs``. All but the last return the columns of documents. Rows with equal
ids are decided on together in the stages that join decisions back by id; null ids are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm import decontaminate, mixing, quality, sharding, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the likelihood ratio keep."""
    trusted = quality.trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.assess(docs.select(*COLUMNS), trusted).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component; one row of it if the id repeats."""
    marked = simhash.near_duplicates(docs.select("doc_id", "text"))
    stay = marked.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("_stay")).distinct()
    rows = docs.select(*COLUMNS)
    # as large as the documents' ids: never a broadcast; the removal of repeats goes on from the join's partitions
    named = rows.join(stay.hint("merge"), F.col("doc_id") == F.col("_stay"), "left_semi").dropDuplicates(["doc_id"])
    return named.union(rows.where(F.col("doc_id").isNull()))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.uncontaminated(docs.select(*COLUMNS), benchmark)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    taken = mixing.mix(docs.select("doc_id", "source", "text")).groupBy(F.col("doc_id").alias("_id")).agg(
        F.max("copies").alias("_n")
    ).where("_n > 0").hint("merge")  # as large as the documents' ids: never a broadcast
    return docs.select(*COLUMNS).join(taken, F.col("doc_id").eqNullSafe(F.col("_id"))).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))
    ).select(*COLUMNS)


def byte_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard(docs.select("doc_id", "text"))


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", source_mixing),
    ("sharding", byte_shards),
]

#: fingerprints and n-gram buckets rest on XXH64, which SQL lacks; tests compare every stage with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
