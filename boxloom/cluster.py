"""Session set-up and lineage cuts that survive the loss of executors."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and for bench runs; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("boxloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session that names none (a test) gets a folder of its own; on a cluster the driver's disk would not
    be seen by the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not named:  # the setting cannot be changed in a running session, so the folder is remembered here
        global _own_dir
        named = _own_dir = _own_dir or tempfile.mkdtemp(prefix="spark-boxloom-")
    return named.rstrip("/")


def spread(df: DataFrame) -> DataFrame:
    """For heavy row-local work: spread an input with fewer partitions than the cluster has cores.

    Inputs of a cluster's size have more partitions than that and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fresh_path(spark: SparkSession, what: str) -> str:
    return os.path.join(shared_dir(spark), f"boxloom-{what}-{uuid.uuid4().hex}")


def cut(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Ends the lineage, fixes the rows (so that values such as
    ``monotonically_increasing_id`` cannot change on a retry) and gives the
    optimizer the true size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
