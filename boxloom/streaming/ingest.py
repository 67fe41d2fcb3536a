"""Incremental ingest: what was unseen, once, up to the quota, across restarts.

State lives in the query's checkpoint and in tables written per micro-batch, so a lost
executor or a restart repeats a batch without changing the result. Batches are filed by run: a
stream that has lost its checkpoint counts batches from 0 again, but in a run of its own, and
knows all that earlier runs have committed.
"""

from __future__ import annotations

import os

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boxloom import vocabulary as V
from boxloom.cluster import cut
from boxloom.operators import crawl, manifests
from boxloom.operators.stats import zero_filled


def landed(spark: SparkSession, path: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Landed parquet files as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def seen_once(stream: DataFrame, key: str = "content_key", salts: int = 64, watermark: tuple[str, str] | None = None) -> DataFrame:
    """The keys of a stream, each once over its whole life.

    Repeats within an Arrow batch go before the shuffle, so a key that arrives very often does not
    meet in one task with all its rows. The state holds every key ever seen, in one row each. With
    ``watermark`` (time column, delay) it forgets keys older than the delay; there a key is first
    reduced under ``salts`` salted copies, since the time has to stay with the rows.
    """
    if watermark:
        time, delay = watermark
        rows = stream.select(key, time).withWatermark(time, delay)
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(time), F.lit(salts)))
        return salted.dropDuplicatesWithinWatermark([key, "_salt"]).dropDuplicatesWithinWatermark([key]).select(key)

    def once(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pc.unique(b.column(0))], [key])

    keys = stream.select(key)
    return keys.mapInArrow(once, keys.schema).dropDuplicates([key])


FILED = "run string, batch bigint"
ACCEPTED = "arrival_id bigint, label string, content_key string"
Filed = tuple[str, int]  # run and batch


def _filed(spark: SparkSession, table: str) -> list[Filed]:
    """The batches whose write was completed, in order."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for run in _runs(spark, table):
        for f in files.listStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"run={run}")):
            name, done = f.getPath().getName(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")
            if name.startswith("batch=") and files.exists(done):
                out.append((run, int(name.removeprefix("batch="))))
    return sorted(out)


def _remove(spark: SparkSession, table: str, filed: Filed) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(table, filed))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _folder(table: str, filed: Filed) -> str:
    return os.path.join(table, f"run={filed[0]}", f"batch={filed[1]}")


def _runs(spark: SparkSession, table: str) -> list[str]:
    """Runs that have written to the table: one for each checkpoint the stream has had."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(path)] if files.exists(path) else []
    return sorted(n.removeprefix("run=") for n in names if n.startswith("run="))


def current_run(spark: SparkSession, table: str) -> str:
    """The run of the stream that is calling: the same after every restart from its checkpoint, else the next one."""
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "no-stream"
    runs = _runs(spark, table)
    return next((r for r in runs if r.endswith(f"_{stream}")), f"{len(runs):06d}_{stream}")


def write_batch(df: DataFrame, table: str, run: str, batch: int) -> None:
    """A repeated batch replaces its own rows only."""
    df.write.mode("overwrite").parquet(_folder(table, (run, batch)))


def state_of(table: str) -> str:
    """Where ``accept`` keeps its state: next to the table, one row for each accepted item."""
    return f"{table.rstrip('/')}-state"


def accept(batch: DataFrame, number: int, table: str, target: int = V.TARGET_PER_CLASS, run: str | None = None) -> None:
    """One micro-batch of the quota rule: new content only, in arrival order, until each class is full.

    What is known is read from the state that the batch before has left, whose size the quotas bound; the batches
    themselves are not read again. The new state, written last, also commits the batch: rows of a batch that died before are
    replaced by its repetition or, if the checkpoint was lost with it, removed when the next run begins.
    """
    spark = batch.sparkSession
    run = run or current_run(spark, table)
    state, this = state_of(table), (run, number)
    filed = _filed(spark, state)
    before = [f for f in filed if f < this]
    if before and all(f[0] != run for f in filed):
        for f in _filed(spark, table):
            if before[-1] < f < this:
                _remove(spark, table, f)
    known = spark.read.schema(ACCEPTED).parquet(_folder(state, before[-1])) if before else spark.createDataFrame([], ACCEPTED)
    have = known.groupBy("label").agg(F.count(F.lit(1)).alias("have"))
    taken = crawl.within_quota(crawl.unseen(batch, known), have, target)
    write_batch(taken.select("arrival_id", "label", "content_key"), table, run, number)
    new = spark.read.schema(ACCEPTED).parquet(_folder(table, this))
    write_batch(known.unionByName(new).coalesce(8), state, run, number)
    for f in before[:-1]:  # the state before this batch stays, for its repetition
        _remove(spark, state, f)


def collect_until_full(stream: DataFrame, table: str, checkpoint: str, target: int = V.TARGET_PER_CLASS) -> StreamingQuery:
    """Accept arrivals until every class has ``target`` items; reads all that has landed, then stops."""
    return (
        stream.writeStream.foreachBatch(lambda df, n: accept(df, n, table, target))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def progress(accepted: DataFrame, classes: DataFrame, target: int = V.TARGET_PER_CLASS) -> DataFrame:
    """(class_id, label, count, completed) and the items gained in the latest batch."""
    last = accepted.agg(F.max(F.struct("run", "batch"))).scalar()
    counts = accepted.groupBy("label").agg(
        F.count(F.lit(1)).alias("count"), F.count_if(F.struct("run", "batch") == last).alias("gained"))
    return zero_filled(classes, counts, ["label"], ["count", "gained"]).withColumn("completed", F.col("count") >= target)


def progress_by_batch(spark: SparkSession, table: str, classes: DataFrame, target: int = V.TARGET_PER_CLASS) -> DataFrame:
    """(step, class_id, label, count, gained, completed) after each batch filed in ``table``; steps go from 1 over all runs."""
    steps = spark.createDataFrame([(k + 1, *f) for k, f in enumerate(_filed(spark, table))], f"step bigint, {FILED}")
    accepted = spark.read.schema(f"{ACCEPTED}, {FILED}").parquet(table)
    gained = accepted.groupBy("run", "batch", "label").agg(F.count(F.lit(1)).alias("gained"))
    every = steps.withColumn("_of", F.explode(classes.agg(F.collect_list(F.struct("class_id", "label"))).scalar())).select("step", "run", "batch", "_of.*")
    filled = every.join(gained, ["run", "batch", "label"], "left").withColumn("gained", F.coalesce("gained", F.lit(0)))
    count = F.sum("gained").over(W.partitionBy("label").orderBy("step"))
    return filled.withColumn("count", count).select("step", "class_id", "label", "count", "gained", (F.col("count") >= target).alias("completed"))


def detect_new(stream: DataFrame, cache: str, boxes: str, checkpoint: str, score, schema: str) -> StreamingQuery:
    """Score only images whose (export_stem, sha1, source_class) is not cached yet.

    ``score`` maps a frame of pending images to boxes; both tables grow by one batch folder each. What this run has seen is
    in the stream's state, one row an image; only what earlier runs have cached is read. The cache entry is written last and
    commits the boxes: those of a batch that died before it are replaced by its repetition, or removed when the next run begins.
    """
    keys = ["export_stem", "sha1", "source_class"]
    names = [c.split()[0] for c in schema.split(", ")]

    def detect(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        run = current_run(spark, cache)
        filed = _filed(spark, cache)
        if all(f[0] != run for f in filed):
            for f in _filed(spark, boxes):
                if f[0] != run and f not in filed:
                    _remove(spark, boxes, f)
        known = spark.createDataFrame([], schema)
        if earlier := sorted({r for r, _ in filed if r != run}):
            known = spark.read.schema(schema).parquet(*[os.path.join(cache, f"run={r}") for r in earlier])
        _, pending = manifests.split_cache(batch, known)
        pending = cut(pending)  # the batch is scored and cached from the same rows
        write_batch(score(pending), boxes, run, number)
        write_batch(pending.select(*names), cache, run, number)

    once = stream.dropDuplicates(keys)
    return once.writeStream.foreachBatch(detect).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
