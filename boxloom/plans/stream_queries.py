"""Queries that run a stream over the landed tables to its end, and a scorer over all scenes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom import vocabulary as V
from boxloom.cluster import fresh_path
from boxloom.operators import scoring
from boxloom.plans.box_queries import nms_oracle
from boxloom.plans.catalog import query
from boxloom.plans.inputs import Inputs
from boxloom.plans.oracle_inputs import compose
from boxloom.streaming import ingest

TARGET, TARGET_STEPS = 60, 150


def _events(i: Inputs):
    schema = i.table("events").schema
    # a glob, so that the table may be one file or a folder of files
    raw = ingest.landed(i.spark, f"{i.folder}/events.parque[t]", schema)
    return raw.select(
        F.col("event_id").alias("arrival_id"), "ts", F.col("event_type").alias("label"),
        F.md5(F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"))).alias("content_key"))


@query("stream_dedupe", compose(["arrivals"], "select distinct content_key from arrivals"))
def stream_dedupe(i: Inputs):
    out, checkpoint = fresh_path(i.spark, "stream"), fresh_path(i.spark, "stream-state")
    keys = ingest.seen_once(_events(i).select("content_key", "arrival_id"))
    run = (keys.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    return i.spark.read.schema("content_key string").parquet(out)


@query("stream_quota", compose(["arrivals"], f"""
select label, least({TARGET}, count(distinct content_key)) as accepted, count(distinct content_key) >= {TARGET} as completed
from arrivals group by label"""))
def stream_quota(i: Inputs):
    table, checkpoint = fresh_path(i.spark, "accepted"), fresh_path(i.spark, "accepted-state")
    ingest.collect_until_full(_events(i), table, checkpoint, TARGET).awaitTermination()
    accepted = i.spark.read.schema(f"{ingest.ACCEPTED}, {ingest.FILED}").parquet(table)
    counts = accepted.groupBy("label").agg(F.count(F.lit(1)).alias("accepted"))
    return counts.withColumn("completed", F.col("accepted") >= TARGET)


@query("stream_progress", compose(["arrivals"], f"""
select step, class_id, label, count, count - coalesce(lag(count) over (partition by label order by step), 0) as gained, count >= {TARGET_STEPS} as completed
from (select step, class_id, label, least({TARGET_STEPS}, count(distinct content_key) filter (where arrival_id % 3 < step)) as count
  from arrivals, range(1, 4) s(step), (select label, row_number() over (order by label) - 1 as class_id from (select distinct label from arrivals)) c using (label)
  group by all)""".replace("from arrivals, range(1, 4) s(step), (", "from arrivals cross join range(1, 4) s(step) join (")))
def stream_progress(i: Inputs):
    """Arrivals land in three parts, each picked up by a restart of the stream; what every class has after each of them."""
    table, checkpoint, landing = (fresh_path(i.spark, n) for n in ("accepted", "accepted-state", "landing"))
    rows = i.table("events").select(
        F.col("event_id").alias("arrival_id"), "ts", F.col("event_type").alias("label"),
        F.md5(F.concat_ws("|", F.col("user_id").cast("string"), F.col("event_type"))).alias("content_key"))
    for part in range(3):
        rows.where(F.col("arrival_id") % 3 == part).write.mode("append").parquet(landing)
        ingest.collect_until_full(ingest.landed(i.spark, landing, rows.schema), table, checkpoint, TARGET_STEPS).awaitTermination()
    labels = rows.select("label").distinct().withColumn("class_id", (F.row_number().over(W.orderBy("label")) - 1).cast("long"))
    return ingest.progress_by_batch(i.spark, table, labels, TARGET_STEPS)


def stub_scorer():
    """A stand-in detector: box, score and text follow from the image id and the prompt."""
    names = [V.PHRASES[n] for n in V.REVIEW_CLASSES]

    def score(images: pd.DataFrame) -> pd.DataFrame:
        key = images["image_id"].to_numpy()
        joint = (images["prompt"] == V.FULL_PROMPT).to_numpy()
        k, n = np.repeat(key, 2), np.tile([0, 1], len(key))
        text = [names[v] for v in (k * 7 + n * 3) % 20]
        return pd.DataFrame({
            "image_id": k, "pos": n, "raw_label": text, "score": np.where(np.repeat(joint, 2), 0.25, 0.2) + (k + n) % 8 * 0.0625,
            "x1": (k % 4) * 128.0, "y1": n * 64.0, "x2": (k % 4) * 128.0 + 256.0, "y2": n * 64.0 + 128.0 + (k % 3) * 64.0,
        })

    return score


SCORED_SQL = {
    "first_pass": f"""select image_id, n as pos, ({[n for n in V.REVIEW_CLASSES]})[(image_id * 7 + n * 3) % 20 + 1] as label,
        0.25::double + (image_id + n) % 8 * 0.0625::double as score, 'full_prompt' as source, (image_id % 4) * 128.0::double as x1, n * 64.0::double as y1,
        (image_id % 4) * 128.0::double + 256.0::double as x2, n * 64.0::double + 128.0::double + (image_id % 3) * 64.0::double as y2
      from scenes, range(0, 2) r(n) where 0.25::double + (image_id + n) % 8 * 0.0625::double > 0.28""",
    "missing": """select image_id, expected_class from scenes s where not exists
      (select 1 from first_pass f where f.image_id = s.image_id and f.label = s.expected_class)""",
    "unioned": """select image_id, pos, label, score, source, x1, y1, x2, y2 from first_pass union all
      select image_id, n + (1::bigint << 40), expected_class, 0.2::double + (image_id + n) % 8 * 0.0625::double, 'expected_fallback',
        (image_id % 4) * 128.0::double, n * 64.0::double, (image_id % 4) * 128.0::double + 256.0::double, n * 64.0::double + 128.0::double + (image_id % 3) * 64.0::double
      from missing, range(0, 2) r(n) where 0.2::double + (image_id + n) % 8 * 0.0625::double > 0.22""",
}


@query("two_pass_scoring", nms_oracle(["scenes"], "unioned", "select image_id, label, score, pos, source from kept", SCORED_SQL))
def two_pass_scoring(i: Inputs):
    """All scenes through a stand-in detector, misses through the per-class prompt, then suppression."""
    return scoring.two_pass(i.scenes(), stub_scorer, max_images=512, max_pixels=400_000_000).select("image_id", "label", "score", "pos", "source")
