"""Incremental publishing (A15 to K10): event files to a published calendar.

Each micro-batch of newly arrived event files is classified, and what is accepted
and not yet on the calendar is uploaded and published. Posts and locations are
Parquet tables with one partition per batch; a batch reads only the partitions
of earlier batches and overwrites its own, so a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import models as J
from ..operators import rules as D
from ..operators.shaping import EVENT_SCHEMA
from ..plans.jobs import POSTS, upload_publish_job

LOCATIONS = "id bigint, name string"


def _table(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """Rows of the batches before ``before``; the table starts with an empty batch."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{path}/batch_id=-1")
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path).where(F.col("batch_id") < before).drop("batch_id")


def publish_batch(events: DataFrame, batch_id: int, base: str, model) -> dict:
    """One batch's events onto the calendar under ``base``; returns the outcome."""
    spark = events.sparkSession
    posts = _table(spark, f"{base}/posts", POSTS, batch_id)
    places = _table(spark, f"{base}/locations", LOCATIONS, batch_id)
    done = upload_publish_job(D.accepted(J.classify(events, model)), posts, places)
    done["new_posts"].write.mode("overwrite").parquet(f"{base}/posts/batch_id={batch_id}")
    new_places = done["locations"].join(places.select("name"), "name", "left_anti").select("id", "name")
    new_places.write.mode("overwrite").parquet(f"{base}/locations/batch_id={batch_id}")
    return done["outcome"]


def publish_increment(spark: SparkSession, in_dir: str, base: str, checkpoint: str, model, fmt: str = "json",
                      max_files: int | None = None) -> list[dict]:
    """Publish the event files under ``in_dir`` that no earlier run has taken;
    returns one outcome per batch."""
    reader = spark.readStream.schema(EVENT_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    outcomes = []
    query = (reader.format(fmt).load(in_dir).writeStream
             .foreachBatch(lambda batch, batch_id: outcomes.append(publish_batch(batch, batch_id, base, model)))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return outcomes
