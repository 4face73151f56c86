"""Structured Streaming jobs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_latest
from ..operators.scoring import ScoringRule, score_rules
from ..sources import versions


def event_stream(spark: SparkSession, path: str, schema: T.StructType | str, key: str = "event_id", timestamp: str = "ts", late: str = "24 hours", fmt: str = "parquet", files_per_trigger: int | None = None) -> DataFrame:
    """Events from files as they come, once a key within the bound of lateness; later ones go."""
    reader = spark.readStream.format(fmt).schema(schema)
    reader = reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader
    return reader.load(path).withColumn(timestamp, F.col(timestamp).cast("timestamp")).withWatermark(timestamp, late).dropDuplicatesWithinWatermark([key])


def windowed_metrics(metrics: DataFrame, value: str, pipeline: str, timestamp: str, window: str = "1 minute", late: str | None = "10 minutes") -> DataFrame:
    """(pipeline, start, n, mean) of each window; on a stream with a watermark, on a table without."""
    source = metrics.withWatermark(timestamp, late) if metrics.isStreaming and late else metrics
    return source.groupBy(F.col(pipeline).alias("pipeline"), F.window(timestamp, window).alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean_value")).select("pipeline", F.col("w.start").alias("start"), "n", "mean_value")


def monitor_stream(metrics: DataFrame, baseline: DataFrame, value: str, pipeline: str, timestamp: str, window: str = "1 minute", late: str | None = "10 minutes") -> DataFrame:
    """Windows whose mean is outside the baseline's mean ± 2 std; baseline: (pipeline, mean, std), a static table."""
    means = windowed_metrics(metrics, value, pipeline, timestamp, window, late)
    off = F.abs(F.col("mean_value") - F.col("mean"))
    return means.join(baseline, "pipeline").filter(off > 2 * F.col("std")).select("pipeline", "start", "n", "mean_value", F.when(off > 3 * F.col("std"), "critical").when(off > 2.5 * F.col("std"), "high").otherwise("medium").alias("severity"))


def score_stream(leads: DataFrame, rules: list[ScoringRule], as_of, least: float = 70) -> DataFrame:
    """Leads with their score, those from `least` on."""
    return score_rules(leads, rules, as_of).filter(F.col("score") >= least)


def latest_stream(leads: DataFrame, key: str, date: str, tie: list[str], target: str, checkpoint: str, part_rows: int = versions.PART_ROWS) -> StreamingQuery:
    """The newest row of each key over all micro-batches, kept at `target` as a table in versions.

    A batch is merged into the parts that it has keys of. The checkpoint's own id and the batch's number stand in the
    version, so a batch that is run again changes nothing, and a stream with another checkpoint continues the table.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        newest = lambda old, new: dedup_latest(old.unionByName(new), key, date, tie)
        versions.merge(spark, target, batch, key, newest, stream_id(spark, checkpoint), number, part_rows)

    return leads.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a stream when its checkpoint is made."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def latest_table(spark: SparkSession, target: str) -> DataFrame:
    """The newest version of all parts."""
    return versions.read_version(spark, target)
