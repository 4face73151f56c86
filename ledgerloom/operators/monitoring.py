"""Baselines, anomalies and alerts of run metrics."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from .aggregates import grouped_percentiles

METRICS = ["records_processed", "processing_time_seconds", "memory_usage_mb", "cpu_usage_percent", "error_count", "success_rate", "latency_ms", "throughput_records_per_sec", "data_quality_score"]
CHECKED = ["processing_time_seconds", "memory_usage_mb", "cpu_usage_percent", "error_count", "success_rate", "latency_ms", "data_quality_score"]


def long_metrics(metrics: DataFrame, cols: list[str], keys: list[str]) -> DataFrame:
    """A row for each metric of each run."""
    return metrics.select(*keys, F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in cols])))


def metric_baseline(metrics: DataFrame, cols: list[str] | None = None, pipeline: str = "pipeline_name", quartiles: bool = True) -> DataFrame:
    """(pipeline, metric): mean, population std, min, max, and exact q25 and q75 if asked. A pipeline with most of the runs
    is spread over tasks like others."""
    long = long_metrics(metrics, [c for c in cols or METRICS if c in metrics.columns], [pipeline])
    facts = long.groupBy(pipeline, "metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max"))
    if not quartiles:
        return facts
    q = grouped_percentiles(long, [pipeline, "metric"], "value", [0.25, 0.75]).withColumnsRenamed({pipeline: "_p", "metric": "_m"})
    both = facts.join(q, F.col(f"`{pipeline}`").eqNullSafe(F.col("_p")) & (F.col("metric") == F.col("_m")), "left")
    return both.select(pipeline, "metric", "mean", "std", "min", "max", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q75"))


def metric_anomalies(metrics: DataFrame, baseline: DataFrame, cols: list[str] | None = None, pipeline: str = "pipeline_name", timestamp: str = "timestamp") -> DataFrame:
    """Values outside mean ± 2 std; medium, from 2.5 high, from 3 critical; with the range and an action."""
    long = long_metrics(metrics, [c for c in cols or CHECKED if c in metrics.columns], [pipeline, timestamp])
    both = long.join(baseline.select(pipeline, "metric", "mean", "std"), [pipeline, "metric"])
    off = F.abs(F.col("value") - F.col("mean"))
    above = F.col("value") > F.col("mean")
    action = (
        F.when((F.col("metric") == "processing_time_seconds") & above, "tune queries and resources").when((F.col("metric") == "memory_usage_mb") & above, "look for leaks")
        .when((F.col("metric") == "error_count") & above, "read the error logs").when((F.col("metric") == "success_rate") & ~above, "look into failed runs").otherwise("look into the cause")
    )
    found = both.filter(off > 2 * F.col("std"))
    return found.select(pipeline, timestamp, "metric", "value", (F.col("mean") - 2 * F.col("std")).alias("low"), (F.col("mean") + 2 * F.col("std")).alias("high"), F.when(off > 3 * F.col("std"), "critical").when(off > 2.5 * F.col("std"), "high").otherwise("medium").alias("severity"), action.alias("action"))


def run_anomalies(metrics: DataFrame, cols: list[str], share: float = 0.1, isolated: bool = False) -> DataFrame:
    """anomaly_distance (root of the sum of squared standard scores) and is_anomaly above its (1 - share) percentile; or
    anomaly_score and is_anomaly by an isolation forest."""
    from .forests import flag_isolated
    from .ml import flag_outliers

    return flag_isolated(metrics, cols, share) if isolated else flag_outliers(metrics, cols, share, "is_anomaly", "anomaly_distance")


def alerts(metrics: DataFrame, anomalies: DataFrame | None = None, pipeline: str = "pipeline_name", timestamp: str = "timestamp") -> DataFrame:
    """(pipeline, timestamp, alert_type, severity, value): success under 0.8, latency over 10 s, memory over 1000 MB,
    and anomalies that are high or critical."""
    rules = [("critical_error_rate", "success_rate", F.col("success_rate") < 0.8), ("high_latency", "latency_ms", F.col("latency_ms") > 10_000), ("memory_spike", "memory_usage_mb", F.col("memory_usage_mb") > 1000)]
    found = F.array_compact(F.array(*[F.when(on, F.struct(F.lit(n).alias("alert_type"), F.lit("high").alias("severity"), F.col(c).cast("double").alias("value"))) for n, c, on in rules]))
    out = metrics.select(pipeline, timestamp, F.inline(found))
    if anomalies is None:
        return out
    return out.unionByName(anomalies.filter(F.col("severity").isin("high", "critical")).select(pipeline, timestamp, F.lit("anomaly_detected").alias("alert_type"), "severity", "value"))


def run_metrics(df: DataFrame, name: str, started: float, ended: float, bad: str = "false") -> DataFrame:
    """One row of a job's output: rows, error rows, seconds, success rate and throughput, by one aggregate over a table
    that is there; `write_measured` takes them from the write."""
    return df.agg(F.count("*").alias("records_processed"), F.count_if(F.expr(bad)).alias("error_count")).select(*metric_columns(name, ended - started))


def metric_columns(name: str, seconds: float) -> list[Column]:
    """A job's metrics from records_processed and error_count."""
    n, errors, seconds = F.col("records_processed"), F.col("error_count"), max(seconds, 1e-9)
    return [F.lit(name).alias("pipeline_name"), n, errors, F.lit(seconds).alias("processing_time_seconds"), F.when(n > 0, (n - errors) / n).otherwise(1.0).alias("success_rate"), (n / F.lit(seconds)).alias("throughput_records_per_sec")]


def write_measured(spark: SparkSession, build: Callable[[SparkSession], DataFrame], path: str, name: str, bad: str = "false", mode: str = "errorifexists") -> DataFrame:
    """Writes what `build(session)` gives as Parquet, and returns the job's metrics as run_metrics() does. They are observed
    while the rows are written, so nothing is read twice.

    The job runs in a session of its own with this one's settings (temporary views are not shared): in Spark 4.1 a session
    that has been observed can no longer send fitted forests to its executors.
    """
    own, seen = spark.newSession(), Observation(name)
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    began = time.perf_counter()
    build(own).observe(seen, F.count(F.lit(1)).alias("records_processed"), F.count_if(F.expr(bad)).alias("error_count")).write.mode(mode).parquet(path)
    seconds, facts = time.perf_counter() - began, seen.get
    one = spark.range(1).select(F.lit(facts["records_processed"]).cast("long").alias("records_processed"), F.lit(facts["error_count"]).cast("long").alias("error_count"))
    return one.select(*metric_columns(name, seconds))
