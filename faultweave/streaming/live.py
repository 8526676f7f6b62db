"""Anomaly scores and failure chains over a stream of telemetry.

Both are windowed aggregations in append mode: a window's rows come out once, when the
watermark has passed it, and are then what the batch operators give for the same spans. Rows
that arrive in any order within `late` are counted; later ones are dropped by Spark, which
counts them in the query's progress. The state is what open windows hold, so it doesn't grow
with the stream. The caller chooses source and sink; `publish` runs a stream to files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from faultweave.config import DEFAULTS, Settings
from faultweave.functions import numbers
from faultweave.operators import anomalies
from faultweave.operators.callgraph import slice_seconds

LATE = "10 minutes"


def live_series(spans: DataFrame, window_minutes: int = DEFAULTS.bucket_minutes, late: str = LATE) -> DataFrame:
    """`anomalies.error_rate_timeseries` of a stream: every bucket once, when it is closed."""
    bucket = F.window("start_time_ts", f"{window_minutes} minutes").alias("_bucket")
    series = (
        spans.withWatermark("start_time_ts", late)
        .groupBy("service_name", bucket)
        .agg(*anomalies.bucket_figures())
        .withColumn("time_bucket", F.col("_bucket.start"))
        .drop("_bucket")
    )
    return series.withColumn("error_rate", numbers.rate(F.col("error_count"), F.col("total_requests")))


def live_scores(
    spans: DataFrame, baseline: DataFrame, settings: Settings = DEFAULTS, late: str = LATE
) -> DataFrame:
    """Scores and objective breaches of each closed bucket.

    `baseline`: `anomalies.baseline_stats` of past buckets, a row per service, best a written
    table. It is read anew for every batch, so a baseline learned meanwhile takes effect. A
    service without baseline is judged by the fixed objectives alone.
    """
    series = live_series(spans, settings.bucket_minutes, late)
    return anomalies.score_against(series.join(baseline, "service_name", "left"), settings)


def live_chains(spans: DataFrame, window_sec: int = DEFAULTS.chain_window_sec, late: str = LATE) -> DataFrame:
    """`callgraph.propagation_chains` of a stream.

    Windows are the batch operator's time slices, each with the opening of the next one, so
    that the successor of a failure is in its own window whatever the batches were cut into.
    A closed window's failures of one trace, not the trace, are put in order together.
    """
    width = slice_seconds(window_sec)
    slices = F.window("start_time_ts", f"{width + window_sec} seconds", f"{width} seconds").alias("_slice")
    failure = F.struct(F.col("start_time_ts").alias("at"), "span_id", "service_name")
    # All spans move the watermark: a condition on the time itself is not moved before it.
    failed_at = F.when(F.col("is_failure") == 1, F.col("start_time_ts"))
    closed = (
        spans.withWatermark("start_time_ts", late)
        .filter(failed_at.isNotNull())
        .groupBy("trace_id", slices)
        .agg(F.sort_array(F.collect_list(failure)).alias("_rows"))
    )
    following = F.transform(
        F.col("_rows"), lambda row, i: F.struct(row.alias("row"), F.get("_rows", i + 1).alias("next"))
    )
    home = F.unix_timestamp("_slice.start") + width
    lag = F.unix_timestamp("_pair.next.at") - F.unix_timestamp("_pair.row.at")
    return (
        closed.select("trace_id", "_slice", F.explode(following).alias("_pair"))
        .filter(F.unix_timestamp("_pair.row.at") < home)
        .filter(
            (lag <= window_sec) & (F.col("_pair.row.service_name") != F.col("_pair.next.service_name"))
        )
        .select(
            "trace_id",
            F.col("_pair.row.service_name").alias("source_service"),
            F.col("_pair.next.service_name").alias("target_service"),
            F.col("_pair.row.at").alias("source_timestamp"),
            F.col("_pair.next.at").alias("target_timestamp"),
            lag.alias("propagation_lag_sec"),
            F.lit(2).alias("propagation_depth"),
        )
    )


def publish(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived by now to Parquet files, and stop.

    Called again it goes on where it stopped; Spark's file sink writes each batch once, also
    after a failure.
    """
    writer = stream.writeStream.outputMode("append").trigger(availableNow=True)
    return writer.option("checkpointLocation", checkpoint).format("parquet").start(path)
