"""From cleaned canonical tables to the unified telemetry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultweave.functions import features


def join_spans(tables: dict[str, DataFrame]) -> DataFrame:
    """Inner joins on span_id.

    The cleaned tables leave their deduplication partitioned by span_id, so these
    joins add no exchange.
    """
    joined = tables["trace_service_name"]
    for name in ("trace_response_times", "trace_request_times", "status_codes"):
        joined = joined.join(tables[name], "span_id", "inner")
    return joined


def resource_minute_avg(resources: DataFrame) -> DataFrame:
    """Mean cpu and memory per pod and minute."""
    return resources.groupBy(
        "pod_id", F.date_trunc("minute", F.col("ts")).alias("metric_minute")
    ).agg(
        F.avg("cpu_usage_mcores").alias("cpu_usage_mcores"),
        F.avg("memory_usage_mb").alias("memory_usage_mb"),
    )


def join_resources(spans: DataFrame, resources: DataFrame) -> DataFrame:
    """Attach the minute average of the span's pod; the number of spans does not change.

    No broadcast hint: the averages grow with pods and time. The right side is
    unique on the join key, so where one pod-minute holds much of the traffic
    adaptive execution can split the span side of the left join.
    """
    usage = resource_minute_avg(resources).withColumnRenamed("pod_id", "_pod")
    minute = F.date_trunc("minute", F.col("start_time_ts"))
    matched = (F.col("pod_id") == F.col("_pod")) & (F.col("_minute") == F.col("metric_minute"))
    return (
        spans.withColumn("_minute", minute)
        .join(usage, matched, "left")
        .drop("_pod", "_minute", "metric_minute")
    )


def engineer_features(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_failure": features.is_failure(F.col("status_code")),
            "is_latency_spike": features.is_latency_spike(F.col("response_time_ms")),
            "latency_bucket": features.latency_bucket(F.col("response_time_ms")),
            "error_category": features.error_category(F.col("status_code")),
            "hour_of_day": F.hour("start_time_ts"),
            "cpu_memory_ratio": features.cpu_memory_ratio(
                F.col("cpu_usage_mcores"), F.col("memory_usage_mb")
            ),
        }
    )
